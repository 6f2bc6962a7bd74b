"""The corpus pipeline against a brute-force version, and the wiring of all queries."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from test_text_models import groups, plain_words, shingles
from test_rules import spans
from tokenizers import Tokenizer

from sparktrips.llm import queries, secret_scan

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark, documents):
    docs, columns = documents, documents.columns
    for (name, stage), following in zip(corpus_pipeline.STAGES[:4], corpus_pipeline.STAGES[1:]):
        after = stage(spark, docs, SF)
        assert after.columns == columns and after.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = after.cache()
    kept = {r.doc_id: r for r in docs.collect()}
    rows = documents.orderBy("doc_id").collect()
    sets = [shingles(r.text) for r in rows]
    first = [r for r, g, i in zip(rows, groups(sets), range(len(rows))) if g == i]
    items = [plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in first if not any(item == w[i:i + len(item)] for w in [plain_words(r.text)] for item in items for i in range(len(w)))]
    assert set(kept) == {r.doc_id for r in clean}
    for r in clean:
        x = kept[r.doc_id]
        assert (x.lang, x.source, x.n_chars) == (r.lang, r.source, len(x.text))
        assert not spans(x.text) and (x.text == r.text) == (not spans(r.text))


def test_run_packs_what_the_stages_keep(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
    wanted = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = defaultdict(int)
    for p in pieces:
        got[p.doc_id] += p.length
        assert p.doc_tokens == wanted[p.doc_id]
    assert got == wanted


def test_pipeline_on_awkward_tables(spark, awkward, nothing):
    for table in (awkward, nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF).cache()
            assert docs.columns == table.columns
        corpus_pipeline.STAGES[4][1](spark, docs, SF).count()
    repeated = corpus_pipeline.drop_near_duplicates(spark, awkward, SF).groupBy("doc_id").count()
    assert {r.doc_id: r["count"] for r in repeated.collect() if r.doc_id in (6, 7, 12)}.items() >= {6: 1, 7: 2}.items()


def test_names():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 11)), "pipeline"} and set(queries.oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "secret_scan", "packing"]
    assert secret_scan.RULES[:3] == tuple(r for r in secret_scan.RULES if r.base)
