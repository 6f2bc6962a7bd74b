"""Ranked search against its SQL, a brute-force scorer and an exhaustive evaluation."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sparktrips.llm import queries, ranked_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item, rank, doc, score) rows; ``docs`` and ``items`` are lists of (id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            scored += [(-score, i is None, i)] if score > 0 else []
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    got = queries.op12_ranked_search(spark, SF)
    assert rows(got) == sorted(con.sql(ranked_search.oracle()).fetchall(), key=str)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_awkward_documents_and_items(spark, awkward, texts, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [(1, texts[0]), (1, texts[0]), (1, "one id, TWO texts"), (2, None), (3, ""), (None, "word A b"), (4, "zzzqqq notthere"), (5, "x" * 30_000),
             (6, "İSTANBUL ß 中文 \U0001f600́ a\x00b a\x7fb"), (7, " ".join(list(texts.values())[1:6]))]
    wanted = spark.createDataFrame([(i, t, "extra", "extra") for i, t in items], "item_id bigint, text string, slot string, rank string")
    assert rows(ranked_search.search(awkward, wanted)) == brute(docs, items)
    assert rows(ranked_search.search(nothing, wanted)) == [] == rows(ranked_search.search(awkward, wanted.where("false")))
    assert rows(ranked_search.search(awkward, wanted.where("item_id in (2, 3)"))) == []


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here" if i % 3 else "other words") for i in range(60, 0, -1)] + [(None, "same words here")] * 3 + [(7, "same words here")] * 4
    items = [(1, "same"), (2, "words"), (3, "here here words other")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = rows(ranked_search.search(table, spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == brute(docs, items)


def test_blocks_of_items_give_the_same_rows(spark, documents, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = rows(ranked_search.search(documents, items))
    monkeypatch.setattr(ranked_search, "BLOCK_WORDS", 400)
    assert rows(ranked_search.search(documents, items)) == whole


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_limited_accumulators_lose_nothing(seed):
    """One slice after the other, as a task does, against scores of all documents."""
    draw = np.random.default_rng(seed)
    words = [f"w{i}".encode() for i in range(40)]
    share = 1 / np.arange(1, 41) ** draw.uniform(0.5, 2)
    text = lambda n: b" ".join(draw.choice(words, n, p=share / share.sum()))
    docs = [text(int(draw.integers(0, 30))) for _ in range(300)]
    asked = ranked_search.Queries([text(int(draw.integers(1, 12))) for _ in range(5)])
    known = ranked_search.Statistics(0, 0, np.zeros(len(asked.terms), np.int64))
    whole = ranked_search.Postings(docs, asked.terms)
    known = ranked_search.Statistics(int((whole.n > 0).sum()), int(whole.n.sum()), np.diff(whole.at))
    exact = defaultdict(lambda: np.zeros(len(docs), np.int64))
    impacts = known.impacts(whole)
    for i, query in enumerate(asked.of):
        for t, times in query.items():
            span = slice(whole.at[t], whole.at[t + 1])
            exact[i][whole.docs[span]] += times * known.weight[t] * impacts[span]
    k, stopped = 3, 0
    best = [[] for _ in asked.of]
    for at in range(0, 300, 75):
        part = ranked_search.Postings(docs[at:at + 75], asked.terms)
        worth = known.impacts(part)
        largest = np.array([worth[a:b].max(initial=0) for a, b in zip(part.at, part.at[1:])])
        for i, query in enumerate(asked.of):
            order = sorted(((t, known.weight[t] * n) for t, n in query.items()), key=lambda x: int(known.holding[x[0]]))
            scores = np.zeros(75, np.int64)
            least = sorted(best[i], reverse=True)[k - 1] if len(best[i]) >= k else 0
            chosen = ranked_search.best_documents(part, worth, largest, order, k, least, scores)
            assert (scores[chosen] == exact[i][at + chosen]).all()
            stopped += len(chosen) < (exact[i][at:at + 75] > 0).sum()
            best[i] += scores[chosen].tolist()
    for i in range(len(asked.of)):
        assert sorted((s for s in best[i] if s), reverse=True)[:k] == sorted((s for s in exact[i].tolist() if s), reverse=True)[:k]
