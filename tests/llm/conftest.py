"""Small tables that hold the awkward cases of every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside.
CLASHES = ("id", "key", "found", "class", "row", "rest", "n", "hashes", "size", "host", "word", "bits", "slot", "code")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


@pytest.fixture(scope="session")
def awkward(spark, texts):
    """Nulls in every column, empty and blank texts, a very long text, repeated rows,
    equal and null ids, and extra columns with clashing names."""
    whole = " ".join(texts.values())
    rows = [
        (1, None, None, None, None), (2, "", "en", "src0", 0), (3, " \n\t ", "de", "src0", 4), (None, "a text without an id at all", "en", "src1", 27),
        (5, whole, "en", "src1", len(whole)), (6, texts[0], "en", "src0", len(texts[0])), (6, texts[0], "en", "src0", len(texts[0])),
        (7, "one id, two texts: the first of them", "en", None, 36), (7, "one id, two texts: quite another one", None, "src0", 36),
        (8, "word", "fr", "src2", 4), (9, "x" * 30_000, "en", "src2", 30_000), (10, "a b c d", "es", "src2", 7),
        (11, "<|endoftext|> 's İSTANBUL \U0001f600\u0301 ß 中文 \x00 \x85end", "en", "src3", 10), (12, texts[0] + " tail", "en", "src0", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
