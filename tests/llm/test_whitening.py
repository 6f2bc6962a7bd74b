"""Whitening against a dense eigendecomposition and against whole numbers of any size."""

from __future__ import annotations

import numpy as np
import pytest

from sparktrips.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, n string, d string, x string, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(3)


def usable(rows, d):
    return [(i, np.floor(256 * np.array(v, float))) for i, v in rows
            if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]


def check(got, rows, d, rank, tolerance=1e-6):
    """The rows of a result against the definition, by a dense eigendecomposition."""
    kept = usable(rows, d)
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, total = len(fit), [sum(int(v) for v in c) for c in fit.T]
    mean = np.array([t / n for t in total])
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == len(kept) * min(4, rank)
    expected = sorted((i, k + 1, sum((n * int(a) - t) ** 2 for a, t in zip(x, total)), abs((x - mean) @ vectors[:, k]) / values[k] ** .5)
                      for i, x in kept for k in range(min(4, rank)))
    for row, (i, k, deviation, whitened) in zip(sorted(got, key=lambda r: (r.vec_id, r.component, abs(r.whitened))), expected):
        assert (row.vec_id, row.component, row.n) == (i, k, n)
        assert row.deviation == (deviation if deviation < 1 << 63 else None)
        assert abs(row.whitened) == pytest.approx(whitened, rel=tolerance, abs=tolerance)
        assert row.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-6)
        assert row.identity_error <= 1e-4
    for k in range(min(4, rank)):  # one sign for all rows
        signs = {np.sign(r.whitened * ((x - mean) @ vectors[:, k])) for i, x in kept for r in got if (r.vec_id, r.component) == (i, k + 1) and abs(r.whitened) > 1e-3}
        assert len(signs) == 1


def test_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op13_embedding_whitening(spark, SF).collect(), rows, 64, 64)


@pytest.mark.parametrize("offset, spread", [(0.0, 1.0), (1e6, 1.0), (1e11, 3.0), (0.0, 1e4)])
def test_offsets_and_condition(spark, offset, spread):
    draw = np.random.default_rng(3)
    scales = spread ** -np.arange(5.0) * 1000
    rows = [(i, (offset + draw.normal(size=5) * scales).tolist()) for i in range(300)]
    check(whitening.whiten(table(spark, rows)).collect(), rows, 5, 5, 1e-5)


@pytest.mark.parametrize("rank", [1, 2, 3])
def test_low_rank(spark, rank):
    draw = np.random.default_rng(rank)
    base = draw.integers(-9, 9, (rank, 6))
    rows = [(i, (draw.integers(-50, 50, rank) @ base / 256).tolist()) for i in range(200)]
    check(whitening.whiten(table(spark, rows)).collect(), rows, 6, rank)


def test_awkward_vectors(spark):
    draw = np.random.default_rng(1)
    good = [(i, draw.normal(size=4).tolist()) for i in range(40)]
    same = [(100 + i, good[0][1]) for i in range(60)]  # copies count once in the fit list
    odd = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [1.0, float("nan"), 2.0, 3.0]), (203, [float("inf"), 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0]),
           (5, good[5][1]), (-7, [-0.0, 0.0, -1e-9, 1e-9])]
    rows = good + same + odd
    check(whitening.whiten(table(spark, rows)).collect(), rows, 4, 4)
    ids = [r.vec_id for r in whitening.whiten(table(spark, good + [(None, [0.5, 0.25, 0.0, 1.0])])).collect()]
    assert ids.count(None) == 4


def test_numbers_beyond_64_bits(spark):
    rows = [(i, [3e38 if i == 0 else float(i), float(i * i), 1.0]) for i in range(20)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(20)) and all(r.deviation is None for r in got)
    rows = [(i, [i * 3e5, float(i * i), 1.0]) for i in range(2000)]
    check(whitening.whiten(table(spark, rows)).collect(), rows, 3, 2, 1e-4)


def test_no_components(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(table(spark, rows))
        assert got.collect() == [] and [f.name for f in got.schema][:4] == ["vec_id", "component", "n", "deviation"]
