"""Selection: quantiles and moments against numpy, on ties, few and many rows, and hot groups."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktrips.operators import profile, quantiles

PCTS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.995, 1.0]


def samples():
    draw = np.random.default_rng(7)
    return {
        "continuous": draw.normal(size=60_000),
        "ties": draw.integers(0, 40, 50_000) / 4,
        "one value": np.full(30_000, 2.5),
        "two values": np.repeat([1.0, 9.0], [25_000, 25_001]),
        "heavy tail": np.exp(draw.normal(size=40_000) * 4),
        "few": draw.normal(size=7),
        "at the limit": draw.normal(size=quantiles.ACCURACY + 1),
        "single": np.array([3.0]),
    }


@pytest.mark.parametrize("name", list(samples()))
def test_quantiles_of_a_column(spark, name):
    x = samples()[name]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 3, "v double").repartition(7)
    got = quantiles.statistics(df, [F.col("v"), -F.col("v"), F.lit(None).cast("double")], PCTS).orderBy("ordinal").collect()
    assert got[0]["q"] == pytest.approx(np.quantile(x, PCTS), rel=1e-12, abs=1e-12)
    assert got[1]["q"] == pytest.approx(np.quantile(-x, PCTS), rel=1e-12, abs=1e-12)
    assert got[0]["count"] == len(x) and got[0]["mean"] == pytest.approx(x.mean()) and (got[0]["min"], got[0]["max"]) == (x.min(), x.max())
    assert got[0]["std"] == (pytest.approx(x.std(ddof=1), abs=1e-9) if len(x) > 1 else None)
    assert got[2]["count"] == 0 and got[2]["q"] is None
    assert quantiles.quantile(df, F.col("v"), 0.995).first()[0] == pytest.approx(np.quantile(x, 0.995), rel=1e-12)


def test_quantiles_of_groups(spark):
    """One group holds a third of all rows, one a single row, one has a null key."""
    x = samples()
    groups = {"hot": x["continuous"], "ties": x["ties"], None: x["heavy tail"], "few": x["few"], "single": x["single"]}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in quantiles.grouped_statistics(df, F.col("v"), PCTS, {"g": F.col("g")}).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g]["q"] == pytest.approx(np.quantile(values, PCTS), rel=1e-12, abs=1e-12) and got[g]["count"] == len(values)


def test_only_values_around_the_ranks_are_ordered(spark):
    """Cells of a column: the brackets' distinct values and the gaps, not all values."""
    x = samples()["continuous"]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    whole = df.agg(quantiles._summary(F.col("v"), [0.5, 0.95]).alias("whole")).first()["whole"]
    low = [b["low"] for b in whole["brackets"]]
    inside = sum(((x >= b["low"]) & (x <= b["high"])).sum() for b in whole["brackets"])
    assert low == sorted(low) and inside <= 2 * 3 * quantiles.SLACK * len(x)


def test_empty_column(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles.quantile(df, F.col("v"), 0.5).first()[0] is None
    assert profile.iqr_bounds(df, "v").count() == 0
    assert quantiles.grouped_statistics(df, F.col("v"), [0.5], {"g": F.lit(1)}).count() == 0


def test_correlations_by_co_moments(spark):
    draw = np.random.default_rng(1)
    n = 20_000
    a = draw.normal(size=n) + 1e6  # a mean far above the spread
    b = 0.3 * a + draw.normal(size=n)
    c = np.where(draw.random(n) < 0.2, np.nan, draw.normal(size=n) + b)
    rows = [(float(x), float(y), None if np.isnan(z) else float(z), 0.1, None) for x, y, z in zip(a, b, c)]
    df = spark.createDataFrame(rows, "a double, b double, c double, one double, none double")
    both = ~np.isnan(c)
    expected = {("a", "b"): np.corrcoef(a, b)[0, 1], ("a", "c"): np.corrcoef(a[both], c[both])[0, 1], ("a", "a"): 1.0, ("a", "one"): None, ("one", "one"): None}
    for parts in (1, 7):
        got = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.corr_long(df.repartition(parts), [*expected, ("a", "none")]).collect()}
        assert {k: got[k] for k in expected} == {k: None if v is None else pytest.approx(v, abs=2e-6) for k, v in expected.items()}
