"""Duration, cleaning chain, splits, golden counts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sparktrips.operators import clean, split
from sparktrips.sources import views
from sparktrips.sources.tables import load_trips, normalize_nan


def test_duration_minutes(raw_trips):
    d = clean.with_trip_duration(raw_trips).select("trip_duration").collect()
    assert [r[0] for r in d] == [20.0] * 10


def test_clean_keeps_nine_of_ten(raw_trips):
    out = clean.clean_trips(raw_trips)
    assert out.count() == 9
    assert "ehail_fee" not in out.columns and "trip_duration" in out.columns


def test_existing_target_not_recomputed(raw_trips):
    df = raw_trips.withColumn("trip_duration", F.lit(5.0))
    assert clean.clean_trips(df).select(F.max("trip_duration")).first()[0] == 5.0


def test_empty_input_passes(spark, raw_trips):
    assert clean.clean_trips(raw_trips.limit(0)).count() == 0


def test_missing_path_raises(spark, tmp_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        load_trips(spark, str(tmp_path / "nope.parquet"))
    with pytest.raises(FileNotFoundError):
        load_trips(spark)


def test_files_with_other_types_and_columns(spark, sf_small, tmp_path):
    """Integer codes, an absent column of the null block, an extra column, no key:
    the same rows are kept as by cleaning the frame itself."""
    import pytest
    trips = views.trips(spark, sf_small)
    wanted = clean.clean_trips(trips.drop("congestion_surcharge")).count()
    odd = trips.drop("congestion_surcharge", "trip_id").withColumns(
        {"passenger_count": F.col("passenger_count").cast("bigint"), "payment_type": F.col("payment_type").cast("int"), "weather": F.lit("dry")})
    path = str(tmp_path / "trips")
    odd.write.parquet(path)
    read = load_trips(spark, path)
    assert dict(read.dtypes)["passenger_count"] == "double" and "weather" in read.columns and "congestion_surcharge" not in read.columns
    assert read.select("trip_id").distinct().count() == trips.count() and 0 < clean.clean_trips(read).count() == wanted
    odd.drop("lpep_pickup_datetime").write.parquet(str(tmp_path / "no-times"))
    with pytest.raises(ValueError, match="lpep_pickup_datetime"):
        load_trips(spark, str(tmp_path / "no-times"))


def test_density_agrees_with_an_exact_kernel_estimate(spark):
    import numpy as np
    from sparktrips.operators import profile
    for n in (500, 8000):
        x = np.random.default_rng(n).gamma(3.0, 4.0, n)
        curve = profile.density_curve(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").orderBy("grid_index").collect()
        h = x.std(ddof=1) * n ** -0.2
        exact = [np.exp(-0.5 * ((r["x"] - x) / h) ** 2).mean() / (h * np.sqrt(2 * np.pi)) for r in curve]
        assert len(curve) == 200 and max(abs(e - r["density"]) for e, r in zip(exact, curve)) < 1e-4


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "x double")
    out = normalize_nan(df)
    assert out.filter(F.col("x").isNull()).count() == 1
    assert out.agg(F.percentile("x", 0.5)).first()[0] == 2.0


def test_golden_counts_sf0001(spark, sf_small):
    trips = views.trips(spark, sf_small)
    rep = {r["stage"]: r["rows"] for r in clean.retention_report(trips).collect()}
    assert rep == {"raw": 6000, "null_block": 5233, "duration": 5115, "distance": 4828}
    blocked = clean.blocked_trips(trips)
    ub = blocked.agg(F.percentile("trip_duration", 0.995)).first()[0]
    assert math.isclose(ub, 34.19733333333334, rel_tol=1e-12)


def test_cleaning_idempotent_apart_from_quantile(spark, sf_small):
    once = clean.clean_trips(views.trips(spark, sf_small))
    twice = clean.clean_trips(once)
    # the second pass recomputes the 0.995 quantile on already-cut data
    assert twice.count() <= once.count()
    assert twice.filter(F.col("trip_duration") <= 0).count() == 0


def test_hash_split_partitions_rows(raw_trips):
    doubled = clean.clean_trips(raw_trips.unionByName(raw_trips))
    labelled = split.hash_split(doubled.withColumn("trip_id", F.monotonically_increasing_id().cast("string")))
    sizes = {r["split"]: r["rows"] for r in split.split_sizes(labelled).collect()}
    assert sum(sizes.values()) == 18


def test_hash_split_share_and_stability(spark):
    df = spark.range(20000).withColumn("trip_id", F.col("id").cast("string"))
    a = split.hash_split(df)
    b = split.hash_split(df.repartition(7))
    share = a.filter(F.col("split") == "test").count() / 20000
    assert abs(share - 0.2) < 0.02
    assert a.join(b, ["trip_id", "split"]).count() == 20000


def test_exact_split_sizes(spark):
    df = spark.range(37535).withColumn("trip_id", F.col("id").cast("string"))
    sizes = {r["split"]: r["rows"] for r in split.split_sizes(split.exact_split(df)).collect()}
    assert sizes == {"train": 22521, "val": 7507, "test": 7507}


def test_approximate_quantile_option(spark, sf_small):
    from sparktrips.config import DEFAULT_SETTINGS
    trips = views.trips(spark, sf_small)
    exact = clean.clean_trips(trips).count()
    approx = clean.clean_trips(trips, DEFAULT_SETTINGS.with_(quantile_accuracy=100000)).count()
    assert abs(exact - approx) <= 5


def test_exact_split_equals_an_order_of_hashes(spark):
    """Against md5 in Python, on unique keys, keys with copies that a cut tears, and few rows."""
    import hashlib
    from sparktrips.config import DEFAULT_SETTINGS as s
    h = lambda k: int(hashlib.md5(f"{k}:{s.random_state}".encode()).hexdigest()[:8], 16)
    for keys in ([str(i) for i in range(3001)], [str(i % 40) for i in range(1000)], ["same"] * 55, ["a"], [], [str(i) for i in range(4)]):
        order = sorted(keys, key=lambda k: (h(k), k))
        n_test = math.ceil(len(keys) * s.test_size)
        n_val = math.ceil((len(keys) - n_test) * s.val_size)
        expected = sorted(zip(order, ["test"] * n_test + ["val"] * n_val + ["train"] * len(keys)))
        df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "trip_id string, x int").repartition(3)
        got = split.exact_split(df)
        assert sorted((r["trip_id"], r["split"]) for r in got.collect()) == expected
        assert sorted(r["x"] for r in got.collect()) == list(range(len(keys)))
