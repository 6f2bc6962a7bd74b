"""Flag encoding, record normalisation and the vocabulary."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sparktrips.config import ORDERED_FEATURE_NAMES
from sparktrips.operators import features


@pytest.mark.parametrize("value,expected", [
    ("Y", 1), ("y", 1), ("N", 0), ("n", 0), (None, 0), ("", 0), ("UNKNOWN", 0), (" y ", 1),
])
def test_flag_string_column(spark, value, expected):
    df = spark.createDataFrame([(value,)], "store_and_fwd_flag string")
    assert features.encode_flag_column(df).first()["store_and_fwd_flag_encoded"] == expected


@pytest.mark.parametrize("value,dtype,expected", [
    (1, "int", 1), (0, "int", 0), (True, "boolean", 1), (False, "boolean", 0), (None, "int", 0),
])
def test_flag_typed_column(spark, value, dtype, expected):
    df = spark.createDataFrame([(value,)], f"store_and_fwd_flag {dtype}")
    assert features.encode_flag_column(df).first()["store_and_fwd_flag_encoded"] == expected


@pytest.mark.parametrize("value,expected", [
    ("Y", 1), ("y", 1), ("N", 0), ("n", 0), (1, 1), (0, 0), (True, 1), (False, 0), (None, 0), ("", 0),
    ("UNKNOWN", 0),
])
def test_flag_in_records(spark, value, expected):
    df = spark.createDataFrame([(json.dumps({"store_and_fwd_flag": value}),)], "payload string")
    out = features.prepare_features(df).first()
    assert out["store_and_fwd_flag_encoded"] == expected


def _norm(spark, record):
    df = spark.createDataFrame([(json.dumps(record),)], "payload string")
    return features.prepare_features(df).first().asDict()


def test_record_without_flag_defaults_to_zero(spark):
    out = _norm(spark, {"trip_distance": 2.5, "fare_amount": 10})
    assert out["store_and_fwd_flag_encoded"] == 0
    assert out["trip_distance"] == 2.5 and out["fare_amount"] == 10.0


def test_record_zero_distance_kept(spark):
    out = _norm(spark, {"trip_distance": 0.0, "store_and_fwd_flag": "N"})
    assert out["trip_distance"] == 0.0 and out["store_and_fwd_flag_encoded"] == 0


def test_record_pu_do_explicit_and_derived(spark):
    assert _norm(spark, {"PU_DO": "9999_8888"})["PU_DO"] == "9999_8888"
    assert _norm(spark, {"PULocationID": 9999, "DOLocationID": 8888})["PU_DO"] == "9999_8888"
    assert _norm(spark, {"PULocationID": 9999})["PU_DO"] is None


def test_record_unknown_keys_dropped_and_numeric_strings(spark):
    out = _norm(spark, {"store_and_fwd_flag": "Y", "trip_distance": "3.5", "fare_amount": 14.5, "unknown": 1})
    assert "unknown" not in out
    assert out["store_and_fwd_flag_encoded"] == 1 and out["trip_distance"] == 3.5 and out["fare_amount"] == 14.5


def test_explicit_encoded_flag_wins(spark):
    assert _norm(spark, {"store_and_fwd_flag": "N", "store_and_fwd_flag_encoded": 1})["store_and_fwd_flag_encoded"] == 1


def test_encode_features_drops_excluded_keeps_unknown(spark, raw_trips):
    out = features.encode_features(raw_trips.withColumn("extra_col", F.lit(7)))
    cols = set(out.columns)
    assert "store_and_fwd_flag" not in cols and "VendorID" not in cols and "ehail_fee" not in cols
    assert "extra_col" in cols and "store_and_fwd_flag_encoded" in cols


def test_feature_columns_order_and_missing(spark):
    df = spark.createDataFrame([(3.5,)], "trip_distance double")
    out = features.feature_columns(df)
    assert out.columns == ORDERED_FEATURE_NAMES
    row = out.first()
    assert row["trip_distance"] == 3.5 and row["fare_amount"] == 0.0


def test_vocabulary_unseen_category_keeps_width(spark):
    train = spark.createDataFrame([(100.0, 10.0, "100_101"), (200.0, 20.0, "100_102")],
                                  "trip_distance double, fare_amount double, PU_DO string")
    model = features.fit_dict_vectorizer(train, ["fare_amount", "trip_distance"], ["PU_DO"])
    assert model.vocabulary == ["PU_DO=100_101", "PU_DO=100_102", "fare_amount", "trip_distance"]
    test = spark.createDataFrame([(5.0, 1.0, "999_999")], "trip_distance double, fare_amount double, PU_DO string")
    v = model.transform(test).first()["features"]
    assert v.size == 4
    assert list(v.toArray()) == [0.0, 0.0, 1.0, 5.0]
    seen = model.transform(train).orderBy("trip_distance").first()["features"]
    assert list(seen.toArray()) == [1.0, 0.0, 10.0, 100.0]


def test_vocabulary_of_numbers_only_and_unseen_numbers(spark):
    train = spark.createDataFrame([(1.0, 2.0, None), (3.0, 4.0, None)], "b double, a double, c double")
    model = features.fit_dict_vectorizer(train, ["a", "b", "c"], [])
    assert model.vocabulary == ["a", "b"]
    assert [list(r["features"].toArray()) for r in model.transform(train).collect()] == [[2.0, 1.0], [4.0, 3.0]]


def test_vocabulary_has_a_limit(spark):
    import pytest
    df = spark.range(20).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError):
        features.fit_vocabulary(df, [], ["c"], most=10)


def test_flag_ignores_all_white_space(spark):
    from sparktrips.functions.columns import encode_flag_string
    rows = [("Y\t", 1), ("\n y ", 1), ("N", 0), ("Y Y", 0), (None, 0)]
    df = spark.createDataFrame(rows, "f string, e int")
    assert df.where(encode_flag_string("f") != F.col("e")).count() == 0


def test_records_are_decoded_once_for_all_keys(spark):
    rows = [(1, '{"trip_distance": "1_0", "store_and_fwd_flag_encoded": 1}'), (2, '{"trip_distance": "x"}'), (3, "[1]"), (4, None), (5, '{"tip_amount": null}')]
    df = features.prepare_features(spark.createDataFrame(rows, "pos int, payload string"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    got = {r["pos"]: r for r in df.collect()}
    assert sorted(got) == [1, 3, 4] and got[1]["trip_distance"] == 10.0 and got[1]["store_and_fwd_flag_encoded"] == 1
