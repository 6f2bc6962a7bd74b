"""The record path inside the saved model."""

from __future__ import annotations

import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, ORDERED_FEATURE_NAMES
from sparktrips.operators import clean, features, model
from sparktrips.operators.stages import RecordFeatures
from sparktrips.session import scratch_path
from sparktrips.sources import views

RECORDS = [
    '{"trip_distance": 2.5, "fare_amount": "12.5", "store_and_fwd_flag": "y"}', '{"trip_distance": 1, "store_and_fwd_flag": true, "tip_amount": 1}',
    '{"trip_distance": "abc"}', '{"fare_amount": null}', "[1, 2]", '{}', '{"store_and_fwd_flag_encoded": 1, "unknown": "x"}',
]


@pytest.mark.parametrize("kind", ["linear_regression", "random_forest"])
def test_a_reloaded_pipeline_scores_raw_records_and_raw_tables(spark, sf_small, kind):
    s = DEFAULT_SETTINGS.with_(n_estimators=3, max_depth=5)
    raw = views.trips(spark, sf_small)
    train = model.training_frame(clean.clean_trips(raw))
    fitted = model.train_pipeline(train, model.create_model(kind, s), s)
    path = scratch_path(spark, f"whole-{kind}")
    model.save_model(fitted, path)
    again = PipelineModel.load(path)
    # raw trips: the same as the encoded, filled table
    one = {r["trip_id"]: r["prediction"] for r in again.transform(raw).select("trip_id", "prediction").collect()}
    two = {r["trip_id"]: r["prediction"] for r in fitted.transform(model.training_frame(clean.with_trip_duration(raw))).collect()}
    assert one == two and len(one) > 1000
    # raw records: the same as the normalised ones
    records = spark.createDataFrame(list(enumerate(RECORDS)), "n int, payload string").withColumn("errors", F.lit("mine"))
    got = {r["n"]: r["prediction"] for r in again.transform(records).collect()}
    norm = features.prepare_features(records.drop("errors"))
    assert got == {r["n"]: r["prediction"] for r in model.score(fitted, norm.drop("payload")).collect()}
    assert set(got) == {r["n"] for r in norm.collect()} and 2 not in got and 3 not in got


def test_kept_records_carry_their_errors(spark):
    df = spark.createDataFrame(list(enumerate(RECORDS)), "n int, payload string")
    stage = RecordFeatures(handleInvalid="keep")
    rows = {r["n"]: r for r in stage.transform(df).collect()}
    assert len(rows) == len(RECORDS) and rows[2]["errors"] == ["trip_distance"] and rows[3]["errors"] == ["fare_amount"] and rows[0]["errors"] == []
    assert rows[0]["_in_fare_amount"] == 12.5 and rows[0]["_in_store_and_fwd_flag_encoded"] == 1.0 and rows[5]["_in_trip_distance"] == 0.0
    path = scratch_path(spark, "stage")
    stage.write().overwrite().save(path)
    again = RecordFeatures.load(path)
    assert again.transform(df).collect() == stage.transform(df).collect() and again.inputs() == [f"_in_{n}" for n in ORDERED_FEATURE_NAMES]
    with pytest.raises(ValueError):
        RecordFeatures(handleInvalid="drop")


def test_a_table_with_a_payload_column_stays_a_table(spark):
    df = spark.createDataFrame([(2.0, json.dumps({"trip_distance": 9}))], "trip_distance double, payload string")
    assert RecordFeatures().transform(df).first()["_in_trip_distance"] == 2.0
