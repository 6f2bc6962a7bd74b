"""Training job (F15) and its command line (F16).

load -> clean -> split -> features -> (written once) -> fit -> evaluate on
the validation split -> save. The test split is kept aside, unused.

    spark-submit -m sparktrips.train_job --data-path trips/ --model-path models/m \
        --model-type random_forest --n-estimators 100
"""

from __future__ import annotations

import argparse
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, MODEL_TYPES, TripSettings
from sparktrips.operators import clean, model, split
from sparktrips.session import scratch_path
from sparktrips.sources.tables import load_trips, with_row_key


def prepare_training_table(spark: SparkSession, trips: DataFrame, s: TripSettings, path: str | None = None) -> DataFrame:
    """Clean, label the split and build model inputs; write the result once to
    the shared checkpoint folder so the fit and the metrics read a fixed table
    (lineage is cut: a lost executor later does not recompute the cleaning)."""
    labelled = split.hash_split(clean.clean_trips(with_row_key(trips, s.key_col), s), s)
    table = model.training_frame(labelled, s.key_col, s.feature_names, extra=[split.SPLIT])
    out = path or scratch_path(spark, "training-table")
    table.write.mode("overwrite").partitionBy(split.SPLIT).parquet(out)
    return spark.read.schema(table.schema).parquet(out)


def run_training(spark: SparkSession, trips: DataFrame, s: TripSettings = DEFAULT_SETTINGS,
                 model_path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    table = prepare_training_table(spark, trips, s)
    train = table.filter(F.col(split.SPLIT) == "train")
    val = table.filter(F.col(split.SPLIT) == "val")
    fitted = model.train_pipeline(train, model.create_model(s.model_type, s), s, s.key_col)
    metrics = model.regression_metrics(model.score(fitted, val))
    if model_path:
        model.save_model(fitted, model_path)
    return fitted, metrics


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Train a trip-duration model with Spark ML")
    p.add_argument("--data-path", default=DEFAULT_SETTINGS.data_path, help="trip parquet file or folder")
    p.add_argument("--model-path", required=True, help="where the fitted PipelineModel is saved")
    p.add_argument("--model-type", default=DEFAULT_SETTINGS.model_type, choices=list(MODEL_TYPES))
    p.add_argument("--n-estimators", type=int, default=DEFAULT_SETTINGS.n_estimators)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    from sparktrips.session import build_session
    args = parse_args(argv)
    s = DEFAULT_SETTINGS.with_(model_type=args.model_type, n_estimators=args.n_estimators)
    spark = build_session()
    _, metrics = run_training(spark, load_trips(spark, args.data_path), s, args.model_path)
    row = metrics.first().asDict()
    print(json.dumps(row))
    return row


if __name__ == "__main__":
    main()
