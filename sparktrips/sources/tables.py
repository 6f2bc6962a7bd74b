"""Table readers: the driver's parquet tables and typed trip files."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktrips.config import DEFAULT_SETTINGS, TripSettings
from sparktrips.functions.columns import nan_to_null
from sparktrips.session import small_methods

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    small_methods(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Columns of a raw trip file and the types they are read as.
TRIP_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("lpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("lpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("ehail_fee", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("payment_type", T.DoubleType()),
    T.StructField("trip_type", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])


def normalize_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column, so aggregates skip it the way
    pandas does and comparisons with it are never true."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[nan_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])


#: Columns without which there is no trip duration.
REQUIRED_TRIP_COLUMNS = ("lpep_pickup_datetime", "lpep_dropoff_datetime")


def load_trips(spark: SparkSession, path: str | None = None, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Trip parquet with the file's own columns: known ones are cast to the types of
    ``TRIP_SCHEMA`` (files store codes as integers or doubles), unknown ones are
    kept, and absent ones stay absent, since cleaning looks at present columns
    only. Rows get a key of file name and row index where the file has none.

    A missing path raises ``FileNotFoundError``, a file without pickup or dropoff
    time ``ValueError``.
    """
    path = s.data_path if path is None else path
    small_methods(spark)
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Dataset not found at {path}") from e
        raise
    missing = [c for c in REQUIRED_TRIP_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    known = {f.name: f.dataType for f in TRIP_SCHEMA}
    columns = [F.col(f"`{c}`").cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in raw.columns]
    if s.key_col not in raw.columns:
        columns.append(F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias(s.key_col))
    return normalize_nan(raw.select(*columns))


def with_row_key(df: DataFrame, key: str) -> DataFrame:
    """A key for rows of any origin: a hash of all columns and, for equal rows, their
    number. Equal rows are interchangeable, so the keys are the same each time."""
    if key in df.columns:
        return df
    whole = F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256)
    numbered = df.withColumn("_row", whole)
    number = F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(0)))
    return numbered.withColumn(key, F.concat_ws(":", "_row", number.cast("string"))).drop("_row")
