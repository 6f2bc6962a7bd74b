"""Trip cleaning: duration, null block, duration quantile cut, distance cut.

Each step is ``DataFrame -> DataFrame`` and the chain stays one lazy plan.
The quantile cut is a scalar subquery (one-row aggregate evaluated once by
Spark, then used as a literal in the filter): no cross join, nothing pulled
through driver code.

Order matters for results, not for Catalyst: the quantile is taken after the
null block and before any duration/distance filter, so non-positive
durations take part in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, NULL_BLOCK_COLUMNS, TripSettings
from sparktrips.functions.columns import duration_minutes
from sparktrips.operators import quantiles


def with_trip_duration(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Add the target in minutes unless it is already there."""
    if s.target_col in df.columns:
        return df
    return df.withColumn(s.target_col, duration_minutes(s.pickup_col, s.dropoff_col))


def drop_all_null_col(df: DataFrame) -> DataFrame:
    """Drop the always-empty ``ehail_fee`` column (no-op when absent)."""
    return df.drop("ehail_fee")


def drop_null_block(df: DataFrame, columns: list[str] = NULL_BLOCK_COLUMNS) -> DataFrame:
    """Drop rows with a null in any present column of the null block."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def quantile_scalar(df: DataFrame, column: str, q: float, accuracy: int | None = None) -> Column:
    """Quantile as a scalar-subquery column.

    Default: exact and linearly interpolated, by selection (``quantiles``). With ``accuracy``: ``percentile_approx`` (bounded sketch,
    relative rank error 1/accuracy) for columns with unbounded distinct values.
    """
    if accuracy:
        return df.agg(F.percentile_approx(F.col(column), q, accuracy)).scalar()
    return quantiles.quantile(df, F.col(column), q).scalar()


def duration_quantile_filter(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Keep ``min < duration <= quantile(q)``."""
    upper = quantile_scalar(df, s.target_col, s.duration_max_quantile, s.quantile_accuracy)
    d = F.col(s.target_col)
    return df.filter((d > F.lit(s.duration_min)) & (d <= upper))


def distance_filter(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """P5: ``trip_distance > min`` when the column exists."""
    if "trip_distance" not in df.columns:
        return df
    return df.filter(F.col("trip_distance") > F.lit(s.distance_min))


def clean_trips(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """P1 -> P2 -> P3 -> P4 -> P5."""
    return (df.transform(lambda d: with_trip_duration(d, s))
              .transform(drop_all_null_col)
              .transform(drop_null_block)
              .transform(lambda d: duration_quantile_filter(d, s))
              .transform(lambda d: distance_filter(d, s)))


def blocked_trips(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Trips after P1-P3: the table the duration quantile is taken on."""
    return drop_null_block(drop_all_null_col(with_trip_duration(df, s)))


def retention_report(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Rows kept after each cleaning stage, in one pass over the input.

    Each row gets stage flags; a single aggregate counts them; ``inline`` turns
    the one-row result into (stage, rows, pct_of_raw).
    """
    d = with_trip_duration(df, s)
    present = [c for c in NULL_BLOCK_COLUMNS if c in d.columns]
    ok_block = F.lit(True)
    for c in present:
        ok_block = ok_block & F.col(c).isNotNull()
    upper = quantile_scalar(drop_null_block(d), s.target_col, s.duration_max_quantile, s.quantile_accuracy)
    dur = F.col(s.target_col)
    ok_dur = ok_block & (dur > F.lit(s.duration_min)) & (dur <= upper)
    ok_dist = ok_dur & (F.col("trip_distance") > F.lit(s.distance_min)) if "trip_distance" in d.columns else ok_dur
    counts = d.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(ok_block).alias("null_block"),
        F.count_if(ok_dur).alias("duration"),
        F.count_if(ok_dist).alias("distance"),
    )
    long = counts.select(
        F.col("raw").alias("n_raw"),
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), F.col(name).alias("rows"))
            for i, name in enumerate(["raw", "null_block", "duration", "distance"])
        ])),
    )
    return long.select(
        "stage_no", "stage", F.col("rows").cast("bigint").alias("rows"),
        F.round(F.try_divide(F.col("rows") * 100.0, F.col("n_raw")), 6).alias("pct_of_raw"),
    )
