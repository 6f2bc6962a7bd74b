"""Service-log analytics: parse JSON log lines, pull latencies out of the
message text, summarise them, count levels.

All built-in expressions: ``from_json`` with a fixed schema, ``regexp_extract``
and grouped aggregates (partially aggregated, so a hot path or level does not
concentrate rows in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktrips.operators import quantiles

# Log record layout: fixed keys plus an optional exception text.
LOG_SCHEMA = ("timestamp STRING, level STRING, logger STRING, message STRING, "
              "correlation_id STRING, exception STRING")

# The service's message formats, as regular expressions.
NUM = r"(-?[0-9]+(?:\.[0-9]+)?)"
RE_PREDICTION = r"^Prediction served: " + NUM + r" minutes with latency " + NUM + r" ms$"
RE_REQUEST = r"^Request (\S+) (\S+) completed with status ([0-9]+) in " + NUM + r" ms$"
RE_TIMED = r"^(\S+) executed in " + NUM + r" ms$"


def parse_log_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """L1: JSON line -> typed columns; ``parsed_ok`` false for lines that are
    not a JSON object (kept, not dropped)."""
    rec = F.from_json(F.col(line), LOG_SCHEMA)
    keep = [c for c in df.columns if c != line]
    return df.select(*keep, F.col(line), rec.alias("_r")).select(
        *keep, F.col("_r.timestamp").alias("timestamp"), F.col("_r.level").alias("level"),
        F.col("_r.logger").alias("logger"), F.col("_r.message").alias("message"),
        F.col("_r.correlation_id").alias("correlation_id"), F.col("_r.exception").alias("exception"),
        (F.col("_r").isNotNull() & F.col("_r.level").isNotNull()).alias("parsed_ok"))


def _num(c: Column) -> Column:
    return F.when(c != "", c).try_cast("double")


def extract_latency(parsed: DataFrame, message: str = "message") -> DataFrame:
    """L2: message kind, request method/path/status and latency in ms."""
    m = F.col(message)
    is_pred = m.rlike(RE_PREDICTION)
    is_req = m.rlike(RE_REQUEST)
    is_timed = m.rlike(RE_TIMED)
    kind = (F.when(is_pred, "prediction").when(is_req, "request").when(is_timed, "timed"))
    latency = (F.when(is_pred, _num(F.regexp_extract(m, RE_PREDICTION, 2)))
                .when(is_req, _num(F.regexp_extract(m, RE_REQUEST, 4)))
                .when(is_timed, _num(F.regexp_extract(m, RE_TIMED, 2))))
    return parsed.select(
        "*", kind.alias("kind"),
        F.when(is_req, F.regexp_extract(m, RE_REQUEST, 1)).alias("method"),
        F.when(is_req, F.regexp_extract(m, RE_REQUEST, 2)).when(is_timed, F.regexp_extract(m, RE_TIMED, 1))
         .alias("path"),
        F.when(is_req, F.regexp_extract(m, RE_REQUEST, 3).try_cast("int")).alias("status"),
        latency.alias("latency_ms"))


def latency_summary(lat: DataFrame, keys: list[str] = ("kind", "path")) -> DataFrame:
    """L3: mean and P95 (linear interpolation) latency per group, and each
    group's mean relative to the fastest group's mean (null where that is 0; a
    window over the small grouped result)."""
    g = quantiles.grouped_statistics(lat, F.col("latency_ms"), [0.95], {k: F.col(k) for k in keys})
    return g.select(*keys, F.col("count").cast("bigint").alias("calls"), F.round("mean", 6).alias("mean_ms"),
                    F.round(F.col("q")[0], 6).alias("p95_ms"),
                    F.round(F.try_divide(F.col("mean"), F.min("mean").over(Window.partitionBy())), 6).alias("ratio_to_fastest"))


def level_counts(parsed: DataFrame) -> DataFrame:
    """L4: lines per level and logger."""
    return (parsed.filter("parsed_ok").groupBy("level", "logger")
                  .agg(F.count(F.lit(1)).cast("bigint").alias("lines")))


def errors_by_correlation(parsed: DataFrame) -> DataFrame:
    """L4: error lines per correlation id (null ids grouped as NULL)."""
    return (parsed.filter(F.col("level") == "ERROR").groupBy("correlation_id")
                  .agg(F.count(F.lit(1)).cast("bigint").alias("errors")))


def latency_windows(lat: DataFrame, ts: str = "ts", width: str = "1 hour") -> DataFrame:
    """L5 (batch form): tumbling windows of request latency."""
    return (lat.filter(F.col("latency_ms").isNotNull())
               .groupBy(F.window(ts, width).alias("w"))
               .agg(F.count(F.lit(1)).cast("bigint").alias("calls"), F.avg("latency_ms").alias("mean_ms"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "calls", F.round("mean_ms", 6).alias("mean_ms")))
