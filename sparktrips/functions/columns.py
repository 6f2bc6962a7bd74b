"""Column expressions used across operators.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
there is no Python UDF anywhere in the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktrips.config import DAY_NAMES

MICROS_PER_MINUTE = 60_000_000.0
#: What Python's ``str.strip`` takes off, up to U+00A0.
WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(pickup: str | Column, dropoff: str | Column) -> Column:
    """Trip duration in (fractional) minutes; sub-second precision kept."""
    return F.timestamp_diff("MICROSECOND", col_(pickup), col_(dropoff)).cast("double") / MICROS_PER_MINUTE


def nan_to_null(c: str | Column) -> Column:
    """pandas treats NaN as missing; Spark does not. Normalise once at ingest."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def encode_flag_string(c: str | Column) -> Column:
    """'Y' (any case, surrounding white space ignored) -> 1, anything else (incl. null) -> 0."""
    return F.when(F.upper(F.btrim(col_(c), F.lit(WHITE_SPACE))) == "Y", 1).otherwise(0).cast("int")


def encode_flag(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Encode store_and_fwd_flag by column type: strings compare to 'Y',
    numbers/booleans are truthy; null -> 0."""
    x = col_(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return encode_flag_string(x)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(x, F.lit(False)).cast("int")
    if isinstance(dtype, T.NumericType):
        return F.coalesce(x != 0, F.lit(False)).cast("int")
    return F.lit(0)


def pickup_hour(c: str | Column) -> Column:
    return F.hour(col_(c)).cast("int")


def day_of_week(c: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(c)).cast("int")


def day_name(dow: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), col_(dow) + 1)


def row_sum_skip_null(cols: list[str]) -> Column:
    """Row sum that treats a missing component as 0 (pandas ``sum(axis=1)``)."""
    out = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0.0))
        out = term if out is None else out + term
    return out


def pu_do(pu: str | Column, do: str | Column) -> Column:
    """"{PU}_{DO}" interaction key, only when both ids are present."""
    return F.when(col_(pu).isNotNull() & col_(do).isNotNull(),
                  F.concat_ws("_", col_(pu).cast("string"), col_(do).cast("string")))


def tip_percentage(tip: str | Column = "tip_amount", fare: str | Column = "fare_amount") -> Column:
    return F.when(col_(fare) > 0, col_(tip) * 100.0 / col_(fare))


def unit_hash(key: Column, seed: int) -> Column:
    """Deterministic uniform number in [0, 1) from a row key and a seed.

    First 32 bits of md5(key:seed); stable under any partitioning and
    reproducible in any SQL engine that has md5.
    """
    h = F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), 1, 8), 16, 10)
    return h.cast("bigint").cast("double") / 4294967296.0

