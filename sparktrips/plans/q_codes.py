"""Queries: code names, averages by code, tip percentage, imputation
(J1-J4), and a binned density curve (A21)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktrips.config import PAYMENT_TYPE_NAMES, RATECODE_NAMES, TRIP_TYPE_NAMES
from sparktrips.functions.columns import tip_percentage as tip_pct
from sparktrips.operators import clean
from sparktrips.plans.catalog import register
from sparktrips.plans.sqlviews import with_clean, with_trips
from sparktrips.sources import views

UNKNOWN = "Unknown"
CODE_TABLES = {"RatecodeID": RATECODE_NAMES, "payment_type": PAYMENT_TYPE_NAMES, "trip_type": TRIP_TYPE_NAMES}


def code_name(col: str, names: dict[int, str]) -> Column:
    """Code -> name through a literal map (a few entries, no join, no
    broadcast); unknown or missing code -> 'Unknown'."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(names.items())))
    return F.coalesce(F.element_at(m, F.col(col).try_cast("int")), F.lit(UNKNOWN))


def _name_sql(col: str, names: dict[int, str]) -> str:
    whens = " ".join(f"when {k} then '{v}'" for k, v in sorted(names.items()))
    return f"coalesce(case try_cast({col} as int) {whens} end, '{UNKNOWN}')"


def with_code_names(df):
    """Add ``<code>_name`` columns."""
    for c, names in CODE_TABLES.items():
        df = df.withColumn(f"{c}_name", code_name(c, names))
    return df


@register("code_names", with_trips(f"""
select trip_id, {", ".join(f"{_name_sql(c, n)} as {c}_name" for c, n in CODE_TABLES.items())} from trips"""))
def code_names(spark, sf_dir):
    df = with_code_names(views.trips(spark, sf_dir))
    return df.select("trip_id", *[f"{c}_name" for c in CODE_TABLES])


_AVG_COLS = ["trip_distance", "trip_duration", "fare_amount", "tip_amount"]
_VENDOR_NAME = "cast(VendorID as varchar)"


@register("averages_by_code", with_clean(f"""
select case when grouping(payment_type_name) = 0 then 'payment_type' when grouping(RatecodeID_name) = 0 then 'RatecodeID'
            when grouping(trip_type_name) = 0 then 'trip_type' else 'VendorID' end as code_type,
  coalesce(payment_type_name, RatecodeID_name, trip_type_name, vendor) as code_name,
  count(*) as trips, {", ".join(f"round(avg({c}), 6) as avg_{c}" for c in _AVG_COLS)}
from (select *, {", ".join(f"{_name_sql(c, n)} as {c}_name" for c, n in CODE_TABLES.items())},
             {_VENDOR_NAME} as vendor from cleaned) t
group by grouping sets ((payment_type_name), (RatecodeID_name), (trip_type_name), (vendor))"""))
def averages_by_code(spark, sf_dir):
    """Mean distance, duration, fare and tip per payment type, rate code,
    trip type and vendor: four groupings in one grouping-sets aggregate."""
    df = with_code_names(clean.clean_trips(views.trips(spark, sf_dir))).withColumn(
        "vendor", F.col("VendorID").cast("string"))
    keys = ["payment_type_name", "RatecodeID_name", "trip_type_name", "vendor"]
    g = df.groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("trips"), *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in _AVG_COLS],
        *[F.grouping(k).alias(f"_g{i}") for i, k in enumerate(keys)])
    code_type = (F.when(F.col("_g0") == 0, "payment_type").when(F.col("_g1") == 0, "RatecodeID")
                  .when(F.col("_g2") == 0, "trip_type").otherwise("VendorID"))
    return g.select(code_type.alias("code_type"), F.coalesce(*[F.col(k) for k in keys]).alias("code_name"),
                    "trips", *[f"avg_{c}" for c in _AVG_COLS])


@register("tip_percentage", with_clean("""
select trip_id, case when fare_amount > 0 then tip_amount * cast(100.0 as double) / fare_amount end as tip_percentage
from cleaned"""))
def tip_percentage(spark, sf_dir):
    """J3 (assumed formula): 100 * tip / fare, NULL when fare <= 0."""
    df = clean.clean_trips(views.trips(spark, sf_dir))
    return df.select("trip_id", tip_pct().alias("tip_percentage"))


def impute_unknown(df):
    """Categorical codes -> text with 'Unknown' for missing; missing
    congestion surcharge -> 0; passenger_count stays missing."""
    out = df.withColumn("store_and_fwd_flag", F.coalesce(F.col("store_and_fwd_flag"), F.lit(UNKNOWN)))
    for c in ("RatecodeID", "payment_type", "trip_type"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)))
    return out.fillna({"congestion_surcharge": 0.0})


@register("impute_unknown", with_trips(f"""
select trip_id, coalesce(store_and_fwd_flag, '{UNKNOWN}') as store_and_fwd_flag,
  {", ".join(f"coalesce(cast({c} as varchar), '{UNKNOWN}') as {c}" for c in ("RatecodeID", "payment_type", "trip_type"))},
  passenger_count, coalesce(congestion_surcharge, 0.0) as congestion_surcharge
from trips"""))
def impute_unknown_q(spark, sf_dir):
    df = impute_unknown(views.trips(spark, sf_dir))
    return df.select("trip_id", "store_and_fwd_flag", "RatecodeID", "payment_type", "trip_type", "passenger_count",
                     "congestion_surcharge")
