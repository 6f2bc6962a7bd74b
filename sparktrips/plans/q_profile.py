"""Queries: profiling studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktrips.config import (CORRELATION_EXCLUDED, FARE_COMPONENTS, MONETARY_COLUMNS, NULL_BLOCK_COLUMNS,
                               DEFAULT_SETTINGS)
from sparktrips.operators import clean, profile
from sparktrips.plans.catalog import register
from sparktrips.plans.sqlviews import with_clean, with_trips
from sparktrips.sources import views

# Column names and Spark type names of the trip view, in order (for the SQL side).
TRIP_COLUMNS = [
    ("trip_id", "string"), ("VendorID", "int"), ("lpep_pickup_datetime", "timestamp_ntz"),
    ("lpep_dropoff_datetime", "timestamp_ntz"), ("store_and_fwd_flag", "string"), ("RatecodeID", "double"),
    ("PULocationID", "int"), ("DOLocationID", "int"), ("passenger_count", "double"),
    ("trip_distance", "double"), ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"), ("ehail_fee", "double"),
    ("improvement_surcharge", "double"), ("total_amount", "double"), ("payment_type", "double"),
    ("trip_type", "double"), ("congestion_surcharge", "double"), ("cbd_congestion_fee", "double"),
]
# Numeric columns of the cleaned table that enter the correlation matrix, in table order.
CLEANED_NUMERIC = [c for c, t in TRIP_COLUMNS if t in ("int", "double") and c != "ehail_fee"
                   and c not in CORRELATION_EXCLUDED] + ["trip_duration"]


def _trips(spark, sf_dir):
    return views.trips(spark, sf_dir)


def _blocked(spark, sf_dir):
    return clean.blocked_trips(_trips(spark, sf_dir))


def _dur_ok(spark, sf_dir):
    return clean.duration_quantile_filter(_blocked(spark, sf_dir))


def _cleaned(spark, sf_dir):
    return clean.clean_trips(_trips(spark, sf_dir))


# ------------------------------------------------------------------ SQL helpers

def _describe_sql(label_col: str, items: list[tuple[str, str, str]], pcts=profile.DESCRIBE_PCTS) -> str:
    """items: (label, expression, from-table)."""
    parts = []
    for i, (label, x, src) in enumerate(items):
        qs = ", ".join(f"round(quantile_cont({x}, {p}), 6) as {profile._pname(p)}" for p in pcts)
        parts.append(
            f"select {i} as ordinal, '{label}' as {label_col}, count({x}) as count, round(avg({x}), 6) as mean, "
            f"round(stddev_samp({x}), 6) as std, cast(min({x}) as double) as min, {qs}, "
            f"cast(max({x}) as double) as max from {src}")
    return "\nunion all\n".join(parts)


def _hist_sql(items: list[tuple[str, str, int, str]]) -> str:
    """items: (label, expression, bins, from-table with optional where)."""
    parts = []
    for i, (label, x, bins, src) in enumerate(items):
        parts.append(f"""
select {i} as ordinal, '{label}' as column_name, bin,
  round(lo + bin * ((hi - lo) / {bins}), 6) as bin_lower, round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) as bin_upper,
  count(*) as count
from (
  select cast(least(floor(({x} - lo) * {bins} / (hi - lo)), {bins - 1}) as int) as bin, lo, hi
  from {src} s, (select case when min(x0) = max(x0) then min(x0) - 0.5 else min(x0) end as lo,
                        case when min(x0) = max(x0) then max(x0) + 0.5 else max(x0) end as hi
                 from (select {x} as x0 from {src}) t) b
  where {x} is not null)
group by bin, lo, hi""")
    return "\nunion all\n".join(parts)


def _box_sql(value: str, src: str, group: str | None = None, group_name: str = "group") -> str:
    if group is None:
        return f"""
select count(v) as count, round(q[1], 6) as q1, round(q[2], 6) as median, round(q[3], 6) as q3,
  round(q[3] - q[1], 6) as iqr,
  round(min(v) filter (where v >= q[1] - 1.5 * (q[3] - q[1])), 6) as whisker_low,
  round(max(v) filter (where v <= q[3] + 1.5 * (q[3] - q[1])), 6) as whisker_high,
  count(*) filter (where v < q[1] - 1.5 * (q[3] - q[1]) or v > q[3] + 1.5 * (q[3] - q[1])) as outliers
from (select {value} as v, (select quantile_cont({value}, [0.25, 0.5, 0.75]) from {src}) as q from {src}) t
group by q"""
    return f"""
select g as "{group_name}", count(v) as count, round(q[1], 6) as q1, round(q[2], 6) as median, round(q[3], 6) as q3,
  round(q[3] - q[1], 6) as iqr,
  round(min(v) filter (where v >= q[1] - 1.5 * (q[3] - q[1])), 6) as whisker_low,
  round(max(v) filter (where v <= q[3] + 1.5 * (q[3] - q[1])), 6) as whisker_high,
  count(*) filter (where v < q[1] - 1.5 * (q[3] - q[1]) or v > q[3] + 1.5 * (q[3] - q[1])) as outliers
from (select {group} as g, {value} as v from {src} where {group} is not null) t
join (select {group} as g2, quantile_cont({value}, [0.25, 0.5, 0.75]) as q from {src}
      where {group} is not null group by 1) qs on t.g = qs.g2
group by g, q"""


_BLOCK_OK = " and ".join(f"{c} is not null" for c in NULL_BLOCK_COLUMNS)

# ------------------------------------------------------------------- null study

_null_sql = "\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as column_name, count(*) filter (where {c} is null) as null_count from trips"
    for i, (c, _) in enumerate(TRIP_COLUMNS))


@register("null_counts", with_trips(_null_sql))
def null_counts(spark, sf_dir):
    return profile.null_counts(_trips(spark, sf_dir))


_info_sql = "\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as column_name, '{t}' as data_type, count({c}) as non_null from trips"
    for i, (c, t) in enumerate(TRIP_COLUMNS))


@register("table_info", with_trips(_info_sql))
def table_info(spark, sf_dir):
    return profile.table_info(_trips(spark, sf_dir))


_any = " or ".join(f"{c} is null" for c in NULL_BLOCK_COLUMNS)
_all = " and ".join(f"{c} is null" for c in NULL_BLOCK_COLUMNS)


@register("null_cooccurrence", with_trips(f"""
select count(*) as total_rows, count(*) filter (where {_any}) as any_null, count(*) filter (where {_all}) as all_null,
  count(*) filter (where {_any}) = count(*) filter (where {_all}) as same_rows,
  round(cast(count(*) filter (where {_any}) as double) * 100.0 / count(*), 6) as pct_rows
from trips"""))
def null_cooccurrence(spark, sf_dir):
    return profile.null_cooccurrence(_trips(spark, sf_dir), NULL_BLOCK_COLUMNS)


# ------------------------------------------------------------- describe studies

@register("describe_duration", with_clean(_describe_sql("stage", [
    ("raw", "trip_duration", "with_duration"),
    ("after_null_block", "trip_duration", "blocked"),
    ("after_duration_filter", "trip_duration", "dur_ok")])))
def describe_duration(spark, sf_dir):
    """A4 for three stages in one pass over the duration table."""
    s = DEFAULT_SETTINGS
    d = clean.with_trip_duration(_trips(spark, sf_dir))
    ok_block = F.lit(True)
    for c in NULL_BLOCK_COLUMNS:
        ok_block = ok_block & F.col(c).isNotNull()
    upper = clean.quantile_scalar(clean.drop_null_block(d), s.target_col, s.duration_max_quantile)
    x = F.col("trip_duration")
    ok_dur = ok_block & (x > s.duration_min) & (x <= upper)
    return profile.describe_many(d, [("raw", x), ("after_null_block", F.when(ok_block, x)),
                                     ("after_duration_filter", F.when(ok_dur, x))], label="stage")


@register("describe_distance", with_clean(_describe_sql("stage", [
    ("before_distance_filter", "trip_distance", "dur_ok"),
    ("after_distance_filter", "trip_distance", "cleaned")])))
def describe_distance(spark, sf_dir):
    """A5: distance before and after the distance filter, one pass."""
    d = _dur_ok(spark, sf_dir)
    x = F.col("trip_distance")
    return profile.describe_many(d, [("before_distance_filter", x),
                                     ("after_distance_filter", F.when(x > 0, x))], label="stage")


@register("iqr_bounds", with_clean("""
select round(q[1], 6) as q1, round(q[2], 6) as q3, round(q[2] - q[1], 6) as iqr,
  round(q[1] - 1.5 * (q[2] - q[1]), 6) as lower_fence, round(q[2] + 1.5 * (q[2] - q[1]), 6) as upper_fence
from (select quantile_cont(trip_duration, [0.25, 0.75]) as q from blocked)"""))
def iqr_bounds(spark, sf_dir):
    return profile.iqr_bounds(_blocked(spark, sf_dir), "trip_duration")


@register("passenger_distribution", with_clean("""
select passenger_count, count(*) as trips,
  round(cast(count(*) as double) * 100.0 / cast(sum(count(*)) over () as double), 6) as pct
from cleaned where passenger_count is not null group by passenger_count"""))
def passenger_distribution(spark, sf_dir):
    return profile.value_distribution(_cleaned(spark, sf_dir), "passenger_count")


@register("describe_passengers", with_clean(_describe_sql("name", [("passenger_count", "passenger_count", "cleaned")],
                                                          pcts=[0.25, 0.5, 0.75])))
def describe_passengers(spark, sf_dir):
    return profile.describe_many(_cleaned(spark, sf_dir), [("passenger_count", F.col("passenger_count"))],
                                 pcts=[0.25, 0.5, 0.75])


_PASSENGER_AVG = ["trip_distance", "fare_amount", "total_amount", "tip_amount", "trip_duration"]


@register("passenger_averages", with_clean(f"""
select passenger_count, count(*) as trips, {", ".join(f"round(avg({c}), 6) as avg_{c}" for c in _PASSENGER_AVG)}
from cleaned where passenger_count is not null group by passenger_count"""))
def passenger_averages(spark, sf_dir):
    return profile.group_means(_cleaned(spark, sf_dir), "passenger_count", _PASSENGER_AVG)


# ------------------------------------------------------------------- money

_fin_sql = "\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as column_name, count({c}) as count, round(avg({c}), 6) as mean, "
    f"round(quantile_cont({c}, 0.5), 6) as median, round(stddev_samp({c}), 6) as std, "
    f"cast(min({c}) as double) as min, cast(max({c}) as double) as max, "
    f"round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.75), 6) as q3 from cleaned"
    for i, c in enumerate(MONETARY_COLUMNS))


@register("financial_summary", with_clean(_fin_sql))
def financial_summary(spark, sf_dir):
    return profile.financial_summary(_cleaned(spark, sf_dir))


_sign_sql = "\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as column_name, count(*) filter (where {c} < 0) as negative, "
    f"count(*) filter (where {c} = 0) as zero, count(*) filter (where {c} > 0) as positive, "
    f"cast(min({c}) as double) as min, cast(max({c}) as double) as max from cleaned"
    for i, c in enumerate(MONETARY_COLUMNS))


@register("sign_summary", with_clean(_sign_sql))
def sign_summary(spark, sf_dir):
    return profile.sign_summary(_cleaned(spark, sf_dir))


_EXPECTED_SQL = " + ".join(f"coalesce({c}, 0.0)" for c in FARE_COMPONENTS)


@register("fare_consistency", with_clean(f"""
select trip_id, {_EXPECTED_SQL} as expected_total_amount, total_amount - ({_EXPECTED_SQL}) as total_amount_difference
from cleaned"""))
def fare_consistency(spark, sf_dir):
    return profile.fare_consistency(_cleaned(spark, sf_dir)).select(
        "trip_id", "expected_total_amount", "total_amount_difference")


@register("fare_discrepancies", with_clean(f"""
select trip_id, total_amount, expected_total_amount, total_amount_difference, {", ".join(FARE_COMPONENTS)}
from (select *, {_EXPECTED_SQL} as expected_total_amount, total_amount - ({_EXPECTED_SQL}) as total_amount_difference
      from cleaned) t
where abs(total_amount_difference) > 0.01 order by trip_id limit 5"""))
def fare_discrepancies(spark, sf_dir):
    return profile.fare_discrepancies(_cleaned(spark, sf_dir))


@register("discrepancy_rate", with_clean(f"""
select count(d) as count, round(avg(d), 6) as mean, round(stddev_samp(d), 6) as std, cast(min(d) as double) as min,
  round(quantile_cont(d, 0.25), 6) as p25, round(quantile_cont(d, 0.5), 6) as p50, round(quantile_cont(d, 0.75), 6) as p75,
  cast(max(d) as double) as max, count(*) filter (where abs(d) > 0.01) as discrepant,
  round(cast(count(*) filter (where abs(d) > 0.01) as double) * 100.0 / count(*), 6) as pct_discrepant
from (select total_amount - ({_EXPECTED_SQL}) as d from cleaned) t"""))
def discrepancy_rate(spark, sf_dir):
    return profile.discrepancy_rate(_cleaned(spark, sf_dir))


# ------------------------------------------------------------- correlations

def _corr_sql(a: str, b: str) -> str:
    both = f"{a} is not null and {b} is not null"
    return (f"round(covar_samp({a}, {b}) filter (where {both}) / nullif(stddev_samp({a}) filter (where {both}) "
            f"* stddev_samp({b}) filter (where {both}), 0), 6)")


_CORR_PAIRS = [("trip_distance", "fare_amount"), ("trip_distance", "total_amount")]


@register("corr_pairs", with_clean("\nunion all\n".join(
    f"select '{a}' as column_a, '{b}' as column_b, {_corr_sql(a, b)} as corr from cleaned" for a, b in _CORR_PAIRS)))
def corr_pairs(spark, sf_dir):
    return profile.corr_long(_cleaned(spark, sf_dir), _CORR_PAIRS)


@register("corr_matrix", with_clean("\nunion all\n".join(
    f"select '{a}' as column_a, '{b}' as column_b, {_corr_sql(a, b)} as corr from cleaned"
    for a in CLEANED_NUMERIC for b in CLEANED_NUMERIC)))
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(_cleaned(spark, sf_dir))


@register("select_numeric", with_clean(f"select {', '.join(CLEANED_NUMERIC)} from cleaned"))
def select_numeric(spark, sf_dir):
    df = _cleaned(spark, sf_dir)
    return df.select(*profile.numeric_columns(df))


@register("distinct_flags", with_trips("select distinct store_and_fwd_flag from trips"))
def distinct_flags(spark, sf_dir):
    return _trips(spark, sf_dir).select("store_and_fwd_flag").distinct()


# -------------------------------------------------------------- histograms

@register("histogram_duration", with_clean(_hist_sql([("trip_duration", "trip_duration", 50, "dur_ok")])))
def histogram_duration(spark, sf_dir):
    return profile.histogram(_dur_ok(spark, sf_dir), [("trip_duration", F.col("trip_duration"), 50)])


@register("histogram_distance", with_clean(_hist_sql([("trip_distance", "trip_distance", 50, "dur_ok")])))
def histogram_distance(spark, sf_dir):
    return profile.histogram(_dur_ok(spark, sf_dir), [("trip_distance", F.col("trip_distance"), 50)])


@register("histogram_money", with_clean(_hist_sql([
    ("fare_amount", "fare_amount", 50, "cleaned"), ("total_amount", "total_amount", 50, "cleaned"),
    ("tip_amount", "tip_amount", 30, "(select * from cleaned where tip_amount > 0)"),
    ("tolls_amount", "tolls_amount", 20, "(select * from cleaned where tolls_amount > 0)")])))
def histogram_money(spark, sf_dir):
    tip, tolls = F.col("tip_amount"), F.col("tolls_amount")
    return profile.histogram(_cleaned(spark, sf_dir), [
        ("fare_amount", F.col("fare_amount"), 50), ("total_amount", F.col("total_amount"), 50),
        ("tip_amount", F.when(tip > 0, tip), 30), ("tolls_amount", F.when(tolls > 0, tolls), 20)])


# ---------------------------------------------------------------- box plots

@register("box_stats", with_clean(_box_sql("trip_duration", "dur_ok")))
def box_stats(spark, sf_dir):
    return profile.box_stats(_dur_ok(spark, sf_dir), "trip_duration")


@register("box_distance", with_clean(_box_sql("trip_distance", "dur_ok")))
def box_distance(spark, sf_dir):
    return profile.box_stats(_dur_ok(spark, sf_dir), "trip_distance")


@register("box_by_passenger", with_clean(_box_sql("trip_duration", "dur_ok", "passenger_count", "passenger_count")))
def box_by_passenger(spark, sf_dir):
    return profile.box_stats(_dur_ok(spark, sf_dir), "trip_duration", "passenger_count", "passenger_count")


@register("box_by_ratecode", with_clean(_box_sql("trip_duration", "dur_ok", "cast(RatecodeID as varchar)",
                                                 "RatecodeID")))
def box_by_ratecode(spark, sf_dir):
    return profile.box_stats(_dur_ok(spark, sf_dir), "trip_duration",
                             F.col("RatecodeID").cast("string"), "RatecodeID")


# ------------------------------------------------------------- flag studies

@register("duration_flags", with_clean("""
select count(*) as rows, count(*) filter (where trip_duration <= 0) as non_positive,
  count(*) filter (where trip_duration > 0 and trip_duration < 1) as under_1_min,
  count(*) filter (where trip_duration > (select quantile_cont(trip_duration, 0.99) from blocked)) as above_p99,
  round((select quantile_cont(trip_duration, 0.99) from blocked), 6) as p99
from blocked"""))
def duration_flags(spark, sf_dir):
    return profile.duration_flags(_blocked(spark, sf_dir))


@register("distance_flags", with_clean("""
select count(*) as rows, count(*) filter (where trip_distance = 0) as zero,
  count(*) filter (where trip_distance < 0) as negative,
  count(*) filter (where trip_distance > (select quantile_cont(trip_distance, 0.99) from dur_ok)) as above_p99,
  round((select quantile_cont(trip_distance, 0.99) from dur_ok), 6) as p99
from dur_ok"""))
def distance_flags(spark, sf_dir):
    return profile.distance_flags(_dur_ok(spark, sf_dir))


@register("passenger_flags", with_clean("""
select count(*) filter (where passenger_count = 0) as zero, count(*) filter (where passenger_count < 0) as negative,
  cast(max(passenger_count) as double) as max from cleaned"""))
def passenger_flags(spark, sf_dir):
    return profile.passenger_flags(_cleaned(spark, sf_dir))


@register("ratecode_as_string", with_clean("""
select cast(RatecodeID as varchar) as RatecodeID, count(*) as trips from dur_ok group by 1"""))
def ratecode_as_string(spark, sf_dir):
    df = _dur_ok(spark, sf_dir)
    return (df.groupBy(F.col("RatecodeID").cast("string").alias("RatecodeID"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("trips")))


@register("sample_trips", with_clean("""
select trip_id, trip_distance, trip_duration, fare_amount, total_amount from cleaned
order by md5(concat_ws(':', trip_id, '42')), trip_id limit 10000"""))
def sample_trips(spark, sf_dir):
    df = _cleaned(spark, sf_dir).select("trip_id", "trip_distance", "trip_duration", "fare_amount", "total_amount")
    return profile.sample_rows(df, 10000, "trip_id", 42)


def _density_sql(column: str, src: str) -> str:
    return with_clean(f"""
, st as (select *, sd * pow(n, -0.2) as bw, ceil((hi - lo) * 16 / (sd * pow(n, -0.2))) as bins from (
         select count({column}) as n, stddev_samp({column}) as sd, min({column}) as lo, max({column}) as hi from {src})
         where sd > 0 and hi > lo),
hb as (select least(floor(({column} - lo) * bins / (hi - lo)), bins - 1) as bin, count(*) as cnt
       from {src}, st where {column} is not null group by 1),
grid as (select cast(range as int) as g from range(200))
select g as grid_index, round(lo + g * ((hi - lo) / 199), 6) as x,
  round(sum(cnt * exp(-0.5 * pow((lo + g * ((hi - lo) / 199) - (lo + (bin + 0.5) * ((hi - lo) / bins))) / bw, 2)))
        / (n * bw * sqrt(2 * pi())), 6) as density
from hb, grid, st group by g, lo, hi, n, bw""")


#: Query, column, rows, and the same rows in SQL.
_CURVES = [
    ("density_curve", "trip_duration", _dur_ok, "dur_ok"),
    ("density_distance", "trip_distance", _dur_ok, "dur_ok"),
    ("density_fare", "fare_amount", _cleaned, "cleaned"),
    ("density_total", "total_amount", _cleaned, "cleaned"),
    ("density_tip", "tip_amount", lambda s, d: _cleaned(s, d).where("tip_amount > 0"), "(select * from cleaned where tip_amount > 0)"),
    ("density_tolls", "tolls_amount", _cleaned, "cleaned"),
]


def _register_curve(name, column, rows, src):
    @register(name, _density_sql(column, src))
    def curve(spark, sf_dir):
        return profile.density_curve(rows(spark, sf_dir), column)


for _curve in _CURVES:
    _register_curve(*_curve)
