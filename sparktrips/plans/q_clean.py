"""Queries: trip view, duration and the cleaning chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktrips.functions.columns import day_name, day_of_week, pickup_hour
from sparktrips.operators import clean
from sparktrips.plans.catalog import register
from sparktrips.plans.sqlviews import DURATION_SQL, with_clean, with_trips
from sparktrips.session import scratch_path
from sparktrips.sources import views
from sparktrips.sources.tables import load_trips as load_files


@register("load_trips", with_trips("select * from trips"))
def load_trips(spark, sf_dir):
    return views.trips(spark, sf_dir)


@register("load_trip_files", with_trips("select * from trips"))
def load_trip_files(spark, sf_dir):
    """S1 through the reader: the trips written as files and loaded again."""
    path = scratch_path(spark, "trip-files")
    views.trips(spark, sf_dir).write.parquet(path)
    return load_files(spark, path)


@register("trip_duration", with_trips(f"select trip_id, {DURATION_SQL} as trip_duration from trips"))
def trip_duration(spark, sf_dir):
    return clean.with_trip_duration(views.trips(spark, sf_dir)).select("trip_id", "trip_duration")


@register("drop_all_null_col", with_trips("select * exclude (ehail_fee) from trips"))
def drop_all_null_col(spark, sf_dir):
    return clean.drop_all_null_col(views.trips(spark, sf_dir))


@register("drop_null_block", with_clean("select * from blocked"))
def drop_null_block(spark, sf_dir):
    return clean.blocked_trips(views.trips(spark, sf_dir))


@register("duration_quantile_filter", with_clean("select * from dur_ok"))
def duration_quantile_filter(spark, sf_dir):
    return clean.duration_quantile_filter(clean.blocked_trips(views.trips(spark, sf_dir)))


@register("distance_filter", with_trips("select * from trips where trip_distance > 0"))
def distance_filter(spark, sf_dir):
    return clean.distance_filter(views.trips(spark, sf_dir))


@register("clean_trips", with_clean("select * from cleaned"))
def clean_trips(spark, sf_dir):
    return clean.clean_trips(views.trips(spark, sf_dir))


@register("retention_report", with_clean("""
select stage_no, stage, rows, round(rows * 100.0 / (select count(*) from trips), 6) as pct_of_raw from (
  select 0 as stage_no, 'raw' as stage, (select count(*) from trips) as rows
  union all select 1, 'null_block', (select count(*) from blocked)
  union all select 2, 'duration', (select count(*) from dur_ok)
  union all select 3, 'distance', (select count(*) from cleaned))
"""))
def retention_report(spark, sf_dir):
    return clean.retention_report(views.trips(spark, sf_dir))


@register("temporal_features", with_clean("""
select trip_id, cast(hour(lpep_pickup_datetime) as int) as pickup_hour,
       cast(isodow(lpep_pickup_datetime) - 1 as int) as pickup_day_of_week,
       dayname(lpep_pickup_datetime) as day_name
from cleaned
"""))
def temporal_features(spark, sf_dir):
    df = clean.clean_trips(views.trips(spark, sf_dir))
    return df.select(
        "trip_id",
        pickup_hour("lpep_pickup_datetime").alias("pickup_hour"),
        day_of_week("lpep_pickup_datetime").alias("pickup_day_of_week"),
    ).withColumn("day_name", day_name("pickup_day_of_week"))


@register("avg_duration_by_hour", with_clean("""
select cast(hour(lpep_pickup_datetime) as int) as pickup_hour,
       round(avg(trip_duration), 6) as avg_duration, count(*) as trips
from cleaned group by 1
"""))
def avg_duration_by_hour(spark, sf_dir):
    """A8 — the flagship slice: clean, then mean duration per pickup hour."""
    df = clean.clean_trips(views.trips(spark, sf_dir))
    return (df.groupBy(pickup_hour("lpep_pickup_datetime").alias("pickup_hour"))
              .agg(F.round(F.avg("trip_duration"), 6).alias("avg_duration"),
                   F.count(F.lit(1)).alias("trips")))


@register("avg_duration_by_dow", with_clean("""
select cast(isodow(lpep_pickup_datetime) - 1 as int) as pickup_day_of_week,
       dayname(lpep_pickup_datetime) as day_name,
       round(avg(trip_duration), 6) as avg_duration, count(*) as trips
from cleaned group by 1, 2
"""))
def avg_duration_by_dow(spark, sf_dir):
    """Mean duration by weekday (Monday = 0) with its name."""
    df = clean.clean_trips(views.trips(spark, sf_dir))
    return (df.groupBy(day_of_week("lpep_pickup_datetime").alias("pickup_day_of_week"))
              .agg(F.round(F.avg("trip_duration"), 6).alias("avg_duration"),
                   F.count(F.lit(1)).alias("trips"))
              .withColumn("day_name", day_name("pickup_day_of_week")))
