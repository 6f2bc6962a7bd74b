"""Queries: service logs and streaming."""

from __future__ import annotations


from pyspark.sql import functions as F

from sparktrips.operators import logs
from sparktrips.operators.epochs import read_epochs
from sparktrips.plans.catalog import register
from sparktrips.plans.q_validate import _K, _VALIDATED_CTE, _num as _number_sql
from sparktrips.plans.sqlviews import with_log, with_requests
from sparktrips.sources import views
from sparktrips.streaming import jobs

_PARSED_CTE = """parsed as (
  select ts, line, json_extract_string(line, '$.timestamp') as timestamp, json_extract_string(line, '$.level') as level,
    json_extract_string(line, '$.logger') as logger, json_extract_string(line, '$.message') as message,
    json_extract_string(line, '$.correlation_id') as correlation_id, json_extract_string(line, '$.exception') as exception,
    coalesce(json_valid(line) and json_type(line) = 'OBJECT' and json_extract_string(line, '$.level') is not null, false)
      as parsed_ok
  from service_log)"""


def _rx(name: str) -> str:
    return "'" + getattr(logs, name) + "'"


_LAT_CTE = f"""lat as (
  select ts, message,
    case when regexp_matches(message, {_rx('RE_PREDICTION')}) then 'prediction'
         when regexp_matches(message, {_rx('RE_REQUEST')}) then 'request'
         when regexp_matches(message, {_rx('RE_TIMED')}) then 'timed' end as kind,
    case when regexp_matches(message, {_rx('RE_REQUEST')}) then regexp_extract(message, {_rx('RE_REQUEST')}, 1) end as method,
    case when regexp_matches(message, {_rx('RE_REQUEST')}) then regexp_extract(message, {_rx('RE_REQUEST')}, 2)
         when regexp_matches(message, {_rx('RE_TIMED')}) then regexp_extract(message, {_rx('RE_TIMED')}, 1) end as path,
    case when regexp_matches(message, {_rx('RE_REQUEST')}) then try_cast(regexp_extract(message, {_rx('RE_REQUEST')}, 3) as int) end as status,
    case when regexp_matches(message, {_rx('RE_PREDICTION')}) then try_cast(regexp_extract(message, {_rx('RE_PREDICTION')}, 2) as double)
         when regexp_matches(message, {_rx('RE_REQUEST')}) then try_cast(regexp_extract(message, {_rx('RE_REQUEST')}, 4) as double)
         when regexp_matches(message, {_rx('RE_TIMED')}) then try_cast(regexp_extract(message, {_rx('RE_TIMED')}, 2) as double) end
      as latency_ms
  from parsed)"""


def _parsed(spark, sf_dir):
    return logs.parse_log_lines(views.service_log(spark, sf_dir))


def _lat(spark, sf_dir):
    return logs.extract_latency(_parsed(spark, sf_dir))


@register("parse_log_lines", with_log("""
select ts, timestamp, level, logger, message, correlation_id, exception, parsed_ok from parsed""", _PARSED_CTE))
def parse_log_lines(spark, sf_dir):
    return _parsed(spark, sf_dir).drop("line")


@register("extract_latency", with_log("select ts, kind, method, path, status, latency_ms from lat",
                                      _PARSED_CTE + ",\n" + _LAT_CTE))
def extract_latency(spark, sf_dir):
    return _lat(spark, sf_dir).select("ts", "kind", "method", "path", "status", "latency_ms")


@register("latency_summary", with_log("""
select kind, path, count(*) as calls, round(avg(latency_ms), 6) as mean_ms,
  round(quantile_cont(latency_ms, 0.95), 6) as p95_ms,
  round(avg(latency_ms) / nullif(min(avg(latency_ms)) over (), 0), 6) as ratio_to_fastest
from lat where latency_ms is not null group by kind, path""", _PARSED_CTE + ",\n" + _LAT_CTE))
def latency_summary(spark, sf_dir):
    return logs.latency_summary(_lat(spark, sf_dir), ["kind", "path"])


@register("log_level_counts", with_log("""
select level, logger, count(*) as lines from parsed where parsed_ok group by level, logger""", _PARSED_CTE))
def log_level_counts(spark, sf_dir):
    return logs.level_counts(_parsed(spark, sf_dir))


@register("errors_by_correlation", with_log("""
select correlation_id, count(*) as errors from parsed where level = 'ERROR' group by correlation_id""", _PARSED_CTE))
def errors_by_correlation(spark, sf_dir):
    return logs.errors_by_correlation(_parsed(spark, sf_dir))


_WINDOWS_SQL = with_log("""
select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval '1' hour as window_end,
  count(*) as calls, round(avg(latency_ms), 6) as mean_ms
from lat where latency_ms is not null group by 1, 2""", _PARSED_CTE + ",\n" + _LAT_CTE)


@register("latency_windows", _WINDOWS_SQL)
def latency_windows(spark, sf_dir):
    """L5 batch form: hourly tumbling windows (the stream's reference result)."""
    return logs.latency_windows(_lat(spark, sf_dir), "ts", "1 hour")


@register("stream_latency_windows", _WINDOWS_SQL)
def stream_latency_windows(spark, sf_dir):
    """The same windows from a Structured Streaming query with a watermark."""
    return jobs.stream_latency_windows(spark, sf_dir).drop("p95_ms", "late")


@register("stream_latency_p95", with_log("""
select date_trunc('hour', ts) as window_start, count(*) as calls, true as within_rank_error
from lat where latency_ms is not null group by 1""", _PARSED_CTE + ",\n" + _LAT_CTE))
def stream_latency_p95(spark, sf_dir):
    """Each window's streamed P95 has a rank of 95 % of the window's lines, but for the sketch's error."""
    windows = jobs.stream_latency_windows(spark, sf_dir).select("window_start", "calls", "p95_ms")
    lines = _lat(spark, sf_dir).where("latency_ms is not null").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "latency_ms")
    ranks = lines.join(windows, "window_start").groupBy("window_start", "calls").agg(
        F.count_if(F.col("latency_ms") < F.col("p95_ms")).alias("below"), F.count_if(F.col("latency_ms") <= F.col("p95_ms")).alias("upto"))
    slack = jobs.P95_RANK_ERROR * F.col("calls") + 1
    within = (F.col("below") <= 0.95 * F.col("calls") + slack) & (F.col("upto") >= 0.95 * F.col("calls") - slack)
    return ranks.select("window_start", "calls", within.alias("within_rank_error"))


@register("stream_late_lines", with_log("""
select date_trunc('hour', ts) as window_start, count(*) as lines from lat where latency_ms is not null group by 1""", _PARSED_CTE + ",\n" + _LAT_CTE))
def stream_late_lines(spark, sf_dir):
    """L5 on lines that come out of order: those kept and those counted as late are all."""
    found = jobs.stream_out_of_order(spark, sf_dir)
    return found.select("window_start", (F.col("calls") + F.col("late")).alias("lines"))


_SCORED = ["request_id", "pos", "l_partkey", "l_suppkey", "correlation_id", "prediction", "out_of_training_range"]


@register("stream_score")
def stream_score(spark, sf_dir):
    """Requests stream -> validate -> score with the fitted linear
    pipeline (Spark ML ``transform`` inside ``foreachBatch``) -> predictions."""
    from sparktrips.plans.q_model import _fit
    fitted = _fit(spark, sf_dir, "linear_regression")
    scorer = lambda df: fitted.transform(df).drop("features")
    return read_epochs(spark, jobs.stream_score(spark, sf_dir, scorer)["root"], "predictions").select(*_SCORED)


_WHOLE_SQL = with_requests(f"""
, judged as (select *, coalesce(request_id, sha256(concat_ws('|', cast(pos as varchar), payload))) as correlation_id from validated),
whole as (select correlation_id from judged group by 1 having count(*) filter (where n_errors > 0) = 0 and count(*) between 1 and 1000)
select {_K}, correlation_id, 3.0 * d + 5.0 as prediction, d > 100 as out_of_training_range
from (select *, {_number_sql('trip_distance')} as d from judged where correlation_id in (select correlation_id from whole)) t""", _VALIDATED_CTE)


def _known_weights(df):
    return df.withColumn("prediction", F.lit(3.0) * F.col("trip_distance") + F.lit(5.0))


@register("stream_score_known_weights", _WHOLE_SQL)
def stream_score_known_weights(spark, sf_dir):
    """T1 with the weights of ``score_linear_sql``: whole requests only."""
    return read_epochs(spark, jobs.stream_score(spark, sf_dir, _known_weights)["root"], "predictions").select(*_SCORED)


@register("stream_score_parts", _WHOLE_SQL)
def stream_score_parts(spark, sf_dir):
    """T1 where the trips of a request come in several micro-batches: the same result."""
    return read_epochs(spark, jobs.stream_score_parts(spark, views.requests(spark, sf_dir), _known_weights)["root"], "predictions").select(*_SCORED)
