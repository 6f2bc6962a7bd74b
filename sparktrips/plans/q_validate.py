"""Queries: request parsing and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktrips.config import (FLAG_PATTERN, MSG_GE, MSG_GT, MSG_LT, MSG_NUMBER, MSG_NUMBER_PARSE, MSG_PATTERN,
                               MSG_REQUIRED, MSG_STRING, OUT_OF_RANGE_DISTANCE, REQUEST_FIELDS)
from sparktrips.operators import validate as V
from sparktrips.plans.catalog import register
from sparktrips.plans.sqlviews import with_requests
from sparktrips.session import scratch_path
from sparktrips.sources import views

KEYS = ["request_id", "pos", "l_partkey", "l_suppkey"]
_K = ", ".join(KEYS)


def _requests(spark, sf_dir):
    return views.requests(spark, sf_dir)


def _validated(spark, sf_dir):
    return V.validate_records(_requests(spark, sf_dir))


# ------------------------------------------------------------- SQL side

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _present(n):
    return f"json_extract(payload, '$.{n}') is not null"


def _jt(n):
    return f"json_type(payload, '$.{n}')"


_NUMBER_SQL = "'^[+-]?([0-9]+(_[0-9]+)*(\\.([0-9]+(_[0-9]+)*)?)?([eE][+-]?[0-9]+)?|\\.[0-9]+([eE][+-]?[0-9]+)?)$'"


def _num(n):
    txt = f"trim(json_extract_string(payload, '$.{n}'))"
    return (f"(case when {_jt(n)} = 'BOOLEAN' then (case when json_extract_string(payload, '$.{n}') = 'true' "
            f"then 1.0 else 0.0 end) when regexp_matches({txt}, {_NUMBER_SQL}) then try_cast(replace({txt}, '_', '') as double) end)")


def _err_sql(n, default, gt, ge, lt):
    """'field: message' or NULL, first failing rule wins."""
    def e(msg):
        return _q(f"{n}: {msg}")
    missing = e(MSG_REQUIRED) if default is None else "null"
    if n == "store_and_fwd_flag":
        return (f"case when not ({_present(n)}) then {missing} when {_jt(n)} <> 'VARCHAR' then {e(MSG_STRING)} "
                f"when json_extract_string(payload, '$.{n}') not in ('Y', 'N', 'y', 'n') "
                f"then {e(MSG_PATTERN.format(FLAG_PATTERN))} end")
    x = _num(n)
    s = (f"case when not ({_present(n)}) then {missing} when {_jt(n)} = 'NULL' then {e(MSG_NUMBER)} "
         f"when {_jt(n)} = 'VARCHAR' and {x} is null then {e(MSG_NUMBER_PARSE)} "
         f"when {_jt(n)} not in ('UBIGINT', 'BIGINT', 'DOUBLE', 'VARCHAR', 'BOOLEAN') or {x} is null then {e(MSG_NUMBER)} ")
    if lt is not None:
        s += f"when isnan({x}) or not ({x} < {lt!r}) then {e(MSG_LT.format(V._num_txt(lt)))} "
    if ge is not None:
        s += f"when isnan({x}) or not ({x} >= {ge!r}) then {e(MSG_GE.format(V._num_txt(ge)))} "
    if gt is not None:
        s += f"when isnan({x}) or not ({x} > {gt!r}) then {e(MSG_GT.format(V._num_txt(gt)))} "
    return s + "end"


_ERRS = [_err_sql(*f) for f in REQUEST_FIELDS]
_ROOT_MSG = _q(f"root: {V.MSG_NOT_OBJECT}")
_IS_OBJ = "coalesce(json_type(payload) = 'OBJECT', false)"
_VALIDATED_CTE = f"""validated as (
  select {_K}, payload,
    case when {_IS_OBJ} then concat_ws('; ', {", ".join(_ERRS)}) else {_ROOT_MSG} end as message,
    case when {_IS_OBJ} then {" + ".join(f"(case when ({x}) is null then 0 else 1 end)" for x in _ERRS)} else 1 end as n_errors
  from requests)"""


def _field_value_sql(n, default, use_default: bool):
    if n == "store_and_fwd_flag":
        val = f"json_extract_string(payload, '$.{n}')"
        d = _q(default)
    else:
        val = _num(n)
        d = "cast(null as double)" if default is None else f"cast({float(default)!r} as double)"
    if use_default:
        return f"case when not ({_present(n)}) then {d} else {val} end as {n}"
    return f"{val} as {n}"


# ------------------------------------------------------------------ queries

@register("read_trip_requests", with_requests(f"""
select {_K}, {_IS_OBJ} as is_object, {", ".join(_field_value_sql(n, d, False) for n, d, *_ in REQUEST_FIELDS)}
from requests"""))
def read_trip_requests(spark, sf_dir):
    """Request records parsed to typed fields (no defaults yet)."""
    d = V.with_field_parts(_requests(spark, sf_dir))
    part = lambda n: F.col(V._parts_col(n))["txt" if n == "store_and_fwd_flag" else "num"].alias(n)
    return d.select(*KEYS, F.col("_is_object").alias("is_object"), *[part(n) for n, *_ in REQUEST_FIELDS])


@register("read_request_files", with_requests(f"""
select payload, {_IS_OBJ} as is_object, {", ".join(_field_value_sql(n, d, False) for n, d, *_ in REQUEST_FIELDS)}, count(*) over () as requests
from requests"""))
def read_request_files(spark, sf_dir):
    """S2 through the reader: the records written as JSON lines, read again and parsed;
    every line has an id of its own."""
    path = scratch_path(spark, "request-files")
    _requests(spark, sf_dir).select("payload").write.text(path)
    lines = V.read_trip_requests(spark, path)
    ids = lines.agg(F.countDistinct("request_id")).scalar()
    part = lambda n: F.col(V._parts_col(n))["txt" if n == "store_and_fwd_flag" else "num"].alias(n)
    return V.with_field_parts(lines).select("payload", F.col("_is_object").alias("is_object"), *[part(n) for n, *_ in REQUEST_FIELDS], ids.alias("requests"))


@register("validate_ranges", with_requests(f"""
select {_K}, n_errors = 0 as accepted, n_errors from validated""", _VALIDATED_CTE))
def validate_ranges(spark, sf_dir):
    """V1 (+V3, V8): every record accepted or rejected, with its error count."""
    return _validated(spark, sf_dir).select(*KEYS, "accepted", F.size("errors").alias("n_errors"))


@register("apply_defaults", with_requests(f"""
select {_K}, {", ".join(_field_value_sql(n, d, True) for n, d, *_ in REQUEST_FIELDS)}
from (select * from validated where n_errors = 0) v""", _VALIDATED_CTE))
def apply_defaults(spark, sf_dir):
    """V2: accepted records as typed requests with defaults filled."""
    val = V.validate_records(_requests(spark, sf_dir), with_values=True)
    return V.route(val, True, [*KEYS, *[n for n, *_ in REQUEST_FIELDS]])


_FLAG_ERR = _err_sql(*[f for f in REQUEST_FIELDS if f[0] == "store_and_fwd_flag"][0])


@register("validate_flag_pattern", with_requests(f"""
select {_K}, json_extract_string(payload, '$.store_and_fwd_flag') as store_and_fwd_flag,
  ({_FLAG_ERR}) is null as flag_ok from requests"""))
def validate_flag_pattern(spark, sf_dir):
    """V3: flag must be one of Y N y n (missing -> default 'N')."""
    d = V.with_variant(_requests(spark, sf_dir))
    v = F.col(V.VARIANT)
    err = V.field_error(v, "store_and_fwd_flag", "N", None, None, None)
    return d.select(*KEYS, F.try_variant_get(v, "$.store_and_fwd_flag", "string").alias("store_and_fwd_flag"),
                    err.isNull().alias("flag_ok"))


@register("validation_report", with_requests(f"""
select {_K}, message, n_errors from validated where n_errors > 0""", _VALIDATED_CTE))
def validation_report(spark, sf_dir):
    """V4: rejected records with 'field: message; ...' and the error count."""
    return V.validation_report(_validated(spark, sf_dir), KEYS)


@register("rejects_by_rule", with_requests(f"""
select split_part(m, ': ', 1) as field, substr(m, strpos(m, ': ') + 2) as message, count(*) as rejections
from (select unnest(case when {_IS_OBJ} then list_filter([{", ".join(_ERRS)}], lambda x: x is not null) else [{_ROOT_MSG}] end) as m
      from requests) t
group by 1, 2"""))
def rejects_by_rule(spark, sf_dir):
    """V5: rejection counts per failing field and message."""
    return V.rejects_by_rule(_validated(spark, sf_dir))


@register("batch_size_rule", with_requests(f"""
select request_id, count(*) as n_trips, count(*) between 1 and 1000 as size_ok,
  case when count(*) > 1000 then concat('trips: List should have at most 1000 items after validation, not ', count(*)) end as message
from requests where request_id is not null group by request_id"""))
def batch_size_rule(spark, sf_dir):
    """V6: 1..1000 trips per request (trips of the caller's requests)."""
    return V.batch_size_rule(_requests(spark, sf_dir).where("request_id is not null"))


@register("reject_whole_request", with_requests(f"""
select request_id, count(*) as n_trips, count(*) filter (where n_errors > 0) as n_bad,
  count(*) filter (where n_errors > 0) = 0 and count(*) between 1 and 1000 as accepted
from validated group by request_id""", _VALIDATED_CTE))
def reject_whole_request(spark, sf_dir):
    """V7: a request is accepted only if every trip in it is valid."""
    return V.request_verdicts(_validated(spark, sf_dir))


@register("reject_malformed", with_requests(f"""
select {_K}, case when not {_IS_OBJ} then 'not_object' else 'unparsable_trip_distance' end as reason from requests
where not {_IS_OBJ} or (json_extract(payload, '$.trip_distance') is not null and (
  {_jt('trip_distance')} in ('NULL', 'ARRAY', 'OBJECT') or {_jt('trip_distance')} = 'VARCHAR'
  and not regexp_matches(trim(json_extract_string(payload, '$.trip_distance')), {_NUMBER_SQL})))"""))
def reject_malformed(spark, sf_dir):
    """V8: bodies that are not objects, or whose distance is no number."""
    return V.malformed(_requests(spark, sf_dir)).select(*KEYS, "reason")


@register("out_of_range_flag", with_requests(f"""
select {_K}, {_num('trip_distance')} as trip_distance,
  coalesce({_num('trip_distance')} > {OUT_OF_RANGE_DISTANCE!r}, false) as out_of_training_range
from (select * from validated where n_errors = 0) v""", _VALIDATED_CTE))
def out_of_range_flag(spark, sf_dir):
    """Accepted trips beyond the training distance are flagged, not dropped."""
    val = V.validate_records(_requests(spark, sf_dir), with_values=True)
    return V.route(val, True, [*KEYS, "trip_distance", V.out_of_range().alias("out_of_training_range")])


@register("correlation_id", with_requests(f"""
select {_K}, coalesce(request_id, sha256(concat_ws('|', cast(pos as varchar), payload))) as correlation_id
from requests"""))
def correlation_id(spark, sf_dir):
    """Caller id, else one derived from position and content."""
    return _requests(spark, sf_dir).select(*KEYS, V.correlation_id("request_id").alias("correlation_id"))
