"""Queries: encodings, record normalisation, feature vectors, vocabulary and
splits (P7-P11, F1, F8, D1-D3, D5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, ORDERED_FEATURE_NAMES, RECORD_NUMERIC_KEYS
from sparktrips.functions.columns import pu_do
from sparktrips.operators import clean, features, split
from sparktrips.plans.catalog import register
from sparktrips.plans.q_validate import _num as _number_sql
from sparktrips.plans.sqlviews import with_clean, with_requests, with_trips
from sparktrips.sources import views

_ENC_SQL = "case when upper(trim(store_and_fwd_flag)) = 'Y' then 1 else 0 end"
_TABLE_FEATURES = [c for c in ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "improvement_surcharge",
                               "total_amount", "congestion_surcharge", "cbd_congestion_fee"]]


def _cleaned(spark, sf_dir):
    return clean.clean_trips(views.trips(spark, sf_dir))


@register("encode_flag", with_trips(f"""
select trip_id, store_and_fwd_flag, cast({_ENC_SQL} as int) as store_and_fwd_flag_encoded from trips"""))
def encode_flag(spark, sf_dir):
    return features.encode_flag_column(views.trips(spark, sf_dir)).select(
        "trip_id", "store_and_fwd_flag", "store_and_fwd_flag_encoded")


@register("encode_features", with_clean(f"""
select trip_id, {", ".join(_TABLE_FEATURES)}, cast({_ENC_SQL} as int) as store_and_fwd_flag_encoded from cleaned"""))
def encode_features(spark, sf_dir):
    return features.encode_features(_cleaned(spark, sf_dir))


# Record path in SQL: JSON member presence, text and type.
def _value(k):
    return _number_sql(k)


def _num(k):
    return f"{_value(k)} as {k}"


def _bad(k):
    return f"case when json_extract(payload, '$.{k}') is not null and {_value(k)} is null then '{k}' end"


_ERRORS_SQL = "list_filter([" + ", ".join(_bad(k) for k in [*RECORD_NUMERIC_KEYS, "store_and_fwd_flag_encoded"]) + "], lambda x: x is not null)"


_FLAG_TXT = "json_extract_string(payload, '$.store_and_fwd_flag')"
_FLAG_TYPE = "json_type(payload, '$.store_and_fwd_flag')"
_REC_FLAG_SQL = f"""cast(case
  when json_extract(payload, '$.store_and_fwd_flag_encoded') is not null
    then try_cast(trunc({_number_sql('store_and_fwd_flag_encoded')}) as int)
  when json_extract(payload, '$.store_and_fwd_flag') is not null then case
    when {_FLAG_TYPE} = 'VARCHAR' then (case when upper(trim({_FLAG_TXT})) = 'Y' then 1 else 0 end)
    when {_FLAG_TYPE} = 'BOOLEAN' then (case when {_FLAG_TXT} = 'true' then 1 else 0 end)
    when {_FLAG_TYPE} in ('UBIGINT', 'BIGINT', 'DOUBLE') then (case when try_cast({_FLAG_TXT} as double) <> 0 then 1 else 0 end)
    else 0 end
  else 0 end as int)"""
_REC_PUDO_SQL = """case
  when json_extract(payload, '$.PU_DO') is not null then coalesce(json_extract_string(payload, '$.PU_DO'), 'None')
  when json_extract(payload, '$.PULocationID') is not null and json_extract(payload, '$.DOLocationID') is not null
    then concat_ws('_', coalesce(json_extract_string(payload, '$.PULocationID'), 'None'),
                        coalesce(json_extract_string(payload, '$.DOLocationID'), 'None'))
  end"""


@register("normalize_record", with_requests(f"""
select request_id, pos, l_partkey, l_suppkey, payload, {", ".join(_num(k) for k in RECORD_NUMERIC_KEYS)},
  {_REC_FLAG_SQL} as store_and_fwd_flag_encoded, {_REC_PUDO_SQL} as PU_DO, array_to_string({_ERRORS_SQL}, ',') as errors
from requests"""))
def normalize_record(spark, sf_dir):
    records = features.normalize_records(features.parse_records(views.requests(spark, sf_dir)))
    return records.withColumn("errors", F.array_join("errors", ","))


@register("pu_do_pair", with_trips("""
select trip_id, case when PULocationID is not null and DOLocationID is not null
  then concat_ws('_', PULocationID, DOLocationID) end as PU_DO from trips"""))
def pu_do_pair(spark, sf_dir):
    return views.trips(spark, sf_dir).select("trip_id", pu_do("PULocationID", "DOLocationID").alias("PU_DO"))


_ORDERED_RECORD_SQL = ", ".join(
    f"coalesce({_value(n)}, 0.0) as {n}"
    if n != "store_and_fwd_flag_encoded" else f"cast({_REC_FLAG_SQL} as double) as {n}"
    for n in ORDERED_FEATURE_NAMES)


@register("prepare_features", with_requests(f"""
select request_id, pos, l_partkey, l_suppkey, payload, {_REC_PUDO_SQL} as PU_DO, {_ORDERED_RECORD_SQL} from requests
where len({_ERRORS_SQL}) = 0"""))
def prepare_features(spark, sf_dir):
    """P11 + F1 on the record path: records -> fixed-order model inputs."""
    return features.feature_columns(features.prepare_features(views.requests(spark, sf_dir)))


@register("assemble_features", with_clean(f"""
select trip_id, {", ".join(f"cast({_ENC_SQL} as double) as {n}" if n == "store_and_fwd_flag_encoded"
                           else f"coalesce(cast({n} as double), 0.0) as {n}" for n in ORDERED_FEATURE_NAMES)}
from cleaned"""))
def assemble_features(spark, sf_dir):
    """F1 (columnar check form): trip table -> the nine inputs in model order."""
    return features.feature_columns(features.encode_features(_cleaned(spark, sf_dir)))


def _vector_records(spark, sf_dir):
    df = _cleaned(spark, sf_dir)
    enc = features.encode_flag_column(df)
    return enc.select("trip_id", *ORDERED_FEATURE_NAMES, pu_do("PULocationID", "DOLocationID").alias("PU_DO"))


def _entry_sql(n: str) -> str:
    v = f"cast({_ENC_SQL} as double)" if n == "store_and_fwd_flag_encoded" else f"coalesce(cast({n} as double), 0.0)"
    return f"select trip_id, '{n}' as name, {v} as value from cleaned"


_PUDO_ENTRY_SQL = "select trip_id, concat('PU_DO=', concat_ws('_', PULocationID, DOLocationID)) as name, 1.0 as value from cleaned"


@register("dict_vectorize", with_clean(
    "select distinct name from (\n" + "\nunion all\n".join(
        [_PUDO_ENTRY_SQL] + [_entry_sql(n) for n in ORDERED_FEATURE_NAMES]) + "\n) t"))
def dict_vectorize(spark, sf_dir):
    """F8 fit, as a table: the vocabulary (feature names)."""
    return features.vocabulary_frame(_vector_records(spark, sf_dir), ORDERED_FEATURE_NAMES, ["PU_DO"])


@register("dict_vectorize_long", with_clean(
    "select trip_id, name, value from (\n" + "\nunion all\n".join(
        [_PUDO_ENTRY_SQL] + [_entry_sql(n) for n in ORDERED_FEATURE_NAMES]) + "\n) t where value <> 0"))
def dict_vectorize_long(spark, sf_dir):
    """F8 transform, checkable long form: (trip_id, name, value) of non-zero entries."""
    recs = _vector_records(spark, sf_dir)
    vocab = features.vocabulary_frame(recs, ORDERED_FEATURE_NAMES, ["PU_DO"])
    return features.vectorize_long(recs, "trip_id", ORDERED_FEATURE_NAMES, ["PU_DO"], vocab)


# ------------------------------------------------------------------ splits

_S = DEFAULT_SETTINGS
_U_SQL = f"cast(('0x' || substr(md5(concat_ws(':', trip_id, '{_S.random_state}')), 1, 8)) as ubigint)"
_CUT_VAL = _S.test_size + (1.0 - _S.test_size) * _S.val_size
_HASH_SPLIT_SQL = (f"case when cast({_U_SQL} as double) / 4294967296.0 < {_S.test_size!r} then 'test' "
                   f"when cast({_U_SQL} as double) / 4294967296.0 < {_CUT_VAL!r} then 'val' else 'train' end")


@register("hash_split", with_clean(f"select trip_id, {_HASH_SPLIT_SQL} as split from cleaned"))
def hash_split(spark, sf_dir):
    return split.hash_split(_cleaned(spark, sf_dir)).select("trip_id", "split")


@register("exact_split", with_clean(f"""
select trip_id, case when r < n_test then 'test' when r < n_test + n_val then 'val' else 'train' end as split
from (select trip_id, row_number() over (order by {_U_SQL}, trip_id) - 1 as r from cleaned) t,
     (select ceil(cast(count(*) as double) * {_S.test_size!r}) as n_test,
             ceil((cast(count(*) as double) - ceil(cast(count(*) as double) * {_S.test_size!r})) * {_S.val_size!r}) as n_val
      from cleaned) n"""))
def exact_split(spark, sf_dir):
    return split.exact_split(_cleaned(spark, sf_dir).select("trip_id")).select("trip_id", "split")


@register("split_sizes", with_clean(f"""
select split, count(*) as rows, round(cast(count(*) as double) * 100.0 / cast(sum(count(*)) over () as double), 6) as pct
from (select {_HASH_SPLIT_SQL} as split from cleaned) t group by split"""))
def split_sizes(spark, sf_dir):
    return split.split_sizes(split.hash_split(_cleaned(spark, sf_dir)))


@register("first_n", with_clean("""
select trip_id, trip_distance, fare_amount, total_amount, trip_duration from cleaned order by trip_id limit 500"""))
def first_n(spark, sf_dir):
    df = _cleaned(spark, sf_dir).select("trip_id", "trip_distance", "fare_amount", "total_amount", "trip_duration")
    return split.first_n(df, 500)
