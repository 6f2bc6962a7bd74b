"""DuckDB SQL for the fixture views and the cleaning chain.

These are the oracle's side of ``sources/views.py`` and ``operators/clean.py``:
the same rows, written independently in SQL. Each oracle query is
``WITH <ctes> SELECT ...`` over the driver's pre-registered tables.
"""

TRIPS_SQL = """
select
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as trip_id,
  cast(l_suppkey % 2 + 1 as int) as VendorID,
  l_shipdate + interval '1' minute * cast((l_orderkey * 37 + l_linenumber * 11) % 1440 as int) as lpep_pickup_datetime,
  l_shipdate + interval '1' minute * cast((l_orderkey * 37 + l_linenumber * 11) % 1440 as int)
    + interval '1' second * cast(case when l_partkey % 50 = 0 then 0
                                      when l_partkey % 211 = 0 then -300
                                      when l_orderkey % 307 = 0 then 86000 + l_partkey % 300
                                      else l_quantity * 40 + l_partkey % 60 end as int) as lpep_dropoff_datetime,
  case when l_partkey % 8 = 0 then null when l_returnflag = 'R' then 'Y' else 'N' end as store_and_fwd_flag,
  case when l_partkey % 8 = 0 then null else cast(l_partkey % 6 + 1 as double) end as RatecodeID,
  cast(l_partkey % 263 + 1 as int) as PULocationID,
  cast(l_suppkey % 263 + 1 as int) as DOLocationID,
  case when l_partkey % 8 = 0 then null else cast(l_linenumber % 7 as double) end as passenger_count,
  case when l_partkey % 17 = 0 then cast(0 as double) else floor(l_quantity * 25 + l_discount * 100) / cast(100 as double) end as trip_distance,
  floor(l_extendedprice / 10) / cast(100 as double) as fare_amount,
  case when l_linenumber % 3 = 0 then cast(1 as double) else cast(0 as double) end as extra,
  cast(0.5 as double) as mta_tax,
  floor(l_extendedprice * l_discount / 10) / cast(100 as double) as tip_amount,
  case when l_suppkey % 20 = 0 then cast(6.94 as double) else cast(0 as double) end as tolls_amount,
  cast(null as double) as ehail_fee,
  cast(1 as double) as improvement_surcharge,
  floor(l_extendedprice / 10) / cast(100 as double) + floor(l_extendedprice * l_discount / 10) / cast(100 as double)
    + case when l_suppkey % 20 = 0 then cast(6.94 as double) else cast(0 as double) end
    + case when l_linenumber % 3 = 0 then cast(1 as double) else cast(0 as double) end + cast(1.5 as double)
    + case when l_partkey % 12 = 0 then cast(2.75 as double) else cast(0 as double) end as total_amount,
  case when l_partkey % 8 = 0 then null else cast(l_orderkey % 4 + 1 as double) end as payment_type,
  case when l_partkey % 8 = 0 then null else cast(l_orderkey % 2 + 1 as double) end as trip_type,
  case when l_partkey % 8 = 0 then null when l_partkey % 3 = 0 then cast(2.75 as double) else cast(0 as double) end as congestion_surcharge,
  case when l_partkey % 4 = 1 then cast(0.75 as double) else cast(0 as double) end as cbd_congestion_fee
from lineitem
"""

REQUESTS_SQL = """
select case when l_orderkey % 97 = 0 then null when l_orderkey % 5000 < 400 then concat('b', l_orderkey // 5000)
            else concat('r', l_orderkey) end as request_id,
 l_linenumber as pos, l_partkey, l_suppkey,
 case when l_partkey % 83 = 0 then '[1, 2]' when l_partkey % 89 = 0 then '"text"' else
 concat('{"trip_distance": ', case
     when l_partkey % 59 = 0 then '"3.5d"' when l_partkey % 61 = 0 then '" 7.5 "' when l_partkey % 67 = 0 then 'null'
     when l_partkey % 71 = 0 then '[1]' when l_partkey % 73 = 0 then '{"a": 1}' when l_partkey % 79 = 0 then 'true'
     when l_partkey % 31 = 0 then '-5' when l_partkey % 37 = 0 then '250' when l_partkey % 41 = 0 then '150'
     when l_partkey % 103 = 0 then '"1_0"' else cast(cast(l_quantity as int) as varchar(20)) end,
   case when l_partkey % 43 = 0 then '' when l_partkey % 107 = 0 then ', "fare_amount": "abc"'
        else concat(', "fare_amount": ', cast(cast(floor(l_extendedprice/1000) as int) as varchar(20))) end,
   ', "total_amount": ', cast(cast(floor(l_extendedprice/1000) as int) + 3 as varchar(20)),
   case when l_partkey % 47 = 0 then ', "store_and_fwd_flag": "X"' when l_partkey % 19 = 0 then ', "store_and_fwd_flag": true'
        when l_partkey % 17 = 0 then ', "store_and_fwd_flag": 1' when l_partkey % 2 = 0 then ', "store_and_fwd_flag": "y"' else '' end,
   case when l_partkey % 53 = 0 then ', "tip_amount": null' else '' end,
   case when l_partkey % 23 = 0 then ', "PU_DO": "7_8"' when l_partkey % 29 = 0 then ', "PULocationID": 10, "DOLocationID": 20' else '' end,
   case when l_partkey % 109 = 0 then ', "store_and_fwd_flag_encoded": 1' else '' end, '}') end as payload
from lineitem
"""

_LATENCY_SQL = """case when user_id % 50 = 0 then '0' else concat(cast(floor(value * 100) as bigint) // 100, '.',
  lpad(cast(cast(floor(value * 100) as bigint) % 100 as varchar), 2, '0')) end"""
SERVICE_LOG_SQL = f"""
select cast(ts as timestamp) as ts, concat('{{"timestamp": "2024-01-01T00:00:00+00:00", "level": "', case when event_type = 'error' then 'ERROR' else 'INFO' end,
  '", "logger": "svc.api", "message": "', case
    when user_id % 3 = 0 then concat('Prediction served: 12.50 minutes with latency ', {_LATENCY_SQL}, ' ms')
    when user_id % 7 = 0 then concat(event_type, ' executed in ', {_LATENCY_SQL}, ' ms')
    when user_id % 11 = 0 then 'Model loaded'
    else concat('Request POST /', event_type, ' completed with status ', case when event_type = 'error' then '500' else '200' end,
                ' in ', {_LATENCY_SQL}, ' ms') end,
  '", "correlation_id": ', case when user_id % 10 = 0 then 'null' else concat('"c', user_id, '"') end, '}}') as line
from events
"""

# Cleaning chain in SQL: duration, drop ehail_fee, null block, quantile cut, distance cut.
DURATION_SQL = "cast(date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) as double) / 60000000.0"

CLEAN_CTES = f"""
trips as ({TRIPS_SQL}),
with_duration as (select * exclude (ehail_fee), {DURATION_SQL} as trip_duration from trips),
blocked as (
  select * from with_duration
  where store_and_fwd_flag is not null and RatecodeID is not null and passenger_count is not null
    and payment_type is not null and trip_type is not null and congestion_surcharge is not null),
bound as (select quantile_cont(trip_duration, 0.995) as upper_bound from blocked),
dur_ok as (select * from blocked where trip_duration > 0 and trip_duration <= (select upper_bound from bound)),
cleaned as (select * from dur_ok where trip_distance > 0)
"""


def with_trips(body: str) -> str:
    return f"with trips as ({TRIPS_SQL})\n{body}"


def with_clean(body: str) -> str:
    return f"with {CLEAN_CTES}\n{body}"


def with_requests(body: str, extra_ctes: str = "") -> str:
    sep = ",\n" if extra_ctes else ""
    return f"with requests as ({REQUESTS_SQL}){sep}{extra_ctes}\n{body}"


def with_log(body: str, extra_ctes: str = "") -> str:
    sep = ",\n" if extra_ctes else ""
    return f"with service_log as ({SERVICE_LOG_SQL}){sep}{extra_ctes}\n{body}"
