"""Fixture views over the driver's tables.

The driver's tables hold no taxi trips, requests or service logs. These views
derive those shapes from ``lineitem`` and ``events`` deterministically, so the
same rows exist in Spark and in the SQL oracle (see FIXTURES.md §2). Every
column is a per-row expression: the views scale with their input and add no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrips.sources.tables import read_table

def _d(x: float):
    return F.lit(float(x))


def trips_from_lineitem(li: DataFrame) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    qty, price, disc = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    block = pk % 8 == 0

    pickup = F.timestamp_add("MINUTE", ((ok * 37 + ln * 11) % 1440).cast("int"), F.col("l_shipdate"))
    seconds = (F.when(pk % 50 == 0, _d(0))
               .when(pk % 211 == 0, _d(-300))
               .when(ok % 307 == 0, (86000 + pk % 300).cast("double"))
               .otherwise(qty * 40 + pk % 60)).cast("int")
    dropoff = F.timestamp_add("SECOND", seconds, pickup)

    fare = F.floor(price / 10) / _d(100)
    tip = F.floor(price * disc / 10) / _d(100)
    tolls = F.when(sk % 20 == 0, _d(6.94)).otherwise(_d(0))
    extra = F.when(ln % 3 == 0, _d(1)).otherwise(_d(0))
    congestion_in_total = F.when(pk % 12 == 0, _d(2.75)).otherwise(_d(0))

    return li.select(
        F.concat_ws("-", *[c.cast("string") for c in (ok, ln, pk, sk)]).alias("trip_id"),
        (sk % 2 + 1).cast("int").alias("VendorID"),
        pickup.alias("lpep_pickup_datetime"),
        dropoff.alias("lpep_dropoff_datetime"),
        F.when(block, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "R", F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        F.when(~block, (pk % 6 + 1).cast("double")).alias("RatecodeID"),
        (pk % 263 + 1).cast("int").alias("PULocationID"),
        (sk % 263 + 1).cast("int").alias("DOLocationID"),
        F.when(~block, (ln % 7).cast("double")).alias("passenger_count"),
        F.when(pk % 17 == 0, _d(0)).otherwise(F.floor(qty * 25 + disc * 100) / _d(100)).alias("trip_distance"),
        fare.alias("fare_amount"),
        extra.alias("extra"),
        _d(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        F.lit(None).cast("double").alias("ehail_fee"),
        _d(1).alias("improvement_surcharge"),
        (fare + tip + tolls + extra + _d(1.5) + congestion_in_total).alias("total_amount"),
        F.when(~block, (ok % 4 + 1).cast("double")).alias("payment_type"),
        F.when(~block, (ok % 2 + 1).cast("double")).alias("trip_type"),
        F.when(block, F.lit(None).cast("double"))
         .when(pk % 3 == 0, _d(2.75)).otherwise(_d(0)).alias("congestion_surcharge"),
        F.when(pk % 4 == 1, _d(0.75)).otherwise(_d(0)).alias("cbd_congestion_fee"),
    )


def requests_from_lineitem(li: DataFrame, *kept: str) -> DataFrame:
    """One JSON request record per lineitem row. An order is a request of a few
    trips; of each 5,000 orders, 400 make one request of over 1,000 trips, and
    one order in 97 gives no request id. The records hold every kind of value
    that validation tells apart (FIXTURES.md)."""
    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    fare_i = F.floor(F.col("l_extendedprice") / 1000).cast("int")
    odd = {59: '"3.5d"', 61: '" 7.5 "', 67: "null", 71: "[1]", 73: '{"a": 1}', 79: "true", 31: "-5", 37: "250", 41: "150", 103: '"1_0"'}
    dist = F.lit(None).cast("string")
    for k, text in reversed(odd.items()):
        dist = F.when(pk % k == 0, F.lit(text)).otherwise(dist)
    dist = F.coalesce(dist, F.col("l_quantity").cast("int").cast("string"))
    flag = (F.when(pk % 47 == 0, ', "store_and_fwd_flag": "X"').when(pk % 19 == 0, ', "store_and_fwd_flag": true')
             .when(pk % 17 == 0, ', "store_and_fwd_flag": 1').when(pk % 2 == 0, ', "store_and_fwd_flag": "y"').otherwise(""))
    body = F.concat(
        F.lit('{"trip_distance": '), dist,
        F.when(pk % 43 == 0, F.lit("")).when(pk % 107 == 0, F.lit(', "fare_amount": "abc"'))
         .otherwise(F.concat(F.lit(', "fare_amount": '), fare_i.cast("string"))),
        F.lit(', "total_amount": '), (fare_i + 3).cast("string"), flag,
        F.when(pk % 53 == 0, F.lit(', "tip_amount": null')).otherwise(F.lit("")),
        F.when(pk % 23 == 0, F.lit(', "PU_DO": "7_8"')).when(pk % 29 == 0, F.lit(', "PULocationID": 10, "DOLocationID": 20')).otherwise(F.lit("")),
        F.when(pk % 109 == 0, F.lit(', "store_and_fwd_flag_encoded": 1')).otherwise(F.lit("")),
        F.lit("}"),
    )
    payload = F.when(pk % 83 == 0, F.lit("[1, 2]")).when(pk % 89 == 0, F.lit('"text"')).otherwise(body)
    request = (F.when(ok % 97 == 0, F.lit(None).cast("string"))
                .when(ok % 5000 < 400, F.concat(F.lit("b"), F.floor(ok / 5000).cast("string")))
                .otherwise(F.concat(F.lit("r"), ok.cast("string"))))
    return li.select(request.alias("request_id"), F.col("l_linenumber").alias("pos"), "l_partkey", "l_suppkey", payload.alias("payload"), *kept)


def service_log_from_events(ev: DataFrame) -> DataFrame:
    """JSON service-log lines, one per event; ``ts`` is the event time."""
    is_err = F.col("event_type") == "error"
    hundredths = F.floor(F.col("value") * 100)
    # two decimals written out: engines print doubles differently
    ms = F.when(F.col("user_id") % 50 == 0, F.lit("0")).otherwise(F.concat(
        F.floor(hundredths / 100).cast("int").cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("int").cast("string"), 2, "0")))
    message = (F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("Prediction served: 12.50 minutes with latency "), ms, F.lit(" ms")))
                .when(F.col("user_id") % 7 == 0, F.concat(F.col("event_type"), F.lit(" executed in "), ms, F.lit(" ms")))
                .when(F.col("user_id") % 11 == 0, F.lit("Model loaded"))
                .otherwise(F.concat(F.lit("Request POST /"), F.col("event_type"), F.lit(" completed with status "),
                                    F.when(is_err, F.lit("500")).otherwise(F.lit("200")), F.lit(" in "), ms, F.lit(" ms"))))
    line = F.concat(
        F.lit('{"timestamp": "2024-01-01T00:00:00+00:00", "level": "'),
        F.when(is_err, F.lit("ERROR")).otherwise(F.lit("INFO")),
        F.lit('", "logger": "svc.api", "message": "'), message, F.lit('", "correlation_id": '),
        F.when(F.col("user_id") % 10 == 0, F.lit("null"))
         .otherwise(F.concat(F.lit('"c'), F.col("user_id").cast("string"), F.lit('"'))),
        F.lit("}"),
    )
    return ev.select(F.col("ts"), line.alias("line"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def service_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_log_from_events(read_table(spark, sf_dir, "events"))
