"""Request validation: each JSON trip record is checked field by field and
routed to *accepted* or *rejected* with an ``errors`` array of
``STRUCT<field STRING, message STRING>``.

Per-row rules are column expressions (no UDF). Rules over a whole request
(size, one-bad-trip-rejects-all) are ``groupBy`` aggregates, which combine
map-side, so a request holding a third of all rows costs one partial buffer
per task rather than one oversized task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktrips.config import (BATCH_MAX_TRIPS, BATCH_MIN_TRIPS, FLAG_PATTERN, MSG_GE, MSG_GT, MSG_LIST_MAX,
                               MSG_LIST_MIN, MSG_LT, MSG_NUMBER, MSG_NUMBER_PARSE, MSG_PATTERN, MSG_REQUIRED,
                               MSG_STRING, OUT_OF_RANGE_DISTANCE, REQUEST_FIELDS)
from sparktrips.functions.columns import WHITE_SPACE

# Fixed value: message for a body that is not a JSON object.
MSG_NOT_OBJECT = "Input should be a valid dictionary or object to extract fields from"
MSG_LIST = "Input should be a valid list"
ROOT = "root"
ERRORS = "errors"
VARIANT = "_v"

def _num_txt(x: float) -> str:
    return f"{x:g}"


def with_variant(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.withColumn(VARIANT, F.try_parse_json(F.col(payload)))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def field_parts(v: Column, name: str) -> tuple[Column, Column, Column]:
    """(present, json type, value as double) of one member of the object."""
    fv = F.try_variant_get(v, f"$.{name}", "variant")
    present = fv.isNotNull()
    jtype = F.schema_of_variant(fv)
    num = F.try_variant_get(v, f"$.{name}", "double")
    return present, jtype, num


def _parts_col(name: str) -> str:
    return f"_f_{name}"


# JSON kind of a member, decoded once per field.
K_MISSING, K_NULL, K_NUMBER, K_STRING, K_BOOL, K_OTHER = range(6)
_NUMERIC = "BIGINT", "DECIMAL", "DOUBLE", "INT", "SMALLINT", "TINYINT", "FLOAT"


def _kind(present: Column, jtype: Column) -> Column:
    number = reduce(or_, [jtype.startswith(n) for n in _NUMERIC])  # a pattern took longer than all else here
    return (F.when(~present, K_MISSING).when(jtype == "VOID", K_NULL).when(jtype == "STRING", K_STRING)
             .when(jtype == "BOOLEAN", K_BOOL).when(number, K_NUMBER).otherwise(K_OTHER))


#: Text that Python reads as a number: digits may be grouped by single underscores.
_DIGITS = "[0-9]+(_[0-9]+)*"
NUMBER_TEXT = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?([eE][+-]?{_DIGITS})?|\.{_DIGITS}([eE][+-]?{_DIGITS})?|(?i:nan|inf|infinity))\s*$"


def number_of(text: Column) -> Column:
    """A JSON number or numeric string as double; null for any other text."""
    return F.when(text.rlike(NUMBER_TEXT), F.replace(F.btrim(text, F.lit(WHITE_SPACE)), F.lit("_")).try_cast("double"))


PARTS, _RECORD = "_parts", "_record"


def _rule(name: str, default, gt, ge, lt) -> dict[str, Column]:
    """What the messages of a field need to know, as constants."""
    def bound(x):
        return F.lit(None if x is None else float(x)).cast("double")

    def said(message, x):
        return F.lit(None if x is None else message.format(_num_txt(x))).cast("string")

    return {"required": F.lit(default is None), "lt": bound(lt), "ge": bound(ge), "gt": bound(gt),
            "lt_message": said(MSG_LT, lt), "ge_message": said(MSG_GE, ge), "gt_message": said(MSG_GT, gt)}


def _flag_message(f: dict) -> Column:
    return (F.when(f["kind"] == K_MISSING, F.when(f["rule"]["required"], MSG_REQUIRED)).when(f["kind"] != K_STRING, MSG_STRING)
             .when(~f["txt"].isin("Y", "N", "y", "n"), MSG_PATTERN.format(FLAG_PATTERN)))


def _number_message(f: dict) -> Column:
    """One error per field, first failing rule wins: missing, null, type, then bounds (lt, ge, gt)."""
    kind, num, rule = f["kind"], f["num"], f["rule"]
    nan = F.isnan(num)
    return (F.when(kind == K_MISSING, F.when(rule["required"], MSG_REQUIRED)).when(kind == K_NULL, MSG_NUMBER)
             .when((kind == K_STRING) & num.isNull(), MSG_NUMBER_PARSE).when((kind == K_OTHER) | num.isNull(), MSG_NUMBER)
             .when(rule["lt"].isNotNull() & (nan | ~(num < rule["lt"])), rule["lt_message"])
             .when(rule["ge"].isNotNull() & (nan | ~(num >= rule["ge"])), rule["ge_message"])
             .when(rule["gt"].isNotNull() & (nan | ~(num > rule["gt"])), rule["gt_message"]))


def with_field_parts(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``_is_object``, ``_parts`` (name and message of each field) and one struct column per request field holding
    (kind, num, txt, message). The record is parsed once, to a map of variants, which is null where the body is no object.

    Each step is a projection whose columns the next one reads several times, so Catalyst keeps
    the steps apart and every value is worked out once. They hold no higher-order functions, which
    are interpreted row by row with all that is below them. (The test for null, which changes
    nothing, likewise keeps an expression that makes the payload out of the parser's interpreted part.)"""
    record, body = F.col(_RECORD), F.col(payload)
    col = lambda part, name: F.col(f"_{part}_{name}")
    flag, numbers = "store_and_fwd_flag", [n for n, *_ in REQUEST_FIELDS if n != "store_and_fwd_flag"]
    names = [n for n, *_ in REQUEST_FIELDS]
    kept = [F.col(c) for c in df.columns]
    d = df.withColumn(_RECORD, F.when(body.isNotNull(), F.from_json(body, "MAP<STRING,VARIANT>")))
    d = d.select(*kept, record.isNotNull().alias("_is_object"),
                 *[F.coalesce(F.map_contains_key(record, F.lit(n)), F.lit(False)).alias(f"_present_{n}") for n in names],
                 *[F.try_element_at(record, F.lit(n)).alias(f"_v_{n}") for n in names])
    d = d.withColumns({f"_type_{n}": F.schema_of_variant(col("v", n)) for n in names})
    d = d.withColumns({f"_kind_{n}": _kind(col("present", n), col("type", n)) for n in names} |
                      {f"_txt_{n}": F.when((col("type", n) == "STRING") | (col("type", n) == "BOOLEAN") | F.lit(n == flag), F.try_variant_get(col("v", n), "$", "string"))
                       for n in names})
    d = d.withColumns({f"_num_{n}": F.when(col("kind", n) == K_NUMBER, F.try_variant_get(col("v", n), "$", "double"))
                       .when(col("kind", n) == K_STRING, number_of(col("txt", n))).when(col("kind", n) == K_BOOL, (col("txt", n) == "true").cast("double"))
                       for n in numbers} | {f"_num_{flag}": F.lit(None).cast("double")})
    part = lambda name: {p: col(p, name) for p in ("kind", "num", "txt")}
    d = d.withColumns({f"_message_{n}": (_flag_message if n == flag else _number_message)(part(n) | {"rule": _rule(n, *rule)}) for n, *rule in REQUEST_FIELDS})
    shown = lambda n: F.struct(col("kind", n).alias("kind"), col("num", n).alias("num"),
                               (col("txt", n) if n == flag else F.lit(None).cast("string")).alias("txt"), col("message", n).alias("message"))
    return d.select(*kept, "_is_object", F.array(*[F.struct(F.lit(n).alias("name"), col("message", n).alias("message")) for n in names]).alias(PARTS),
                    *[shown(n).alias(_parts_col(n)) for n in names])


def field_error(v: Column, name: str, default, gt, ge, lt) -> Column:
    """Error struct ``{field, message}`` for one field, decoded from the variant ``v``, or NULL."""
    present, jtype, num = field_parts(v, name)
    rule = [_rule(*f) for f in REQUEST_FIELDS if f[0] == name][0]
    f = {"rule": rule, "kind": _kind(present, jtype), "num": num, "txt": F.try_variant_get(v, f"$.{name}", "string")}
    message = _flag_message(f) if name == "store_and_fwd_flag" else _number_message(f)
    return F.when(message.isNotNull(), F.struct(F.lit(name).alias("field"), message.alias("message")))


def errors_from_parts(prefix: Column | None = None) -> Column:
    """All field errors of one record, in field declaration order; the error of a body that is no object."""
    root = F.lit(ROOT) if prefix is None else F.regexp_replace(prefix, r"\.$", "")
    said = [(n, F.col(_parts_col(n))["message"]) for n, *_ in REQUEST_FIELDS]
    error = lambda n, m: F.struct((F.lit(n) if prefix is None else F.concat(prefix, F.lit(n))).alias("field"), m.alias("message"))
    some = F.coalesce(*[m for _, m in said]).isNotNull()
    none = F.array().cast("array<struct<field:string,message:string>>")
    per_field = F.when(some, F.array_compact(F.array(*[F.when(m.isNotNull(), error(n, m)) for n, m in said]))).otherwise(none)
    return F.when(F.col("_is_object"), per_field).otherwise(
        F.array(F.struct(root.alias("field"), F.lit(MSG_NOT_OBJECT).alias("message"))))


def _drop_parts(df: DataFrame) -> DataFrame:
    return df.drop(PARTS, "_is_object", *[_parts_col(n) for n, *_ in REQUEST_FIELDS])


def typed_values(parts_of=lambda n: F.col(_parts_col(n))) -> list[Column]:
    """V2: typed request fields from decoded parts; a *missing* member takes
    its default (an explicit null stays NULL and is an error elsewhere)."""
    cols = []
    for name, default, *_ in REQUEST_FIELDS:
        p = parts_of(name)
        if name == "store_and_fwd_flag":
            cols.append(F.when(p["kind"] == K_MISSING, F.lit(default)).otherwise(p["txt"]).alias(name))
        else:
            dflt = F.lit(None).cast("double") if default is None else F.lit(float(default))
            cols.append(F.when(p["kind"] == K_MISSING, dflt).otherwise(p["num"]).alias(name))
    return cols


def validate_records(df: DataFrame, payload: str = "payload", with_values: bool = False) -> DataFrame:
    """V1-V3, V8: adds ``errors`` and ``accepted`` (and, with ``with_values``,
    the typed fields with defaults, decoded in the same pass)."""
    d = with_field_parts(df, payload)
    d = d.withColumn(ERRORS, errors_from_parts()).withColumn("accepted", F.size(ERRORS) == 0)
    if with_values:
        d = d.select("*", *typed_values())
    return _drop_parts(d)


def route(validated: DataFrame, accepted: bool, cols: list[str | Column]) -> DataFrame:
    """Rows with the given verdict, projected to ``cols``.

    The verdict selects rows through an outer generator instead of a plain
    filter. A filter would be pushed below the projections by Catalyst and,
    through alias substitution, repeat the JSON decode many times inside the
    predicate; a filter on generator output stays above it, so every record
    is decoded once.
    """
    cond = F.col("accepted") if accepted else ~F.col("accepted")
    picked = validated.select(F.explode_outer(F.when(cond, F.array(F.struct(*cols)))).alias("_r"))
    return picked.filter(F.col("_r").isNotNull()).select("_r.*")


def malformed(df: DataFrame, payload: str = "payload") -> DataFrame:
    """V8: bodies that are no objects, and objects whose distance is there but no
    number (junk text, null, array, object), with the ``reason``."""
    d = with_field_parts(df, payload)
    distance = F.col(_parts_col("trip_distance"))
    bad = (distance["kind"] != K_MISSING) & distance["num"].isNull()
    reason = F.when(~F.col("_is_object"), "not_object").when(bad, "unparsable_trip_distance")
    # through a generator, so that the condition is not pushed into the decoding (see ``route``)
    picked = d.select(F.explode_outer(F.when(reason.isNotNull(), F.array(F.struct(*df.columns, reason.alias("reason"))))).alias("_r"))
    return picked.where(F.col("_r").isNotNull()).select("_r.*")


def error_message(errors: str = ERRORS) -> Column:
    """V4: ``field: message`` pairs joined by '; '."""
    return F.array_join(F.transform(F.col(errors), lambda e: F.concat(e["field"], F.lit(": "), e["message"])), "; ")


def validation_report(validated: DataFrame, keys: list[str]) -> DataFrame:
    """V4: rejected rows with their summary message and error count."""
    return route(validated, False, [*keys, error_message().alias("message"), F.size(ERRORS).alias("n_errors")])


def rejects_by_rule(validated: DataFrame) -> DataFrame:
    """V5: count per failing (field, message)."""
    return (validated.select(F.explode_outer(ERRORS).alias("e")).filter(F.col("e").isNotNull())
                     .groupBy(F.col("e.field").alias("field"), F.col("e.message").alias("message"))
                     .agg(F.count(F.lit(1)).cast("bigint").alias("rejections")))


def batch_size_rule(df: DataFrame, request_col: str = "request_id") -> DataFrame:
    """V6: 1..1000 trips per request."""
    n = F.col("n_trips")
    g = df.groupBy(request_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_trips"))
    msg = (F.when(n < BATCH_MIN_TRIPS, F.concat(F.lit("trips: "), F.format_string(
                MSG_LIST_MIN.replace("{}", "%d", 1).replace("{}", "%d", 1), F.lit(BATCH_MIN_TRIPS), n)))
            .when(n > BATCH_MAX_TRIPS, F.concat(F.lit("trips: "), F.format_string(
                MSG_LIST_MAX.replace("{}", "%d", 1).replace("{}", "%d", 1), F.lit(BATCH_MAX_TRIPS), n))))
    return g.select(request_col, "n_trips", ((n >= BATCH_MIN_TRIPS) & (n <= BATCH_MAX_TRIPS)).alias("size_ok"),
                    msg.alias("message"))


def request_verdicts(validated: DataFrame, request_col: str = "request_id") -> DataFrame:
    """V7: one bad trip (or a bad size) rejects the whole request."""
    g = validated.groupBy(request_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_trips"),
                                           F.count_if(~F.col("accepted")).cast("bigint").alias("n_bad"))
    n = F.col("n_trips")
    return g.withColumn("accepted", (F.col("n_bad") == 0) & (n >= BATCH_MIN_TRIPS) & (n <= BATCH_MAX_TRIPS))


def reject_whole_request(validated: DataFrame, request_col: str = "request_id") -> DataFrame:
    """V7 at row level: each row carries its request's verdict. The verdict
    table has one row per request; AQE broadcasts it when small and otherwise
    splits skewed partitions of the shuffle join."""
    verdicts = request_verdicts(validated, request_col).select(request_col, F.col("accepted").alias("request_accepted"))
    return validated.join(verdicts, request_col)


def by_request(validated: DataFrame, request_col: str) -> tuple[DataFrame, DataFrame]:
    """V7: the rows of accepted requests and all others. Rows with errors of their own are
    rejected as they are; only the rest is joined with the accepted requests."""
    whole = request_verdicts(validated, request_col).where("accepted").select(request_col)
    good = validated.where(F.col("accepted"))
    return good.join(whole, request_col, "left_semi"), validated.where(~F.col("accepted")).unionByName(good.join(whole, request_col, "left_anti"))


def out_of_range(col: str = "trip_distance") -> Column:
    """Trips beyond the training range (still scored, flagged)."""
    return F.coalesce(F.col(col) > F.lit(OUT_OF_RANGE_DISTANCE), F.lit(False))


def correlation_id(request_col: str | None, payload: str = "payload", pos: str | None = "pos",
                   source: str | None = None) -> Column:
    """caller's id, else one derived from file, position and body, so that a
    replay gives the same id and two equal requests get two."""
    parts = [F.col(c).cast("string") for c in (source, pos) if c] + [F.col(payload)]
    derived = F.sha2(F.concat_ws("|", *parts), 256)
    return derived if request_col is None else F.coalesce(F.col(request_col), derived)


#: Errors of a batch body without a usable list of trips.
TRIPS = "trips"


def numbered_lines(spark, path: str | list[str], value: str = "payload", separator: str | None = None,
                   columns: dict[str, str] | None = None) -> DataFrame:
    """Lines of text files with ``position``, the line's number in its file, from 0, the
    same however the files are split, and ``columns`` of the files' metadata.

    A split's lines are consecutive in one task, so a line's place in its split is its
    row id less the split's first one; the lines of the splits before it come from one
    count per split. Lines are joined with that small table, not shuffled in order."""
    columns = {"source_file": "_metadata.file_name"} if columns is None else columns
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    lines = reader.text(path).select(
        F.col("value").alias(value), *[F.col(c).alias(n) for n, c in columns.items()], F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_begin"), F.monotonically_increasing_id().alias("_row"))
    splits = lines.groupBy("_path", "_begin").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_path").orderBy("_begin")) - F.col("_n")  # a row per split of the file
    starts = splits.select("_path", "_begin", (before - F.col("_first")).alias("_shift"))
    return lines.join(starts, ["_path", "_begin"]).select(value, *columns, (F.col("_row") + F.col("_shift")).alias("position"))


def read_trip_requests(spark, path: str, batch: bool = False) -> DataFrame:
    """JSON-lines requests. One trip object per line, or (``batch``) one
    ``{"trips": [...]}`` object per line, exploded with its position kept; the
    field names of batch errors become ``trips.<i>.<field>``.

    ``request_id`` is derived from file, position (the line's number) and body, one for
    all trips of a line, and does not depend on how files are split. A body
    without trips is one row with a null ``trip_index``."""
    lines = numbered_lines(spark, path)
    lines = lines.withColumn("request_id", correlation_id(None, "payload", "position", "source_file"))
    if not batch:
        return lines
    v = F.try_parse_json(F.col("payload"))
    trips = F.try_variant_get(v, f"$.{TRIPS}", "array<variant>")
    listed = lines.withColumn("_trips", trips).withColumn("_named", F.try_variant_get(v, f"$.{TRIPS}", "variant").isNotNull())
    return (listed.select("request_id", "source_file", F.col("payload").alias("request_payload"), is_object(v).alias("body_is_object"),
                          F.col("_named").alias("has_trips"), F.size("_trips").alias("n_listed"),
                          F.posexplode_outer("_trips").alias("trip_index", "trip"))
                  .withColumn("payload", F.to_json(F.col("trip"))).drop("trip"))


def _batch_error() -> Column:
    """The error of a whole batch body, or NULL where it has trips."""
    def of(field: str, message: Column) -> Column:
        return F.array(F.struct(F.lit(field).alias("field"), message.alias("message")))

    few = F.lit(MSG_LIST_MIN.replace("{}", str(BATCH_MIN_TRIPS), 1).replace("{}", "0", 1))
    return (F.when(~F.col("body_is_object"), of(ROOT, F.lit(MSG_NOT_OBJECT)))
             .when(~F.col("has_trips"), of(TRIPS, F.lit(MSG_REQUIRED)))
             .when(F.col("trip_index").isNull(), F.when(F.col("n_listed") == 0, of(TRIPS, few)).otherwise(of(TRIPS, F.lit(MSG_LIST)))))


def validate_batch(df: DataFrame, with_values: bool = False) -> DataFrame:
    """Validation of exploded batch rows: field paths ``trips.<i>.<field>``; a body
    without trips has an error for the body."""
    prefix = F.concat(F.lit(f"{TRIPS}."), F.col("trip_index").cast("string"), F.lit("."))
    d = with_field_parts(df, "payload")
    d = d.withColumn(ERRORS, F.coalesce(_batch_error(), errors_from_parts(prefix))).withColumn("accepted", F.size(ERRORS) == 0)
    return _drop_parts(d.select("*", *typed_values()) if with_values else d)


def batch_verdicts(validated: DataFrame) -> DataFrame:
    """V6 and V7 per batch request: trips, whether their number is allowed, and
    whether the whole request is accepted."""
    g = validated.groupBy("request_id").agg(F.count("trip_index").cast("bigint").alias("n_trips"),
                                            F.count_if(~F.col("accepted")).cast("bigint").alias("n_bad"))
    n = F.col("n_trips")
    g = g.withColumn("size_ok", (n >= BATCH_MIN_TRIPS) & (n <= BATCH_MAX_TRIPS))
    return g.withColumn("accepted", F.col("size_ok") & (F.col("n_bad") == 0))


def with_latency(scored: DataFrame, received: str) -> DataFrame:
    """Adds ``latency_ms``, from the time in ``received`` to the scoring, and drops that column."""
    ms = lambda t: F.unix_micros(t.cast("timestamp")) / 1000.0
    taken = F.greatest(F.lit(0.0), F.round(ms(F.current_timestamp()) - ms(F.col(received)), 3))
    return scored.withColumn("latency_ms", taken).drop(received)


def batch_responses(scored: DataFrame, model_version: str, received: str | None = None) -> DataFrame:
    """S3: per accepted request its predictions in the order of its trips, their
    ``count``, the model's version and the correlation id; with ``received`` (when its rows
    arrived) also ``latency_ms``. A request has at most ``BATCH_MAX_TRIPS`` trips, so its
    list is bounded."""
    ordered = F.sort_array(F.collect_list(F.struct("trip_index", "prediction")))
    arrival = [F.min(received).alias("_received")] if received else []
    g = scored.groupBy("request_id").agg(F.transform(ordered, lambda x: x["prediction"]).alias("predictions"),
                                         F.count(F.lit(1)).cast("bigint").alias("count"), *arrival)
    out = g.select("predictions", "count", F.lit(model_version).alias("model_version"), F.col("request_id").alias("correlation_id"),
                   *(["_received"] if received else []))
    return with_latency(out, "_received") if received else out
