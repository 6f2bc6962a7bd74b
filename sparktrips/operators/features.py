"""Feature encoding for tables and for JSON records, the fixed-order feature
vector, and a vocabulary (dict-vectorizer) fit built from Spark ML stages.

Tables and records are two shapes of the same data:

* a table keeps typed columns (``encode_features``);
* a record is a JSON object parsed to ``MAP<STRING,STRING>`` (missing key and
  explicit null stay distinguishable) plus the JSON type of the flag value
  (``normalize_records``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSlicer
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparktrips.config import EXCLUDED_COLUMNS, ORDERED_FEATURE_NAMES, RECORD_NUMERIC_KEYS
from sparktrips.functions.columns import encode_flag, encode_flag_string
from sparktrips.operators.split import global_rank
from sparktrips.operators.validate import ERRORS, number_of
from sparktrips.session import scratch_path, ship_package

FLAG = "store_and_fwd_flag"
FLAG_ENC = "store_and_fwd_flag_encoded"


# ------------------------------------------------------------------ tables

def encode_flag_column(df: DataFrame, column: str = FLAG) -> DataFrame:
    """Add ``store_and_fwd_flag_encoded`` (0/1), chosen by column type."""
    dtype = df.schema[column].dataType
    return df.withColumn(FLAG_ENC, encode_flag(column, dtype))


def encode_features(df: DataFrame) -> DataFrame:
    """Encode the flag (when present), drop excluded columns and the raw
    flag. Unknown columns survive."""
    out = encode_flag_column(df) if FLAG in df.columns else df
    drop = [c for c in EXCLUDED_COLUMNS if c in out.columns] + ([FLAG] if FLAG in out.columns else [])
    return out.drop(*drop)


# ----------------------------------------------------------------- records

RECORD_MAP = "record"
FLAG_JSON_TYPE = "flag_json_type"


def parse_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON text -> ``record MAP<STRING,STRING>`` (NULL for a non-object) and
    the JSON type of the flag value (OBJECT member type, NULL when absent)."""
    v = F.try_parse_json(F.col(payload))
    flag_v = F.try_variant_get(v, f"$.{FLAG}", "variant")
    # the test for null, which changes nothing, keeps an expression that makes the payload out of the parser's interpreted part
    out = df.withColumn(RECORD_MAP, F.when(F.col(payload).isNotNull(), F.from_json(F.col(payload), "MAP<STRING,STRING>")))
    return out.withColumn(FLAG_JSON_TYPE, F.when(flag_v.isNotNull(), F.schema_of_variant(flag_v)))


def _has(m: Column, k: str) -> Column:
    return F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False))


def _number(text: Column) -> Column:
    """A member's text as a number; JSON true and false are 1 and 0."""
    return F.coalesce(number_of(text), F.when(text == "true", 1.0).when(text == "false", 0.0))


def record_flag_encoded(m: Column, jtype: Column | None, number: Column | None = None) -> Column:
    """Explicit encoded value wins; else encode the flag by its JSON type
    (string -> 'Y' test; number / boolean -> truthy; null -> 0); else 0. ``number`` is
    the explicit value, where it is known."""
    raw = m[FLAG]
    if jtype is None:
        by_type = encode_flag_string(raw)
    else:
        truthy_num = F.coalesce(raw.try_cast("double") != 0, F.lit(False)).cast("int")
        truthy_bool = F.when(F.lower(raw) == "true", 1).otherwise(0)
        by_type = (F.when(jtype == "STRING", encode_flag_string(raw))
                    .when(jtype == "BOOLEAN", truthy_bool)
                    .when(jtype.startswith("BIGINT") | jtype.startswith("DOUBLE") | jtype.startswith("DECIMAL")
                          | jtype.startswith("INT") | jtype.startswith("FLOAT"), truthy_num)
                    .otherwise(0))
    explicit = _number(m[FLAG_ENC]) if number is None else number
    return (F.when(_has(m, FLAG_ENC), explicit.try_cast("int"))
             .when(_has(m, FLAG), by_type)
             .otherwise(F.lit(0))).cast("int")


def record_pu_do(m: Column) -> Column:
    """Explicit ``PU_DO`` (as text) wins; else ``"{PU}_{DO}"`` when both ids exist."""
    txt = lambda k: F.coalesce(m[k], F.lit("None"))  # noqa: E731  (text of a null value)
    return (F.when(_has(m, "PU_DO"), txt("PU_DO"))
             .when(_has(m, "PULocationID") & _has(m, "DOLocationID"),
                   F.concat_ws("_", txt("PULocationID"), txt("DOLocationID"))))


def normalize_records(df: DataFrame) -> DataFrame:
    """The record's feature columns: the 8 numerics (double, NULL when
    absent), the encoded flag, ``PU_DO``, and ``errors``, the keys whose values are
    unusable. Unknown keys are dropped by projection."""
    m = F.col(RECORD_MAP)
    jtype = F.col(FLAG_JSON_TYPE) if FLAG_JSON_TYPE in df.columns else None
    keep = [c for c in df.columns if c not in (RECORD_MAP, FLAG_JSON_TYPE)]
    # in steps, whose columns are read several times: each number is worked out once
    keys, number = [*RECORD_NUMERIC_KEYS, FLAG_ENC], lambda k: F.col(f"_number_{k}")
    numbered = df.withColumns({f"_number_{k}": _number(m[k]) for k in keys})
    bad = {k: _has(m, k) & number(k).isNull() for k in keys}
    errors = F.when(reduce(or_, bad.values()), F.array_compact(F.array(*[F.when(x, F.lit(k)) for k, x in bad.items()]))).otherwise(F.array().cast("array<string>"))
    return numbered.select(*keep, *[number(k).alias(k) for k in RECORD_NUMERIC_KEYS],
                           record_flag_encoded(m, jtype, number(FLAG_ENC)).alias(FLAG_ENC), record_pu_do(m).alias("PU_DO"), errors.alias(ERRORS))


def usable(records: DataFrame) -> DataFrame:
    """The records without errors, ready to be scored. They are picked through an outer generator: a
    plain filter would be pushed into the decoding and repeat it for each key (see ``validate.route``)."""
    cols = [c for c in records.columns if c != ERRORS]
    picked = records.select(F.explode_outer(F.when(F.size(ERRORS) == 0, F.array(F.struct(*cols)))).alias("_r"))
    return picked.where(F.col("_r").isNotNull()).select("_r.*")


def prepare_features(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One entry point for both shapes. A frame with a JSON ``payload``
    column is a set of records, of which only usable ones are returned; any other
    frame is a trip table."""
    if payload in df.columns:
        return usable(normalize_records(parse_records(df, payload)))
    if RECORD_MAP in df.columns:
        return usable(normalize_records(df))
    return encode_features(df)


# ---------------------------------------------------------- feature vectors

def feature_columns(df: DataFrame, names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    """F1 (columnar form): the model inputs in fixed order, missing -> 0.0."""
    others = [c for c in df.columns if c not in names]
    return df.select(*others, *[(F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns
                                 else F.lit(0.0)).alias(n) for n in names])


def assembler(names: list[str] = ORDERED_FEATURE_NAMES, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="error")


def assemble_features(df: DataFrame, names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    """``features`` vector (doubles) in ``names`` order."""
    return assembler(names).transform(feature_columns(df, names))


# ------------------------------------------------------ vocabulary (F8)

def record_tokens(df: DataFrame, categorical: list[str]) -> DataFrame:
    """``_tokens``: the ``key=value`` names of each record's string values."""
    tokens = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in categorical]
    return df.withColumn("_tokens", F.array_compact(F.array(*tokens)) if tokens else F.array().cast("array<string>"))


def vocabulary_frame(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The vocabulary as a table (name): distinct ``key=value`` tokens, and the
    numeric keys of which some record has a value."""
    tokens = record_tokens(df, categorical).select(F.explode("_tokens").alias("name")).distinct()
    if not numeric:
        return tokens
    seen = df.agg(*[F.count(c).alias(c) for c in numeric])
    names = seen.select(F.explode(F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in numeric]))).alias("name"))
    return tokens.unionByName(names)


def vocabulary_index(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The vocabulary as a written table ``(name, index)``: names in sorted order, dense
    from 0. The names are sorted by range and numbered from the partitions' offsets, so
    there may be any number of them."""
    path = scratch_path(df.sparkSession, "vocabulary")
    ranked = global_rank(vocabulary_frame(df, numeric, categorical), ["name"], "index")
    ranked.select("name", F.col("index").cast("bigint").alias("index")).write.parquet(path)
    return df.sparkSession.read.schema("name string, index bigint").parquet(path)


def fit_vocabulary(df: DataFrame, numeric: list[str], categorical: list[str], most: int | None = 1 << 20) -> list[str]:
    """Sorted feature names seen in ``df``, brought to the driver; more than ``most``
    are refused before any are (``fit_dict_vectorizer`` takes any number)."""
    names = vocabulary_frame(df, numeric, categorical).persist()
    try:
        if most is not None and (n := names.count()) > most:
            raise ValueError(f"{n} feature names; at most {most} make a vocabulary on the driver")
        return sorted(r["name"] for r in names.collect())
    finally:
        names.unpersist()


class DictVectorizerModel:
    """Vectorises records with a fixed vocabulary, using only Spark ML stages:
    categorical tokens -> CountVectorizerModel (unseen tokens ignored),
    numerics -> VectorAssembler, then VectorSlicer puts names in sorted order.
    Numeric keys that are not in the vocabulary are left out."""

    def __init__(self, vocabulary: list[str], numeric: list[str], categorical: list[str], output: str = "features"):
        self.vocabulary = list(vocabulary)
        self.numeric = [n for n in numeric if n in set(vocabulary)]
        self.categorical = list(categorical)
        self.output = output
        categories = [v for v in self.vocabulary if v not in set(self.numeric)]
        layout = self.numeric + categories  # of the assembled vector; sliced into sorted order
        place = {n: i for i, n in enumerate(layout)}
        stages = [CountVectorizerModel.from_vocabulary(categories, inputCol="_tokens", outputCol="_cat", binary=True)] if categories else []
        stages.append(VectorAssembler(inputCols=self.numeric + ["_cat"] * bool(categories), outputCol="_raw", handleInvalid="keep"))
        stages.append(VectorSlicer(inputCol="_raw", outputCol=output, indices=[place[n] for n in self.vocabulary]))
        self.pipeline = PipelineModel(stages=stages)

    def transform(self, df: DataFrame) -> DataFrame:
        d = record_tokens(df, self.categorical)
        d = d.select(*[c for c in d.columns if c not in self.numeric],
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.numeric])
        return self.pipeline.transform(d).drop("_tokens", "_cat", "_raw")


class DictVectorizerTable:
    """Vectorises records with a vocabulary of any size, a table ``(name, index)``: tokens
    meet their indices in a join (a frequent token is split over tasks), come back per
    record by its unique ``key``, and become one sparse vector. The driver learns only
    how many names there are and the indices of the numeric columns."""

    def __init__(self, vocabulary: DataFrame, numeric: list[str], categorical: list[str], key: str, output: str = "features"):
        self.vocabulary, self.categorical, self.key, self.output = vocabulary, list(categorical), key, output
        self.size = vocabulary.count()
        if self.size >= 1 << 31:
            raise ValueError(f"{self.size} feature names; a vector has fewer than 2^31 entries")
        found = vocabulary.where(F.col("name").isin(list(numeric))).collect() if numeric else []
        self.numeric = {r["name"]: r["index"] for r in found}

    def transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        tokens = record_tokens(df, self.categorical).select(self.key, F.explode("_tokens").alias("name"))
        met = tokens.join(self.vocabulary, "name").groupBy(self.key).agg(
            F.collect_list(F.struct(F.col("index").cast("int").alias("index"), F.lit(1.0).alias("value"))).alias("_met"))  # one per categorical column at most
        entry = "array<struct<index:int,value:double>>"
        numbers = F.array(*[F.struct(F.lit(i).cast("int").alias("index"), F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias("value"))
                            for n, i in self.numeric.items()]).cast(entry)
        nonzero = F.filter(numbers, lambda e: e["value"] != 0)
        entries = F.sort_array(F.concat(nonzero, F.coalesce(F.col("_met"), F.array().cast(entry))))
        kept = [c for c in df.columns if c != self.output]
        rows = df.join(met, self.key, "left").select(*kept, entries.alias("_e")).select(
            *kept, F.col("_e.index").alias("_indices"), F.col("_e.value").alias("_values"))
        schema = StructType([*df.select(*kept).schema.fields, StructField(self.output, VectorUDT())])
        size, names = self.size, [*kept, self.output]

        def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), batch.column("_indices"), batch.column("_values")]
                vector = pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], vector], names)

        return rows.mapInArrow(assemble, schema)


def fit_dict_vectorizer(df: DataFrame, numeric: list[str], categorical: list[str], key: str | None = None,
                        most: int = 1 << 20) -> DictVectorizerModel | DictVectorizerTable:
    """A vectorizer for the names in ``df``. Up to ``most`` names are a parameter of the model;
    more stay in a table, and the records need a unique ``key``. The vectors are the same."""
    index = vocabulary_index(df, numeric, categorical)
    if index.count() <= most:
        return DictVectorizerModel([r["name"] for r in index.orderBy("index").collect()], numeric, categorical)
    if key is None:
        raise ValueError(f"more than {most} feature names: name the records' key column")
    return DictVectorizerTable(index, numeric, categorical, key)


def vectorize_long(df: DataFrame, key: str, numeric: list[str], categorical: list[str],
                   vocab: DataFrame) -> DataFrame:
    """Checkable long form of the vectorizer: (key, name, value) for every
    non-zero entry whose name is in the vocabulary. Numeric names need no join
    (one without any value has no non-zero entry); only category tokens are
    looked up."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in numeric])
    long = df.select(key, F.explode(entries).alias("e")).where("e.value <> 0").select(key, "e.name", "e.value") if numeric else None
    if not categorical:
        return long
    tokens = record_tokens(df, categorical).select(key, F.explode("_tokens").alias("name"))
    known = tokens.join(vocab.select("name"), "name", "left_semi").select(key, "name", F.lit(1.0).alias("value"))
    return known if long is None else long.unionByName(known)
