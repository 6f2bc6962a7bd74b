"""The record path as a stage of a saved model.

``RecordFeatures`` turns raw trips or raw JSON records into the model's inputs, so a
reloaded ``PipelineModel`` scores either without library calls around it:

* a frame with the ``payload`` column and none of the features holds JSON records: they are parsed, normalised and
  checked; what is missing is 0.0. Records with unusable values are left out
  (``handleInvalid`` "skip") or kept with their ``errors`` ("keep");
* any other frame is a trip table: its flag is encoded, known columns are taken as they
  are, what is missing or null is 0.0.

All other columns are kept. The stage is saved with the pipeline like any Spark ML stage.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.config import ORDERED_FEATURE_NAMES
from sparktrips.functions.columns import encode_flag
from sparktrips.operators.features import FLAG, FLAG_ENC, normalize_records, parse_records
from sparktrips.operators.validate import ERRORS

_RECORD = "_record_features"


class RecordFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    payloadCol = Param(Params._dummy(), "payloadCol", "column of JSON records", TypeConverters.toString)
    featureCols = Param(Params._dummy(), "featureCols", "features, in order", TypeConverters.toListString)
    prefix = Param(Params._dummy(), "prefix", "what the inputs' names begin with", TypeConverters.toString)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "records with errors: skip or keep", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, payloadCol="payload", featureCols=None, prefix="_in_", handleInvalid="skip"):
        super().__init__()
        self._setDefault(payloadCol="payload", featureCols=list(ORDERED_FEATURE_NAMES), prefix="_in_", handleInvalid="skip")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault("handleInvalid") not in ("skip", "keep"):
            raise ValueError("handleInvalid is skip or keep")

    def inputs(self) -> list[str]:
        return [self.getOrDefault("prefix") + n for n in self.getOrDefault("featureCols")]

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getOrDefault("payloadCol") in df.columns and not any(n in df.columns for n in self.getOrDefault("featureCols")):
            return self._from_records(df)
        return df.select("*", *[self._input(n, F.col(n).cast("double") if n in df.columns else self._flag(df, n)) for n in self.getOrDefault("featureCols")])

    def _input(self, name: str, value: Column | None) -> Column:
        filled = F.lit(0.0) if value is None else F.coalesce(value, F.lit(0.0))
        return filled.alias(self.getOrDefault("prefix") + name)

    @staticmethod
    def _flag(df: DataFrame, name: str) -> Column | None:
        return encode_flag(FLAG, df.schema[FLAG].dataType).cast("double") if name == FLAG_ENC and FLAG in df.columns else None

    def _from_records(self, df: DataFrame) -> DataFrame:
        """The record's fields are decoded apart from the frame's own columns, which may share their names."""
        payload = self.getOrDefault("payloadCol")
        own = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(_RECORD)
        fields = normalize_records(parse_records(df.select(own, F.col(f"`{payload}`").alias("payload")), "payload"))
        names = self.getOrDefault("featureCols")
        out = fields.select(f"{_RECORD}.*", *[self._input(n, F.col(n).cast("double") if n in fields.columns else None) for n in names],
                            F.col(ERRORS).alias("_errors"))
        if self.getOrDefault("handleInvalid") == "skip":
            return out.where(F.size("_errors") == 0).drop("_errors")
        return out.drop(ERRORS).withColumnRenamed("_errors", ERRORS)
