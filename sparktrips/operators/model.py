"""Models: build, fit, evaluate, score, persist and verify trip-duration
regressors with Spark ML.

* The fitted object is a ``PipelineModel`` [RecordFeatures (raw trips or JSON records ->
  inputs, missing -> 0.0), VectorAssembler (fixed order; not for the forest),
  regressor], so a loaded model treats raw data like the one that was fitted.
* A fit depends on row order and partitioning, so training rows are
  canonicalised first (partition count by the row count, hash of a unique key,
  sorted within partitions): the same data and seed give the same model.
* Metrics are one aggregate over the scored rows (plus the label mean as a
  scalar subquery); parity checks score both models in the same projection,
  so they need no join.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, MODEL_TYPES, ORDERED_FEATURE_NAMES, TripSettings
from sparktrips.operators.epochs import append_version, read_versions
from sparktrips.operators.forest import ForestRegressor
from sparktrips.operators.features import FLAG, FLAG_ENC, assembler, encode_features, feature_columns
from sparktrips.operators.stages import RecordFeatures
from sparktrips.operators.validate import numbered_lines

LABEL = "trip_duration"
PREDICTION = "prediction"


def create_model(model_type: str = "random_forest", s: TripSettings = DEFAULT_SETTINGS, **kw):
    """plain OLS, or a forest grown as deep as Spark allows with all
    features considered at each split (the usual forest defaults elsewhere)."""
    if model_type == "linear_regression":
        return LinearRegression(featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION,
                                regParam=0.0, elasticNetParam=0.0, **kw)
    if model_type == "random_forest":
        params = dict(numTrees=s.n_estimators, maxDepth=s.max_depth, maxBins=s.max_bins, minInstancesPerNode=1, bootstrap=True, seed=s.random_state)
        params.update(kw)
        return ForestRegressor(featureCols=[_input(n) for n in s.feature_names], labelCol=LABEL, predictionCol=PREDICTION, keyCol=s.key_col, **params)
    raise ValueError(f"Unsupported model_type '{model_type}'. Expected one of: {', '.join(MODEL_TYPES)}")


def _input(name: str) -> str:
    return f"_in_{name}"


def build_pipeline(estimator, names: list[str] = ORDERED_FEATURE_NAMES) -> Pipeline:
    """F2: raw trips or JSON records to inputs (missing values as 0.0), estimator; a Spark ML
    estimator gets the inputs as one vector."""
    vector = [] if isinstance(estimator, ForestRegressor) else [assembler([_input(n) for n in names])]
    return Pipeline(stages=[RecordFeatures(featureCols=list(names), prefix=_input("")), *vector, estimator])


def _predicted(model: PipelineModel, df: DataFrame, names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    return model.transform(df).drop("features", *map(_input, names))


def canonical(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Partitions and order by the key, so a refit sees the same rows in the same
    places (forest bagging and binning depend on it)."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit_partitions(rows: int, s: TripSettings = DEFAULT_SETTINGS) -> int:
    return s.fit_partitions or max(1, -(-rows // s.rows_per_fit_partition))


def training_frame(df: DataFrame, key: str = "trip_id", names: list[str] = ORDERED_FEATURE_NAMES,
                   extra: list[str] | None = None) -> DataFrame:
    """Trip table -> key, ordered feature columns, label (+ ``extra`` columns)."""
    enc = encode_features(df.withColumn("_label", F.col(LABEL))).withColumnRenamed("_label", LABEL)
    return feature_columns(enc, names).select(key, *names, LABEL, *(extra or []))


def train_pipeline(train: DataFrame, estimator=None, s: TripSettings = DEFAULT_SETTINGS,
                   key: str = "trip_id") -> PipelineModel:
    """default estimator is the forest, which does not depend on the order of rows.

    Spark ML estimators do, and make several passes over their input (summary
    statistics, then the solver), so the training rows are canonicalised and
    persisted (memory, spilling to disk) for the fit and released afterwards. ``train`` itself
    is read twice, to count its rows and to canonicalise them: best a written table.
    """
    from pyspark import StorageLevel
    est = estimator if estimator is not None else create_model("random_forest", s)
    if isinstance(est, ForestRegressor):
        return build_pipeline(est, s.feature_names).fit(train)
    data = canonical(train, key, fit_partitions(train.count(), s)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return build_pipeline(est).fit(data)
    finally:
        data.unpersist()


def regression_metrics(pred: DataFrame, label: str = LABEL, prediction: str = PREDICTION,
                       group: str | None = None) -> DataFrame:
    """MAE, RMSE, R^2 (NULL when the label is constant), one aggregate
    per group. The total sum of squares is ``var_pop(y) * n`` (a stable
    one-pass moment), so no second pass over the label mean is needed."""
    y, p = F.col(label), F.col(prediction)
    keys = [group] if group else []
    e = y - p
    agg = pred.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"))
    return agg.select(*keys, "rows", *[F.round(F.col(c), 6).alias(c) for c in ("mae", "rmse", "r2")])


def score(model: PipelineModel, df: DataFrame, names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    """predictions for a trip table, for JSON records (``payload``; unusable ones are left
    out) or for normalised records (order kept by keys). A frame without any of the
    features is refused."""
    known = [*names, *([FLAG] if FLAG_ENC in names else []), "payload"]
    if not any(n in df.columns for n in known):
        raise ValueError(f"none of the features {', '.join(names)} is a column")
    return _predicted(model, df, names)


def score_one(model: PipelineModel, spark: SparkSession, record: dict) -> float:
    """one record -> float; ValueError for input that is not an object or
    holds a value that is no number. Re-aimed as a one-row DataFrame."""
    from sparktrips.operators.features import normalize_records, parse_records
    if not isinstance(record, dict):
        raise ValueError("Input must be a dictionary of features")
    df = spark.createDataFrame([(json.dumps(record),)], "payload string")
    norm = normalize_records(parse_records(df))
    errors = norm.first()["errors"]
    if errors:
        raise ValueError(f"Invalid {', '.join(errors)} value")
    return float(score(model, norm).select(PREDICTION).first()[0])


def linear_expression(model: PipelineModel, names: list[str] = ORDERED_FEATURE_NAMES):
    """The fitted linear model as a plain column expression."""
    lr = [s for s in model.stages if isinstance(s, LinearRegressionModel)][0]
    expr = F.lit(float(lr.intercept))
    for n, c in zip(names, lr.coefficients.toArray()):
        expr = expr + F.lit(float(c)) * F.coalesce(F.col(n).cast("double"), F.lit(0.0))
    return expr


def parity(df: DataFrame, a: PipelineModel | None, b: PipelineModel | None = None, b_expr=None,
           tolerance: float = 1e-4) -> DataFrame:
    """score the same rows two ways in one projection; report the
    largest absolute difference and whether it is within tolerance."""
    x = feature_columns(df)
    pa = _predicted(a, x).withColumnRenamed(PREDICTION, "_pa")
    if b is not None:
        both = _predicted(b, pa).withColumnRenamed(PREDICTION, "_pb")
    else:
        both = pa.withColumn("_pb", b_expr)
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.max(F.abs(F.col("_pa") - F.col("_pb"))).alias("max_abs_diff")).withColumn(
        "within_tolerance", F.coalesce(F.col("max_abs_diff") <= tolerance, F.lit(True)))


def coefficients_frame(spark: SparkSession, model: PipelineModel,
                       names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    """Coefficients ordered by absolute size (a 9-row table)."""
    lr = [s for s in model.stages if isinstance(s, LinearRegressionModel)][0]
    rows = [(n, float(c)) for n, c in zip(names, lr.coefficients.toArray())]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.orderBy(F.abs("coefficient").desc(), "feature")


def importances_frame(spark: SparkSession, model: PipelineModel,
                      names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    forest = model.stages[-1]
    rows = [(n, float(v)) for n, v in zip(names, forest.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


# ------------------------------------------------------------ persistence

def save_model(model: PipelineModel, path: str) -> str:
    """Spark ML persistence (metadata JSON + parquet data), overwrite."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load; a missing path raises FileNotFoundError."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001 - surfaced as the reference's error type
        if "does not exist" in str(e) or "PATH_NOT_FOUND" in str(e) or "No such file" in str(e):
            raise FileNotFoundError(f"Model artifact not found at {path}") from e
        raise


#: Files up to this size are hashed whole, as one value; longer ones as a tree.
WHOLE_FILE_BYTES = 1 << 28
#: Lines whose digests make one node of a tree.
TREE_LINES = 1 << 14


def tree_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, length, sha256)`` of files of any size, read in parts: a file is cut at its
    line feeds, each piece is hashed where it is read, and the pieces' digests are hashed in
    order, ``TREE_LINES`` at a time, until one is left. The length goes into it, so a
    line feed at the end counts. The digest does not depend on how the file is split."""
    lines = numbered_lines(spark, paths, "piece", separator="\n", columns={"path": "_metadata.file_path", "length": "_metadata.file_size"})
    counts = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"))  # a row per file
    longest = counts.agg(F.max("n")).first()[0] or 0
    level = lines.join(counts, "path").select("path", "length", "n", "position", F.sha2(F.col("piece").cast("binary"), 256).alias("digest"))
    while longest > 1:
        group = F.floor(F.col("position") / TREE_LINES)
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("position", "digest"))), lambda x: x["digest"])  # TREE_LINES at most
        above = level.where("n > 1").groupBy("path", "length", F.ceil(F.col("n") / TREE_LINES).alias("n"), group.alias("position")).agg(
            F.sha2(F.concat_ws(",", F.lit("node"), ordered), 256).alias("digest"))
        level = above.unionByName(level.where("n = 1"))  # the height of a file's tree is its own
        longest = -(-longest // TREE_LINES)
    return level.select("path", "length", F.sha2(F.concat_ws(":", F.lit("tree"), F.col("length").cast("string"), "digest"), 256).alias("sha256"))


def artifact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file of a saved model, by path below ``path`` (whatever the file system or
    location). Files are hashed in parallel by the executors, those of more than
    ``WHOLE_FILE_BYTES`` as a tree over their parts (``tree_digests``), so no file must fit
    into one value; the file list of a model is small. One row that says so where
    there is nothing at that path."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([("artifact-not-found", None, None, "artifact-not-found")],
                                     "relative_path string, length bigint, modificationTime timestamp, sha256 string")
    # the length is pushed down, so longer files are not read here
    out = files.where(F.col("length") <= WHOLE_FILE_BYTES).select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))
    long = files.where(F.col("length") > WHOLE_FILE_BYTES).select("path", "modificationTime")
    if names := [r["path"] for r in long.collect()]:
        plain = lambda c: F.regexp_replace(c, "^[a-zA-Z0-9+.-]+:/*", "/")  # noqa: E731  (one reader writes file:/x, the other file:///x)
        trees = tree_digests(spark, names).withColumn("_plain", plain("path")).drop("path")
        out = out.unionByName(long.withColumn("_plain", plain("path")).join(trees, "_plain").select("path", "length", "modificationTime", "sha256"))
    below = F.substring_index("path", path.rstrip("/").split("://")[-1].strip("/") + "/", -1)
    return out.select(below.alias("relative_path"), "length", "modificationTime", "sha256")


def artifact_digest(manifest: DataFrame, data_only: bool = False) -> DataFrame:
    """One digest over the sorted manifest lines. ``data_only``: over the files in
    ``data`` folders, by folder and content; the names of part files are random
    and the ``metadata`` holds the time of saving, so this digest is equal for two
    saves of one model."""
    name = F.col("relative_path")
    m = manifest.filter(F.concat(F.lit("/"), name).contains("/data/")) if data_only else manifest
    lines = F.sort_array(F.collect_list(F.concat_ws(":", F.regexp_replace(name, "[^/]+$", "") if data_only else name, "sha256")))
    return m.agg(F.sha2(F.array_join(lines, "\n"), 256).alias("artifact_hash"),
                 F.count(F.lit(1)).cast("bigint").alias("files"),
                 F.max("modificationTime").alias("newest_file_time"))


def model_registry_row(spark: SparkSession, path: str, s: TripSettings = DEFAULT_SETTINGS,
                       names: list[str] = ORDERED_FEATURE_NAMES) -> DataFrame:
    """Version, training date (newest file time, UTC ISO), features, settings,
    framework and artifact hash, as one row of the registry table."""
    import pyspark
    dig = artifact_digest(artifact_manifest(spark, path))
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("newest_file_time").cast("timestamp_ntz"))
    forest = {"n_estimators": s.n_estimators, "max_depth": s.max_depth, "max_bins": s.max_bins, "random_state": s.random_state}
    settings = {"model_type": s.model_type, "rows_per_fit_partition": s.rows_per_fit_partition} | (
        forest if s.model_type == "random_forest" else {})
    return dig.select(F.lit(s.model_version).alias("model_version"),
                      F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("training_date"),
                      F.array(*[F.lit(n) for n in names]).alias("feature_names"),
                      F.lit(json.dumps(settings)).alias("settings"),
                      F.lit(f"pyspark.ml {pyspark.__version__}").alias("framework"), "artifact_hash", "files")


def append_registry(row: DataFrame, path: str) -> DataFrame:
    """Adds the row to the registry as its next version and returns the table, with
    ``version_number``. Of two writers at once each gets a number of its own."""
    append_version(row, path)
    return read_versions(row.sparkSession, path)
