"""Queries: fitting, scoring, metrics, persistence and parity (F2-F16, A22,
D4, S3-S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, ORDERED_FEATURE_NAMES, REQUEST_FIELDS
from sparktrips.operators import clean, model, split, validate as V
from sparktrips.operators.epochs import read_epochs, write_epoch
from sparktrips.plans.catalog import register
from sparktrips.plans.q_features import _HASH_SPLIT_SQL
from sparktrips.plans.q_validate import KEYS, _K, _VALIDATED_CTE, _field_value_sql
from sparktrips.plans.sqlviews import with_clean, with_requests
from sparktrips.session import scratch_path
from sparktrips.sources import views
from sparktrips.train_job import prepare_training_table

# A lighter forest than the default (100 trees, depth 30, 256 bins), for queries that
# are named after it. ``run_training`` fits the default, which ``load_model`` reloads.
LIGHT_FOREST = DEFAULT_SETTINGS.with_(n_estimators=5, max_depth=8, max_bins=64)

_FITTED: dict = {}


def _labelled(spark, sf_dir):
    return model.training_frame(split.hash_split(clean.clean_trips(views.trips(spark, sf_dir))), "trip_id", extra=[split.SPLIT])


def _table(spark, sf_dir):
    """Key, features, label and split of the cleaned trips, written once per table: fits and metrics
    read it several times."""
    key = (spark.sparkContext.applicationId, sf_dir, "table")
    if key not in _FITTED:
        path = scratch_path(spark, "model-table")
        _FITTED[key] = path, prepare_training_table(spark, views.trips(spark, sf_dir), DEFAULT_SETTINGS, path).schema
    path, schema = _FITTED[key]
    return spark.read.schema(schema).parquet(path)


def _part(spark, sf_dir, name):
    return _table(spark, sf_dir).filter(F.col(split.SPLIT) == name)


def _fit(spark, sf_dir, kind: str):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FITTED:
        s = LIGHT_FOREST
        est = model.create_model(kind, s)
        _FITTED[key] = model.train_pipeline(_part(spark, sf_dir, "train"), est, s)
    return _FITTED[key]


# ------------------------------------------------------- SQL-checkable models

@register("fit_linear_univariate", with_clean(f"""
select count(*) as rows, round(regr_slope(trip_duration, trip_distance), 6) as slope,
  round(regr_intercept(trip_duration, trip_distance), 6) as intercept,
  round(regr_r2(trip_duration, trip_distance), 6) as r2
from cleaned where {_HASH_SPLIT_SQL} = 'train'"""))
def fit_linear_univariate(spark, sf_dir):
    """closed-form OLS on distance, fitted on the train split."""
    t = _labelled(spark, sf_dir).filter(F.col(split.SPLIT) == "train")
    y, x = F.col("trip_duration"), F.col("trip_distance")
    return t.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                 F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"),
                 F.round(F.regr_r2(y, x), 6).alias("r2"))


@register("score_linear_sql", with_clean("""
select trip_id, 3.0 * trip_distance + 5.0 as prediction from cleaned"""))
def score_linear_sql(spark, sf_dir):
    """scoring with known linear weights (prediction = 3 * distance + 5)."""
    df = clean.clean_trips(views.trips(spark, sf_dir))
    return df.select("trip_id", (F.lit(3.0) * F.col("trip_distance") + F.lit(5.0)).alias("prediction"))


@register("regression_metrics", with_clean(f"""
, sp as (select *, {_HASH_SPLIT_SQL} as split from cleaned),
fit as (select regr_slope(trip_duration, trip_distance) as b, regr_intercept(trip_duration, trip_distance) as a
        from sp where split = 'train'),
pred as (select trip_duration as y, a + b * trip_distance as p from sp, fit where split = 'val')
select count(*) as rows, round(avg(abs(y - p)), 6) as mae, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
  round(1.0 - sum((y - p) * (y - p)) / nullif(sum((y - (select avg(y) from pred)) * (y - (select avg(y) from pred))), 0), 6) as r2
from pred"""))
def regression_metrics(spark, sf_dir):
    """MAE / RMSE / R^2 on the validation split for the distance-only OLS
    fitted on the train split (coefficients as a scalar subquery)."""
    t = _labelled(spark, sf_dir)
    y, x = F.col("trip_duration"), F.col("trip_distance")
    coef = t.filter(F.col(split.SPLIT) == "train").agg(
        F.struct(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"))).scalar()
    val = t.filter(F.col(split.SPLIT) == "val").select(y, x, coef.alias("_c"))
    pred = val.select(y, (F.col("_c.a") + F.col("_c.b") * x).alias("prediction"))
    return model.regression_metrics(pred)


@register("score_sink", with_requests(f"""
select {_K}, 3.0 * trip_distance + 5.0 as prediction, '{DEFAULT_SETTINGS.model_version}' as model_version,
  coalesce(request_id, sha256(concat_ws('|', cast(pos as varchar), payload))) as correlation_id
from (select {_K}, payload, {_field_value_sql("trip_distance", None, True)}
      from validated where n_errors = 0) t""", _VALIDATED_CTE))
def score_sink(spark, sf_dir):
    """S3: response rows (prediction, model_version, correlation_id) for the
    accepted requests, scored with the known linear weights; ``write_scores``
    persists them."""
    val = V.validate_records(views.requests(spark, sf_dir), with_values=True)
    return V.route(val, True, [*KEYS, (F.lit(3.0) * F.col("trip_distance") + F.lit(5.0)).alias("prediction"),
                               F.lit(DEFAULT_SETTINGS.model_version).alias("model_version"),
                               V.correlation_id("request_id").alias("correlation_id")])


def write_scores(scored, path: str, epoch: int) -> None:
    """S3 sink: the scores of an epoch, replaced as a whole when it is written again."""
    write_epoch(scored.sparkSession, path, epoch, {"scores": scored})


# --------------------------------------------------------- Spark ML models

_VAL_ROWS = with_clean(f"select count(*) as rows, 0.0 as max_abs_diff, true as within_tolerance from cleaned where {_HASH_SPLIT_SQL} = 'val'")
_MOMENTS = ["intercept", *ORDERED_FEATURE_NAMES]


@register("linear_normal_equations", with_clean("\nunion all\n".join(
    f"select '{t}' as term, count(*) as rows, 0.0 as mean_moment from cleaned where {_HASH_SPLIT_SQL} = 'train'" for t in _MOMENTS)))
def linear_normal_equations(spark, sf_dir):
    """F3 checked: over the training rows the residuals of a least-squares fit have
    mean 0, also times each feature."""
    m = _fit(spark, sf_dir, "linear_regression")
    rows = model.score(m, _part(spark, sf_dir, "train")).withColumn("_r", F.col("trip_duration") - F.col("prediction"))
    means = rows.agg(F.count(F.lit(1)).alias("n"), *[
        F.avg(F.col("_r") * (F.lit(1.0) if t == "intercept" else F.col(t))).alias(t) for t in _MOMENTS])
    return means.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col("n").alias("rows"), (F.round(t, 6) + F.lit(0.0)).alias("mean_moment")) for t in _MOMENTS])))


@register("fit_linear")
def fit_linear(spark, sf_dir):
    """OLS on the nine features; coefficients and intercept."""
    m = _fit(spark, sf_dir, "linear_regression")
    lr = m.stages[-1]
    rows = [(n, float(c)) for n, c in zip(ORDERED_FEATURE_NAMES, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "term string, value double")


@register("fit_forest_5_trees_depth_8")
def fit_forest_5_trees_depth_8(spark, sf_dir):
    """random forest (all features per split, seed fixed); importances."""
    return model.importances_frame(spark, _fit(spark, sf_dir, "random_forest"))


@register("forest_metrics_5_trees_depth_8")
def forest_metrics_5_trees_depth_8(spark, sf_dir):
    """The pipeline (missing -> 0.0, assembler, forest) fitted on
    canonicalised rows; validation metrics."""
    m = _fit(spark, sf_dir, "random_forest")
    return model.regression_metrics(model.score(m, _part(spark, sf_dir, "val")))


@register("score_batch")
def score_batch(spark, sf_dir):
    """predictions for every validation row, key kept."""
    m = _fit(spark, sf_dir, "linear_regression")
    return model.score(m, _part(spark, sf_dir, "val")).select("trip_id", "prediction")


@register("score_one")
def score_one(spark, sf_dir):
    """one request record scored through the full record path."""
    m = _fit(spark, sf_dir, "linear_regression")
    val = V.validate_records(views.requests(spark, sf_dir), with_values=True)
    first = V.route(val, True, [*KEYS, *[n for n, *_ in REQUEST_FIELDS]]).orderBy(*KEYS).limit(1)
    norm = model.feature_columns(first.withColumn(
        "store_and_fwd_flag_encoded", F.when(F.upper(F.col("store_and_fwd_flag")) == "Y", 1).otherwise(0)))
    return model.score(m, norm).select(*KEYS, "prediction",
                                       V.out_of_range().alias("out_of_training_range"))


@register("model_comparison_5_trees_depth_8")
def model_comparison_5_trees_depth_8(spark, sf_dir):
    """linear vs forest on the same validation rows, scored in one pass."""
    kinds = ("linear_regression", "random_forest")
    rows = _part(spark, sf_dir, "val")
    for k in kinds:
        rows = model.score(_fit(spark, sf_dir, k), rows).withColumnRenamed("prediction", k)
    long = rows.select("trip_duration", F.explode(F.array(*[F.struct(F.lit(k).alias("model"), F.col(k).alias("prediction")) for k in kinds])).alias("p"))
    return model.regression_metrics(long.select("trip_duration", "p.*"), group="model")


@register("top_coefficients")
def top_coefficients(spark, sf_dir):
    """Linear coefficients by absolute size."""
    return model.coefficients_frame(spark, _fit(spark, sf_dir, "linear_regression"))


def _saved(spark, sf_dir, kind="linear_regression"):
    key = (spark.sparkContext.applicationId, sf_dir, kind, "saved")
    if key not in _FITTED:
        path = scratch_path(spark, f"model-{kind}")
        model.save_model(_fit(spark, sf_dir, kind), path)
        _FITTED[key] = path
    return _FITTED[key]


@register("save_model")
def save_model(spark, sf_dir):
    """Persist the fitted pipeline; the files written."""
    return model.artifact_manifest(spark, _saved(spark, sf_dir)).select("relative_path", "length")


@register("load_model")
def load_model(spark, sf_dir):
    """Reload the pipeline that the training job saved (the default forest) and
    score the validation rows."""
    m = model.load_model(_trained(spark, sf_dir)[0])
    return model.score(m, _part(spark, sf_dir, "val")).select("trip_id", "prediction")


@register("default_forest_parity", _VAL_ROWS)
def default_forest_parity(spark, sf_dir):
    """The default forest as the training job fitted it and as it is reloaded."""
    path, _, fitted = _trained(spark, sf_dir)
    return model.parity(_part(spark, sf_dir, "val"), fitted, model.load_model(path))


@register("default_forest_facts", with_clean(f"""
select count(*) as train_rows, 100 as trees, true as every_weight_near_the_rows, true as deep, true as children_add_up from cleaned where {_HASH_SPLIT_SQL} = 'train'"""))
def default_forest_facts(spark, sf_dir):
    """what the nodes of the default forest must satisfy: 100 trees whose bags weigh about
    as much as the training rows, nodes beyond the depth of a light forest, and
    children that weigh as much as their parent."""
    nodes = _trained(spark, sf_dir)[2].stages[-1].nodes
    rows = _part(spark, sf_dir, "train").count()
    roots = nodes.where("node = 1").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("weight") - rows)).alias("off")).first()
    depth = nodes.agg(F.max(F.floor(F.log2("node")))).first()[0]
    below = nodes.where("node > 1").groupBy("tree", F.expr("node div 2").alias("node")).agg(F.sum("weight").alias("children"), F.count(F.lit(1)).alias("n"))
    odd = nodes.where("feature >= 0").join(below, ["tree", "node"], "left").where("n is null or n <> 2 or children <> weight").count()
    row = rows, roots["n"], roots["off"] < 6 * rows ** 0.5, depth > 8, odd == 0
    return spark.createDataFrame([row], "train_rows bigint, trees int, every_weight_near_the_rows boolean, deep boolean, children_add_up boolean")


@register("reload_parity", _VAL_ROWS)
def reload_parity(spark, sf_dir):
    """in-memory vs reloaded model on the validation rows; max |diff|."""
    a = _fit(spark, sf_dir, "linear_regression")
    b = model.load_model(_saved(spark, sf_dir))
    return model.parity(_part(spark, sf_dir, "val"), a, b)


@register("linear_parity", _VAL_ROWS)
def linear_parity(spark, sf_dir):
    """Spark ML linear model vs the same model as a column expression."""
    m = _fit(spark, sf_dir, "linear_regression")
    same = model.parity(_part(spark, sf_dir, "val"), m, b_expr=model.linear_expression(m))
    return same.withColumn("max_abs_diff", F.round("max_abs_diff", 9))


@register("artifact_manifest")
def artifact_manifest(spark, sf_dir):
    """SHA-256 per artifact file."""
    return model.artifact_manifest(spark, _saved(spark, sf_dir))


@register("score_sink_written", with_requests(f"""
select count(*) as rows, count(*) as with_latency, count(distinct correlation_id) as ids
from (select coalesce(request_id, sha256(concat_ws('|', cast(pos as varchar), payload))) as correlation_id from validated where n_errors = 0) t""", _VALIDATED_CTE))
def score_sink_written(spark, sf_dir):
    """S3: the responses of ``score_sink`` with their latency, written twice as one epoch and read: no row twice."""
    path = scratch_path(spark, "scores")
    for _ in range(2):
        write_scores(V.with_latency(score_sink(spark, sf_dir).withColumn("received_at", F.current_timestamp()), "received_at"), path, 0)
    rows = read_epochs(spark, path, "scores")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("latency_ms") >= 0).alias("with_latency"), F.countDistinct("correlation_id").alias("ids"))


@register("saved_model_facts", "select true as has_files, true as digests_equal, true as one_version_each, 9 as coefficients, true as one_is_batch")
def saved_model_facts(spark, sf_dir):
    """S4, S6, S7, D4, F9, F11 as equalities: two saves of one model have the same data
    digest; two registrations are versions 1 and 2; a record scored alone gets the
    prediction that it gets in a batch."""
    m = _fit(spark, sf_dir, "linear_regression")
    paths = [model.save_model(m, scratch_path(spark, "facts")) for _ in range(2)]
    files = [model.artifact_manifest(spark, p) for p in paths]
    digests = {model.artifact_digest(f, data_only=True).first()["artifact_hash"] for f in files}
    registry = scratch_path(spark, "facts-registry")
    for p in paths:
        rows = model.append_registry(model.model_registry_row(spark, p, DEFAULT_SETTINGS.with_(model_type="linear_regression")), registry)
    versions = sorted(r["version_number"] for r in rows.collect())
    some = _part(spark, sf_dir, "val").orderBy("trip_id").limit(3).collect()
    batch = {r["trip_id"]: r["prediction"] for r in model.score(m, _part(spark, sf_dir, "val")).select("trip_id", "prediction").where(
        F.col("trip_id").isin([r["trip_id"] for r in some])).collect()}
    alone = [model.score_one(m, spark, {n: r[n] for n in ORDERED_FEATURE_NAMES}) == batch[r["trip_id"]] for r in some]
    n = model.coefficients_frame(spark, m).count()
    row = (files[0].where("length(sha256) = 64").count() == files[0].count() > 0, len(digests) == 1, versions == [1, 2], n, all(alone))
    return spark.createDataFrame([row], "has_files boolean, digests_equal boolean, one_version_each boolean, coefficients int, one_is_batch boolean")


@register("model_registry")
def model_registry(spark, sf_dir):
    """One registry row for the saved model."""
    row = model.model_registry_row(spark, _saved(spark, sf_dir), DEFAULT_SETTINGS.with_(model_type="linear_regression"))
    return model.append_registry(row, scratch_path(spark, "registry"))


def _trained(spark, sf_dir):
    """The training job with its default settings, once per table: where the model is
    saved, its metrics, and the model."""
    from sparktrips import train_job
    key = (spark.sparkContext.applicationId, sf_dir, "trained")
    if key not in _FITTED:
        path = scratch_path(spark, "run-training-model")
        fitted, metrics = train_job.run_training(spark, views.trips(spark, sf_dir), DEFAULT_SETTINGS, path)
        _FITTED[key] = path, metrics, fitted
    return _FITTED[key]


@register("run_training")
def run_training(spark, sf_dir):
    """the whole training job (default settings); validation metrics."""
    return _trained(spark, sf_dir)[1]
