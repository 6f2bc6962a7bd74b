"""Profiling operators: null study, descriptive statistics, group means,
money summaries, fare consistency, correlations, histograms and box plots.

Design rules used throughout:

* one pass per study: several statistics for several columns are computed in
  a single ``agg`` (conditional aggregates instead of one job per column);
* exact quantiles by selection (``quantiles``);
* wide -> long with ``inline(array(struct...))`` on the one-row result, never
  on the input;
* grouped statistics use ``groupBy`` (map-side partial aggregation, so a hot
  key costs one partial buffer per task, not one task's worth of rows);
* scalars needed by a later filter (quantiles, min/max) are scalar subqueries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktrips.config import CORRELATION_EXCLUDED, FARE_COMPONENTS, MONETARY_COLUMNS
from sparktrips.functions.columns import row_sum_skip_null
from sparktrips.operators import quantiles
from sparktrips.session import ship_package

DESCRIBE_PCTS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def _pname(p: float) -> str:
    return f"p{int(round(p * 100)):02d}"


def _inline(one_row: DataFrame, structs: list[Column], keep: list[str] | None = None) -> DataFrame:
    return one_row.select(*(keep or []), F.inline(F.array(*structs)))


# ---------------------------------------------------------------- nulls (A1-A3)

def null_counts(df: DataFrame) -> DataFrame:
    """A1: nulls per column, one aggregate pass, long form."""
    cols = df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    return _inline(one, [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                                  F.col(f"_{i}").cast("bigint").alias("null_count"))
                         for i, c in enumerate(cols)])


def table_info(df: DataFrame) -> DataFrame:
    """A2: column, Spark type name, non-null count."""
    fields = df.schema.fields
    one = df.agg(*[F.count(F.col(f.name)).alias(f"_{i}") for i, f in enumerate(fields)])
    return _inline(one, [F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                                  F.lit(f.dataType.simpleString()).alias("data_type"),
                                  F.col(f"_{i}").cast("bigint").alias("non_null"))
                         for i, f in enumerate(fields)])


def null_cooccurrence(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3: rows with any vs all of ``cols`` null; whether those sets coincide."""
    anyn = F.lit(False)
    alln = F.lit(True)
    for c in cols:
        anyn = anyn | F.col(c).isNull()
        alln = alln & F.col(c).isNull()
    one = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(anyn).alias("any_null"), F.count_if(alln).alias("all_null"))
    return one.select(
        F.col("total_rows").cast("bigint"), F.col("any_null").cast("bigint"), F.col("all_null").cast("bigint"),
        (F.col("any_null") == F.col("all_null")).alias("same_rows"),
        F.round(F.try_divide(F.col("any_null") * 100.0, F.col("total_rows")), 6).alias("pct_rows"))


# ------------------------------------------------------- descriptive statistics

def describe_many(df: DataFrame, items: list[tuple[str, Column]], pcts: list[float] = DESCRIBE_PCTS,
                  label: str = "name") -> DataFrame:
    """count, mean, std (sample), min, percentiles (exact, linear), max for each
    labelled expression; one output row per label.

    Exact quantiles by selection (``quantiles``). Conditional inputs
    (``when(cond, x)``) give per-stage statistics from the same pass, since null
    values are left out.
    """
    found = quantiles.statistics(df, [x for _, x in items], pcts)
    names = df.sparkSession.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], f"ordinal int, {label} string")
    return names.join(found, "ordinal", "left").select(
        "ordinal", label, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"), "min",
        *[F.round(F.col("q")[j], 6).alias(_pname(p)) for j, p in enumerate(pcts)], "max")


def iqr_bounds(df: DataFrame, column: str, whisker: float = 1.5) -> DataFrame:
    """Q1, Q3, IQR and the 1.5*IQR fences."""
    q = quantiles.statistics(df, [F.col(column)], [0.25, 0.75]).where("count > 0")
    return q.select(
        F.round(F.col("q")[0], 6).alias("q1"), F.round(F.col("q")[1], 6).alias("q3"),
        F.round(F.col("q")[1] - F.col("q")[0], 6).alias("iqr"),
        F.round(F.col("q")[0] - whisker * (F.col("q")[1] - F.col("q")[0]), 6).alias("lower_fence"),
        F.round(F.col("q")[1] + whisker * (F.col("q")[1] - F.col("q")[0]), 6).alias("upper_fence"))


# ----------------------------------------------------------- grouped statistics

def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """A10: count and share per value (null keys dropped, like value_counts).

    The share uses a window over the *grouped* result, whose size is the
    number of distinct values, not the number of rows.
    """
    g = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("trips"))
    return g.select(column, F.col("trips").cast("bigint"),
                    F.round(F.col("trips") * 100.0 / F.sum("trips").over(Window.partitionBy()), 6).alias("pct"))


def group_means(df: DataFrame, key: str | Column, columns: list[str], key_name: str | None = None) -> DataFrame:
    """Several means per group in one aggregate (null keys dropped)."""
    k = F.col(key) if isinstance(key, str) else key
    name = key_name or (key if isinstance(key, str) else "key")
    return (df.filter(k.isNotNull()).groupBy(k.alias(name))
              .agg(F.count(F.lit(1)).cast("bigint").alias("trips"),
                   *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in columns]))


# ------------------------------------------------------------------ money

def financial_summary(df: DataFrame, columns: list[str] = MONETARY_COLUMNS) -> DataFrame:
    """Mean, median, std, min, max, Q1, Q3 per money column in one pass."""
    d = describe_many(df, [(c, F.col(c)) for c in columns], pcts=[0.25, 0.5, 0.75], label="column_name")
    return d.select("ordinal", "column_name", "count", "mean", F.col("p50").alias("median"), "std",
                    "min", "max", F.col("p25").alias("q1"), F.col("p75").alias("q3"))


def sign_summary(df: DataFrame, columns: list[str] = MONETARY_COLUMNS) -> DataFrame:
    """Negative / zero / positive counts, min, max per money column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs += [F.count_if(x < 0).alias(f"neg{i}"), F.count_if(x == 0).alias(f"zero{i}"),
                 F.count_if(x > 0).alias(f"pos{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    return _inline(one, [F.struct(
        F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
        F.col(f"neg{i}").cast("bigint").alias("negative"), F.col(f"zero{i}").cast("bigint").alias("zero"),
        F.col(f"pos{i}").cast("bigint").alias("positive"),
        F.col(f"lo{i}").cast("double").alias("min"), F.col(f"hi{i}").cast("double").alias("max"))
        for i, c in enumerate(columns)])


def fare_consistency(df: DataFrame, components: list[str] = FARE_COMPONENTS) -> DataFrame:
    """Expected total = sum of components (missing -> 0); difference."""
    present = [c for c in components if c in df.columns]
    exp = row_sum_skip_null(present)
    return (df.withColumn("expected_total_amount", exp)
              .withColumn("total_amount_difference", F.col("total_amount") - F.col("expected_total_amount")))


def fare_discrepancies(df: DataFrame, tolerance: float = 0.01, n: int = 5, key: str = "trip_id") -> DataFrame:
    """First ``n`` discrepant rows by key (a top-n report)."""
    fc = fare_consistency(df)
    return (fc.filter(F.abs(F.col("total_amount_difference")) > tolerance)
              .select(key, "total_amount", "expected_total_amount", "total_amount_difference", *FARE_COMPONENTS)
              .orderBy(key).limit(n))


def discrepancy_rate(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Count and share of discrepant rows with a describe of the
    difference."""
    rows = fare_consistency(df)
    shares = rows.agg(F.struct(F.count_if(F.abs(F.col("total_amount_difference")) > tolerance).alias("discrepant"), F.count(F.lit(1)).alias("rows"))).scalar()
    one = quantiles.statistics(rows, [F.col("total_amount_difference")], [0.25, 0.5, 0.75]).where("count > 0").select("*", shares.alias("s")).select("*", "s.*")
    return one.select(F.col("count").cast("bigint").alias("count"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min",
                      *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(["p25", "p50", "p75"])],
                      "max", F.col("discrepant").cast("bigint").alias("discrepant"),
                      F.round(F.try_divide(F.col("discrepant") * 100.0, F.col("rows")), 6).alias("pct_discrepant"))


# ------------------------------------------------------------- correlations

def numeric_columns(df: DataFrame, exclude: list[str] = CORRELATION_EXCLUDED,
                    always: str | None = "trip_duration") -> list[str]:
    """P20: numeric columns minus ids/derived; ``always`` kept if present."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    if always and always in df.columns and always not in cols:
        cols.append(always)
    return cols


def _merged(a: tuple, b: tuple) -> tuple:
    """Co-moments of two sets of rows from those of each: counts, means and sums of
    centred products, all as matrices over pairs of columns."""
    (n, x, y, xx, yy, xy), (m, u, v, uu, vv, uv) = a, b
    total = n + m
    share = np.divide(m, total, out=np.zeros_like(total), where=total > 0)
    dx, dy = u - x, v - y
    w = n * share
    return total, x + dx * share, y + dy * share, xx + uu + dx * dx * w, yy + vv + dy * dy * w, xy + uv + dx * dy * w


def _co_moments(values: np.ndarray) -> tuple:
    """Of the rows of a matrix (NaN: missing), over the rows where both columns of a pair are there."""
    there = ~np.isnan(values)
    t = there.astype(float)
    centre = np.divide(np.where(there, values, 0).sum(axis=0), t.sum(axis=0), out=np.zeros(values.shape[1]), where=t.sum(axis=0) > 0)
    c = np.where(there, values - centre, 0.0)  # near the means, so that products lose no digits
    n = t.T @ t
    of = np.maximum(n, 1)
    sx, sxx, sxy = c.T @ t, (c * c).T @ t, c.T @ c
    mx, my = sx / of, sx.T / of
    return n, mx + centre[:, None], my + centre[None, :], sxx - sx * mx, sxx.T - sx.T * my, sxy - sx * my


def _pair_corr(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson correlation per pair over rows where both are present.

    A task adds its batches up to one block of co-moments, as matrix products: no row is
    expanded. The blocks, one row per pair and task, are merged around the common means.
    """
    cols = list(dict.fromkeys([c for p in pairs for c in p]))
    ia, ib = (np.array([cols.index(p[k]) for p in pairs]) for k in (0, 1))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            if batch.num_rows:
                values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
                block = _co_moments(values) if block is None else _merged(block, _co_moments(values))
        if block is not None:
            columns = [pa.array(np.arange(len(pairs), dtype=np.int32)), *[pa.array(m[ia, ib]) for m in block]]
            yield pa.RecordBatch.from_arrays(columns, ["k", "n", "mx", "my", "xx", "yy", "xy"])

    ship_package(df.sparkSession)
    inputs = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = inputs.mapInArrow(add_up, "k int, n double, mx double, my double, xx double, yy double, xy double").where("n > 0")
    whole = Window.partitionBy("k")  # a row per task
    total = F.sum("n").over(whole)
    placed = parts.select("*", *[(F.col(m) - F.sum(F.col("n") * F.col(m)).over(whole) / total).alias(f"d{m}") for m in ("mx", "my")])
    moved = lambda c, a, b: F.sum(F.col(c) + F.col("n") * F.col(a) * F.col(b)).alias(c)
    mean = lambda c: (F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c)
    g = placed.groupBy("k").agg(F.sum("n").alias("n"), mean("mx"), mean("my"), moved("xx", "dmx", "dmx"), moved("yy", "dmy", "dmy"), moved("xy", "dmx", "dmy"))
    names_a, names_b = (F.array(*[F.lit(p[k]) for p in pairs]) for k in (0, 1))
    k = F.col("k") + 1
    # a spread that is rounding of the mean is none
    varies = lambda c, m: F.col(c) > F.col("n") * F.pow(F.col(m) * 1e-13, 2)
    corr = F.when((F.col("n") > 1) & varies("xx", "mx") & varies("yy", "my"), F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))))
    return g.select(F.element_at(names_a, k).alias("column_a"), F.element_at(names_b, k).alias("column_b"), F.round(corr, 6).alias("corr"))


def corr_long(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Correlations for the given pairs (long form)."""
    return _pair_corr(df, pairs)


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Full matrix in long form. Only i <= j is aggregated; the mirror
    half is produced from the small result."""
    cols = columns or numeric_columns(df)
    upper = _pair_corr(df, [(a, b) for i, a in enumerate(cols) for b in cols[i:]])
    both = upper.select(F.explode(F.array(
        F.struct(F.col("column_a").alias("a"), F.col("column_b").alias("b"), "corr"),
        F.when(F.col("column_a") != F.col("column_b"),
               F.struct(F.col("column_b").alias("a"), F.col("column_a").alias("b"), "corr")))).alias("e"))
    return both.filter(F.col("e").isNotNull()).select(F.col("e.a").alias("column_a"), F.col("e.b").alias("column_b"),
                                                      F.col("e.corr").alias("corr"))


# --------------------------------------------------------------- histograms

def histogram(df: DataFrame, items: list[tuple[str, Column, int]]) -> DataFrame:
    """Equal-width histograms (last bin closed) for several labelled
    expressions, in one pass over the data after one bounds aggregate.

    The bounds are one row (min and max per item), fetched once and used as
    literals: referencing a scalar subquery in every bin expression would plan
    one subquery (one pass over the input) per reference. Each row then
    carries an int array with its bin per item (NULL when missing/excluded),
    ``posexplode`` turns it into (item, bin) and a partially aggregated
    groupBy counts at most sum(bins) groups.
    """
    row = df.agg(*[f for i, (_, x, _) in enumerate(items)
                   for f in (F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"))]).first()
    edges = []
    for i, (name, x, bins) in enumerate(items):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None and lo == hi:  # a constant column gets (v - 0.5, v + 0.5), like numpy
            lo, hi = lo - 0.5, hi + 0.5
        edges.append((name, x, bins, lo, hi))
    per_row = F.array(*[
        (F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo)) * bins / F.lit(hi - lo)), F.lit(bins - 1)).cast("int"))
         if lo is not None else F.lit(None).cast("int"))
        for _, x, bins, lo, hi in edges])
    counted = (df.select(F.posexplode(per_row).alias("item", "bin")).filter(F.col("bin").isNotNull())
                 .groupBy("item", "bin").agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    item = F.col("item") + 1
    lo = F.element_at(F.array(*[F.lit(e[3]).cast("double") for e in edges]), item)
    hi = F.element_at(F.array(*[F.lit(e[4]).cast("double") for e in edges]), item)
    nb = F.element_at(F.array(*[F.lit(e[2]) for e in edges]), item)
    width = (hi - lo) / nb
    return counted.select(F.col("item").alias("ordinal"),
                          F.element_at(F.array(*[F.lit(e[0]) for e in edges]), item).alias("column_name"),
                          "bin", F.round(lo + F.col("bin") * width, 6).alias("bin_lower"),
                          F.round(lo + (F.col("bin") + 1) * width, 6).alias("bin_upper"), "count")


# ------------------------------------------------------------------ box plots

def box_stats(df: DataFrame, value: str, group: str | Column | None = None, group_name: str = "group",
              whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the 1.5*IQR fences)
    and outlier counts, overall or per group.

    Whiskers and outliers of groups follow from the rows counted per (group, value), so no row
    is joined with its group.
    """
    keys = {} if group is None else {group_name: F.col(group) if isinstance(group, str) else group}
    pcts, low, high = [0.25, 0.5, 0.75], F.col("q")[0], F.col("q")[2]
    iqr = high - low
    lo_f, hi_f, v = low - whisker * iqr, high + whisker * iqr, F.col("v")
    if keys:
        rows = df.where(keys[group_name].isNotNull())
        counts = quantiles.value_counts(rows, F.col(value), keys)
        quartiles = quantiles.grouped_statistics(rows, F.col(value), pcts, keys).select(group_name, "count", "q")
        placed = counts.join(quartiles, group_name)
    else:
        quartiles = quantiles.statistics(df, [F.col(value)], pcts).where("count > 0").select(F.struct("count", "q")).scalar()
        placed = df.select(F.col(value).cast("double").alias("v"), F.lit(1).alias("n"), quartiles.alias("s")).select("v", "n", "s.*").where("v is not null")
    agg = placed.groupBy(*keys, "count", "q").agg(
        F.min(F.when(v >= lo_f, v)).alias("whisker_low"), F.max(F.when(v <= hi_f, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((v < lo_f) | (v > hi_f), F.col("n"))), F.lit(0)).cast("bigint").alias("outliers"))
    return agg.select(*keys, F.col("count").cast("bigint").alias("count"),
                      *[F.round(F.col("q")[i], 6).alias(c) for i, c in enumerate(("q1", "median", "q3"))],
                      F.round(iqr, 6).alias("iqr"), F.round(F.col("whisker_low"), 6).alias("whisker_low"),
                      F.round(F.col("whisker_high"), 6).alias("whisker_high"), "outliers")


# ---------------------------------------------------------------- flag studies

def _flag_counts(df: DataFrame, column: str, flags: dict[str, Column]) -> DataFrame:
    """Rows in all, rows per flag (a condition on ``v`` and ``quantile``, the 99th
    percentile) and that percentile, in one pass after the percentile."""
    p99 = quantiles.quantile(df, F.col(column), 0.99).scalar()
    rows = df.select(F.col(column).alias("v"), p99.alias("quantile"))
    return rows.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), *[F.count_if(c).cast("bigint").alias(k) for k, c in flags.items()],
                    F.round(F.max("quantile"), 6).alias("p99"))


def duration_flags(df: DataFrame, column: str = "trip_duration") -> DataFrame:
    """Non-positive, under one minute, and above-p99 durations."""
    v = F.col("v")
    return _flag_counts(df, column, {"non_positive": v <= 0, "under_1_min": (v > 0) & (v < 1), "above_p99": v > F.col("quantile")})


def distance_flags(df: DataFrame, column: str = "trip_distance") -> DataFrame:
    """Zero, negative and above-p99 distances."""
    v = F.col("v")
    return _flag_counts(df, column, {"zero": v == 0, "negative": v < 0, "above_p99": v > F.col("quantile")})


def passenger_flags(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """Zero and negative passenger counts, maximum."""
    p = F.col(column)
    return df.agg(F.count_if(p == 0).cast("bigint").alias("zero"),
                  F.count_if(p < 0).cast("bigint").alias("negative"),
                  F.max(p).cast("double").alias("max"))


def sample_rows(df: DataFrame, n: int, key: str = "trip_id", seed: int = 42) -> DataFrame:
    """Deterministic sample of ``n`` rows: the n smallest md5(key:seed).

    First a cut on the hash leaves about 4n rows (all, if there are fewer), so the
    top-n merge sees a few times n rows however many tasks there are; where chance
    leaves fewer than n, the whole table is sorted."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    hashed = df.withColumn("_h", h)
    total = df.count()
    if total > 4 * n:
        cut = hashed.where(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") < int(4 * n / total * 2**32))
        if cut.count() >= n:
            hashed = cut
    return hashed.orderBy("_h", key).limit(n).drop("_h")


# ------------------------------------------------------------- density curve

#: Bins of a density curve per bandwidth: narrow enough that binning is not seen.
BINS_PER_BANDWIDTH = 16


def density_curve(df: DataFrame, column: str, grid: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max], binned.

    The data are binned first (one pass); each bin centre then contributes
    ``count * N(x_g; centre, h)`` to every grid point, so the work is grid x bins
    (exact KDE would be grid x rows). Bandwidth: Scott's rule, ``h = std * n^(-1/5)``;
    it shrinks as rows are added, and the bins with it, a fixed number to each
    bandwidth.
    """
    x = F.col(column)
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"),
                F.max(x).alias("hi")).first()
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    if not n or sd is None or sd == 0 or lo == hi:
        return df.sparkSession.createDataFrame([], "grid_index int, x double, density double")
    bw = sd * n ** (-0.2)
    bins = math.ceil((hi - lo) * BINS_PER_BANDWIDTH / bw)
    width = (hi - lo) / bins
    h = (df.select(F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo)) * bins / F.lit(hi - lo)),
                                                 F.lit(bins - 1)).cast("int")).alias("bin"))
           .filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("cnt")))
    center = F.lit(lo) + (F.col("bin") + 0.5) * F.lit(width)
    g = F.col("g")
    xg = F.lit(lo) + g * F.lit((hi - lo) / (grid - 1))
    z = (xg - F.col("center")) / F.lit(bw)
    contrib = (h.select(center.alias("center"), "cnt", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
                .select(g, xg.alias("x"), (F.col("cnt") * F.exp(F.lit(-0.5) * z * z)).alias("w")))
    norm = float(n) * bw * (2 * 3.141592653589793) ** 0.5
    return (contrib.groupBy("g", "x").agg(F.sum("w").alias("s"))
                   .select(F.col("g").alias("grid_index"), F.round("x", 6).alias("x"),
                           F.round(F.col("s") / F.lit(norm), 6).alias("density")))
