"""Exact quantiles and moments, by selection.

A first aggregate gives count, moments, ends and, from Spark's mergeable quantile
sketch, a bracket of values around each wanted rank. Rows outside all brackets then only
count towards the gap they fall in; rows inside are counted per distinct value. The running
sum over gaps and bracket values, in order, finds the ranks; it sees some ``8 / ACCURACY`` of the
distinct values per quantile (all of them while there are no more than ``ACCURACY`` rows), never
all values of a column or group. Should the sketch break its bound, the query fails
instead of giving a wrong value. Quantiles interpolate linearly.

Columns need two scans and no shuffle of values. Groups are counted per
(group, value) first and then joined with their brackets, so that a hot group is
spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the sketch, as 1 / share of the rows.
ACCURACY = 10_000
#: Half a bracket's width as a share of the rows: the sketch's error on either side, and
#: two ranks where there are more than ``ACCURACY`` rows.
SLACK = 4 / ACCURACY


def _summary(v: Column, pcts: list[float]) -> Column:
    """Count, moments, ends and brackets of the values as one struct."""
    ends = [min(1.0, max(0.0, p + side)) for p in pcts for side in (-SLACK, SLACK)]
    cuts = F.percentile_approx(v, ends, ACCURACY)
    brackets = F.array(*[F.struct(cuts[2 * i].alias("low"), cuts[2 * i + 1].alias("high")) for i in range(len(pcts))])
    return F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                    F.when(F.count(v) > ACCURACY, brackets).alias("brackets"))


def _placed(v: Column, brackets: Column) -> list[Column]:
    """``inside``, the value where it lies in a bracket, else null; and ``gap``, how many
    brackets lie below it then."""
    within = F.coalesce(F.exists(brackets, lambda b: (v >= b["low"]) & (v <= b["high"])), F.lit(True))
    return [F.when(within, v).alias("inside"), F.when(~within, F.size(F.filter(brackets, lambda b: v > b["high"]))).alias("gap")]


def _ranked(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``upto``, the rows up to each cell. Cells are bracket values and gaps."""
    return cells.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("v")))


def _selected(cells: DataFrame, keys: list[str], pcts: list[float]) -> DataFrame:
    """``(keys..., q)`` from cells ``(keys..., inside, gap, v, n)``."""
    rows = _ranked(cells, keys).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    parts, values = [], []
    for i, p in enumerate(pcts):
        at = F.lit(float(p)) * (F.col("total") - 1)
        for name, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            values.append(F.min(F.when(F.col("upto") > rank, F.struct("v", F.col("inside").isNotNull().alias("exact")))).alias(f"_{name}{i}"))
        parts.append(F.max(at - F.floor(at)).alias(f"_part{i}"))
    one = rows.groupBy(*keys).agg(*values, *parts)

    def value(c: str) -> Column:
        return F.when(F.col(f"{c}.exact"), F.col(f"{c}.v")).when(F.col(c).isNotNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double"))

    q = F.array(*[value(f"_lo{i}") + (value(f"_hi{i}") - value(f"_lo{i}")) * F.col(f"_part{i}") for i in range(len(pcts))])
    return one.select(*keys, q.alias("q"))


def statistics(df: DataFrame, items: list[Column], pcts: list[float]) -> DataFrame:
    """Per item (an expression) its ``ordinal``, ``count mean std min max`` and ``q``, the
    array of quantiles. Null values are left out."""
    values = [x.cast("double") for x in items]
    # one row; used twice, but planned and run once
    whole = df.agg(F.array(*[_summary(v, pcts) for v in values]).alias("whole")).scalar()
    entries = F.array(*[F.struct(F.lit(i).alias("ordinal"), v.alias("v")) for i, v in enumerate(values)])
    long = df.select(F.explode(entries).alias("e"), whole.alias("whole")).select("e.*", "whole").where("v is not null")
    placed = long.select("ordinal", "v", *_placed(F.col("v"), F.col("whole")[F.col("ordinal")]["brackets"]))
    cells = placed.groupBy("ordinal", "inside", "gap").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n"))
    found = _selected(cells, ["ordinal"], pcts)
    known = df.sparkSession.range(1).select(F.posexplode(whole).alias("ordinal", "s")).select("ordinal", "s.*").drop("brackets")
    return known.join(found, "ordinal", "left")


def quantile(df: DataFrame, value: Column, p: float) -> DataFrame:
    """One row, one column: the quantile of all rows."""
    v = value.cast("double")
    whole = df.agg(_summary(v, [p]).alias("whole")).scalar()
    placed = df.select(v.alias("v"), whole["brackets"].alias("brackets")).where("v is not null").select("v", *_placed(F.col("v"), F.col("brackets")))
    cells = placed.groupBy("inside", "gap").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n"))
    return _selected(cells, [], [p]).select(F.col("q")[0].alias("quantile"))


def value_counts(df: DataFrame, value: Column, keys: dict[str, Column]) -> DataFrame:
    """``(keys..., v, n)``: rows per distinct value of each group; null values are left out."""
    rows = df.select(*[c.alias(k) for k, c in keys.items()], value.cast("double").alias("v"))
    return rows.where(F.col("v").isNotNull()).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))


def grouped_statistics(df: DataFrame, value: Column, pcts: list[float], keys: dict[str, Column]) -> DataFrame:
    """``statistics`` of one value per group."""
    v, names = value.cast("double"), list(keys)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names]
    rows = df.select(*[c.alias(k) for k, c in keys.items()], v.alias("v")).where(F.col("v").isNotNull())
    whole = rows.groupBy(*names).agg(_summary(F.col("v"), pcts).alias("whole"))
    known = whole.select(*[F.col(k).alias(f"_{k}") for k in names], F.col("whole.brackets").alias("brackets"))
    placed = value_counts(df, value, keys).join(known, same).select(*names, "v", "n", *_placed(F.col("v"), F.col("brackets")))
    cells = placed.groupBy(*names, "inside", "gap").agg(F.min("v").alias("v"), F.sum("n").alias("n"))
    found = _selected(cells, names, pcts).withColumnsRenamed({k: f"_{k}" for k in names})
    return whole.select(*names, "whole.*").drop("brackets").join(found, same).drop(*[f"_{k}" for k in names])
