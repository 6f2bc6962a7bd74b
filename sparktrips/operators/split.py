"""Reproducible train / validation / test splits and first-n reports.

``hash_split`` labels each row from a hash of its key and a seed: no shuffle,
stable under any partitioning, the same in any engine with md5.
``exact_split`` gives exact sizes (ceil(n*test), then ceil(rest*val)): the two cuts in
the order of a hash are found by counting, then rows are labelled one by one.
``global_rank`` numbers rows of any order: range-sorted partitions, a per-partition
index, and per-partition offsets (a table with one row per partition).
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktrips.config import DEFAULT_SETTINGS, TripSettings
from sparktrips.functions.columns import unit_hash

SPLIT = "split"


def hash_split(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS, key: str | None = None) -> DataFrame:
    """D1: 'test' with probability test_size, then 'val' with val_size of the
    rest, else 'train'."""
    u = unit_hash(F.col(key or s.key_col), s.random_state)
    cut_val = s.test_size + (1.0 - s.test_size) * s.val_size
    return df.withColumn(SPLIT, F.when(u < s.test_size, "test").when(u < cut_val, "val").otherwise("train"))


def _order_key(key: str, seed: int):
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8),
                  16, 10).cast("bigint")


def global_rank(df: DataFrame, order_cols: list[str], rank_col: str = "_rank") -> DataFrame:
    """0-based rank in ``order_cols`` order without a single-partition window.

    1. ``orderBy`` range-partitions and sorts (distributed sort);
    2. each row gets (partition id, index within partition) from
       ``monotonically_increasing_id`` (low 33 bits = row index);
    3. the indexed table is checkpointed to the shared checkpoint folder, so
       both uses below see the same rows even if executors are lost;
    4. offsets = running sum of per-partition counts, one row per partition
       (a size bound that does not grow with data), broadcast and joined.
    """
    from sparktrips.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_cols)
    indexed = (ordered.withColumn("_pid", F.spark_partition_id())
                      .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    indexed = indexed.checkpoint(eager=True)
    counts = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_offset"))
    return (indexed.join(F.broadcast(offsets), "_pid")
                   .withColumn(rank_col, F.col("_offset") + F.col("_local"))
                   .drop("_pid", "_local", "_offset"))


class _Cut(NamedTuple):
    """Where a rank lies in the order of (hash, key): the rows before are ranked lower, and of
    the rows with just this hash and key ``inside`` are."""
    hash: int
    key: object
    inside: int
    equal: int


def _cut_at(df: DataFrame, key: str, ranks: list[int]) -> list[_Cut]:
    """The hash and key at each 0-based rank in the order of ``_h`` (32 bits) and key, by
    counting: per 12 bits of the hash, then 12 more and the last 8 below the wanted ones,
    then the keys of the wanted hashes. Nothing is sorted or shuffled but counts; a
    count has at most 4,096 rows per rank."""
    found = [(0, rank) for rank in ranks]  # prefix of the hash, rank below it
    for shift, bits in ((20, 12), (8, 12), (0, 8)):
        inside = F.shiftright("_h", shift + bits).isin(sorted({p for p, _ in found})) if shift < 20 else F.lit(True)
        rows = df.where(inside).groupBy(F.shiftright("_h", shift).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = sorted((r["p"], r["n"]) for r in rows)
        found = [_descend([(p, n) for p, n in counts if p >> bits == prefix or shift == 20], rank) for prefix, rank in found]
    keys = df.where(F.col("_h").isin(sorted({h for h, _ in found}))).groupBy("_h", key).agg(F.count(F.lit(1)).alias("n"))
    keys = keys.orderBy("_h", key).collect()  # the keys that share 32 bits of hash with a cut
    out = []
    for h, rank in found:
        group = [(r[key], r["n"]) for r in keys if r["_h"] == h]
        k, inside = _descend(group, rank)
        out.append(_Cut(h, k, inside, dict(group)[k]))
    return out


def _descend(counts: list[tuple], rank: int) -> tuple:
    """The entry that holds the rank, and the rank within it."""
    for name, n in counts:
        if rank < n:
            return name, rank
        rank -= n
    raise ValueError("a rank beyond the rows")


def exact_split(df: DataFrame, s: TripSettings = DEFAULT_SETTINGS, key: str | None = None) -> DataFrame:
    """Exact split sizes, rows ordered by md5(key:seed) then key.

    The two cuts in that order are found by counting (``_cut_at``, four passes over the key
    column); then each row is labelled by itself. Only where a cut falls between rows
    of one key are those rows numbered."""
    k = key or s.key_col
    hashed = df.withColumn("_h", _order_key(k, s.random_state))
    n = df.count()
    n_test = math.ceil(n * s.test_size)
    n_val = math.ceil((n - n_test) * s.val_size)
    names, ranks = ["test", "val", "train"], [n_test, n_test + n_val]
    wanted = [r for r in ranks if r < n]
    cuts = dict(zip(wanted, _cut_at(hashed.select("_h", k), k, wanted))) if wanted else {}

    def before(cut: _Cut):
        smaller = F.col(k).isNull() & F.lit(cut.key is not None) if cut.key is None else F.coalesce(F.col(k) < F.lit(cut.key), F.lit(True))
        return (F.col("_h") < cut.hash) | ((F.col("_h") == cut.hash) & smaller)

    def label(number=None):
        """By the row's place; ``number``: its number among the rows of its key."""
        place = F.when(F.lit(False), "")
        for name, rank in zip(names, ranks):
            if rank not in cuts:
                place = place.when(F.lit(True), name)
                continue
            first = before(cuts[rank])
            if number is not None:
                first = first | (F.col(k).eqNullSafe(F.lit(cuts[rank].key)) & (number <= cuts[rank].inside))
            place = place.when(first, name)
        return place.otherwise("train")

    torn = [c.key for c in cuts.values() if 0 < c.inside < c.equal]
    if not torn:
        return hashed.withColumn(SPLIT, label()).drop("_h")
    is_torn = F.lit(False)
    for value in torn:
        is_torn = is_torn | F.col(k).eqNullSafe(F.lit(value))
    numbered = hashed.where(is_torn).withColumn("_n", F.row_number().over(Window.partitionBy(k).orderBy("_h")))
    return hashed.where(~is_torn).withColumn(SPLIT, label()).unionByName(numbered.withColumn(SPLIT, label(F.col("_n"))).drop("_n")).drop("_h")


def split_sizes(df: DataFrame) -> DataFrame:
    """D3: rows and share per split (share over the grouped result)."""
    g = df.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("rows"))
    return g.select(SPLIT, F.col("rows").cast("bigint"),
                    F.round(F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()), 6).alias("pct"))


def first_n(df: DataFrame, n: int, key: str = "trip_id") -> DataFrame:
    """The first ``n`` rows by key (TakeOrderedAndProject; a top-n report)."""
    return df.orderBy(key).limit(n)
