"""Buckets of classes that share a key, without ever gathering one: shared by the joins on
sets of shingles.

A bucket's members are known by one grouped aggregation of fixed size. Small buckets are
listed whole; of crowded ones members in different components are narrowed down by
hubs and by the elements that few of them hold, each one by one, before any are paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import map_arrow

#: Slices of the class names of which a bucket keeps both ends.
SLICES = 4
#: Bytes of an element of a packed set.
ELEMENT = 6


class Similarity(NamedTuple):
    """Two sets are linked if their intersection is this share of their union, or more."""
    numerator: int
    denominator: int

    def sizes(self, a: Column, b: Column) -> Column:
        """Whether sets of these sizes may be linked."""
        return (a * self.denominator >= b * self.numerator) & (b * self.denominator >= a * self.numerator)


def as_longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def packed(elements: np.ndarray) -> bytes:
    return elements.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT].tobytes()


def unpacked(data) -> np.ndarray:
    out = np.zeros((len(data) // ELEMENT, 8), np.uint8)
    out[:, :ELEMENT] = np.frombuffer(data, np.uint8).reshape(-1, ELEMENT)
    return out.view("<u8").ravel()


def members_of(keyed: DataFrame) -> DataFrame:
    """Of ``(key, class)``, per key ``n``, ``members``, all of them or the least and the
    greatest of each slice, and ``crowded`` where there are more."""
    inside = lambda i: F.when(F.pmod("class", F.lit(SLICES)) == i, F.col("class"))
    ends = [f(inside(i)) for i in range(SLICES) for f in (F.min, F.max)]
    members = F.sort_array(F.array_distinct(F.array_compact(F.array(*ends))))
    grouped = keyed.groupBy("key").agg(F.count("*").alias("n"), members.alias("members"))
    return grouped.select("key", "n", "members", (F.col("n") > F.size("members")).alias("crowded"))


def buckets_of(keyed: DataFrame) -> DataFrame:
    """The keys of two classes or more."""
    return members_of(keyed).where("n > 1")


def member_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of the members."""
    after = lambda x, i: F.transform(F.slice("members", i + 2, 2 * SLICES), lambda y: F.struct(x.alias("a"), y.alias("b")))
    return buckets.select(F.explode(F.flatten(F.transform("members", after))).alias("x")).select("x.*")


def star(crowded: DataFrame, hub: str) -> DataFrame:
    """Pairs ``(a, b)`` of each member with the column ``hub``."""
    return crowded.where(F.col("class") != F.col(hub)).select(F.least("class", hub).alias("a"), F.greatest("class", hub).alias("b"))


def placed(rows: DataFrame, found: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the component ``name`` of their class in ``column`` (a class without links is its own)."""
    at = found.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(at, column, "left").withColumn(name, F.coalesce(name, column))


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs in different components."""
    return placed(placed(pairs, found, "a", "a_in"), found, "b", "b_in").where("a_in <> b_in").drop("a_in", "b_in")


def open_members(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, class, component)`` of the keys whose classes are in several components."""
    met = placed(crowded.select("key", "class"), found, "class", "component")
    several = met.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    return met.join(several.select("key"), "key", "left_semi")


def few_keys(members: DataFrame) -> DataFrame:
    """Two of the keys of each class, ``(key, class)``: the least and the greatest, which classes that share many keys have in common."""
    ends = members.groupBy("class").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    return ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("key"), "class")


def hubs(opened: DataFrame) -> DataFrame:
    """The open members, each with its key's ``hub``."""
    sizes = opened.groupBy("key").agg(F.count("*").alias("n"))
    weight = opened.join(sizes, "key").groupBy("class").agg(F.sum("n").alias("weight"))
    chosen = opened.join(weight, "class").groupBy("key").agg(F.max_by("class", F.struct("weight", "class")).alias("hub"))
    return opened.join(chosen, "key")


def elements(sets: DataFrame) -> DataFrame:
    """``(key, class)``: the elements of sets."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [unpacked(x.as_buffer()) for x in part.column("set")]
                name = np.repeat(part.column("class").to_numpy(zero_copy_only=False), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays([as_longs(np.concatenate(own)), pa.array(name, pa.int64())], ["key", "class"])

    return map_arrow(sets.select("class", "set"), emit, "key bigint, class bigint")


def with_common(opened: DataFrame, classes: DataFrame, rare: DataFrame, linked: Similarity) -> DataFrame:
    """The open members that may still be linked under their key, with ``size`` and ``common``,
    how many elements they may share with a class that shares no rare element with
    them. A link needs a share of both sizes in common, which bounds the partner's size: a member whose ``reach`` no size under the key is within is left out."""
    counted = rare.select(F.explode("members").alias("class")).groupBy("class").agg(F.count("*").alias("rare"))
    met = opened.join(classes.select("class", "size"), "class").join(counted, "class", "left")
    common = F.col("size") - F.coalesce("rare", F.lit(0))
    reach = F.floor(common * (linked.numerator + linked.denominator) / linked.numerator) - F.col("size")
    met = met.select("key", "class", "component", "size", common.alias("common"), reach.alias("reach"))
    able = met.where(F.col("reach") * linked.denominator >= F.col("size") * linked.numerator)
    ends = able.groupBy("key").agg(F.min("size").alias("least"), F.max("reach").alias("furthest"))
    able = able.join(ends, "key").where("reach >= least and size <= furthest").drop("reach", "least", "furthest")
    groups = able.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("components"))
    return able.join(groups.where("components > 1").select("key", "main"), "key")


def others_of_key(opened: DataFrame, linked: Similarity) -> DataFrame:
    """All pairs of a key in different components that may be linked by their sizes and
    common elements: of each, one is not in ``main``."""
    side = lambda x: opened.select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("class", "component", "size", "common")])
    a, b = side("x").join(opened.select("key", F.col("class").alias("x_class")).where("component <> main"), ["key", "x_class"], "left_semi"), side("y")
    enough = F.least("x_common", "y_common") * (linked.numerator + linked.denominator) >= (F.col("x_size") + F.col("y_size")) * linked.numerator
    fits = (F.col("x_component") != F.col("y_component")) & linked.sizes(F.col("x_size"), F.col("y_size")) & enough
    return a.join(b, "key").where(fits).select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b"))
