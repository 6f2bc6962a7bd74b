"""Near duplicates by circulant MinHash, banded, then verified on the sets.

A text's set holds its distinct runs of ``SHINGLE`` words; equal sets form a class,
which counts once. Two permutations make all coordinates of a signature: the first
gives each element its place on a ring of 2^32, the second orders the ring, shifted
by one place from each coordinate to the next; a coordinate is the least element's
order. Eight bits of a coordinate are kept. ``ROWS`` coordinates are a band: two sets
of similarity s agree in one of ``BANDS`` bands with chance 1 - (1 - s^ROWS)^BANDS,
which misses 2 of ten million pairs at s = 0.85.

Classes under one band value form a bucket. Buckets are found by one grouped
aggregation of fixed size (the least and the greatest class of four slices of the
names, and the number), so that no bucket is ever gathered in one task. Where these
are all members, all their pairs are candidates; else the bucket is crowded, and each
class is paired with the first of two of its crowded buckets: two rows a class, however
many buckets of a group of copies it is in. Candidates must have fitting
sizes and enough agreeing coordinates (6 standard deviations below the threshold's);
those that lie in different components are verified exactly on their sets, each
class's most agreeing partner first.

Crowded buckets whose members are still in different components are taken further, which
holds copies of one text that differ too much from each other. First each class is
paired with the hubs of two of its open buckets; a hub is the class that stands in the most
open buckets (the text that others were copied from). Then the elements of the members are
grouped by the same aggregation: members that share an element which few hold are
paired, and of any other pair both can share at most their *common* elements. That
bounds the sizes of a member's partners, so most of the members without a link are
done with, one by one and not pair by pair. Of what is left, only members whose sizes
and common elements allow a link are paired. So the work is linear in a bucket unless
many of its texts could be linked by all of these and are not, and no pair that agrees
in a band is dropped without a proof that it is no link.

Defined results: null or empty text and text without words have an empty set, no
links and their own id as component; with fewer than ``SHINGLE`` words the whole
sequence is the one shingle; repeated rows give equal rows; equal ids with different
texts each belong to their own text's component; a component's id is its smallest
non-null id (null if it has none), and the row with that id is kept (rows of equal id
all are); of equal least or most similar partners any is taken first, which does not
change the components. Very long texts are one set in one task. An empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.buckets import SLICES, apart, as_longs, buckets_of, elements, few_keys, member_pairs, members_of, open_members, others_of_key, placed, \
    Similarity, star, unpacked, with_common  # noqa: F401 - SLICES is part of what buckets_of promises
from sparktrips.llm.common import map_arrow, mix, shared_table, slices, text_bytes
from sparktrips.llm.jaccard_join import components, Sets, sets_of

#: Two sets are linked from this similarity on.
LINKED = Similarity(85, 100)
ROWS, BANDS = 8, 48
COORDINATES = ROWS * BANDS
#: Agreeing coordinates of a candidate: 0.85 of them, less 6 standard deviations.
LEAST_AGREEING = int(COORDINATES * 0.85 - 6 * (COORDINATES * 0.85 * 0.15) ** 0.5)
#: Elements whose coordinates are computed together, so that they stay in the cache.
RUN = 1 << 15
_U = np.uint64


# --- signatures -------------------------------------------------------------

def ring_places(elements: np.ndarray) -> np.ndarray:
    """The first permutation: where on the ring each element is."""
    return (mix(elements + _U(0xC1AC)) >> _U(32)).astype(np.uint32)


def order(places: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, of the ring, in place: odd factors and shifts can be
    undone, so no two places have one order."""
    for factor, shift in ((0x9E3779B1, 15), (0x85EBCA77, 13), (0xC2B2AE3D, 16)):
        np.multiply(places, np.uint32(factor), out=places)
        np.right_shift(places, np.uint32(shift), out=spare)
        np.bitwise_xor(places, spare, out=places)
    return places


def signatures_of(elements: np.ndarray, first: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Signatures of the non-empty sets ``elements[first[i]:first[i + 1]]``, a row each."""
    out = np.empty((len(first) - 1, coordinates), np.uint8)
    ring = ring_places(elements)
    at = 0
    while at < len(first) - 1:
        to = max(at + 1, int(np.searchsorted(first, first[at] + RUN, side="right")) - 1)
        part, begin = ring[first[at]:first[to]], first[at:to] - first[at]
        moved, spare = np.empty_like(part), np.empty_like(part)
        for k in range(coordinates):
            np.subtract(part, np.uint32(k), out=moved)  # the ring turned by k places
            out[at:to, k] = np.minimum.reduceat(order(moved, spare), begin) & np.uint32(0xFF)
        at = to
    return out


def signed_rows(rows: DataFrame) -> DataFrame:
    """Per ``(id, text)`` row: id, ``size`` and ``class`` of its set, and at the first row
    of a class in a task its signature as ``bands``, a number of 64 bits for each band. Sets too
    small to be similar to another have none."""
    kind = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, _U)
        for part in slices(batches, "text"):
            sets = Sets(text_bytes(part.column("text")))
            name = sets.classes()
            able = np.flatnonzero(sets.sizes * LINKED.denominator >= LINKED.numerator * (sets.sizes + 1))
            _, once = np.unique(name[able], return_index=True)
            chosen = able[np.sort(once)]
            chosen = chosen[~np.isin(name[chosen], seen)]
            seen = np.union1d(seen, name[chosen])
            n = sets.sizes[chosen]
            first = np.concatenate([[0], np.cumsum(n)])
            elements = sets.hashes[np.repeat(sets.first[:-1][chosen] - first[:-1], n) + np.arange(n.sum())]
            bands = signatures_of(elements, first).view(np.int64)
            has = np.zeros(part.num_rows, np.int64)
            has[chosen] = BANDS
            ends = np.concatenate([[0], np.cumsum(has)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.ravel()), mask=pa.array(has == 0))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets.sizes, pa.int64()), as_longs(name), lists], ["id", "size", "class", "bands"])

    return map_arrow(rows, sign, f"id {kind}, size bigint, class bigint, bands array<bigint>")


# --- candidates and links ---------------------------------------------------

def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct pairs ``(a, b)`` whose sizes and signatures allow a link, with the
    number of ``agreeing`` coordinates."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("size").alias(f"{x}_size"), F.col("bands").alias(f"{x}_bands"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, COORDINATES) for c in ("a_bands", "b_bands"))
            agreeing = (x == y).sum(axis=1)
            kept = pa.array(np.flatnonzero(agreeing >= LEAST_AGREEING))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept), pa.array(agreeing).take(kept)], ["a", "b", "agreeing"])

    sized = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(LINKED.sizes(F.col("a_size"), F.col("b_size")))
    return map_arrow(sized.select("a", "b", "a_bands", "b_bands"), compare, "a bigint, b bigint, agreeing bigint")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, by their whole sets."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("set").alias(f"{x}_set"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = unpacked(x.as_buffer()), unpacked(y.as_buffer())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(LINKED.denominator * both >= LINKED.numerator * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return map_arrow(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b"), compare, "a bigint, b bigint")


def best_partners(pairs: DataFrame) -> DataFrame:
    """Of each class the pair with its most agreeing partner."""
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "agreeing"))
    best = both.groupBy("a").agg(F.max(F.struct("agreeing", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def central(opened: DataFrame) -> DataFrame:
    """Per open key its ``hub``, the class that stands in the most open buckets."""
    weight = opened.groupBy("class").agg(F.count("*").alias("weight"))
    return opened.join(weight, "class").groupBy("key").agg(F.max_by("class", F.struct("weight", "class")).alias("hub"))


# --- the job ----------------------------------------------------------------

class Linker:
    """The links found so far, as components of classes. ``sets`` are those of all classes that may be linked."""

    def __init__(self, classes: DataFrame, sets: DataFrame):
        self.classes, self.sets = classes, sets
        self.found = classes.sparkSession.createDataFrame([], "node bigint, component bigint")

    def verify(self, pairs: DataFrame) -> None:
        """Takes in the links among the pairs ``(a, b)``."""
        links = shared_table(verified(apart(pairs, self.found), self.sets), "links")
        if not links.limit(1).count():
            return
        known = self.found.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
        self.found = components(known.unionAll(links))

    def link(self, candidates: DataFrame) -> None:
        """The same, each class's most agreeing partner first."""
        self.verify(best_partners(candidates))
        self.verify(shared_table(apart(candidates, self.found), "apart"))

    def link_plausible(self, pairs: DataFrame) -> None:
        """The same for pairs ``(a, b)``, after sizes and signatures, all at once."""
        candidates = shared_table(plausible(apart(pairs, self.found), self.classes), "candidates")
        if candidates.limit(1).count():
            self.verify(candidates)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = shared_table(signed_rows(rows), "signatures")
    named = signed.where("size > 0").groupBy("class").agg(F.min("id").alias("id"))
    classes = shared_table(signed.where("bands is not null").groupBy("class").agg(F.first("size").alias("size"), F.first("bands").alias("bands")), "classes")

    keyed = classes.select("class", F.posexplode("bands")).select(F.xxhash64("pos", "col").alias("key"), "class")
    buckets = shared_table(buckets_of(keyed), "buckets")
    crowds = buckets.where("crowded").select("key", F.element_at("members", 1).alias("hub"))
    crowded = shared_table(keyed.join(crowds, "key", "left_semi"), "crowded")
    near_first = star(few_keys(crowded).join(crowds, "key"), "hub")
    pairs = shared_table(member_pairs(buckets.where("not crowded")).unionAll(near_first).distinct(), "pairs")
    candidates = shared_table(plausible(pairs, classes), "candidates")
    some = candidates.select(F.explode(F.array("a", "b")).alias("class")).unionAll(crowded.select("class")).distinct()
    sets = shared_table(sets_of(rows, named.join(some, "class", "left_semi")).join(some, "class", "left_semi").dropDuplicates(["class"]), "sets")

    linker = Linker(classes, sets)
    linker.link(candidates)
    still_open = lambda: shared_table(open_members(crowded, linker.found), "open")
    opened = still_open()
    if opened.limit(1).count():
        linker.link_plausible(star(few_keys(opened).join(central(opened), "key"), "hub").distinct())
        opened = still_open()
    if opened.limit(1).count():
        some = sets.join(opened.select("class").distinct(), "class", "left_semi")
        rare = shared_table(members_of(elements(some)).where("not crowded"), "rare-elements")
        linker.link_plausible(member_pairs(rare.where("n > 1")).distinct())
        opened = shared_table(with_common(still_open(), classes, rare, LINKED), "open")
    if opened.limit(1).count():
        linker.link_plausible(others_of_key(opened, LINKED))

    found = linker.found
    labelled = placed(named, found, "class", "component")
    least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    label = labelled.select("class", "component").join(least, "component").select("class", "component_id")
    joined = signed.select("id", "size", F.when(F.col("size") > 0, F.col("class")).alias("class")).join(label, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = joined.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
