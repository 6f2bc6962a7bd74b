"""Near duplicates: a parity-sketch join on sets of word shingles.

A text's set holds its distinct runs of ``SHINGLE`` words. Equal sets form a
class, so copies count once. Classes fall into size bands; in a band each set is
laid out over a fixed number of blocks, and each shingle XORs its hash into the
block that its hash names. The number of blocks in which two such sketches
differ never exceeds the symmetric difference of the sets. Similarity 3/4
bounds that difference by D = (a + b) / 7, so two similar sets agree in all but
D of their occupied blocks (pigeonhole), and already in some of the
D + 1 + slack that come first in one order of all block values. Those are the
join keys. A set near a band's lower edge is also laid out in the band below, so
each similar pair meets.

Keys that two or more classes share give pairs: all of them where few classes
share a key; else each class with the first and with its neighbours, which is
linear. A parity bit sketch of the whole set, whose Hamming distance is again a
lower bound, and the sizes drop most pairs; the rest are verified on the sets,
first each class with the partner that it shares most keys with, then what still
lies in different components.

Then only keys with many classes are open whose classes are still in different
components, and that some class needs (one with as many crowded keys as a similar
class must share with it; others have met elsewhere). Members of an open key are paired
with its hub, the class under the most and largest open keys. Members that share an
element which few of them hold are paired; any other two can share at most their
common elements, which bounds the sizes of a member's partners. So texts that merely
share a passage are done with one by one, and only members whose sizes and common
elements allow a link are paired. No link that joins components is lost, no list of
a group is ever built, and only rows that differ in their component are paired.

Hashes have 48 bits within a pair of sets and 64 bits for keys and classes.

Defined results: null or empty text and text without words have an empty set,
no links and their own id as component; with fewer than ``SHINGLE`` words the
whole sequence is the one shingle; repeated rows give equal rows; equal ids with
different texts each belong to their own text's component; very long texts are one set in one task;
of equally good partners any is taken first, which changes no component; a component's id is
its smallest non-null id (null if it has none); an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktrips.llm.buckets import apart, as_longs, elements, hubs, member_pairs, members_of, open_members, others_of_key, packed, Similarity, star, unpacked, \
    with_common
from sparktrips.llm.common import map_arrow, mix, shared_table, slices, text_bytes, Words

SHINGLE = 5
#: Similarity of at least 3/4. With it, |a| and |b| differ by at most 4/3, and the
#: symmetric difference is at most (|a| + |b|) / 7.
NUMERATOR, DENOMINATOR = 3, 4
LINKED = Similarity(NUMERATOR, DENOMINATOR)
#: A band's sizes reach to this many times its first; over 4/3, so that partners
#: are in the same or in an adjoining band.
BAND_RATIO = 1.78
#: Keys beyond D + 1, as a share of D: as many more keys are sure to be shared.
SLACK = 0.1
#: Neighbours that a class is paired with under a key: groups of up to
#: ``NEIGHBOURS + 2`` classes are paired completely.
NEIGHBOURS = 4
#: 64-bit words of a bit sketch at least, and elements per word: 4 to 8 bits an element.
LEAST_WORDS, ELEMENTS_PER_WORD = 16, 16
_LOW = np.uint64((1 << 48) - 1)
_U = np.uint64


# --- sets, classes, keys ----------------------------------------------------

class Sets:
    """Distinct shingles of several texts, as sorted 48-bit hashes: text i owns
    ``hashes[first[i]:first[i + 1]]``."""

    def __init__(self, texts: list[bytes], n: int = SHINGLE):
        words = Words(texts)
        counts = words.counts()
        short = np.flatnonzero((counts > 0) & (counts < n))
        owner = words.owner()
        last = max(0, len(words) - n + 1)
        h = words.hashes[:last].copy()
        for k in range(1, n):
            h = mix(h * _U(3) + words.hashes[k:k + last])
        whole = owner[:last] == owner[n - 1:] if last else np.zeros(0, bool)
        h, of = h[whole], owner[:last][whole]
        if len(short):
            extra = np.empty(len(short), _U)
            for i, t in enumerate(short.tolist()):
                acc = np.array([counts[t]], _U)
                for w in words.hashes[words.first[t]:words.first[t + 1]]:
                    acc = mix(acc * _U(5) + w)
                extra[i] = acc[0]
            h, of = np.concatenate([h, extra]), np.concatenate([of, short])
        code = np.unique(of.astype(_U) << _U(48) | h >> _U(16))
        self.hashes = code & _LOW
        self.first = np.searchsorted(code, np.arange(len(texts) + 1).astype(_U) << _U(48))
        self.sizes = np.diff(self.first)

    def classes(self) -> np.ndarray:
        """64-bit name of each set: equal sets have equal names."""
        mixed = mix(self.hashes + _U(0x51ED270B))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(mixed, dtype=_U)])
        twice = np.concatenate([np.zeros(1, _U), np.cumsum(mix(mixed), dtype=_U)])
        a, b = self.first[:-1], self.first[1:]
        return mix((total[b] - total[a]) * _U(3) + mix(twice[b] - twice[a] + self.sizes.astype(_U)))

    def bit_sketches(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text a parity sketch of so many 64-bit words (powers of two), and where
        each ends: an element flips one bit, so two sketches differ in at most as
        many bits as the sets in elements. Folding a sketch's halves by XOR gives
        the sketch of half the size."""
        ends = np.cumsum(words)
        bit = (mix(self.hashes + _U(0xB175)) & np.repeat(words * 64 - 1, self.sizes).astype(_U)).astype(np.int64)
        flips = np.bincount(np.repeat((ends - words) * 64, self.sizes) + bit, minlength=int(words.sum()) * 64)
        return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view("<u8"), ends


def folded(bits: np.ndarray, ends: np.ndarray, words: int) -> np.ndarray:
    """The sketches folded to ``words`` words each."""
    size = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends)), size)
    out = np.zeros(len(ends) * words, _U)
    np.bitwise_xor.at(out, text * words + (np.arange(len(bits)) - (ends - size)[text]) % words, bits)
    return out


def band_edges(largest: int) -> np.ndarray:
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * BAND_RATIO))))
    return np.array(edges, np.int64)


def blocks_of(largest: int) -> int:
    """Blocks of a band whose largest size this is. Small sets get one block per
    hash; others so many that the occupied ones exceed D by 8 standard deviations."""
    return 1 << 40 if largest < 64 else largest if largest < 256 else -(-largest // 2)


def most_difference(size, partner):
    """D of two similar sets, of at most these sizes."""
    return (size + partner) // 7


def sure_keys(size: np.ndarray) -> np.ndarray:
    """Keys that a set is sure to share with each similar one (1 at least)."""
    return 1 + np.ceil(SLACK * most_difference(size, size * DENOMINATOR // NUMERATOR)).astype(np.int64)


def block_keys(sets: Sets, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the chosen texts, and the text of each. Similar sets agree in all but
    D occupied blocks; of the first D + k block values in one order they share k
    at least."""
    edges = band_edges(int(sets.sizes.max(initial=1)) * 2)
    band = np.searchsorted(edges, sets.sizes, side="right") - 1
    layout = np.array([blocks_of(int(e) - 1) for e in edges[1:]], np.int64)  # blocks of each band
    own = band[chosen]
    below = chosen[(own > 0) & (sets.sizes[chosen] * NUMERATOR <= (edges[own] - 1) * DENOMINATOR) & (layout[own] != layout[own - 1])]
    size = sets.sizes
    # in its own band a set may meet larger ones of the next; in the band below only that band's
    partners = size * DENOMINATOR // NUMERATOR, edges[band] - 1
    keys, owners = [], []
    for texts, bands, partner in ((chosen, own, partners[0]), (below, band[below] - 1, partners[1])):
        if not len(texts):
            continue
        n = size[texts]
        at = np.repeat(sets.first[texts] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        h, of = sets.hashes[at], np.repeat(np.arange(len(texts)), n)
        blocks = layout[bands].astype(_U)
        small = blocks >= _U(1 << 40)
        # hashes are sorted, so a block (a range of hashes) is a run
        block = np.where(small[of], h, (h >> _U(16)) * blocks[of] >> _U(32))
        begin = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (of[1:] != of[:-1])]))
        parity = np.bitwise_xor.reduceat(mix(h + _U(0x9A417)), begin)
        key = mix(parity + mix(block[begin] + blocks[of[begin]] * _U(0x9E3779B97F4A7C15)))
        of = of[begin]
        occupied = np.bincount(of, minlength=len(texts))
        wanted = np.minimum(occupied, most_difference(n, partner[texts]) + sure_keys(n))
        order = np.lexsort((key, of))
        rank = np.arange(len(key)) - np.repeat(np.concatenate([[0], np.cumsum(occupied)[:-1]]), occupied)
        taken = rank < wanted[of]
        keys.append(key[order][taken])
        owners.append(texts[of[taken]])
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, _U), np.zeros(0, np.int64))


def signatures(rows: DataFrame) -> DataFrame:
    """Per ``(id, text)`` row: id, ``size`` and ``class`` of its set, its bit ``sketch``, and
    ``sure``, how many keys a similar set must share with it."""
    kind = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", most_rows=5_000):
            sets = Sets(text_bytes(part.column("text")))
            least = np.maximum(LEAST_WORDS, sets.sizes / ELEMENTS_PER_WORD)
            bits, ends = sets.bit_sketches(1 << np.ceil(np.log2(least)).astype(np.int64))
            sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), as_longs(bits))
            columns = [part.column("id"), pa.array(sets.sizes, pa.int64()), as_longs(sets.classes()), sketch, pa.array(sure_keys(sets.sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "size", "class", "sketch", "sure"])

    return map_arrow(rows, sign, f"id {kind}, size bigint, class bigint, sketch array<bigint>, sure bigint")


def keys(rows: DataFrame) -> DataFrame:
    """``(key, class)``: the join keys of all classes. Copies that one task reads
    count once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, _U)
        for part in slices(batches, "text"):
            sets = Sets(text_bytes(part.column("text")))
            name = sets.classes()
            full = np.flatnonzero(sets.sizes)
            _, once = np.unique(name[full], return_index=True)
            chosen = full[np.sort(once)]
            chosen = chosen[~np.isin(name[chosen], seen)]
            seen = np.concatenate([seen, name[chosen]])
            key, owner = block_keys(sets, chosen)
            yield pa.RecordBatch.from_arrays([as_longs(key), as_longs(name[owner])], ["key", "class"])

    return map_arrow(rows.select("text"), emit, "key bigint, class bigint")


# --- candidate pairs --------------------------------------------------------

def shared_keys(keyed: DataFrame) -> DataFrame:
    """From ``(key, class)``, distinct rows ``(crowded, a, b)`` of two kinds with their
    number ``n``: pairs of classes as described above and, where ``crowded``, a key
    that more classes share than are paired completely, and a class."""
    ordered = W.partitionBy("key").orderBy("class")
    running = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    lags = [F.lag("class", k).over(ordered).alias(f"lag{k}") for k in range(1, NEIGHBOURS + 1)]
    rows = keyed.select("key", "class", F.first("class").over(running).alias("lag0"), *lags,
                        F.max("class").over(W.partitionBy("key")).alias("top"), F.count("*").over(W.partitionBy("key")).alias("n"))
    rows = rows.where(F.col("top") != F.col("lag0"))  # two classes or more
    linked = [F.when(F.col(f"lag{k}") != F.col("class"), F.struct(F.lit(False).alias("crowded"), F.col(f"lag{k}").alias("a"), F.col("class").alias("b")))
              for k in range(NEIGHBOURS + 1)]
    crowded = F.when(F.col("n") > NEIGHBOURS + 2, F.struct(F.lit(True).alias("crowded"), F.col("key").alias("a"), F.col("class").alias("b")))
    entries = rows.select(F.explode(F.array_compact(F.array(*linked, crowded))).alias("x")).select("x.*")
    return entries.groupBy("crowded", "a", "b").agg(F.count("*").alias("n"))


def _long_hamming(a: Column, b: Column) -> Column:
    """Of sketches that differ in size by a factor of two at most: similar sizes do."""
    n = F.least(F.size(a), F.size(b))
    folded = lambda x: F.when(F.size(x) == n, x).otherwise(
        F.zip_with(F.slice(x, 1, n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q)))
    return F.aggregate(F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``(a, b, n)`` whose sizes and bit sketches allow a link."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("size").alias(f"{x}_size"), F.col("sketch").alias(f"{x}_sketch"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = LINKED.sizes(F.col("a_size"), F.col("b_size")) & \
        (_long_hamming(F.col("a_sketch"), F.col("b_sketch")) * 7 <= F.col("a_size") + F.col("b_size"))
    return sized.where(fits).select("a", "b", "n")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a similarity of 3/4 or more."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("set").alias(f"{x}_set"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = unpacked(x.as_buffer()), unpacked(y.as_buffer())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return map_arrow(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b"), compare, "a bigint, b bigint").distinct()


def sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(class, set)`` of the texts with the wanted ids; the set as sorted 48-bit
    elements. The ids are written first, so that the planner knows their size and
    broadcasts them where they are few; else it shuffles, through a filter of its own."""
    ids = shared_table(wanted.select(F.col("id").alias("wanted_id")).distinct(), "wanted-ids")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = Sets(text_bytes(part.column("text")))
            data = [packed(sets.hashes[a:b]) for a, b in zip(sets.first, sets.first[1:])]
            yield pa.RecordBatch.from_arrays([as_longs(sets.classes()), pa.array(data, pa.binary())], ["class", "set"])

    chosen = rows.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    return map_arrow(chosen, build, "class bigint, set binary")


# --- components -------------------------------------------------------------

def marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written as a shared table, and their number and the XOR of their
    hashes, observed while they are written."""
    seen = Observation()
    mark = F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark")
    table = shared_table(edges.observe(seen, *mark), "edges")
    return table, (seen.get["n"], seen.get["mark"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``(a, b)``: the smallest node that links
    reach. Alternates the large-star and small-star steps, each one grouped minimum
    and one join; rounds grow with the logarithm of the path lengths."""
    state, seen = marked(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while seen != before:
        before = seen
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: every node and its smaller neighbours point to the least of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("l"), F.explode(F.array("a", "b")).alias("b"))
        state, seen = marked(small.where("l <> b").select(F.col("l").alias("a"), "b").distinct())
    return state.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        state.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


# --- the job ----------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``class`` (rows with one set share it; null for
    an empty set) and ``component_id``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = shared_table(signatures(rows), "signatures")
    classes = signed.where("size > 0").groupBy("class").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("size", "sketch", "sure")])
    classes = shared_table(classes, "classes")

    shared = shared_table(shared_keys(keys(rows)), "shared-keys")
    pairs = shared_table(plausible(shared.where(~F.col("crowded")).select("a", "b", "n"), classes), "pairs")
    found = components(linked(pairs, rows, classes))
    crowded = in_need(shared.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("class")), classes)
    rare = None
    for step in ("hubs", "rare elements", "others"):
        opened = shared_table(open_members(crowded, found), "open")
        if not opened.limit(1).count():
            break
        if step == "hubs":
            met = star(hubs(opened), "hub")
        elif step == "rare elements":
            some = opened.select("class").distinct()
            sets = sets_of(rows, classes.join(some, "class", "left_semi")).join(some, "class", "left_semi").dropDuplicates(["class"])
            rare = shared_table(members_of(elements(sets)).where("not crowded"), "rare-elements")
            met = member_pairs(rare.where("n > 1"))
        else:  # those that share a rare element have met, so the bounds hold for the others
            met = others_of_key(shared_table(with_common(opened, classes, rare, LINKED), "still-open"), LINKED)
        candidates = shared_table(plausible(apart(met, found).distinct().withColumn("n", F.lit(1)), classes), "open-pairs")
        if candidates.limit(1).count() and (links := linked(candidates, rows, classes)).limit(1).count():
            known = found.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = components(known.unionAll(links))

    # the component's id: the least id of its classes; classes without links are their own
    labelled = classes.select("class", "id").join(found.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class"))
    least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    named_class = labelled.select("class", "component").join(least, "component").select("class", "component_id")
    joined = signed.select("id", "size", F.when(F.col("size") > 0, F.col("class")).alias("class")).join(named_class, "class", "left")
    return joined.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "class",
                         F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def linked(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links among the pairs ``(a, b, n)``, enough of them for the components: each
    class is compared with the partner that it shares most keys with; then the
    pairs that still lie in different components are."""
    sets = lambda p: sets_of(rows, classes.join(p.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class", "left_semi"))
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    best = both.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    best = shared_table(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "best")
    first = shared_table(verified(best, sets(best)), "links")
    place = components(first)
    at = lambda x: place.select(F.col("node").alias(x), F.col("component").alias(f"{x}_component"))
    placed = pairs.join(best, ["a", "b"], "left_anti").join(at("a"), "a", "left").join(at("b"), "b", "left")
    apart = shared_table(placed.where(F.coalesce("a_component", "a") != F.coalesce("b_component", "b")).select("a", "b"), "apart")
    return shared_table(first.unionAll(verified(apart, sets(apart))), "links") if apart.limit(1).count() else first


def in_need(crowded: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``(key, class)`` under crowded keys, the keys that some class needs. Similar classes
    share at least the lesser ``sure`` of keys; with fewer crowded ones they met elsewhere.
    One of a pair that did not meet thus has as many crowded keys as are sure."""
    needs = crowded.groupBy("class").agg(F.count("*").alias("n")).join(classes.select("class", "sure"), "class").where("n >= sure").select("class")
    wanted = crowded.join(needs, "class", "left_semi").select("key").distinct()
    return shared_table(crowded.join(wanted, "key", "left_semi"), "crowded")
