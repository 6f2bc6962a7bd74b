"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model with absolute discounting and backoff, learned from
the training rows only. An n-gram of two words and more is kept if the training
rows hold it ``LEAST`` times, however large the corpus is. Kept n-grams are the
states and arcs of the automaton; a state without an arc for the next word fails,
at the cost of its backoff weight, to the state of its longest shorter suffix. A
text's score is the sum of the log10 probabilities on its way, one per token.

The automaton is never in one place. Texts are dealt to *blocks* of a few MB, the
64-bit keys of words and n-grams to *parts* by their upper bits. A block asks each
part about its own distinct keys, in packed records: sorted keys as byte-cut
differences. After these rounds a block knows all that its texts meet:

1. A part adds up the counts and answers with a bit per key (kept or not) and
   the counts of those kept. Keys that occur once travel once, and never again.
   First words and bigrams; of longer n-grams, order by order, only those
   whose first and last words (all but one) are kept, as those of all kept ones are.
2. For each kept n-gram one block (the part names it) sends what the n-gram adds to
   the state of its first words; a block asks about those states that its texts
   fail from. A part adds up and answers with their backoff weights.

Then each block walks its texts, left to right. A key is sent once per block,
so none is hot; a part holds one value per key and block that has it.

Counts are exact and cover every training row. Words and n-grams are told apart
by 64-bit hashes. An unknown word has the probability that discounting took from
all known ones.

Defined results: null or empty text is the end token alone; a null id counts as
an empty one in the split; repeated rows and equal ids give one row each;
without training rows every token is unknown and all scores are 0; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import crc_mod, mix, release_memory, shared_table, ship_package, text_bytes, Words

#: An n-gram with this share of all tokens is a frequent one; rarer ones count alike.
GRAM_SHARE, ORDER = 2e-5, 3
#: Training count from which an n-gram of two words and more is kept.
LEAST = 2
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 7, 2
#: Stands for the end of a text among the word hashes.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
#: Bytes of text in a block, and bytes of text whose keys make up a part.
BLOCK_BYTES, PART_BYTES = 1 << 22, 1 << 24
#: Bytes of text that are compressed together.
CHUNK_BYTES = 1 << 20
#: Blocks are of fewer bytes, but not of fewer than these, where there are few for each core.
LEAST_BLOCK = 1 << 18
#: Partitions of a shuffle at most.
MOST_PARTITIONS = 4096
#: Drops an execution's shuffle files at its end. Results are written as tables here, so none is read again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_U = np.uint64


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by ``END``, and where each text ends."""
    words = Words(texts)
    ends = words.first[1:] + np.arange(1, len(texts) + 1)
    out = np.full(len(words) + len(texts), END, np.uint64)
    out[np.delete(np.arange(len(out)), ends - 1)] = words.hashes
    return out, ends


def grams(hashes: np.ndarray, ends: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 2 on the n-grams inside the texts: keys of their first
    and of their last words (all but one), and where in ``hashes`` they end."""
    last = np.arange(len(hashes))
    place = last - np.repeat(np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0))
    keys = hashes
    for k in range(2, order + 1):
        whole = place[1:] >= 1
        first, second, last, place = keys[:-1][whole], keys[1:][whole], last[1:][whole], place[1:][whole] - 1
        yield first, second, last
        keys = gram_keys(first, second)


def gram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The key of an n-gram, by those of its first and of its last words (all but one)."""
    return mix(first * np.uint64(3) + second)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64), pa.int64())


def looked_up(rows: DataFrame, key: str, table: DataFrame, hot: float) -> DataFrame:
    """``rows`` with the columns of ``table`` for ``key``, which it holds for every
    row. Entries with a count ``n`` of at least ``hot`` are broadcast: many n-grams
    share a part that is frequent."""
    table = table.withColumnRenamed("key", key)
    frequent = F.broadcast(table.where(F.col("n") >= hot).drop("n"))
    others = rows.join(F.broadcast(table.where(F.col("n") >= hot).select(key)), key, "left_anti")
    return rows.join(frequent, key).unionByName(others.join(table.where(F.col("n") < hot).drop("n"), key))


def by_text(rest: list[tuple[np.ndarray, np.ndarray, int]], size: int) -> tuple[pa.Array, pa.Array]:
    """What is looked up: per text the keys of ``rest`` (owners, keys, sign) and how
    often they are in it, times their sign."""
    of, keys = np.concatenate([x[0] for x in rest]), np.concatenate([x[1] for x in rest])
    sign = np.repeat([x[2] for x in rest], [len(x[0]) for x in rest]).astype(np.int32)
    by = np.lexsort((keys, of))
    of, keys, sign = of[by], keys[by], sign[by]
    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])) if len(of) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(of))).astype(np.int32) * sign[new]
    offsets = pa.array(np.searchsorted(of[new], np.arange(size + 1)), pa.int32())
    return pa.ListArray.from_arrays(offsets, signed(keys[new])), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))


# --- packed keys and numbers --------------------------------------------------

def pack(keys: np.ndarray, base: int) -> bytes:
    """Sorted keys from ``base`` on, as differences cut to as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=_U(base))
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(keys) else 1
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, base: int) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)[1:].reshape(-1, data[0])
    out = np.zeros((len(steps), 8), np.uint8)
    out[:, :data[0]] = steps
    return np.cumsum(out.view("<u8").ravel(), dtype=_U) + _U(base)


def pack_counts(n: np.ndarray) -> bytes:
    """A byte per count, compressed, then those of 255 and more."""
    small = pa.compress(np.minimum(n, 255).astype(np.uint8).tobytes(), "zstd", asbytes=True)
    return len(small).to_bytes(4, "little") + small + n[n >= 255].astype("<i8").tobytes()


def unpack_counts(data: bytes, size: int) -> np.ndarray:
    end = 4 + int.from_bytes(data[:4], "little")
    n = np.frombuffer(pa.decompress(data[4:end], size, "zstd", asbytes=True), np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(data[end:], "<i8")
    return n


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=size).astype(bool)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, where each of them is, and the place of each key among them. As ``np.unique``, whose sort is a slower one."""
    by = np.argsort(keys)
    ordered = keys[by]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    place = np.empty(len(keys), np.int64)
    place[by] = np.cumsum(new) - 1
    return ordered[new], by[new], place


def bounds(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where in sorted keys each part begins, and the end."""
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << _U(64 - bits)), len(keys))


def base_of(part: int, bits: int) -> int:
    return int(part) << (64 - bits)


# --- texts ----------------------------------------------------------------------

def _stored(table: pa.Table) -> pa.Table:
    """A block's rows, about ``CHUNK_BYTES`` of text to a record: ids, flags, and compressed the lengths of the texts and the texts."""
    ids, held = (table.column(c).combine_chunks() for c in ("id", "held_out"))
    texts = text_bytes(table.column("text"))
    lengths = np.array(list(map(len, texts)), "<i8")
    chunk = (np.cumsum(lengths) - lengths) // CHUNK_BYTES
    begins = np.flatnonzero(np.diff(chunk, prepend=-1))
    ends = np.append(begins, len(texts))
    data = [lengths[a:b].tobytes() + b"".join(texts[a:b]) for a, b in zip(ends, ends[1:])]
    offsets, codec = pa.array(ends, pa.int32()), pa.Codec("zstd", compression_level=3)
    return pa.table({"block": table.column("block").take(pa.array(begins)), "id": pa.ListArray.from_arrays(offsets, ids),
                     "held_out": pa.ListArray.from_arrays(offsets, held), "size": pa.array(list(map(len, data)), pa.int64()),
                     "text": pa.array([codec.compress(x, asbytes=True) for x in data], pa.binary())})


def _texts(table: pa.Table) -> list[bytes]:
    """The texts of stored records, in order."""
    out = []
    for n, size, packed in zip(table.column("held_out").combine_chunks().value_lengths().to_pylist(), table.column("size").to_pylist(), table.column("text").to_pylist()):
        data = pa.decompress(packed, size, "zstd", asbytes=True)
        ends = (8 * n + np.cumsum(np.frombuffer(data[:8 * n], "<i8"))).tolist()
        out += [data[a:b] for a, b in zip([8 * n, *ends], ends)]
    return out


def _column(table: pa.Table, name: str) -> pa.Array:
    """The ids or flags of stored records, one per text."""
    return table.column(name).combine_chunks().flatten()


# --- blocks -------------------------------------------------------------------

@dataclass
class Totals:
    tokens: int
    vocabulary: int
    discount: float

    @property
    def unknown(self) -> float:
        """log10 probability of an unknown word."""
        return float(np.log10(self.discount * self.vocabulary / self.tokens)) if self.tokens else 0.0


class Block:
    """The n-grams of some texts. Per order k, from 1 on: ``keys[k]``, distinct and sorted,
    ``at[k]``, the place in them of the n-gram that ends at each token (-1: none does),
    and ``pos[k]``, a token that each key ends at."""

    def __init__(self, table: pa.Table, order: int, bits: int):
        texts = _texts(table)
        hashes, self.ends = tokens(texts)
        self.size, self.order, self.bits = len(texts), order, bits
        self.owner = np.repeat(np.arange(self.size), np.diff(self.ends, prepend=0))
        self.keys, self.at, self.pos, self.bounds = [None], [None], [None], [None]
        for keys, last in [(hashes, np.arange(len(hashes))), *((gram_keys(a, b), c) for a, b, c in grams(hashes, self.ends, order))]:
            one, index, place = distinct(keys)
            at = np.full(len(hashes), -1, np.int64)
            at[last] = place
            self.keys.append(one)
            self.at.append(at)
            self.pos.append(last[index])
            self.bounds.append(bounds(one, bits))
        self.n, self.own = ([None, *(np.zeros(len(x), kind) for x in self.keys[1:])] for kind in (np.int64, bool))

    def by_part(self, k: int, among: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The parts that have keys of order ``k`` among the given ones (bits), and the places of these."""
        places = np.flatnonzero(among)
        ends = np.searchsorted(places, self.bounds[k])
        return ((p, places[ends[p]:ends[p + 1]]) for p in np.flatnonzero(np.diff(ends)).tolist())

    def asked(self, k: int) -> np.ndarray:
        """The keys of order ``k`` that this block asks the counts of, as bits; ``n[k - 1]`` must be there from order 3 on."""
        if k <= 2:
            return np.ones(len(self.keys[k]), bool)
        known = self.n[k - 1] >= LEAST
        return known[self.first(k, self.pos[k])] & known[self.at[k - 1][self.pos[k]]]

    def answered(self, answers: list[dict], order: int) -> None:
        """Takes the counts up to ``order`` in: ``n[k]``, 0 for n-grams that are not kept, and ``own[k]``, those that this block speaks for."""
        for k in range(1, order + 1):
            places = dict(self.by_part(k, self.asked(k)))
            for r in answers:
                if r["own"] is not None and r["k"] == k:
                    asked = places[r["part"]]
                    kept = asked[unpack_bits(r["mask"], len(asked))]
                    self.n[k][kept], self.own[k][kept] = unpack_counts(r["answer"], len(kept)), unpack_bits(r["own"], len(kept))

    def first(self, k: int, last: np.ndarray) -> np.ndarray:
        """Places, among the keys of order k - 1, of the first words of n-grams by their last token."""
        return self.at[k - 1][last - 1]

    def probabilities(self, totals: Totals) -> list:
        """Per order the probability of each kept n-gram's last word after its first ones."""
        out = [None, (self.n[1] - totals.discount) / max(1, totals.tokens)]
        for k in range(2, self.order + 1):
            out.append((self.n[k] - totals.discount) / np.maximum(1, self.n[k - 1][self.first(k, self.pos[k])]))
        return out

    def failing(self, k: int) -> np.ndarray:
        """Of the keys of order ``k`` those that the texts fail from, if they are states: an n-gram that goes on by a token is not kept."""
        last = np.flatnonzero(self.at[k + 1] >= 0)
        last = last[self.n[k + 1][self.at[k + 1][last]] == 0]
        out = np.zeros(len(self.keys[k]), bool)
        out[self.first(k + 1, last)] = True
        return out & (self.n[k] >= LEAST)

    def backoffs(self, answers: list[dict]) -> list:
        """Per order below the highest the backoff weight of each key, 0 where it is no state."""
        out = [None, *(np.zeros(len(x)) for x in self.keys[1:-1])]
        places = [None, *(dict(self.by_part(k, self.failing(k))) for k in range(1, self.order))]
        for r in answers:
            if r["own"] is None:
                own = places[r["k"]][r["part"]]
                out[r["k"]][own[unpack_bits(r["mask"], len(own))]] = np.frombuffer(r["answer"], "<f8")
        return out

    def walk(self, totals: Totals, backoffs: list) -> np.ndarray:
        """log10 of the probability of each token: by the longest kept n-gram that ends there, less what failing to it costs."""
        n = self.n[1][self.at[1]]
        with np.errstate(divide="ignore"):
            logs = np.where(n > 0, np.log10(np.maximum(n - totals.discount, 1e-12) / max(1, totals.tokens)), totals.unknown)
        for k in range(2, self.order + 1):
            last = np.flatnonzero(self.at[k] >= 0)
            n, first = self.n[k][self.at[k][last]], self.first(k, last)
            arc = np.log10(np.maximum(n - totals.discount, 1e-12) / np.maximum(1, self.n[k - 1][first]))
            logs[last] = np.where(n > 0, arc, backoffs[k - 1][first] + logs[last])
        return logs


# --- what blocks and parts tell each other --------------------------------------

_ASKED = "block bigint, part int, k tinyint, keys binary, counts binary"
#: ``own`` is null in answers of the second round. Block -1: sums over the words of a part.
_ANSWERED = "block bigint, part int, k tinyint, mask binary, own binary, answer binary"
_LINKED = "block bigint, part int, k tinyint, keys binary, states binary, arcs binary, seen binary, n binary, below binary"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "tinyint": pa.int8(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(list(c), kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _released(fn):
    """``fn`` of one table, whose memory is given back to the system after each group."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return fn(table)
        finally:
            release_memory()

    return run


def _met(fn):
    """The same for ``fn`` of a block's texts and what parts answered."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return fn(texts, answers.to_pylist())
        finally:
            release_memory()

    return run


def _ask(orders: list[int], bits: int):
    """Round 1: the distinct keys of a block, with their counts in training texts."""

    def ask(texts: pa.Table, answers: list[dict] = ()) -> pa.Table:
        block, number, out = Block(texts, orders[-1], bits), texts.column("block")[0].as_py(), []
        block.answered(answers, orders[0] - 1)
        train = ~_column(texts, "held_out").to_numpy(zero_copy_only=False)[block.owner]
        for k in orders:
            own = (block.at[k] >= 0) & train
            counts = np.bincount(block.at[k][own], minlength=len(block.keys[k]))
            out += [(number, p, k, pack(block.keys[k][x], base_of(p, bits)), pack_counts(counts[x])) for p, x in block.by_part(k, block.asked(k))]
        return _table(out, _ASKED)

    return ask


def _count(bits: int):
    """Round 1, a part: counts of all blocks added up."""

    def count(asked: pa.Table) -> pa.Table:
        part, k = asked.column("part")[0].as_py(), asked.column("k")[0].as_py()
        numbers = asked.column("block").to_pylist()
        keys = [unpack(x, base_of(part, bits)) for x in asked.column("keys").to_pylist()]
        ends = np.cumsum([0, *map(len, keys)])
        counts = np.concatenate([unpack_counts(x, len(y)) for x, y in zip(asked.column("counts").to_pylist(), keys)])
        _, speaker, at = distinct(np.concatenate(keys))
        total = np.bincount(at, counts).astype(np.int64)
        n, own = total[at], np.zeros(len(at), bool)
        own[speaker] = True
        kept = n >= (1 if k == 1 else LEAST)
        out = []
        for number, a, b in zip(numbers, ends, ends[1:]):
            some = kept[a:b]
            out.append((number, part, k, pack_bits(some), pack_bits(own[a:b][some]), pack_counts(n[a:b][some])))
        if k == 1:
            sums = total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()
            out.append((-1, part, k, b"", b"", np.array(sums, "<i8").tobytes()))
        return _table(out, _ANSWERED)

    return count


def _link(order: int, bits: int, totals: Totals):
    """Round 2: what the n-grams that a block speaks for add to the states of their first words,
    and the states that its texts fail from."""

    def link(texts: pa.Table, answers: list[dict]) -> pa.Table:
        block, number, out = Block(texts, order, bits), texts.column("block")[0].as_py(), []
        block.answered(answers, order)
        p = block.probabilities(totals)
        for k in range(1, order):
            mine = np.flatnonzero(block.own[k + 1])
            last, size = block.pos[k + 1][mine], len(block.keys[k])
            first = block.first(k + 1, last)
            arcs, below = np.bincount(first, minlength=size), np.bincount(first, p[k][block.at[k][last]], size)
            seen = np.bincount(first, block.n[k + 1][mine], size).astype(np.int64)
            asked, states = (dict(block.by_part(k, x)) for x in (block.failing(k), arcs > 0))
            none = np.zeros(0, np.int64)
            for part in asked.keys() | states.keys():
                x, y = asked.get(part, none), states.get(part, none)
                out.append((number, part, k, *(pack(block.keys[k][z], base_of(part, bits)) for z in (x, y)),
                            *(pack_counts(z[y]) for z in (arcs, seen, block.n[k])), below[y].astype("<f8").tobytes()))
        return _table(out, _LINKED)

    return link


def _back_off(bits: int, totals: Totals):
    """Round 2, a part: the backoff weights of its states."""

    def back_off(linked: pa.Table) -> pa.Table:
        part, k = linked.column("part")[0].as_py(), linked.column("k")[0].as_py()
        base = base_of(part, bits)
        keys = [unpack(x, base) for x in linked.column("states").to_pylist()]
        states, index, at = distinct(np.concatenate(keys))
        arcs, seen, n = (np.concatenate([unpack_counts(x, len(y)) for x, y in zip(linked.column(c).to_pylist(), keys)]) for c in ("arcs", "seen", "n"))
        arcs, seen = (np.bincount(at, x, len(states)) for x in (arcs, seen))
        below = np.bincount(at, np.frombuffer(b"".join(linked.column("below").to_pylist()), "<f8"), len(states))
        left = lambda share: np.maximum(1 - share, 1e-12)
        weights = np.log10(left((seen - totals.discount * arcs) / n[index]) / left(below))
        out = []
        for number, asked in zip(linked.column("block").to_pylist(), linked.column("keys").to_pylist()):
            asked = unpack(asked, base)
            if len(asked) and len(states):
                place = np.minimum(np.searchsorted(states, asked), len(states) - 1)
                found = states[place] == asked
                out.append((number, part, k, pack_bits(found), None, weights[place[found]].astype("<f8").tobytes()))
        return _table(out, _ANSWERED)

    return back_off


# --- the job ----------------------------------------------------------------

def _written(df: DataFrame, name: str) -> DataFrame:
    """``shared_table``, whose shuffle files are dropped once it is written."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return shared_table(df.select("*"), name)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` (the automaton)."""
    spark = docs.sparkSession
    ship_package(spark)
    held = crc_mod(F.col(id_col), HELD_OUT_MODULUS) == HELD_OUT_REMAINDER
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out"))
    size, cores = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, spark.sparkContext.defaultParallelism
    n_blocks = max(1, -(-size // BLOCK_BYTES), min(4 * cores, size // LEAST_BLOCK))
    bits = max(2, (-(-size // PART_BYTES) - 1).bit_length())
    block_parts, part_parts = min(MOST_PARTITIONS, n_blocks), min(MOST_PARTITIONS, max(cores, 1 << bits))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks).cast("bigint")).alias("block")
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.select(block, "id", "held_out", "text").repartition(block_parts, "block").groupBy("block")
    stored = _written(dealt.applyInArrow(_released(_stored), f"block bigint, id array<{kind}>, held_out array<boolean>, size bigint, text binary"), "blocks")
    texts = stored.repartition(block_parts, "block")

    def met(answers: DataFrame, fn, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(answers.repartition(block_parts, "block").groupBy("block")).applyInArrow(_met(fn), schema)

    def at_parts(sent: DataFrame, fn) -> DataFrame:
        return sent.repartition(part_parts, "part", "k").groupBy("part", "k").applyInArrow(_released(fn), _ANSWERED)

    asked = texts.drop("id").groupBy("block").applyInArrow(_released(_ask([1, 2][:order], bits)), _ASKED)
    counted = _written(at_parts(asked, _count(bits)), "counts")
    sums = np.array([np.frombuffer(r[0], "<i8") for r in counted.where("block = -1").select("answer").collect()]).reshape(-1, 4).sum(axis=0).tolist()  # a row per part
    n, v, n1, n2 = sums
    totals = Totals(n, v, min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5)
    counted = counted.where("block >= 0")
    for k in range(3, order + 1):
        counted = counted.unionByName(_written(at_parts(met(counted, _ask([k], bits), _ASKED), _count(bits)), f"counts-{k}"))
    weighed = _written(at_parts(met(counted, _link(order, bits, totals), _LINKED), _back_off(bits, totals)), "backoffs")
    log_all = float(np.log10(totals.tokens + totals.vocabulary + 1))

    def traverse(texts: pa.Table, answers: list[dict]) -> pa.Table:
        block = Block(texts, order, bits)
        block.answered(answers, order)
        found = block.n[1][block.at[1]]
        sums = lambda values: np.bincount(block.owner, values, block.size)
        lengths = np.diff(block.ends, prepend=0)
        return pa.table({id_col: _column(texts, "id"), "held_out": _column(texts, "held_out"), "n_tokens": pa.array(lengths, pa.int64()),
                         "n_known": pa.array(sums(found > 0).astype(np.int64)), "train_tokens": pa.array(np.full(block.size, totals.tokens), pa.int64()),
                         "base_score": pa.array(sums(np.log10(found + 1.0)) - lengths * log_all), "score": pa.array(sums(block.walk(totals, block.backoffs(answers))))})

    return met(counted.unionByName(weighed), traverse,
               f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
