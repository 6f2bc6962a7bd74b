"""Benchmark decontamination: windows of the size of a benchmark item that lie within
a small edit distance of the item.

Texts are words (runs of letters, digits and other bytes beyond ASCII, A-Z
lower-cased; ASCII punctuation and white space separate), so case, punctuation
and line breaks do not hide a copy. Per repetition:

* CGK embedding: a random walk reads a window from its first word; step j writes
  the word under it and moves on if a random bit of (step, word) says so. Walks
  over texts at a small edit distance soon meet again, so their outputs differ in
  few places: edit distance becomes Hamming distance.
* Bit sampling: three places of the embedding are compared. They are the same for
  all items, so one pass over all word positions serves all of them, and few
  positions are left after each place. As many repetitions run as the target
  recall needs. An item is embedded from several of its words on, spread over its
  whole length, so that edits anywhere do not hide it; items below 15 words have
  shorter spans of places as well.

Every window start of every text is walked. Windows whose samples agree are
verified exactly: the least word edit distance between the item and a window
around that place. The benchmark reaches the tasks in blocks of bounded size, so
nothing is shuffled whatever its size.

Defined results: null or empty texts match nothing; an item without words
matches nothing; an item shorter than ``1 / MAX_EDIT_SHARE`` words must be found
word for word; repeated rows and equal ids give one row each; equal items are
all reported, and of several equally good windows the first; very long texts and items are
whole in one task; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparktrips.llm.common import _IS_SEPARATOR, map_arrow, mix, slices, text_bytes, Words

#: A window counts as a copy up to this word edit distance, as a share of the item.
MAX_EDIT_SHARE = 0.2
#: Recall aimed at for copies of which a sampled place agrees with this chance.
TARGET_RECALL, AGREEMENT = 0.98, 0.75
SAMPLES = 3
#: Spans of an embedding, in steps: the places are among a span's steps, one in each third.
SPANS = 3, 6, 12
#: Of each span, so many walks of an item begin at words spread evenly over it, so that its
#: whole length is sampled; items have walks of the longest spans that fit into it.
BEGINS = {3: 6, 6: 6, 12: 4}
#: Candidates times words around them that are looked at together.
PLACES_AT_ONCE = 1 << 20
#: Most benchmark words that a task holds at a time.
BLOCK_WORDS = 1 << 20
SEED = 20

#: Bytes that are no part of a word: white space and ASCII punctuation.
SEPARATOR = _IS_SEPARATOR.copy()
SEPARATOR[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def repetitions(target: float = TARGET_RECALL, agreement: float = AGREEMENT) -> int:
    return math.ceil(math.log(1 - target) / math.log(1 - agreement ** SAMPLES))


class Items:
    """A block of benchmark items, and the values of their samples per repetition."""

    def __init__(self, ids: list, texts: list[bytes]):
        words = Words(texts, separator=SEPARATOR)
        kept = [(i, words.hashes[a:b]) for i, a, b in zip(ids, words.first, words.first[1:]) if b > a]
        self.ids, self.words = [i for i, _ in kept], [w for _, w in kept]
        self.tables = [self._table(r) for r in range(repetitions())] if kept else []

    def _table(self, repetition: int) -> list["Samples"]:
        rng = np.random.default_rng([SEED, repetition])
        groups = []
        for span in SPANS:
            third = span // SAMPLES
            places = tuple(int(rng.integers(third * i, third * (i + 1))) for i in range(SAMPLES))
            members = []
            for k, whole in enumerate(self.words):
                for begin in begins(len(whole), span):
                    found = [whole[begin:][at] for at in walk(whole[begin:], np.zeros(1, np.int64), repetition, places)]
                    two = chained(found[0], found[1])
                    members.append((k, begin, int(found[0][0]), int(two[0]), int(chained(two, found[2])[0])))
            if members:
                groups.append(Samples(places, members))
        return groups


def begins(words: int, span: int) -> list[int]:
    """Where walks of ``span`` steps begin in an item: evenly from its first word to the last
    one that leaves a whole span. Short items have the shorter spans too, since few
    of their long ones are without an edit."""
    if span == SPANS[0]:
        last = max(0, words - span) if words < 12 else -1
    else:
        last = words - span if words < (15 if span == 6 else 1 << 62) else -1
    return sorted({round(last * i / (BEGINS[span] - 1)) for i in range(BEGINS[span])}) if last >= 0 else []


class Samples:
    """Of the items that share the places of a repetition: bitmaps of the words at
    the first and of the hashes of the first two places, and the hashes of all
    three, sorted, with the item and where in it the walk began."""

    def __init__(self, places: tuple[int, ...], members: list[tuple[int, int, int, int, int]]):
        item, begin, one, two, three = (np.array(x) for x in zip(*[(k, b, np.uint64(x), np.uint64(y), np.uint64(z)) for k, b, x, y, z in members]))
        by = np.argsort(three)
        self.places, self.item, self.begin, self.keys = places, item[by], begin[by], three[by]
        self.bitmaps = []
        for values in (one, two):
            bitmap = np.zeros(1 << 16, bool)
            bitmap[values & np.uint64(0xFFFF)] = True
            self.bitmaps.append(bitmap)


def chained(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of what was read so far, with one more word."""
    return mix(hashes * np.uint64(3) + words)


def move(words: np.ndarray, repetition: int) -> np.ndarray:
    """64 random bits of each word for 64 steps of the walk."""
    return mix(words ^ np.uint64(0x9E3779B97F4A7C15 * (2 * repetition + 1) & (1 << 64) - 1))


def steps(bits: np.ndarray, at: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Positions after the steps ``begin`` to ``end`` of the walks that are at ``at``."""
    last = len(bits) - 1
    for j in range(begin, end):
        # words repeat their bits every 64 steps, rotated, so that long walks stay random
        at = at + (bits[np.minimum(at, last)] >> np.uint64((j + 7 * (j // 64)) % 64) & np.uint64(1)).astype(at.dtype)
    return np.minimum(at, last)


def walk(words: np.ndarray, at: np.ndarray, repetition: int, places: tuple[int, ...]) -> list[np.ndarray]:
    bits, out, done = move(words, repetition), [], 0
    for place in places:
        at = steps(bits, at, done, place)
        out.append(at)
        done = place
    return out


def candidate_windows(words: Words, items: Items) -> np.ndarray:
    """Rows (position where the item would begin, item, a position in its text) of the
    windows whose samples agree in some repetition."""
    hashes, found = words.hashes, [np.zeros((0, 3), np.int64)]
    everywhere = np.arange(len(hashes), dtype=np.int32 if len(hashes) < 2**31 - 2 else np.int64)
    for repetition, groups in enumerate(items.tables if len(hashes) else []):
        bits = move(hashes, repetition)
        for samples in groups:
            one, two, three = samples.places
            at = steps(bits, everywhere, 0, one)
            start = np.flatnonzero(samples.bitmaps[0][hashes[at] & np.uint64(0xFFFF)])
            read = hashes[at[start]]
            at = steps(bits, at[start], one, two)
            read = chained(read, hashes[at])
            left = np.flatnonzero(samples.bitmaps[1][read & np.uint64(0xFFFF)])
            start, at = start[left], steps(bits, at[left], two, three)
            read = chained(read[left], hashes[at])
            low, high = (np.searchsorted(samples.keys, read, side) for side in ("left", "right"))
            n = high - low
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            inside = np.repeat(start, n)
            found.append(np.stack([inside - samples.begin[entry], samples.item[entry], inside], axis=1))
    rows = np.concatenate(found)
    # one row per place and item
    return rows[np.unique(rows[:, 0] * (len(items.ids) + 1) + rows[:, 1], return_index=True)[1]]


def with_enough_words(rows: np.ndarray, words: Words, items: Items, share: float) -> list[tuple[int, int, int]]:
    """The candidates around whose place enough words are words of the item: all but
    the edits must be. Common words alone bring most candidates about."""
    kept = []
    for k in np.unique(rows[:, 1]).tolist():
        own, item = rows[rows[:, 1] == k], items.words[k]
        most = int(share * len(item))
        bitmap = np.zeros(1 << 16, bool)
        bitmap[item & np.uint64(0xFFFF)] = True
        offsets = np.arange(-most, len(item) + most)
        step = max(1, PLACES_AT_ONCE // len(offsets))
        for i in range(0, len(own), step):
            around = np.clip(own[i:i + step, :1] + offsets, 0, len(words) - 1)
            enough = bitmap[words.hashes[around] & np.uint64(0xFFFF)].sum(axis=1) >= len(item) - most
            kept += [tuple(r) for r in own[i:i + step][enough].tolist()]
    return sorted(kept)


def edit_distance(item: np.ndarray, text: np.ndarray, most: int, anywhere: bool) -> int:
    """Least word edit distance between the item and a prefix of ``text``, or any
    run of it, if at most ``most``; else ``most + 1``. Row by row, with insertions
    by a running minimum."""
    if np.isin(item, text, invert=True).sum() > most:
        return most + 1
    idx = np.arange(len(text) + 1)
    row = np.zeros_like(idx) if anywhere else idx.copy()
    for i, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - idx) + idx
        if row.min() > most:
            return most + 1
    return int(row.min())


def verified(words: Words, items: Items, found: list[tuple[int, int, int]], share: float) -> dict[tuple[int, int], tuple[int, int]]:
    """Per (text, item): the least distance and the first position that has it."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for start, k, inside in found:
        text = int(np.searchsorted(words.first, inside, side="right")) - 1
        low, high = int(words.first[text]), int(words.first[text + 1])
        item, most = items.words[k], int(share * len(items.words[k]))
        known = best.get((text, k), (most + 1, 0))[0]
        if known == 0:
            continue
        if start >= low and start + len(item) <= high and (words.hashes[start:start + len(item)] == item).all():
            best[text, k] = (0, start)
            continue
        a, b = max(low, start - most), min(high, start + len(item) + most)
        d = edit_distance(item, words.hashes[a:b], most, True)
        if d < known:
            at = next(p for p in range(a, b) if edit_distance(item, words.hashes[p:min(b, p + len(item) + most)], most, False) == d)
            best[text, k] = (d, at)
    return best


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most_words: int = BLOCK_WORDS) -> Iterator[list]:
    """The benchmark's rows in blocks of about ``most_words`` words, one at a time."""
    sized = benchmark.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * most_words)))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for b in range(blocks if total else 0):
        yield sized.where(block == b).collect()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", share: float = MAX_EDIT_SHARE) -> DataFrame:
    """One row per document row and item that it holds a copy of: both ids,
    ``distance`` (word edits), ``item_words`` and ``start_word`` of the best window."""
    docs = docs.select(F.col(id_col), F.col(text_col))
    kinds = [docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()]
    schema = f"`{id_col}` {kinds[0]}, `{item_id_col}` {kinds[1]}, distance bigint, item_words bigint, start_word bigint"
    item_type = to_arrow_type(benchmark.schema[item_id_col].dataType)
    out = docs.sparkSession.createDataFrame([], schema)
    for rows in item_blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(([r.id for r in rows], [r.text.encode() for r in rows]))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for part in slices(batches, text_col):
                words = Words(text_bytes(part.column(text_col)), separator=SEPARATOR)
                found = with_enough_words(candidate_windows(words, items), words, items, share)
                best = verified(words, items, found, share)
                if not best:
                    continue
                order = sorted(best)
                owner = part.column(id_col).take(pa.array([t for t, _ in order]))
                values = [[items.ids[k] for _, k in order], [best[x][0] for x in order], [len(items.words[k]) for _, k in order],
                          [best[x][1] - int(words.first[x[0]]) for x in order]]
                yield pa.RecordBatch.from_arrays([owner, pa.array(values[0], item_type), *[pa.array(v, pa.int64()) for v in values[1:]]],
                                                 [id_col, item_id_col, "distance", "item_words", "start_word"])

        out = out.unionAll(map_arrow(docs, find, schema))
    return out
