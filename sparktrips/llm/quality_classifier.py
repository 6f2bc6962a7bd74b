"""Quality classifier: an interpolated modified Kneser-Ney n-gram model, trained on
trusted text, gives each text's perplexity; language-specific quantiles of the
perplexities of other trusted texts are the thresholds. Half of the trusted
texts train, the other half calibrates, by a hash of the id.

Two models judge each text, and it is kept if neither finds it too perplexing.

The n-grams of the first are of symbols: 32 classes (letters a-z in either case,
separators, digits, punctuation, other ASCII, leading and continuation bytes of
characters beyond ASCII). So there are at most 32**ORDER of them whatever the
corpus, texts in any language and unseen words have a probability, and the table
of all conditional probabilities (4 MB) may be broadcast.

The counts of each order are sharded by n-gram and joined: with the totals of
their contexts, and with the lower order's probabilities. Per-document
perplexity is then one pass over the texts without a shuffle.

The n-grams of the second are of whole characters (code points, A-Z lower-cased)
of any script, all that the training texts hold, so the model grows with them. An
n-gram's weight is its log probability less what falling back on the shorter one
would give, and a text's log probability is the sum of the weights of its n-grams
of all orders. Weights stay in a table: n-grams that hold ``HOT_SHARE`` of the
training characters are broadcast, a text's others are joined by n-gram.

Defined results: null or empty text has perplexity null and is not kept;
repeated rows and equal ids give one row each; an unknown character has the
probability that discounting took from all known ones; a null or rare language
uses the quantile over all trusted texts; without trusted texts nothing is known, every
symbol is equally likely and every text with symbols is kept; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktrips.llm.common import _IS_SEPARATOR, crc_mod, cut, map_arrow, mix, shared_table, slices, text_bytes
from sparktrips.llm.lm_scoring import by_text, gram_keys, grams, looked_up, signed

ORDER, BITS = 4, 5
#: Order of the n-grams of characters. At most 1 / ``HOT_SHARE`` of each order are broadcast.
CHAR_ORDER, HOT_SHARE = 4, 4e-7
SYMBOLS = 1 << BITS
#: A text is kept up to this quantile of its language's trusted perplexities,
#: times a tolerance for texts just beyond those seen.
QUANTILE, TOLERANCE = 0.99, 1.1
#: Languages with fewer trusted texts use the quantile over all.
MIN_TRUSTED = 50
#: Bins per bit of entropy in which quantiles are counted.
BINS = 512
#: Bytes of text whose characters are counted, and that are scored, at a time: what is computed from
#: a text takes some 60 times its bytes, and in scoring stays in the cache.
COUNTED_BYTES, SCORED_BYTES = 1 << 20, 1 << 18

_SYMBOL = np.full(256, 29, np.uint8)  # other ASCII
_SYMBOL[128:192], _SYMBOL[192:] = 31, 30  # continuation and leading bytes
for _i in range(26):
    _SYMBOL[97 + _i] = _SYMBOL[65 + _i] = _i
_SYMBOL[[ord(c) for c in "0123456789"]] = 27
_SYMBOL[[ord(c) for c in ".,;:!?'\"-()"]] = 28
_SYMBOL[_IS_SEPARATOR] = 26


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per symbol of all texts the code of the n-gram that ends there (each text is
    preceded by separators), and the symbols of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    pad = bytes([32]) * (ORDER - 1)
    data = _SYMBOL[np.frombuffer(pad + pad.join(texts) if texts else b"", np.uint8)].astype(np.int32)
    if not sizes.sum():
        return np.zeros(0, np.int32), sizes
    code = np.zeros(len(data) - ORDER + 1, np.int32)
    for k in range(ORDER):
        code = code << BITS | data[k:k + len(code)]
    # text i's symbols begin after its own padding
    first = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
    at = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return code[at], sizes


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(code, c)``: counts of all n-grams of the column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for part in slices(batches, "text"):
            total += np.bincount(codes(text_bytes(part.column("text")))[0], minlength=len(total))
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code], pa.int64())], ["code", "c"])

    return map_arrow(texts.select("text"), count, "code bigint, c bigint").groupBy("code").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and from 3 on, from the counts of
    counts; 0.5 where those are missing."""
    t = counts.agg(*[F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)]).first()
    t1, t2, t3, t4 = (float(x or 0) for x in t)
    if not t1 or not t2:
        return [0.5, 0.5, 0.5]
    y = t1 / (t1 + 2 * t2)
    raw = [1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3 if t3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


def conditional_table(texts: DataFrame) -> np.ndarray:
    """log2 P(last symbol | the others) of every possible n-gram, in code order."""
    counts = {ORDER: cut(gram_counts(texts))}
    for k in range(ORDER - 1, 0, -1):
        # continuation counts: how many symbols have been seen before the n-gram
        low = F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1).cast("bigint"))
        counts[k] = counts[k + 1].groupBy(low.alias("code")).agg(F.count("*").alias("c"))
    table, lower = np.full(SYMBOLS, 1 / SYMBOLS), None
    for k in range(1, ORDER + 1):
        d = discounts(counts[k])
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = F.shiftright("code", BITS)
        contexts = counts[k].groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum(taken).alias("freed"))
        contexts = contexts.withColumn("gamma", F.col("freed") / F.col("total"))
        seen = counts[k].withColumn("context", context).join(contexts, "context")
        own = (F.col("c") - taken) / F.col("total")
        if k == 1:
            seen = seen.select("code", (own + F.col("gamma") / SYMBOLS).alias("p"))
        else:
            suffix = F.col("code").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1).cast("bigint"))
            seen = seen.withColumn("suffix", suffix).join(lower, "suffix").select("code", (own + F.col("gamma") * F.col("below")).alias("p"))
        seen = cut(seen)
        # everything unseen: the lower order, weighted by what the context's discounts freed
        gamma = np.ones(SYMBOLS ** (k - 1))
        found = contexts.select("context", "gamma").toArrow()
        gamma[found.column("context").to_numpy()] = found.column("gamma").to_numpy()
        below = np.full(SYMBOLS, 1 / SYMBOLS) if k == 1 else np.tile(table, SYMBOLS)
        table = np.repeat(gamma, SYMBOLS) * below
        found = seen.toArrow()  # at most SYMBOLS ** k rows
        table[found.column("code").to_numpy()] = found.column("p").to_numpy()
        lower = seen.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
    return np.log2(table)


def with_entropy(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """``(row, id, lang, n_symbols, bits)`` of rows ``(row, id, lang, text)``: bits per symbol."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shared = rows.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for part in slices(batches, "text", SCORED_BYTES):
            code, sizes = codes(text_bytes(part.column("text")))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            bits = -np.bincount(owner, weights=logs[code], minlength=len(sizes)) / np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), part.column("lang"), pa.array(sizes, pa.int64()),
                                              pa.array(bits, pa.float64(), mask=sizes == 0)], ["row", "id", "lang", "n_symbols", "bits"])

    return map_arrow(rows, score, f"row bigint, id {kinds['id']}, lang string, n_symbols bigint, bits double")


# --- whole characters -------------------------------------------------------

#: Stand for the beginning and the end of a text among the code points.
BEGIN, END = 0x110000, 0x110001


@cache
def character_hashes() -> np.ndarray:
    """The hash of each code point, A-Z lower-cased, and of ``BEGIN`` and ``END``."""
    points = np.arange(END + 1, dtype=np.uint64)
    points[65:91] += np.uint64(32)
    return mix(points + np.uint64(1))


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the characters of all texts, each text between ``BEGIN`` and ``END``,
    and where each text ends."""
    sizes = np.array([len(t or "") for t in texts], np.int64)
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes + 2)
    out = np.zeros(len(points) + 2 * len(sizes), np.uint32)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = inside[ends - sizes - 2] = False
    out[inside], out[ends - 1], out[ends - sizes - 2] = points, END, BEGIN
    return character_hashes()[out], ends


BEGIN_KEY = int(mix(np.array([BEGIN + 1], np.uint64)).view(np.int64)[0])


def character_counts(texts: DataFrame) -> DataFrame:
    """``(k, first, second, key, n)``: counts of all n-grams of characters of the column
    ``text``: keys of their first and last characters (all but one) and their own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", COUNTED_BYTES):
            hashes, ends = characters(part.column("text").to_pylist())
            none = np.zeros(len(hashes), np.uint64)
            longer = ((a, b, gram_keys(a, b)) for a, b, _ in grams(hashes, ends, CHAR_ORDER))  # one order at a time
            for k, (first, second, keys) in enumerate(chain([(none, none, hashes)], longer), 1):
                key, one, n = np.unique(keys, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one), k, np.int8)), signed(first[one]), signed(second[one]), signed(key), pa.array(n, pa.int64())],
                                                 ["k", "first", "second", "key", "n"])

    counted = map_arrow(texts.select("text"), count, "k tinyint, first bigint, second bigint, key bigint, n bigint")
    return counted.groupBy("k", "first", "second", "key").agg(F.sum("n").alias("n"))


def character_weights(texts: DataFrame) -> tuple[DataFrame, float, float]:
    """``(k, key, n, weight)`` of all n-grams of interpolated modified Kneser-Ney, the
    count from which one is hot, and the weight of an unknown character (log2)."""
    raw = shared_table(character_counts(texts), "character-counts")
    total = raw.where("k = 1").agg(F.sum("n")).first()[0] or 0
    hot = max(1.0, HOT_SHARE * total)

    def counted(k: int) -> tuple[DataFrame, Column]:
        """The n-grams with ``c``, their counts: in lower orders that of the characters
        seen before, but for n-grams that begin a text."""
        rows = raw.where(F.col("k") == k).drop("k")
        if k == CHAR_ORDER:
            rows = rows.withColumn("c", F.col("n"))
        else:
            before = raw.where(F.col("k") == k + 1).groupBy(F.col("second").alias("key")).agg(F.count("*").alias("before"))
            rows = rows.join(before, "key", "left").withColumn("c", F.coalesce("before", "n")).drop("before")
        rows = cut(rows)
        d = discounts(rows if k > 1 else rows.where(F.col("key") != BEGIN_KEY))
        return rows, F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])

    rows, taken = counted(1)
    begins = F.col("key") == BEGIN_KEY
    whole = rows.where(~begins).agg(F.sum("c").alias("total"), F.sum(taken).alias("freed"), F.count("*").alias("known")).first()
    if not whole.total:
        return raw.select("k", "key", "n", F.lit(0.0).alias("weight")), hot, 0.0
    unknown = whole.freed / whole.total / (whole.known + 1)
    p = F.when(begins, 1.0).otherwise((F.col("c") - taken) / F.lit(float(whole.total)) + F.lit(unknown))
    level = rows.select("key", "n", p.alias("p"), F.log2(p).alias("arc"))
    out = []
    for k in range(2, CHAR_ORDER + 1):
        rows, taken = counted(k)
        rows = rows.withColumn("taken", taken)
        mass = rows.groupBy(F.col("first").alias("key")).agg(F.sum("c").alias("total"), (F.sum("taken") / F.sum("c")).alias("gamma"))
        level = shared_table(level.join(mass, "key", "left"), f"characters-{k - 1}")
        out.append(level.select(F.lit(k - 1).alias("k"), "key", "n", (F.col("arc") + F.coalesce(F.log2("gamma"), F.lit(0.0))).alias("weight")))
        rows = looked_up(rows, "second", level.select("key", "n", F.col("p").alias("below")), hot)
        rows = looked_up(rows, "first", level.select("key", "n", "total", "gamma"), hot)
        p = (F.col("c") - F.col("taken")) / F.col("total") + F.col("gamma") * F.col("below")
        level = rows.select("key", "n", p.alias("p"), (F.log2(p) - F.log2("gamma") - F.log2("below")).alias("arc"))
    out.append(level.select(F.lit(CHAR_ORDER).alias("k"), "key", "n", F.col("arc").alias("weight")))
    weights = out[0]
    for x in out[1:]:
        weights = weights.unionByName(x)
    return shared_table(weights, "character-weights"), hot, float(np.log2(unknown))


class HotWeights:
    """Weights of the hot n-grams: most have a place of their own by the low bits of the
    key, so that one look finds them; the others are sorted."""

    def __init__(self, rows: DataFrame):
        table = rows.select("key", "weight").toArrow()
        keys, weights = table.column("key").to_numpy().view(np.uint64), table.column("weight").to_numpy()
        bits = max(10, int(len(keys)).bit_length() + 1)
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.weights = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits)
        place = keys & self.mask
        self.keys[place], self.weights[place] = keys, weights
        other = self.keys[place] != keys
        by = np.argsort(keys[other])
        self.more, self.more_weights = keys[other][by], weights[other][by]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of each key (0 where it is not hot), and whether it is hot."""
        place = (keys & self.mask).view(np.int64)  # numpy looks up signed places faster
        found = self.keys[place] == keys
        out, miss = self.weights[place], np.flatnonzero(~found)
        out[miss] = 0.0
        if len(self.more):
            keys = keys[miss]
            at = np.minimum(np.searchsorted(self.more, keys), len(self.more) - 1)
            hit = self.more[at] == keys
            out[miss[hit]], found[miss[hit]] = self.more_weights[at[hit]], True
        return out, found


def with_character_bits(rows: DataFrame, weights: DataFrame, hot: float, unknown: float) -> DataFrame:
    """``rows`` (with ``row`` and ``text``) as ``(row, char_bits)``: bits per character,
    the end counted as one. No row without characters."""
    shared = rows.sparkSession.sparkContext.broadcast(HotWeights(weights.where(F.col("n") >= hot)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_weights, begin = shared.value, np.array([BEGIN_KEY], np.int64).view(np.uint64)[0]
        for part in slices(batches, "text", SCORED_BYTES):
            hashes, ends = characters(part.column("text").to_pylist())
            size, lengths = part.num_rows, np.diff(ends, prepend=0)
            owner = np.repeat(np.arange(size), lengths)
            value, found = hot_weights.find(hashes)
            # keys without a weight add nothing, but for characters (sign 1), which are unknown then
            sums, starts = np.bincount(owner, value, size), hashes == begin
            rest = [(owner[~found & at], hashes[~found & at], sign) for at, sign in ((~starts, 1), (starts, -1))]
            for first, second, last in grams(hashes, ends, CHAR_ORDER):
                keys, of = gram_keys(first, second), owner[last]
                value, found = hot_weights.find(keys)
                sums += np.bincount(of, value, size)
                rest.append((of[~found], keys[~found], -1))
            keys, times = by_text(rest, size)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(lengths - 1, pa.int64()), pa.array(sums, pa.float64()), keys, times],
                                             ["row", "size", "hot", "rest", "times"])

    texts = shared_table(map_arrow(rows.select("row", "text"), score, "row bigint, size bigint, hot double, rest array<bigint>, times array<int>"), "character-scores")
    each = texts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("key"), F.col("x.times").alias("times"))
    others = weights.where(F.col("n") < hot).select("key", "weight")
    joined = each.join(others, "key", "left").where((F.col("times") > 0) | F.col("weight").isNotNull())
    sums = joined.groupBy("row").agg(F.sum(F.abs("times") * F.coalesce("weight", F.lit(unknown))).alias("more"))
    bits = -(F.col("hot") + F.coalesce("more", F.lit(0.0))) / F.col("size")
    return texts.where("size > 1").join(sums, "row", "left").select("row", bits.alias("char_bits"))


# --- thresholds -------------------------------------------------------------

def quantiles(trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``(lang, most_bits)``: the upper edge of the bin that holds the quantile, per
    language with enough trusted texts; a null language stands for all."""
    binned = trusted.where("bits is not null").select("lang", F.ceil(F.col("bits") * BINS).alias("bin"))
    counted = binned.where("lang is not null").groupBy("lang", "bin").count().unionByName(
        binned.groupBy("bin").count().withColumn("lang", F.lit(None).cast("string")))
    by = W.partitionBy("lang")
    ranked = counted.withColumn("upto", F.sum("count").over(by.orderBy("bin"))).withColumn("all", F.sum("count").over(by))
    enough = F.col("lang").isNull() | (F.col("all") >= MIN_TRUSTED)
    return ranked.where(enough & (F.col("upto") >= F.col("all") * quantile)).groupBy("lang").agg((F.min("bin") / BINS).alias("most_bits"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             quality_col: str = "quality", quantile: float = QUANTILE) -> DataFrame:
    """Per row: id, ``lang``, ``n_symbols``, ``perplexity`` (per symbol),
    ``max_perplexity`` of its language, the same of characters, and ``kept``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # half of the trusted texts train the model, the other half gives the quantiles. Only texts of
    # the first half are joined with the labels, which grow with the texts and are not broadcast.
    good = labels.where(F.col(quality_col) == 1).select(F.col(id_col).alias("id")).distinct().hint("merge")
    training = crc_mod(F.col("id"), 2) == 0
    learned = shared_table(rows.where(training).select("id", "text").join(good, "id", "left_semi").select("text"), "training-texts")
    table, (weights, hot, unknown) = conditional_table(learned), character_weights(learned)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    scored = shared_table(with_entropy(numbered, table), "entropy")
    scored = shared_table(scored.join(with_character_bits(numbered, weights, hot, unknown), "row", "left"), "entropies")
    trusted = scored.where(~training).join(good, "id", "left_semi")
    result, perplexities = scored, []
    for bits, most, most_known in (("bits", "most", float(BITS)), ("char_bits", "char_most", float("inf"))):
        levels = cut(quantiles(trusted.select("lang", F.col(bits).alias("bits")), quantile))
        overall = levels.where("lang is null").first()
        fallback = F.lit(overall.most_bits if overall else most_known)
        result = result.join(levels.where("lang is not null").select("lang", F.col("most_bits").alias(most)), "lang", "left")
        perplexities.append((F.pow(F.lit(2.0), F.col(bits)), F.pow(F.lit(2.0), F.coalesce(most, fallback)) * TOLERANCE))
    (perplexity, highest), (char_perplexity, char_highest) = perplexities
    return result.select(
        F.col("id").alias(id_col), "lang", "n_symbols", perplexity.alias("perplexity"), highest.alias("max_perplexity"),
        char_perplexity.alias("char_perplexity"), char_highest.alias("max_char_perplexity"),
        F.coalesce((perplexity <= highest) & (char_perplexity <= char_highest), F.lit(False)).alias("kept"))
