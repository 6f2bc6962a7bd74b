"""Quality rules: fixed base rules, then a hashed n-gram log-likelihood ratio.

Words and pairs of words are hashed into ``BUCKETS`` buckets. Two multinomials
over the buckets are counted: of trusted texts (labelled quality 1) and of all
texts. A text's score is the mean, over its n-grams and ``NEUTRAL`` more that say
nothing, of the logarithm of the ratio of the two probabilities: length does not
matter, but for short texts, whose means vary by chance. Half of the trusted
texts, by a hash of their id, give the target counts; the scores of the others
and of the texts labelled bad set the threshold, where the share of bad texts
kept plus ``LOSS`` times the share of good ones lost is least. Without labels of
both kinds it is ``SPREADS`` standard deviations below the mean of the good ones,
or of all. Every text is scored and judged alike, and the counts cover every text.

All of it is DataFrame functions: no Python runs on the executors. The driver
gets one row per bucket and one per bin of scores and label.

Defined results: null or empty text has no words, fails the base rules and is
not kept; repeated rows and equal ids give one row each (a label counts for each
row with its id); without labels both multinomials are equal, all scores are 0
and all texts that pass the base rules are kept; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import SEPARATORS, crc_mod, shared_table

BUCKETS = 10_000
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Rows that each bucket is smoothed by, and the fallback threshold's distance.
SMOOTHING, SPREADS = 0.5, 3.0
#: What losing a good text weighs against keeping a bad one; bins of scores from
#: -RANGE to RANGE, per unit.
LOSS, RANGE, BINS = 10.0, 8, 512
NEUTRAL = 20
_BLANKS = SEPARATORS.decode()


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _places(n: Column, run: int) -> Column:
    """0, 1, ... the last place where ``run`` words begin."""
    return F.when(n >= run, F.sequence(F.lit(0), (n - run).cast("int"))).otherwise(F.array().cast("array<int>"))


def with_hashes(rows: DataFrame) -> DataFrame:
    """Adds ``n`` and ``hashes``, one 64-bit hash per word."""
    return rows.withColumn("words", _words(F.col("text"))).withColumn("n", F.size("words")) \
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")


def _run_hash(i: Column, run: int) -> Column:
    return F.xxhash64(*[F.get("hashes", i + k) for k in range(run)])


def buckets(kind: str) -> Column:
    """The buckets of a text's words, or of its pairs of words."""
    if kind == "word":
        return F.transform("hashes", lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    return F.transform(_places(F.col("n"), 2), lambda i: F.pmod(_run_hash(i, 2), F.lit(BUCKETS)).cast("int"))


# --- base rules -------------------------------------------------------------

def base_features(rows: DataFrame) -> DataFrame:
    """Of ``(id, text, n, hashes)``: the base columns, and hashes for the score."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({
        "word_chars": F.length(F.translate(text, _BLANKS, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "lines": lines,
        "runs": F.transform(_places(F.col("n"), WINDOW), lambda i: _run_hash(i, WINDOW)),
    }).drop("text")
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")).drop("lines")
    # runs sorted with their places: equal ones are neighbours. Most texts repeat none and need no sort.
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    rows = rows.withColumn("sorted", F.when(repeats, F.sort_array(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("sorted", lambda x, i: F.coalesce(x["h"] == F.get("sorted", i - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("sorted", i + 1)["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
                          lambda s, p: F.struct(p.alias("last"), (s["sum"] + F.least(F.lit(WINDOW), p - s["last"])).alias("sum")),
                          lambda s: s["sum"])
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("runs", "sorted")


# --- the ratio --------------------------------------------------------------

def bucket_counts(hashed: DataFrame) -> np.ndarray:
    """N-grams per bucket of rows ``(n, hashes)``; partial sums before the shuffle."""
    grams = hashed.select(F.explode(F.concat(buckets("word"), buckets("pair"))).alias("bucket"))
    n = np.zeros(BUCKETS)
    for row in grams.groupBy("bucket").agg(F.count("*").alias("n")).collect():  # at most BUCKETS rows
        n[row.bucket] = row.n
    return n


def log_ratios(everything: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log of each bucket's probability in the trusted texts over that in all."""
    n = np.stack([bucket_counts(everything), bucket_counts(trusted)])
    if not n[1].sum():
        return np.zeros(BUCKETS)
    share = (n + SMOOTHING) / (n + SMOOTHING).sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def _mean_ratio(ratios: np.ndarray) -> Column:
    table = F.lit(ratios)
    total = lambda kind: F.aggregate(buckets(kind), F.lit(0.0), lambda s, b: s + F.get(table, b))
    grams = F.col("n") + F.greatest(F.lit(0), F.col("n") - 1) + NEUTRAL
    return (total("word") + total("pair")) / grams


def threshold(scored: DataFrame) -> float:
    """From ``(score, good)`` of texts that pass the base rules, good null for texts
    that say nothing. The middle of the scores that lose least."""
    at = F.least(F.greatest(F.floor((F.col("score") + RANGE) * BINS), F.lit(0)), F.lit(2 * RANGE * BINS - 1))
    n = np.zeros((2, 2 * RANGE * BINS + 1))
    for row in scored.where("good is not null").groupBy("good", at.alias("bin")).count().collect():
        n[int(row.good), row.bin + 1] = row["count"]
    if n.sum(axis=1).all():
        below = np.cumsum(n, axis=1) / n.sum(axis=1, keepdims=True)  # share of each kind in lower bins
        loss = 1 - below[0] + LOSS * below[1]
        best = np.flatnonzero(loss <= loss.min() + 1e-12)
        run = best[: int(np.argmax(np.append(np.diff(best) > 1, True))) + 1]
        return float(run.mean() / BINS - RANGE)
    kinds = scored.where("good") if n[1].any() else scored
    k, m, s = kinds.agg(F.count("score"), F.avg("score"), F.stddev("score")).first()
    return m - SPREADS * s - 1e-9 if k > 1 else -1e-9


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          quality_col: str = "quality") -> DataFrame:
    """Per row: id, the base columns, ``base_failed``, ``score`` and ``kept``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    graded = labels.select(F.col(id_col).alias("label_id"), F.col(quality_col).alias("quality")).where("label_id is not null") \
        .groupBy("label_id").agg(F.max("quality").alias("quality"))
    # half of the trusted texts are the target, the other half sets the threshold: only texts of
    # the first half need their label, so only those are shuffled (labels grow with the texts,
    # so they are never broadcast)
    target = crc_mod(F.col("id"), 2) == 0
    good_ids = graded.where("quality = 1").select(F.col("label_id").alias("id")).hint("merge")
    targets = rows.where(target).join(good_ids, "id", "left_semi")
    ratios = log_ratios(with_hashes(rows), with_hashes(targets))

    base = base_features(with_hashes(rows))
    failed = (F.col("n") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n").cast("bigint") * MAX_REPEAT_PERCENT)
    scored = base.withColumn("score", _mean_ratio(ratios)).select(
        "id", F.col("n").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "score")
    scored = shared_table(scored, "quality")
    good = F.when(F.col("quality") == 0, False).when((F.col("quality") == 1) & ~target, True)
    passed = scored.where(~F.col("base_failed")).join(graded, F.col("id") == F.col("label_id"), "left")
    least = threshold(passed.select("score", good.alias("good")))
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(least))
    return scored.select(F.col("id").alias(id_col), *scored.columns[1:], kept.alias("kept"))
