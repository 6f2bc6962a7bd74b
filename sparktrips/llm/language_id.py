"""Language identification by Bayesian fusion of four kinds of evidence.

* Text: per language a multinomial over hashed byte trigrams, counted over all
  texts under their declared language. ``und`` (undetermined) is one more class,
  under which all trigrams are equally likely.
* Declared language: how often texts of each language declare each language.
* Address suffix and host: priors from grouped counts of the text's language,
  smoothed hierarchically: all rows, then the suffix, then the host. A row's own
  text is taken out of its host's count.

The languages are the declared codes of two or three letters that at least
``MIN_ROWS`` rows declare, however many rows declare others (a code with a region
or script counts as its language), and whatever else (names, codes of small
tables) ``MIN_SHARE`` of all rows declare. So there are no more than the codes of ISO 639 that are in use and
1 / ``MIN_SHARE``, and the tables that the driver gets (languages x buckets,
languages x declared) are bounded by that, not by the rows.

Defined results: text without a trigram of letters has no text evidence and is
judged by the rest; text without letters (null and empty too) is never accepted; null declared language,
suffix or host carry no evidence; of languages with equal posteriors the first in
alphabetical order is named; very long texts are read whole; repeated rows and equal ids give
one row each; an empty table gives an empty result; other columns are ignored, whatever their
names. Without any declared language every row is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import _IS_SEPARATOR, _LOWER, lower_ascii, map_arrow, mix, shared_table, slices, text_bytes

MIN_ROWS, MIN_SHARE = 20, 0.01
LANGUAGE_CODE = "^[a-z]{2,3}$"
LANGUAGE_TAG = "^([a-z]{2,3})[-_][a-z0-9_-]*$"
BUCKETS = 1 << 13
#: A text's likelihood counts as that of at most so many independent trigrams.
EFFECTIVE_TRIGRAMS = 64.0
#: Rows that a prior from the level above weighs.
PRIOR_ROWS = 8.0
UND, UND_PRIOR = "und", 1e-3
MIN_CONFIDENCE = 0.5


#: Bytes that trigrams are made of: letters, bytes of characters beyond ASCII, and the
#: blank, which white space counts as. Digits and symbols say nothing of a language.
_TEXT = _LOWER.copy()
_TEXT[_IS_SEPARATOR] = 32
_SPEAKS = np.zeros(256, bool)
_SPEAKS[97:123] = _SPEAKS[128:] = True


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each byte trigram (A-Z lower-cased), the text that it is in, and the
    letters of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = _TEXT[np.frombuffer(b"".join(texts), np.uint8)]
    owner, letter = np.repeat(np.arange(len(texts)), sizes), _SPEAKS[data]
    letters = np.bincount(owner[letter], minlength=len(texts))
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    usable = letter | (data == 32)
    whole = (owner[:-2] == owner[2:]) & usable[:-2] & usable[1:-1] & usable[2:] & (letter[:-2] | letter[1:-1] | letter[2:])
    wide = data.astype(np.uint64)
    code = mix((wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:])[whole]) % np.uint64(BUCKETS)
    return code.astype(np.int64), owner[:-2][whole], letters


def base_code(declared: Column) -> Column:
    """The language of a code with a region or script ("pt-br", "zh_hans"); other values as they are."""
    code = F.regexp_extract(declared, LANGUAGE_TAG, 1)
    return F.when(code != "", code).otherwise(declared)


def declared_languages(rows: DataFrame, min_share: float = MIN_SHARE, min_rows: int = MIN_ROWS) -> list[str]:
    counts = rows.where("declared is not null").groupBy("declared").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    code = F.col("declared").rlike(LANGUAGE_CODE) & (F.col("declared") != UND)
    enough = (F.col("count") >= F.lit(min_share * total)) | (code & (F.col("count") >= min_rows))
    return sorted(r.declared for r in counts.where(enough).collect()) if total else []


def trigram_table(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Log-likelihood of each bucket (columns) under each language and, last, ``und``."""
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # of the languages that the task meets
        for part in slices(batches, "text"):
            of = np.array([place.get(x, -1) for x in part.column("declared").to_pylist()], np.int64)
            code, owner, _ = _trigrams(text_bytes(part.column("text")))
            language = of[owner]
            for i in np.unique(of[of >= 0]).tolist():
                total[i] = total.get(i, 0) + np.bincount(code[language == i], minlength=BUCKETS)
        for i, n in total.items():
            bucket = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(i * BUCKETS + bucket, pa.int64()), pa.array(n[bucket], pa.int64())], ["cell", "n"])

    counted = map_arrow(rows.select("declared", "text"), count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    n = np.zeros((len(languages), BUCKETS))
    cells = counted.toArrow()  # at most languages x buckets
    n.ravel()[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    table = np.log((n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    return np.vstack([table, np.full(BUCKETS, -np.log(BUCKETS))])


def with_text_likelihood(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """Adds ``n_letters``, ``n_trigrams`` and ``likelihood``: mean log-likelihood per class."""
    kept = [f for f in rows.schema if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_letters bigint, n_trigrams bigint, likelihood array<double>"])
    shared = rows.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for part in slices(batches, "text"):
            code, owner, letters = _trigrams(text_bytes(part.column("text")))
            n = np.bincount(owner, minlength=part.num_rows)
            sums = np.stack([np.bincount(owner, weights=row[code], minlength=part.num_rows) for row in logs], axis=1)
            means = sums / np.maximum(n, 1)[:, None]
            values = pa.FixedSizeListArray.from_arrays(pa.array(means.ravel()), len(logs)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(letters, pa.int64()), pa.array(n, pa.int64()), values],
                                             [*(f.name for f in kept), "n_letters", "n_trigrams", "likelihood"])

    return map_arrow(rows, score, schema)


def _argmax(values: Column) -> Column:
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def _group_priors(rows: DataFrame, classes: int) -> tuple[DataFrame, list[float]]:
    """Per host: counts of the text's class and the prior of its suffix; and the
    prior over all rows. Partial sums are taken before the shuffle."""
    evident = rows.where("n_trigrams > 0")
    cells = evident.where("host is not null").groupBy("host", "suffix", "text_class").agg(F.count("*").cast("double").alias("n"))
    known = [0.0] * classes
    for r in evident.groupBy("text_class").count().collect():
        known[r.text_class] = float(r["count"])
    known = known[:-1]
    overall = [(n + 1.0) / (sum(known) + len(known)) * (1 - UND_PRIOR) for n in known] + [UND_PRIOR]
    # a group's counts of all classes, from one row for each class that it has
    by_class = F.map_from_entries(F.collect_list(F.struct("text_class", "n")))
    counts = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.coalesce(F.try_element_at("by_class", i), F.lit(0.0)))
    suffixes = (cells.where("suffix is not null").groupBy("suffix", "text_class").agg(F.sum("n").alias("n"))
                .groupBy("suffix").agg(by_class.alias("by_class"), F.sum("n").alias("size")))
    prior = F.zip_with(counts, _literals(overall), lambda n, p: (n + p * PRIOR_ROWS) / (F.col("size") + PRIOR_ROWS))
    hosts = cells.groupBy("host", "suffix").agg(by_class.alias("by_class")).select("host", "suffix", counts.alias("host_counts"))
    hosts = hosts.join(suffixes.select("suffix", prior.alias("suffix_prior")), "suffix", "left")
    return hosts.select("host", "suffix", "host_counts", F.coalesce("suffix_prior", _literals(overall)).alias("suffix_prior")), overall


def _literals(values: list) -> Column:
    return F.array(*map(F.lit, values))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a column of lists of ``width`` numbers (0 where null), and where it is not null."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[there] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out, there


def _fused(joined: DataFrame, names: list[str], confusion: np.ndarray, overall: list[float]) -> DataFrame:
    """Adds up all evidence of each row: ``(id, language, confidence, text_language,
    declared, n_letters)``. ``confusion`` has the log probability of each declared slot
    (columns) under each class."""
    kind = joined.schema["id"].dataType.simpleString()
    shared = joined.sparkSession.sparkContext.broadcast((names, confusion, np.array(overall)))

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, confusion, overall = shared.value
        width, label = len(names), np.array(names, object)
        for part in batches:
            rows = np.arange(part.num_rows)
            n, of = part.column("n_trigrams").to_numpy(), part.column("text_class").to_numpy()
            likelihood, _ = _matrix(part.column("likelihood"), width)
            others, in_group = _matrix(part.column("host_counts"), width)
            above, has_suffix = _matrix(part.column("suffix_prior"), width)
            above[~has_suffix] = overall
            others[rows, of] -= n > 0
            prior = np.where(in_group[:, None], (others + above * PRIOR_ROWS) / (others.sum(axis=1, keepdims=True) + PRIOR_ROWS), above) if in_group.any() else above
            logs = np.minimum(n, EFFECTIVE_TRIGRAMS)[:, None] * likelihood + np.log(np.maximum(prior, 1e-12))
            declares = part.column("declared").is_valid().to_numpy(zero_copy_only=False)
            logs[declares] += confusion.T[part.column("slot").to_numpy()[declares]]
            best = logs.argmax(axis=1)
            confidence = 1.0 / np.exp(logs - logs[rows, best][:, None]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(label[best], pa.string()), pa.array(confidence, pa.float64()), pa.array(label[of], pa.string(), mask=n == 0),
                 part.column("declared"), part.column("n_letters")], ["id", "language", "confidence", "text_language", "declared", "n_letters"])

    return map_arrow(joined.select("id", "declared", "n_letters", "n_trigrams", "likelihood", "text_class", "slot", "host_counts", "suffix_prior"), fuse,
                     f"id {kind}, language string, confidence double, text_language string, declared string, n_letters bigint")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang",
             host_col: str | None = "source", suffix_col: str | None = None,
             min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row: id, ``language``, ``confidence`` (its posterior), ``text_language``
    (by the text alone, null without trigrams), ``declared`` and ``accepted``: a
    language, with at least ``min_confidence``, of a text that has letters."""
    optional = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lower_ascii(optional(declared_col)).alias("declared"),
                       lower_ascii(optional(host_col)).alias("host"), lower_ascii(optional(suffix_col)).alias("suffix"))
    rows = rows.withColumn("declared", base_code(F.col("declared")))
    languages = declared_languages(rows)
    names = [*languages, UND]
    scored = with_text_likelihood(rows, trigram_table(rows, languages))
    scored = shared_table(scored.withColumn("text_class", _argmax(F.col("likelihood"))), "language-evidence")

    # declared language: P(declared | language) from texts whose language is evident
    at = F.array_position(_literals(languages).cast("array<string>"), F.col("declared"))
    slot = F.coalesce(F.when(at > 0, at - 1), F.lit(len(languages))).cast("int")
    confusion = np.full((len(names), len(names)), 0.5)
    for c, d, n in scored.where("n_trigrams > 0 and declared is not null").groupBy("text_class", slot.alias("d")).count().collect():
        confusion[c, d] += n  # at most languages x languages cells
    confusion = np.log(confusion / confusion.sum(axis=1, keepdims=True))

    hosts, overall = _group_priors(scored, len(names))
    # rows without a host match nothing; their keys are spread so that they do not meet in one task
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64("id", "n_trigrams"), F.lit(4096)).cast("string"))
    named = F.concat(F.lit("h"), "host")
    joined = scored.withColumn("key", F.concat_ws("|", F.coalesce(named, spread), "suffix")).join(
        hosts.select(F.concat_ws("|", named, "suffix").alias("key"), "host_counts", "suffix_prior"), "key", "left")

    result = _fused(joined.withColumn("slot", slot), names, confusion, overall)
    accepted = (F.col("language") != UND) & (F.col("confidence") >= min_confidence) & (F.col("n_letters") > 0)
    return result.select(F.col("id").alias(id_col), "language", "confidence", "text_language", "declared", accepted.alias("accepted"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence columns of web pages: visible text, the language that the markup
    declares, host and address suffix: ``(page_id, text, lang, host, suffix)``."""
    html = F.coalesce("html", F.lit(""))
    body = F.regexp_replace(html, r"(?is)<(script|style|head|nav)\b.*?</\1\s*>", " ")
    host = F.nullif(lower_ascii(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://([^/?#]*)", 1)), F.lit(""))
    declared = F.nullif(F.regexp_extract(html, r"""(?is)<html[^>]*\blang\s*=\s*["']?([a-z]+)""", 1), F.lit(""))
    return pages.select("page_id", F.regexp_replace(body, r"(?s)<[^>]*>", " ").alias("text"), declared.alias("lang"),
                        host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"))
