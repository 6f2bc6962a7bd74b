"""Ranked lexical search: the highest-scoring documents for each item, term at a time
with a limited set of accumulators.

Items reach the tasks in blocks of bounded size. A first pass over all texts counts
the documents that hold each of the block's terms, all documents and all their terms.
In the second, a task turns a slice of its texts into postings (document, times) of
the block's terms and evaluates each item on them: its terms come rarest first, and a
document gets an accumulator when a term meets it. As soon as the terms that are left
cannot lift a new document to the kth best partial score, no accumulator is made any
more; those that exist get the rest of their terms exactly. A term's bound is its
largest contribution in the slice; the kth best whole score of earlier slices of the
task counts as a partial score too. A task hands on its k best documents per item, so
neither postings nor scores of all documents are shuffled, and the last step ranks a
few rows per item and task.

Scores are whole numbers (but for a logarithm per term), so they do not depend on
the order of terms, slices or tasks. Terms are told apart by 64-bit hashes.

Defined results: null texts and texts without a term are not documents, and an item
without a term, or one no document shares a term with, has no rows. Repeated
document rows are ranked each; of equal scores the smaller id comes first, a null id
last. Repeated items count once; items of equal id and different texts are ranked
apart, each from 1. Very long texts are a slice of their own, read whole. Empty
tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparktrips.llm.common import map_arrow, slices, text_bytes, Words
from sparktrips.llm.decontaminate import item_blocks

TOP = 10
#: Words of the items that a task holds at a time.
BLOCK_WORDS = 1 << 18
#: Bytes of text that are turned into postings at a time.
SLICE_BYTES = 1 << 22
#: The scoring contract's fixed values.
LENGTH_SHARE, TIMES, HALF, SATURATION = 75, 1_000_000_000, 1000, 8
#: Bytes between terms: all of ASCII but letters and digits.
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Queries:
    """A block of items as terms: ``terms`` are the block's distinct term hashes,
    sorted; item i has ``of[i]``, a dict of term (its place) -> times."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts, separator=SEPARATOR)
        self.terms = np.unique(words.hashes)
        place = np.searchsorted(self.terms, words.hashes)
        self.of = [Counter(place[a:b].tolist()) for a, b in zip(words.first, words.first[1:])]


class Postings:
    """Of some texts: ``n`` terms of each, and per term of the block the documents
    that hold it (``docs[at[t]:at[t + 1]]``, ascending) and how often (``times``)."""

    def __init__(self, texts: list[bytes], terms: np.ndarray):
        words = Words(texts, separator=SEPARATOR)
        self.n = words.counts()
        count = len(texts)
        place = np.minimum(np.searchsorted(terms, words.hashes), len(terms) - 1)
        known = terms[place] == words.hashes
        code, self.times = np.unique(place[known] * count + words.owner()[known], return_counts=True)
        self.docs = code % max(count, 1)
        self.at = np.searchsorted(code, np.arange(len(terms) + 1) * count)


class Statistics:
    """N, L and the weight of each term (0 where no document holds it)."""

    def __init__(self, documents: int, total: int, holding: np.ndarray):
        self.documents, self.total, self.holding = documents, total, holding
        self.weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) if df else 0 for df in holding]

    def impacts(self, found: Postings) -> np.ndarray:
        """What each posting is worth before its term's weight."""
        factor = LENGTH_SHARE * self.documents
        n = found.n if factor * int(found.n.max(initial=0)) < 1 << 63 else found.n.astype(object)
        m = (100 - LENGTH_SHARE + factor * n // max(self.total, 1)).astype(np.int64)
        return TIMES * found.times // (HALF * found.times + SATURATION * m[found.docs])


def best_documents(found: Postings, impacts: np.ndarray, largest: np.ndarray, query: list[tuple[int, int]], k: int, least: int,
                   scores: np.ndarray) -> np.ndarray:
    """Documents that may be among the k best for ``query`` (place and weight of its
    terms, rarest first), given that ``least`` is the kth best score known before.
    Their scores are left in ``scores``, which is zero elsewhere."""
    bounds = [weight * int(largest[t]) for t, weight in query]
    left = sum(bounds)
    live = None  # the documents with an accumulator, once no more are made
    for (t, weight), bound in zip(query, bounds):
        docs, worth = found.docs[found.at[t]:found.at[t + 1]], impacts[found.at[t]:found.at[t + 1]]
        if live is None:
            kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
            if left < max(kth, least):
                live = np.flatnonzero(scores)
        if live is None:
            scores[docs] += weight * worth
        elif len(docs):
            place = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
            hit = docs[place] == live
            scores[live[hit]] += weight * worth[place[hit]]
        left -= bound
    return np.flatnonzero(scores) if live is None else live


class Ranking:
    """The k best (score, id) per item so far, best first."""

    def __init__(self, items: int, k: int):
        self.k, self.rows = k, [[] for _ in range(items)]

    def least(self, item: int) -> int:
        rows = self.rows[item]
        return -rows[-1][0] if len(rows) == self.k else 0

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        """Takes in the scored documents; of equal scores those of the smallest ids."""
        value = scores[docs]
        if len(docs) > self.k:
            kth = np.partition(value, -self.k)[-self.k]
            above, level = docs[value > kth], docs[value == kth]
            of_level = pc.sort_indices(ids.take(pa.array(level)))[: self.k - len(above)].to_numpy(zero_copy_only=False)
            docs = np.concatenate([above, level[of_level]])
        named = ids.take(pa.array(docs)).to_pylist()
        rows = self.rows[item] + [(-s, x is None, x) for s, x in zip(scores[docs].tolist(), named) if s > 0]
        self.rows[item] = sorted(rows)[: self.k]


def statistics(texts: DataFrame, terms) -> Statistics:
    """Counts over all texts; ``terms`` is the broadcast of a block's queries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = terms.value
        documents, total, holding = 0, 0, np.zeros(len(queries.terms), np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            found = Postings(text_bytes(part.column("text")), queries.terms)
            documents, total, holding = documents + int((found.n > 0).sum()), total + int(found.n.sum()), holding + np.diff(found.at)
        held = np.flatnonzero(holding)
        if documents:
            names, values = np.concatenate([[-2, -1], held]), np.concatenate([[documents, total], holding[held]])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.int64())], ["term", "n"])

    rows = map_arrow(texts, count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per term of the block
    found = {r.term: r.n for r in rows}
    holding = np.zeros(len(terms.value.terms), np.int64)
    for term, n in found.items():
        if term >= 0:
            holding[term] = n
    return Statistics(found.get(-2, 0), found.get(-1, 0), holding)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per item its k highest-scoring documents: item id, ``rank``, document id, ``score``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type, item_type = texts.schema["id"].dataType, items.schema[item_id_col].dataType
    schema = f"slot bigint, item {item_type.simpleString()}, score bigint, id {id_type.simpleString()}"
    best = spark.createDataFrame([], schema)
    wanted = items.select(F.col(item_id_col).alias("id"), F.col(item_text_col).alias("text")).distinct()
    for block, rows in enumerate(item_blocks(wanted, "id", "text", BLOCK_WORDS)):
        queries, names = Queries([r.text.encode() for r in rows]), [r.id for r in rows]
        if not len(queries.terms):
            continue
        shared = spark.sparkContext.broadcast(queries)
        known = statistics(texts.select("text"), shared)
        ordered = [sorted(((t, known.weight[t] * times) for t, times in query.items() if known.weight[t]),
                          key=lambda x: (int(known.holding[x[0]]), x[0])) for query in queries.of]
        plan = spark.sparkContext.broadcast((known, ordered))

        def rank(batches: Iterator[pa.RecordBatch], shared=shared, plan=plan, names=names, block=block) -> Iterator[pa.RecordBatch]:
            queries, (known, ordered) = shared.value, plan.value
            ranking = Ranking(len(ordered), k)
            for part in slices(batches, "text", SLICE_BYTES):
                found = Postings(text_bytes(part.column("text")), queries.terms)
                if not len(found.docs):
                    continue
                impacts = known.impacts(found)
                held = np.diff(found.at) > 0
                largest = np.zeros(len(held), np.int64)
                largest[held] = np.maximum.reduceat(impacts, found.at[:-1][held])
                scores = np.zeros(part.num_rows, np.int64)
                for i, query in enumerate(ordered):
                    chosen = best_documents(found, impacts, largest, query, k, ranking.least(i), scores)
                    enough = chosen[scores[chosen] >= max(ranking.least(i), 1)]
                    if len(enough):
                        ranking.add(i, enough, scores, part.column("id"))
                    scores[chosen] = 0
            out = [((block << 32) + i, names[i], -score, x) for i, rows in enumerate(ranking.rows) for score, _, x in rows]
            if out:
                slot, item, score, x = zip(*out)
                arrays = [pa.array(slot, pa.int64()), pa.array(item, to_arrow_type(item_type)), pa.array(score, pa.int64()), pa.array(x, to_arrow_type(id_type))]
                yield pa.RecordBatch.from_arrays(arrays, ["slot", "item", "score", "id"])

        best = best.unionAll(map_arrow(texts, rank, schema))
    place = F.row_number().over(W.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")


def oracle() -> str:
    """DuckDB SQL for the rows of the whole tables ``documents`` and ``benchmark``."""
    terms = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
with docs as (select row_number() over () as r, doc_id, {terms} as t from documents),
sized as (select r, doc_id, len(t) as n from docs where len(t) > 0),
total as (select count(*) as documents, cast(sum(n) as bigint) as terms from sized),
items as (select row_number() over () as slot, item_id, {terms} as t from (select distinct item_id, text from benchmark)),
wanted as (select slot, term, count(*) as times from (select slot, unnest(t) as term from items) group by slot, term),
found as (select r, term, count(*) as tf from (select r, unnest(t) as term from docs) where term in (select term from wanted) group by r, term),
weights as (select term, cast(floor(1000 * ln(cast(2 * documents + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
            from (select term, count(*) as df from found group by term), total),
lengths as (select r, doc_id, 100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * documents) // terms as m from sized, total),
scores as (select slot, r, doc_id, cast(sum(times * w * (({TIMES} * tf) // ({HALF} * tf + {SATURATION} * m))) as bigint) as score
           from wanted join found using (term) join weights using (term) join lengths using (r) group by slot, r, doc_id),
ranked as (select slot, doc_id, score, row_number() over (partition by slot order by score desc, doc_id asc nulls last) as place
           from scores where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from ranked join items using (slot) where place <= {TOP}
"""
