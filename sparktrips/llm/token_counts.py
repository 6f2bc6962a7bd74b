"""Token counts per document by a two-tier lookup on the map side.

Tier one is a compact table of the corpus's frequent words with their token
counts, broadcast to every task. Tier two is a bounded cache in each Python
worker; only what both miss is encoded. No word is ever shuffled: the frequent
words come from mergeable frequent-item summaries, one of bounded size per
task, that are merged in two levels.

Words are runs of bytes without ASCII white space. The tokenizer never joins
text across white space, so a text's count is the sum of its words' counts.

Defined results: null or empty text counts 0 tokens and 0 bytes; repeated rows
and equal ids give one row each; an empty table gives an empty result; other
columns are ignored, whatever their names; texts may have any length.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import map_arrow, Memo, slices, text_bytes

#: Entries of the frequent table, and of each task's summary.
FREQUENT = 1 << 14
#: New entries that a worker's cache may hold, for words and for word parts.
CACHED = 150_000
#: Summaries merge in groups of about this many at first.
MERGE_SLOTS = 256
TOKEN_LIMIT = 2048


def byte_level() -> list[str]:
    """Character that byte-level tokenizers write for each byte: printable Latin-1
    characters stand for themselves, the others take code points from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class WordCounter:
    """Token counts of words, as the tokenizer in ``path`` gives them. Plain words
    are split by the tokenizer's own pattern and counted part by part; a word
    with a special token's string or with letters beyond Latin goes to the
    tokenizer as it is."""

    def __init__(self, path: str, frequent: dict[bytes, int] | None = None, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = regex.compile(pattern).findall
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.chars = byte_level()
        self.part_counts = Memo(self._part, cached)
        self.words = Memo(self._word, cached, frequent)

    def _part(self, part: str) -> int:
        return len(self.tokenizer.model.tokenize("".join([self.chars[b] for b in part.encode()])))

    def _word(self, word: bytes) -> int:
        text = word.decode()
        if any(s in word for s in self.special) or max(text, default="") >= "ɐ":
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        text = text.lower() if word.isascii() else self.tokenizer.normalizer.normalize_str(text)
        return sum(map(self.part_counts.__getitem__, self.parts(text)))

    def count(self, text: bytes) -> int:
        return sum(map(self.words.__getitem__, text.split()))


def _pruned(counts: Counter, keep: int) -> Counter:
    """Frequent-item summary of at most ``keep`` entries: the next largest count is
    taken off all. What occurs in over 1/keep of all words stays."""
    if len(counts) <= keep:
        return counts
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -(keep + 1))[-(keep + 1)])
    return Counter({w: c - off for w, c in counts.items() if c > off})


_SUMMARY = "slot int, words array<binary>, counts array<bigint>"


def _summary_batch(slot: int, counts: Counter) -> pa.RecordBatch:
    items = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    return pa.RecordBatch.from_arrays(
        [pa.array([slot], pa.int32()), pa.array([[w for w, _ in items]], pa.list_(pa.binary())),
         pa.array([[c for _, c in items]], pa.list_(pa.int64()))], ["slot", "words", "counts"])


def _merged(table: pa.Table, keep: int) -> Counter:
    total: Counter = Counter()
    for words, counts in zip(table.column("words"), table.column("counts")):
        total.update(dict(zip(words.as_py(), counts.as_py())))
        total = _pruned(total, keep)
    return total


def frequent_words(docs: DataFrame, text_col: str = "text", keep: int = FREQUENT) -> list[bytes]:
    """The most frequent words of all texts, at most ``keep`` of them. Each task
    sends one summary of at most ``keep`` entries; the driver gets one."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts: Counter = Counter()
        for part in slices(batches, text_col):
            for text in text_bytes(part.column(text_col)):
                counts.update(text.split())
            if len(counts) > 12 * keep:
                counts = _pruned(counts, keep)
        yield _summary_batch(TaskContext.get().partitionId() % MERGE_SLOTS, _pruned(counts, keep))

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_summary_batch(0, _merged(table, keep))])

    found = (map_arrow(docs.select(text_col), summarise, _SUMMARY)
             .groupBy("slot").applyInArrow(merge, _SUMMARY)
             .groupBy("slot").applyInArrow(merge, _SUMMARY).collect())
    return [bytes(w) for w in found[0].words] if found else []


def frequent_table(words: list[bytes], path: str) -> tuple[bytes, bytes]:
    """The words, blank-separated, and their token counts as 32-bit integers."""
    counter = WordCounter(path, cached=len(words) + 1)
    return b" ".join(words), np.array([counter.words[w] for w in words], np.uint32).tobytes()


_WORKER: dict[tuple, WordCounter] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and whether they
    exceed ``limit`` (``over_limit``)."""
    docs = docs.select(F.col(id_col), F.col(text_col))
    words, counts = frequent_table(frequent_words(docs, text_col), tokenizer_path)
    table = docs.sparkSession.sparkContext.broadcast((words, counts))
    key = (tokenizer_path, hash((words, counts)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _WORKER:
            _WORKER.clear()
            w, c = table.value
            _WORKER[key] = WordCounter(tokenizer_path, dict(zip(w.split(), np.frombuffer(c, np.uint32).tolist())))
        counter = _WORKER[key]
        for part in slices(batches, text_col):
            n = pa.array([counter.count(t) for t in text_bytes(part.column(text_col))], pa.int64())
            size = pc.cast(pc.fill_null(pc.binary_length(part.column(text_col)), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(id_col), size, n, pc.greater(n, limit)],
                                             [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs, count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
