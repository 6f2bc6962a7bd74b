"""Packing of token sequences into fixed windows by non-negative least squares.

Each task packs runs of the documents that it reads, so nothing is shuffled and
no state grows with the table. Per run:

1. Whole windows of long documents are sequences of their own.
2. Remainders are put into length classes. All combinations of few distinct
   class lengths that fill a window are the columns of a matrix; non-negative
   least squares gives how often to repeat each so that together they use up the
   histogram of most remainders. The counts are rounded down and filled.
3. The gaps that the classes leave, and the rest, are packed greedily: residual
   documents are cut to fill gaps exactly, what is left over fills windows end
   to end, and the last partial window is cut at powers of two, which need no
   padding.

So padding is zero, and most documents are cut at window bounds only.

Defined results: null or empty text is the end token alone; repeated rows and
equal ids are packed one by one; an empty table gives an empty result; other
columns are ignored, whatever their names; a text of any length is cut into
windows. Sequence ids are unique, not dense.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import map_arrow, Memo, slices, text_bytes
from sparktrips.llm.token_counts import byte_level

WINDOW = 2048
END_ID = 1
#: Length classes of a window, and distinct classes that a combination may have.
CLASSES, DEPTH = 32, 3
#: Share of the histogram that the combinations are to use; the rest fills gaps.
SOLVED_SHARE = 0.9
#: A run ends after so many documents, or tokens in their remainders.
RUN_DOCS, RUN_TOKENS = 20_000, 6_000_000
CACHED = 200_000
#: The pattern that splits byte-level texts into pre-tokens (a fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- token ids --------------------------------------------------------------

class _Uneven(Exception):
    """A run of white space that a word by itself does not show."""


class TextEncoder:
    """Ids of whole texts as (the machine's) unsigned 32-bit integers, word by word
    through bounded caches. Texts with a special token's string or with runs of
    white space go to the tokenizer as they are."""

    def __init__(self, path: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.split = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.chars = byte_level()
        self.parts = Memo(self._part, 2 * cached)
        self.first = Memo(lambda w: self._word(w, ""), cached)
        self.later = Memo(lambda w: self._word(w, " "), cached)
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():  # such bytes stand for themselves, but for the blank
            shown = part.replace(" ", self.chars[32])
        else:
            shown = "".join([self.chars[b] for b in part.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes, before: str) -> bytes:
        text = word.decode()
        core = text.rstrip(".,")
        if core.isalpha() and (word.isascii() or max(core) < "ɐ"):  # letters, then perhaps points and commas
            head = self.parts[before + core]
            return head + self.parts[text[len(core):]] if len(core) < len(text) else head
        if not text or not text[0].isprintable() or not text[-1].isprintable():
            raise _Uneven
        if not (word.isascii() or max(text) < "ɐ") or not text.isprintable():
            return self._whole(before + text)
        return b"".join([self.parts[p] for p in self.split(before + text)])

    def encode(self, text: bytes) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special) or b"\n\n\n" in text or text[:1] == b"\n" or text[-1:] == b"\n":
            return self._whole(text.decode())
        out = []
        try:
            for i, line in enumerate(text.split(b"\n")):
                if i:
                    out.append(self.newline)
                if line:
                    head, *rest = line.split(b" ")
                    out.append(self.first[head])
                    out.extend(map(self.later.__getitem__, rest))
        except _Uneven:
            return self._whole(text.decode())
        return b"".join(out)


# --- repeat counts ----------------------------------------------------------

@cache
def combinations(classes: int = CLASSES, depth: int = DEPTH) -> np.ndarray:
    """All multisets of class lengths 1..classes that sum to ``classes`` with at most
    ``depth`` distinct lengths: a row per length, a column per combination."""
    found: list[list[tuple[int, int]]] = []

    def extend(left: int, largest: int, chosen: list[tuple[int, int]]) -> None:
        if left == 0:
            found.append(chosen)
        if left == 0 or len(chosen) == depth:
            return
        for length in range(min(left, largest), 0, -1):
            for times in range(1, left // length + 1):
                extend(left - length * times, length - 1, [*chosen, (length, times)])

    extend(classes, classes, [])
    out = np.zeros((classes, len(found)))
    for j, chosen in enumerate(found):
        for length, times in chosen:
            out[length - 1, j] = times
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets: the column that lowers the
    error most enters; columns that would turn negative leave."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    floor = 1e-9 * max(1.0, float(np.abs(gradient).max(initial=0.0)))
    for _ in range(3 * a.shape[0]):
        rest = np.where(active, -np.inf, gradient)
        j = int(rest.argmax())
        if rest[j] <= floor:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > 0).all():
                break
            bad = z <= 0
            step = np.min(x[on][bad] / np.maximum(x[on][bad] - z[bad], 1e-300))
            x[on] += step * (z - x[on])
            gone = on[(x[on] <= 1e-12) & bad]
            x[gone], active[gone] = 0.0, False
            if not len(gone):
                break
        x[on] = np.where(active[on], np.maximum(z if len(z) == len(on) else x[on], 0.0), 0.0)
        gradient = a.T @ (b - a @ x)
    return x


def plan_windows(lengths: np.ndarray, window: int = WINDOW) -> tuple[list[list[int]], list[int]]:
    """Of pieces shorter than a window: groups that share a window by the solved
    combinations, and the pieces left over. Indexes into ``lengths``."""
    width = -(-window // CLASSES)
    kind = -(-lengths // width)
    stacks = [np.flatnonzero(kind == c).tolist()[::-1] for c in range(1, CLASSES + 1)]
    columns = combinations()
    repeats = nonnegative_least_squares(columns, SOLVED_SHARE * np.array([len(s) for s in stacks], float))
    groups = []
    for j in np.flatnonzero(repeats >= 1):
        parts = [(stacks[c], int(columns[c, j])) for c in np.flatnonzero(columns[:, j])]
        for _ in range(min(int(repeats[j]), *[len(s) // k for s, k in parts])):
            groups.append([s.pop() for s, k in parts for _ in range(k)])
    return groups, sorted(i for s in stacks for i in s)


Piece = tuple[int, int, int]  # document, start in it, length


def pack(lengths: list[int], window: int = WINDOW) -> list[list[Piece]]:
    """Sequences of pieces; each holds ``window`` tokens or a power of two."""
    sequences: list[list[Piece]] = []
    tails: list[Piece] = []
    for i, n in enumerate(lengths):
        whole = n - n % window
        sequences += [[(i, s, window)] for s in range(0, whole, window)]
        if n > whole:
            tails.append((i, whole, n - whole))
    if not tails:
        return sequences
    groups, rest = plan_windows(np.array([t[2] for t in tails]), window)
    gaps = [window - sum(tails[i][2] for i in g) for g in groups]
    left, missing = sum(tails[i][2] for i in rest), sum(gaps)
    while missing > left:  # too little to fill all gaps: the last groups fill the others' gaps
        missing -= gaps.pop()
        rest += groups[-1]
        left += sum(tails[i][2] for i in groups.pop())
    stream = [tails[i] for i in reversed(rest)]

    def take(n: int) -> list[Piece]:
        out = []
        while n:
            doc, start, length = stream.pop()
            if length > n:
                stream.append((doc, start + n, length - n))
                length = n
            out.append((doc, start, length))
            n -= length
        return out

    for group, gap in zip(groups, gaps):
        sequences.append([tails[i] for i in group] + take(gap))
        left -= gap
    while left:
        n = min(window, 1 << (left.bit_length() - 1))
        sequences.append(take(n))
        left -= n
    return sequences


# --- the job ----------------------------------------------------------------

_WORKER: dict[str, TextEncoder] = {}


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: the document's id, ``start`` in its ids, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence;
    with ``ids`` (array of int) if kept."""
    docs = docs.select(F.col(id_col), F.col(text_col))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * keep_ids]
    end = np.array([end_id], "<u4").tobytes()

    def columns_of(owners: list, ids: list[bytes], first_sequence: int) -> tuple[list[list], int]:
        sequences = pack([len(x) // 4 for x in ids], window)
        out: list[list] = [[] for _ in names]
        for number, pieces in enumerate(sequences):
            offset = 0
            for doc, start, length in pieces:
                part = ids[doc][4 * start: 4 * (start + length)]
                row = [owners[doc], start, length, zlib.crc32(part), len(ids[doc]) // 4, first_sequence + number, offset]
                if keep_ids:
                    row.append(np.frombuffer(part, "<i4"))
                for column, value in zip(out, row):
                    column.append(value)
                offset += length
        return out, len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer_path not in _WORKER:
            _WORKER[tokenizer_path] = TextEncoder(tokenizer_path)
        encoder = _WORKER[tokenizer_path]
        sequence = TaskContext.get().partitionId() << 36
        owners, ids, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            columns, used = columns_of(owners, ids, sequence)
            sequence += used
            kinds = [id_type, *[pa.int64()] * 6, pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for part in slices(batches, text_col):
            id_type = part.schema.field(id_col).type
            for owner, text in zip(part.column(id_col).to_pylist(), text_bytes(part.column(text_col))):
                owners.append(owner)
                ids.append(encoder.encode(text) + end)
                held += len(ids[-1]) // 4
                if len(ids) >= RUN_DOCS or held >= RUN_TOKENS:
                    yield from flush()
                    owners, ids, held = [], [], 0
        if ids:
            yield from flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs, run, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                f"sequence_id bigint, offset bigint" + ", ids array<int>" * keep_ids)
