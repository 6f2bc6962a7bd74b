"""Helpers shared by the operators: shared scratch tables, text batches, word hashes."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sparktrips
from sparktrips.session import ensure_checkpoint_dir, scratch_path

#: Bytes that separate words: blank and the control characters 9 to 13.
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same set as a character class for Java, RE2 and Python patterns.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_U = np.uint64


# --- the package on the executors -------------------------------------------

_SHIPPED: set[str] = set()


#: Rows of an Arrow batch, unless the session sets its own number: texts are long, and
#: a batch is held by the JVM and by the Python worker.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their
    Python workers can import it wherever they were started."""
    sc = spark.sparkContext
    name, default, ours = BATCH_ROWS
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, ours)
    if sc.applicationId in _SHIPPED:
        return
    root = Path(sparktrips.__file__).parent
    folder = tempfile.mkdtemp(prefix="sparktrips-package-")  # the driver serves the archive from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{folder}/sparktrips-package", "zip", root.parent, root.name))
    _SHIPPED.add(sc.applicationId)


def release_memory() -> None:
    """Gives memory that the worker no longer uses back to the system: workers live as
    long as the application, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors; a task's memory is
    released at its end."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


# --- scratch data -----------------------------------------------------------

def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.
    For wide or large intermediate results, which a checkpoint would store
    row by row and without compression."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- text batches -----------------------------------------------------------

def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 21,
           most_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of at most ``most_rows`` rows and ``most_bytes`` of
    text (a single longer text is a run of its own)."""
    for batch in batches:
        sizes = _byte_ends(batch.column(column))
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + most_bytes, side="right")))
            to = min(to, at + most_rows)
            yield batch.slice(at, to - at)
            at = to


def _byte_ends(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))


class Memo(dict):
    """Bounded cache of ``fn``: when it holds ``limit`` new entries, they become
    the old generation and a new one begins. ``fixed`` entries always stay."""

    def __init__(self, fn: Callable, limit: int, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.fn, self.limit, self.fixed, self.old = fn, limit + len(self), fixed or {}, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        self[key] = value
        return value


# --- word hashes ------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 2 * _BLOCK)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, _U(base), dtype=_U)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts, A-Z lower-cased, as
    64-bit hashes. ``hashes`` are in text order; text i owns
    ``hashes[first[i]:first[i + 1]]``. Other bytes may separate words, by a
    table of 256 flags."""

    def __init__(self, texts: list[bytes], separator: np.ndarray = _IS_SEPARATOR):
        data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]) if texts else np.zeros(1, np.int64)
        inside = ~separator[data]
        bound = np.zeros(len(data) + 1, bool)
        bound[offsets] = True
        after_gap = np.concatenate([[True], ~inside[:-1]]) if len(data) else np.zeros(0, bool)
        before_gap = np.concatenate([~inside[1:], [True]]) if len(data) else np.zeros(0, bool)
        self.start = np.flatnonzero(inside & (after_gap | bound[:-1]))
        self.end = np.flatnonzero(inside & (before_gap | bound[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.data, self.offsets = data, offsets
        self.hashes = self._hash()

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.start), _U)
        block = self.start // _BLOCK
        edges = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *edges], [*edges, len(block)]):
            if a == b:
                continue
            low, high = self.start[a], self.end[b - 1]
            up, down = _powers(high - low + 1)
            total = np.zeros(high - low + 1, _U)
            np.cumsum(_BYTE[self.data[low:high]] * up[: high - low], out=total[1:])
            s, e = self.start[a:b] - low, self.end[a:b] - low
            out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(_U))
        return out


def crc_mod(column, modulus: int):
    """crc32 of a column's text, modulo ``modulus`` (null: of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus
