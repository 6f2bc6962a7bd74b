"""Whitening of embeddings by shifted CholeskyQR.

An entry c becomes the whole number x = floor(256 c). The fit list holds each
distinct x vector once, n of them: vectors are packed into bytes, made distinct by
one shuffle (copies are merged in the tasks that read them) and written once. With
A the fit list's rows less their mean, every pass sums QᵀQ over the tasks, where Q
is A solved against the triangular factors so far, takes its Cholesky factor and
puts it before the others. The first pass adds a shift to the diagonal, so that the
factor exists however ill-conditioned A is; so does a later one if it must. Passes
end when QᵀQ is near enough to the identity for the factor to make Q orthonormal
to rounding. The composed factor R has A's singular values and right singular
vectors: its SVD gives eigenvalues and components of the covariance without
squaring their condition.

Tasks hold a block of rows and one matrix of d x d. The driver receives sums of d
and of d x d numbers, whatever the number of rows.

Defined results: rows whose vector is null or holds null, NaN or infinite entries
are left out. Vectors of another length than most distinct vectors have (of two
equally frequent, the longer counts) are left out too, since they have no place in
one covariance. An x beyond 64 bits is the nearest number of 64 bits. ``deviation``
is null where it exceeds 64 bits. Components whose variance is zero to rounding do
not exist: a fit list of one vector, or an empty table, has none, and so no rows.
Repeated rows and ids give repeated rows; a null id stays null. Of equal
eigenvalues any basis may come, the same for all rows; a component's largest entry
is positive. Vectors of any length are whole in one task; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import map_arrow, shared_table

SCALE = 256
COMPONENTS = 4
#: Passes at most. Two do for most data, three for any of full rank (a singular
#: covariance never comes to the identity, and its null directions do not matter).
PASSES = 5
#: QᵀQ this near to the identity: its factor leaves Q orthonormal to rounding.
NEAR = 0.1
#: Least variance of a component, as a share of the first one's.
LEAST = 1e-24
#: Numbers of a block of rows.
BLOCK = 1 << 20
_LARGEST = float(1 << 63)


# --- vectors ----------------------------------------------------------------

def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a list column: per length their rows and x, as a matrix."""
    flat = pc.list_flatten(column)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries come as NaN
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[begin + sizes] == bad[begin])
    for d in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == d))
        for some in np.array_split(rows, -(-len(rows) * max(d, 1) // BLOCK)):
            with np.errstate(over="ignore"):
                x = np.floor(values[begin[some, None] + np.arange(d)] * SCALE)
            fits = np.abs(x) < _LARGEST
            exact = np.where(fits, x, 0).astype(np.int64)
            yield some, np.where(fits, exact, np.where(x > 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min))


def packed(x: np.ndarray) -> Iterator[pa.Array]:
    """The rows as bytes: the width of an entry, then all entries in the least width
    (2, 4 or 8) that holds them. Equal vectors have equal bytes."""
    low, high = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    done = np.zeros(len(x), bool)
    for width in (2, 4, 8):
        info = np.iinfo(f"<i{width}")
        chosen = ~done & (low >= info.min) & (high <= info.max)
        done |= chosen
        if chosen.any():
            body = np.ascontiguousarray(x[chosen].astype(f"<i{width}")).view(np.uint8).reshape(int(chosen.sum()), -1)
            rows = np.concatenate([np.full((len(body), 1), width, np.uint8), body], axis=1)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
            yield pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def unpacked(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    """The vectors of ``packed``, in blocks."""
    values = [v.as_buffer() for v in column]
    for width in (2, 4, 8):
        own = [v for v in values if len(v) == 1 + width * d]
        step = max(1, BLOCK // max(d, 1))
        for i in range(0, len(own), step):
            rows = np.frombuffer(b"".join(own[i:i + step]), np.uint8).reshape(-1, 1 + width * d)
            yield np.ascontiguousarray(rows[:, 1:]).view(f"<i{width}").astype(np.int64)


def fit_list(rows: DataFrame, vector_col: str) -> DataFrame:
    """``(d, x)``: each distinct usable vector once, with its length, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in whole_vectors(batch.column(0)):
                for data in packed(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(data), x.shape[1]), pa.int32()), data], ["d", "x"])

    return map_arrow(rows.select(vector_col), pack, "d int, x binary").distinct()


# --- sums over the fit list -------------------------------------------------

class Centre(NamedTuple):
    """n and S of the fit list, S as n * q + r per dimension with 0 <= r < n."""
    n: int
    q: np.ndarray
    r: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part is exact, so that large means cost no digits."""
        reach = int(np.abs(x).max(initial=0)) if x.min(initial=0) > np.iinfo(np.int64).min else 1 << 63
        far = reach + int(np.abs(self.q).max(initial=0)) >= 1 << 63
        whole = (x.astype(object) - self.q.astype(object)).astype(float) if far else (x - self.q.astype(np.int64)).astype(float)
        return whole - (self.r / self.n).astype(float)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)² over the dimensions, exact; None beyond 64 bits."""
        d = x.shape[1]
        y = x.astype(object) - self.q if abs(x).max(initial=0) >= 1 << 60 or x.min(initial=0) < -(1 << 60) else None
        if y is None and max((abs(int(v)) for v in self.q), default=0) < 1 << 60:
            y = x - self.q.astype(np.int64)
        if y is None:
            y = x.astype(object) - self.q
        most = max((abs(int(v)) for v in (y.max(initial=0), y.min(initial=0))), default=0)
        if y.dtype == object or d * most * max(most, self.n) >= 1 << 62:
            total = ((self.n * y.astype(object) - self.r) ** 2).sum(axis=1).tolist()
        else:  # (n y - r)² = n² y² - 2 n r y + r², the sums of y² and r y in 64 bits
            squares, mixed = (y * y).sum(axis=1).tolist(), (y @ self.r.astype(np.int64)).tolist()
            rest = sum(int(v) ** 2 for v in self.r)
            total = [self.n * self.n * a - 2 * self.n * b + rest for a, b in zip(squares, mixed)]
        return [v if v < 1 << 63 else None for v in total]


def centre_of(points: DataFrame, d: int) -> Centre:
    """Exact sums: halves of 32 bits in the tasks, whole numbers of any size after."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for x in unpacked(batch.column(0), d):
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            columns = [np.arange(d), np.full(d, n), high, low]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["i", "n", "high", "low"])

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = map_arrow(points, sums, "i bigint, n bigint, high bigint, low bigint").groupBy("i").agg(total("n"), total("high"), total("low")).collect()
    found = sorted(found, key=lambda row: row.i)  # one row per dimension
    n = int(found[0].n)
    s = [(int(row.high) << 32) + int(row.low) for row in found]
    return Centre(n, np.array([v // n for v in s], object), np.array([v % n for v in s], object))


def gram(points: DataFrame, d: int, width: int, block_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of QᵀQ over the fit list, Q = ``block_of`` a block of vectors, with
    ``width`` columns: one matrix per task, merged entry by entry."""
    i, j = np.triu_indices(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            for x in unpacked(batch.column(0), d):
                q = block_of(x)
                total += q.T @ q
                seen = True
        if seen:
            columns = [pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(total[i, j])]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    merged = map_arrow(points, sums, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for row in merged.collect():  # width² / 2 rows at most
        out[row.i, row.j] = out[row.j, row.i] = row.v
    return out


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q R = A, R upper triangular: one column after the other."""
    q = np.empty_like(a)
    for j in range(len(r)):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def triangular_factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper R with RᵀR = G, or G and a shift where asked for or needed."""
    d = len(g)
    shift = 11 * (n * d + d * (d + 1)) * 2.0 ** -53 * float(np.linalg.norm(g, 2))
    shift = min(shift, float(np.linalg.norm(g, 2)) * 1e-3)  # of very many rows the bound would drown the data
    if not shifted:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 16


class Whitening(NamedTuple):
    centre: Centre
    components: np.ndarray  # d x k, columns of unit length
    variances: np.ndarray  # k eigenvalues, falling
    explained: np.ndarray  # k shares of the trace
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.variances)


def fit(points: DataFrame, d: int, most: int = COMPONENTS) -> Whitening | None:
    """The first ``most`` components of the fit list ``(x)`` of vectors of length d."""
    centre = centre_of(points, d)
    factors: list[np.ndarray] = []
    for step in range(PASSES):
        def orthogonal(x: np.ndarray, factors=tuple(factors)) -> np.ndarray:
            q = centre.centred(x)
            for r in factors:
                q = solved(q, r)
            return q

        g = gram(points, d, d, orthogonal)
        if not g.any():
            return None  # one vector only
        factors.append(triangular_factor(g, centre.n, shifted=step == 0))
        if step and np.linalg.norm(g - np.eye(d), 2) <= NEAR:
            break
    r = factors[0]
    for later in factors[1:]:
        r = later @ r
    _, singular, right = np.linalg.svd(r)
    variances = singular ** 2 / centre.n
    k = int((variances[:most] > LEAST * variances[0]).sum())
    components = right[:k].T
    components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(k)])
    model = Whitening(centre, components, variances[:k], variances[:k] / variances.sum(), 0.0)
    covariance = gram(points, d, k, model.whitened) / centre.n
    return model._replace(identity_error=float(np.abs(covariance - np.eye(k)).max()))


# --- the job ----------------------------------------------------------------

def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: id, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``."""
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    points = shared_table(fit_list(rows, vector_col), "vectors")
    common = points.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common.d if common else 0
    model = fit(points.where(F.col("d") == d).select("x"), d, components) if d else None
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole_vectors(batch.column(1)):
                if x.shape[1] != d:
                    continue
                m = len(at)
                each = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n)),
                        pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))]
                owner = batch.column(0).take(pa.array(np.repeat(at, k)))
                yield pa.RecordBatch.from_arrays([owner, *each], [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(rows.select(id_col, vector_col), project, schema)
