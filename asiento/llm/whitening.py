"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

The centred rows X are never gathered. Each step multiplies them by one right vector and, in the same pass
over all rows, the result by their transpose; tasks send back sums no longer than a few vectors. Left and
right vectors are orthogonalised against all earlier ones. The small bidiagonal matrix that is left has the
singular values of X (the deviations), and its right vectors, turned back, are the components.

A left vector is as long as the table, but it is X p for some p as long as a row: only p is kept, and tasks
compute their rows of it anew, so a lost executor loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import stored

COMPONENTS = 32
#: Entries become floor(SCALE * c) + SHIFT; beyond LARGEST they would not be exact as doubles.
SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 45)
#: Bytes of a block of vectors.
BLOCK_BYTES = 1 << 20
#: What is shorter than this share of the largest singular value is zero.
ZERO = 1e-11
#: A component is done when its residual is below this share of the largest singular value.
DONE = 1e-15

RESULT = "id long, component int, deviation long, whitened double, explained double"


class Centre:
    """Exact mean S / n of integer rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self._whole = np.array([s // n for s in sums], np.int64)
        self._rest = np.array([s % n for s in sums], np.int64)

    def off(self, x: np.ndarray) -> np.ndarray:
        return (x - self._whole) - self._rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2 over the dimensions, exact; None where that is no 64-bit number."""
        off = x - self._whole
        largest = self.n * (float(np.abs(off).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 2.0**62:
            return ((off * self.n - self._rest) ** 2).sum(axis=1).tolist()
        exact = ((off.astype(object) * self.n - self._rest.astype(object)) ** 2).sum(axis=1)
        return [value if value < 1 << 63 else None for value in exact]


class Blocks:
    """Integer vectors of one length, stored as blocks of bytes with the ids of their rows."""

    def __init__(self, rows: DataFrame, dim: int):
        self.dim = dim
        self.df = stored(rows.select("id", "v").mapInArrow(_packer(dim), "ids array<long>, x binary"), "blocks")

    def total(self, function: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
        """Sum over all blocks of an array of fixed length."""
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for x in (x for batch in batches for x in _matrices(batch.column(0), dim)):
                part = function(x)
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "value"])

        source = "long" if kind.startswith("decimal") else kind
        parts = self.df.select("x").mapInArrow(run, f"at int, value {source}")
        sums = parts.groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
        return [r.value for r in sorted(sums.collect(), key=lambda r: r.at)]  # as many as the array is long


def _packer(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    size = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                entries = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                parts.append(np.floor(SCALE * entries).astype("<i8") + SHIFT)
                ids.extend(part.column(0).to_pylist())
                n += part.num_rows
                if n >= size:
                    yield _block(ids, parts)
                    ids, parts, n = [], [], 0
        if n:
            yield _block(ids, parts)

    return run


def _block(ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
    x = np.concatenate(parts).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([x], pa.binary())], ["ids", "x"])


def _matrices(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    for value in column:
        yield np.frombuffer(value.as_buffer(), "<i8").reshape(-1, dim)


def _orthogonal(v: np.ndarray, to: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - to @ (to.T @ v)
    return v


def singular_components(
    multiply: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]],
    dim: int,
    wanted: int = COMPONENTS,
    seed: int = 11,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of X above zero, and their right vectors in rows.

    ``multiply(q, p)`` is one pass over X: with t = X q it gives X't, (X p)'t and t't.
    """
    random = np.random.default_rng(seed)
    right = np.zeros((dim, 0))  # right vectors v in columns
    left, back = np.zeros((dim, 0)), np.zeros((dim, 0))  # p of each left vector u = X p, and X'u
    alphas, betas, largest = [], [], 0.0
    v = random.standard_normal(dim)
    v /= np.linalg.norm(v)
    while True:
        right = np.column_stack([right, v])
        q = v - betas[-1] * left[:, -1] if betas else v
        while True:
            turned, overlap, square = multiply(q, left)
            length = np.sqrt(max(0.0, square - overlap @ overlap))
            largest = max(largest, np.sqrt(square) / np.linalg.norm(q), np.sqrt(square))
            q, turned = q - left @ overlap, turned - back @ overlap
            if length <= ZERO * largest or length > 0.7 * np.sqrt(square):
                break  # nothing is left, or little was taken away: orthogonal
        if length <= ZERO * largest:
            alpha, p, u_back = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            alpha, p, u_back = length, q / length, turned / length
        alphas.append(alpha)
        left, back = np.column_stack([left, p]), np.column_stack([back, u_back])
        rest = _orthogonal(u_back - alpha * v, right)
        beta, k = float(np.linalg.norm(rest)), len(alphas)
        bidiagonal = np.diag(alphas) + np.diag(betas, 1)
        u, values, vt = np.linalg.svd(bidiagonal)
        largest = max(largest, values[0])
        if beta > ZERO * largest:
            residuals = beta * np.abs(u[-1, :wanted])
            if k >= wanted and (residuals <= DONE * values[0]).all():
                break
            v = rest / beta
        else:  # the vectors so far reach no others: go on from a new direction, if there is one
            beta = 0.0
            v = _orthogonal(random.standard_normal(dim), right) if k < dim else np.zeros(dim)
            if k < dim:
                v /= np.linalg.norm(v)
        if k == dim:
            break
        betas.append(beta)
    keep = np.flatnonzero(values[:wanted] > ZERO * max(values[0], 1e-300))
    components = (right @ vt.T).T[keep]
    return values[keep], components / np.linalg.norm(components, axis=1, keepdims=True)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", embedding: str = "embedding", wanted: int = COMPONENTS
) -> DataFrame:
    """``id_column, component, n, deviation, whitened, explained, identity_error``: a row per vector and component.

    Entries c become the integers x = floor(64 c) + 1,000,000; n vectors with sums S are the fit list, which
    is every usable vector. ``whitened`` is x - S / n projected on the component, divided by the root of its
    eigenvalue; ``explained`` the eigenvalue's share of the covariance's trace; ``deviation`` the sum of
    (n x - S)^2 over the dimensions (null if it is no 64-bit number); ``identity_error`` the largest absolute
    entry of the covariance of all ``whitened`` minus the identity.

    Vectors that are null, empty or hold null, NaN or infinite entries, or entries of 2^45 and more, have no
    row; of vectors of different lengths those of the most frequent length (the smallest of several) are
    used. Directions without variance are no components, so equal vectors alone, or a single one, have no
    rows. Rows that share an id each count and each have their rows, rows with a null id too; further columns
    are ignored. No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.filter(F.coalesce((F.size("v") > 0) & usable, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = spark.createDataFrame([], RESULT)
    if common is None:
        return _result(empty, id_column, 0, None)
    dim, n = common["dim"], common["count"]
    blocks = Blocks(rows.filter(F.size("v") == dim), dim)
    centre = Centre(n, [int(s) for s in blocks.total(lambda x: x.sum(axis=0), "decimal(38,0)")])
    trace = blocks.total(lambda x: np.array([np.square(centre.off(x)).sum()]))[0] / n

    def multiply(q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            off = centre.off(x)
            t = off @ q
            return np.concatenate([off.T @ t, (off @ p).T @ t, [t @ t]])

        sums = np.array(blocks.total(part))
        return sums[:dim], sums[dim:-1], float(sums[-1])

    if not trace:
        return _result(empty, id_column, n, None)
    values, components = singular_components(multiply, dim, wanted)
    turn = (components * (np.sqrt(n) / values)[:, None]).T
    explained, r = values**2 / n / trace, len(values)
    means = np.array(blocks.total(lambda x: (centre.off(x) @ turn).sum(axis=0))) / n

    def covariance(x: np.ndarray) -> np.ndarray:
        z = centre.off(x) @ turn - means
        return (z.T @ z).ravel()

    error = np.abs(np.array(blocks.total(covariance)).reshape(r, r) / n - np.eye(r)).max()

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.arange(1, r + 1, dtype=np.int32)
        for batch in batches:
            for ids, x in zip(batch.column(0), _matrices(batch.column(1), dim), strict=True):
                deviations = pa.array(centre.deviations(x), pa.int64())
                each = pa.array(np.repeat(np.arange(len(x)), r))
                columns = [
                    ids.values.take(each), pa.array(np.tile(at, len(x))), deviations.take(each),
                    pa.array((centre.off(x) @ turn).ravel()), pa.array(np.tile(explained, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "deviation", "whitened", "explained"])

    return _result(blocks.df.mapInArrow(rows_of, RESULT), id_column, n, float(error))


def _result(rows: DataFrame, id_column: str, n: int, error: float | None) -> DataFrame:
    return rows.select(
        F.col("id").alias(id_column), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        "explained", F.lit(error).cast("double").alias("identity_error"),
    )
