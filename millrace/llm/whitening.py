"""Whitening of embedding vectors by a pivoted Cholesky factor and one-sided Jacobi.

Entries become whole numbers, so sums and the scatter about a whole-number centre
are exact and do not depend on how rows lie in files or tasks. The scatter has as
many rows as a vector has entries; it is the only thing that reaches the driver.
There it is factored with pivoting, one-sided Jacobi rotates the columns of the
triangular factor until they are orthogonal, their squared norms are the
eigenvalues and the normalised columns the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.staging import remove, stage

#: Entries are scaled by this and rounded down, then moved by ``SHIFT`` (fixed values).
SCALE, SHIFT = 64, 1_000_000

#: Vectors that a task multiplies at once.
_ROWS = 16_384

_EXACT = pa.decimal128(38, 0)


def _codes(vectors: pa.Array, scale: int) -> list[bytes | None]:
    """A byte string for each vector of whole numbers, the same for equal ones; None for unusable vectors.

    The first byte is the width of a number, the least of 2, 4 and 8 that holds all of them.
    """
    out: list[bytes | None] = [None] * len(vectors)
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        with np.errstate(invalid="ignore", over="ignore"):
            y = np.floor(scale * flat[starts[rows][:, None] + np.arange(size)])
            # also false where an entry is null or not finite
            high = np.abs(y).max(axis=1)
            usable = high < 2.0 ** 62
        rows, y, high = rows[usable], y[usable].astype(np.int64), high[usable]
        for width, low, top in ((2, 0, 2 ** 15), (4, 2 ** 15, 2 ** 31), (8, 2 ** 31, 2 ** 62)):
            here = np.flatnonzero((high >= low) & (high < top))
            for row, vector in zip(rows[here], y[here].astype(f"<i{width}")):
                out[row] = bytes([width]) + vector.tobytes()
    return out


def vector_code(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * entry)`` of all entries as bytes; null for null, empty and unusable vectors."""
    @F.arrow_udf("binary")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_codes(batch, scale), pa.binary())
    return made(vector)


def _length(code: Column) -> Column:
    """Number of entries of a code."""
    width = F.conv(F.hex(F.substring(code, 1, 1)), 16, 10).cast("int")
    return ((F.octet_length(code) - 1) / width).cast("int")


def _numbers(codes: list[bytes], size: int) -> np.ndarray:
    """Whole numbers of codes of one length, a row each."""
    found = np.empty((len(codes), size), np.int64)
    widths = np.fromiter((c[0] for c in codes), np.int64, len(codes))
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        found[rows] = np.frombuffer(b"".join(codes[r][1:] for r in rows), f"<i{width}").reshape(len(rows), size)
    return found


def _exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers without rounding, as Python integers."""
    if not len(a):
        return np.zeros((a.shape[1], b.shape[1]), object)
    most = max(abs(int(a.max())), abs(int(a.min())), 1) * max(abs(int(b.max())), abs(int(b.min())), 1) * len(a)
    if most < 1 << 53:
        return (a.T.astype(float) @ b.astype(float)).astype(np.int64).astype(object)
    if most < 1 << 62:
        return (a.T @ b).astype(object)
    return a.T.astype(object) @ b.astype(object)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        codes = batch.column(0).to_pylist()
        for low in range(0, len(codes), _ROWS):
            yield _numbers(codes[low:low + _ROWS], size)


def _exact(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], _EXACT)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every entry."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((1, size), object)
        for y in _blocks(batches, size):
            n += len(y)
            total = total + _exact_product(np.ones((len(y), 1), np.int64), y)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), _exact([n, *total[0]])], ["i", "part"])

    found = {r.i: int(r.total) for r in fit.mapInArrow(partial, "i int, part decimal(38,0)").groupBy("i").agg(
        F.sum("part").alias("total")).collect()}
    return found[-1], [found[i] for i in range(size)]


def _scatter(fit: DataFrame, centre: np.ndarray) -> list[list[int]]:
    """Sums of the products of entries, each less its whole-number centre."""
    size = len(centre)
    i, j = np.triu_indices(size)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for y in _blocks(batches, size):
            z = y - centre
            total = total + _exact_product(z, z)
        for low in range(0, len(i), 65_536):
            at = slice(low, low + 65_536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[at].astype(np.int32)), pa.array(j[at].astype(np.int32)), _exact(total[i[at], j[at]])], ["i", "j", "part"])

    found = [[0] * size for _ in range(size)]
    for r in fit.mapInArrow(partial, "i int, j int, part decimal(38,0)").groupBy("i", "j").agg(
            F.sum("part").alias("total")).collect():
        found[r.i][r.j] = found[r.j][r.i] = int(r.total)
    return found


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Columns L with L L' = ``matrix``, the largest remaining diagonal first; as many as the rank.

    A row is used up when nothing but rounding is left of its own diagonal entry, so
    small entries count beside ones that are larger by any factor.
    """
    rest = np.diag(matrix).astype(float).copy()
    size, columns = len(rest), []
    least = 10 * size * np.finfo(float).eps * rest
    for _ in range(size):
        rest[rest <= least] = -np.inf
        pivot = int(np.argmax(rest))
        if rest[pivot] == -np.inf:
            break
        column = matrix[:, pivot].astype(float)
        for known in columns:
            column = column - known[pivot] * known
        column = column / np.sqrt(rest[pivot])
        # rows that have been pivots or are used up are done
        column[rest == -np.inf] = 0.0
        columns.append(column)
        rest = rest - column ** 2
        rest[pivot] = -np.inf
    return np.array(columns).T if columns else np.empty((size, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and directions (rows) of the columns of ``factor`` rotated until they are orthogonal, largest first."""
    rows = np.ascontiguousarray(factor.T)
    count = len(rows)
    seats = list(range(count + count % 2))
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            # a round of a tournament: every column meets one other
            pairs = np.array([(a, b) for a, b in zip(seats[:len(seats) // 2], seats[::-1]) if a < count and b < count])
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not len(pairs):
                continue
            p, q = rows[pairs[:, 0]], rows[pairs[:, 1]]
            a, b, c = (p * p).sum(axis=1), (q * q).sum(axis=1), (p * q).sum(axis=1)
            turn = np.abs(c) > 4 * np.finfo(float).eps * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            pairs, p, q, a, b, c = pairs[turn], p[turn], q[turn], a[turn], b[turn], c[turn]
            zeta = (b - a) / (2 * c)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            rows[pairs[:, 0]] = cosine[:, None] * p - sine[:, None] * q
            rows[pairs[:, 1]] = sine[:, None] * p + cosine[:, None] * q
        if not turned:
            break
    values = (rows * rows).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], rows[order] / np.sqrt(values[order])[:, None]


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors, whole-number ``centre``, exact ``rest`` = sums - n centre, eigenvalues, components (rows)."""
    n: int
    centre: np.ndarray
    rest: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number vectors.

        Added up entry by entry: a matrix product rounds differently with the number of rows.
        """
        shift = np.array([r / self.n for r in self.rest])
        z, weights = (y - self.centre) - shift, self.components / np.sqrt(self.values)[:, None]
        total = np.zeros((len(z), len(weights)))
        for entry, weight in zip(z.T, weights.T):
            total += entry[:, None] * weight
        return total

    def deviations(self, y: np.ndarray) -> list[int]:
        """Exact sum over the entries of (n x - S) squared."""
        z = y - self.centre
        most = max(abs(int(z.max(initial=0))), abs(int(z.min(initial=0))), 1) * z.shape[1]
        rest = np.array(self.rest, object)
        wide = most * max(most, *[abs(r) for r in self.rest], 1) >= 1 << 62
        z, rest = (z.astype(object), rest) if wide else (z, rest.astype(np.int64))
        own, cross, last = (z * z).sum(axis=1), z @ rest, sum(r * r for r in self.rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + last for a, b in zip(own, cross)]


def fit_whitening(fit: DataFrame, size: int, components: int) -> Whitening:
    """``fit``: distinct ``code`` of vectors with ``size`` entries, one at least."""
    n, sums = _sums(fit, size)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    about = _scatter(fit, np.array(centre, np.int64))
    # n times the scatter about the mean, exactly; each quotient is rounded once
    scaled = [[n * about[i][j] - rest[i] * rest[j] for j in range(size)] for i in range(size)]
    scatter = np.array([[v / n for v in row] for row in scaled])
    values, found = one_sided_jacobi(pivoted_cholesky(scatter))
    found = found * np.where(np.take_along_axis(found, np.abs(found).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0) if len(found) else found
    trace = sum(scaled[i][i] for i in range(size)) / (n * n)
    return Whitening(n, np.array(centre, np.int64), rest, values[:components] / n, found[:components], trace)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity."""
    size, count = len(model.centre), len(model.values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, count + 1))
        for y in _blocks(batches, size):
            w = model.project(y)
            total += np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
        at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], ["i", "j", "part"])

    total = np.zeros((count, count + 1))
    for r in fit.mapInArrow(partial, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        total[r.i, r.j] = r.total
    total /= model.n
    return float(np.abs(total[:, :-1] - np.outer(total[:, -1], total[:, -1]) - np.eye(count)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16,
           scale: int = SCALE) -> DataFrame:
    """Whitened coordinates of every usable row, a row for each component.

    Entries become x = floor(scale entry) + ``SHIFT``. Mean and covariance (divisor n)
    are those of the distinct x vectors. Columns: key, ``component`` (from 1, by falling
    eigenvalue e), ``n``, ``deviation`` (sum over the entries of (n x - S) squared, exact
    to 38 digits), ``whitened`` ((x - S/n) on the component over sqrt(e)), ``explained``
    (e over the trace), ``identity_error`` (how far the covariance of the whitened fit
    list is from the identity).

    Rows go whose vector is null, empty, or holds null or non-finite entries or entries
    of 2**62 or more, and rows whose vector has another length than most distinct ones
    (the larger of equally frequent lengths stays). Repeated rows and null keys stay;
    other columns are left out. There are as many components as the covariance has rank,
    up to ``components``: vectors that are all equal, and an empty table, give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("key"), vector_code(F.col(vector), scale).alias("code"))
    fit, path = stage(rows.where("code IS NOT NULL").select("code").distinct(), "fit")
    sizes = fit.groupBy(_length(F.col("code")).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if most is not None:
        size = most["size"]
        fit = fit.where(_length(F.col("code")) == size)
        model = fit_whitening(fit, size, components)
        error = _identity_error(fit, model) if len(model.values) else 0.0
    else:
        size, error, model = 0, 0.0, Whitening(0, np.empty(0), [], np.empty(0), np.empty((0, 0)), 0.0)
    remove(spark, path)

    @F.arrow_udf("struct<deviation: decimal(38,0), whitened: array<double>>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            y = _numbers(batch.to_pylist(), size)
            limit = 10 ** 38
            deviations = [Decimal(d) if d < limit else None for d in model.deviations(y)]
            yield pa.StructArray.from_arrays([pa.array(deviations, _EXACT), pa.array(list(model.project(y)), pa.list_(pa.float64()))],
                                             ["deviation", "whitened"])

    count = len(model.values)
    if not count:
        return rows.where("false").select(
            F.col("key").alias(key), F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"),
            F.lit(None).cast("decimal(38,0)").alias("deviation"), *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    usable = rows.where(F.col("code").isNotNull()).where(_length(F.col("code")) == size)
    found = usable.select("key", made(F.col("code")).alias("made")).select(
        "key", "made.deviation", F.posexplode("made.whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return found.select(F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                        "deviation", "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def _query(spark, folder):
    """Exact deviations beyond 64 bits are null here; the operator itself has 38 digits."""
    from millrace.llm.catalog import table
    found = whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {"op12_whitening": (_query, None)}
