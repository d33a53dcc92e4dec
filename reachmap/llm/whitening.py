"""Embedding whitening (operator 12): leading components by spectrum slicing.

Entries become whole numbers, so sums, products and deviations over the distinct
vectors are exact: tasks add up slices of centred vectors, Spark adds up the
tasks' sums by pair of dimensions, and only the covariance, whose size is that of
the dimensions alone, comes to the driver. There a symmetric factorisation LDL' of
V - s counts the eigenvalues below a shift s (Sylvester's law of inertia);
bisection by these counts gives every leading eigenvalue an interval of its own,
Rayleigh quotient iteration finishes inside it, and counts on both sides of the
result certify its number. Eigenvalues that no shift can part count as one
of several dimensions, whose vectors are made orthogonal to each other.

Defined results: rows whose vector is null, has null or non-finite entries, or
another length than most rows' (see `vectors.whole_vectors`) go. Every other row
counts, also repeated ones and those without an id; the fit takes each vector
once. Only components with a variance above rounding are returned: at most as many
as the vectors have dimensions, none for equal vectors. A deviation past a long's
range is null. An empty table gives no rows.
"""

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import table
from .vectors import ENTRIES, EXACT, LONG, exact, matrix, scaled, top_size, whole_vectors

COMPONENTS = 16
FACTOR, BASE = 64, 1_000_000
# Bisection stops at this share of the spectrum's width: closer eigenvalues are one.
CLOSEST = 1e-12
# Sums travel as high * PART + low, so that squares of any long stay within a decimal.
PART = 1 << 62
SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def _slices(batch, name="x"):
    """Matrices of the rows of an Arrow batch, of bounded size, with their first row."""
    m = matrix(batch.column(name))
    step = max(1, ENTRIES // max(1, m.shape[1]))
    for a in range(0, len(m), step):
        yield a, m[a : a + step]


def _rows(i, j, total):
    halves = zip(*(divmod(int(t), PART) for t in total))
    kind = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array([Decimal(x) for x in h], kind) for h in halves)],
        names=["i", "j", "high", "low"],
    )


def _totals(df: DataFrame, function) -> dict:
    """Sums over all tasks of what `function` makes of the vectors: one number a pair of dimensions."""
    rows = df.select("x").mapInArrow(function, SUMS).groupBy("i", "j")
    rows = rows.agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r["i"], r["j"]): int(r["high"]) * PART + int(r["low"]) for r in rows.toLocalIterator()}


def sums(df: DataFrame):
    """(number of vectors, exact sum of each dimension)."""

    def of_task(batches):
        n, total = 0, None
        for batch in batches:
            for _, m in _slices(batch):
                part = m.sum(axis=0, dtype=np.int64 if top_size(m) * len(m) <= LONG else object).astype(object)
                n, total = n + len(m), part if total is None else total + part
        if n:
            yield _rows([-1, *range(len(total))], [-1] * (len(total) + 1), [n, *total])

    got = _totals(df, of_task)
    return got.get((-1, -1), 0), [got[i, -1] for i in range(len(got) - 1)]


def covariance(df: DataFrame, n: int, total: list) -> np.ndarray:
    """Covariance, divisor n: vectors are centred at the whole number next to the mean, then multiplied.

    The rest of the mean is taken off in whole numbers too; each entry is rounded once.
    """
    d = len(total)
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * c for s, c in zip(total, centre)]
    upper = np.triu_indices(d)

    def of_task(batches):
        at, out = np.array(centre, dtype=np.int64), None
        for batch in batches:
            for _, m in _slices(batch):
                y = m - at
                size = top_size(y)
                step = max(1, min(len(y), (EXACT - 1) // max(1, size * size)))
                for a in range(0, len(y), step):
                    z = exact(y[a : a + step], size * size * step)
                    part = (z.T @ z)[upper]
                    part = part.astype(np.int64).astype(object) if part.dtype != object else part
                    out = part if out is None else out + part
        if out is not None:
            yield _rows(*upper, out)

    got = _totals(df, of_task)
    v = np.zeros((d, d))
    for (i, j), t in got.items():
        v[i, j] = v[j, i] = (n * t - rest[i] * rest[j]) / (n * n)  # one correctly rounded division
    return v


def below(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of `v` are below `shift`: the negative ones of D in LDL' of V - shift.

    Pivots of one or two rows are chosen as Bunch and Kaufman do, for stability.
    """
    a = v - shift * np.eye(len(v))
    alpha, count = (1 + math.sqrt(17)) / 8, 0
    while len(a):
        if len(a) == 1:
            return count + int(a[0, 0] < 0)
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1
        off = column[r - 1]
        size = 1
        if max(abs(a[0, 0]), off) == 0:
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < alpha * off:
            row = np.abs(a[r])
            row[r] = 0
            top = row.max()
            if abs(a[0, 0]) * top < alpha * off * off:
                swap = 0 if abs(a[r, r]) >= alpha * top else 1
                size = 1 + swap
                a[[swap, r]] = a[[r, swap]]
                a[:, [swap, r]] = a[:, [r, swap]]
        b, c = a[:size, :size], a[size:, :size]
        if size == 1:
            count += int(b[0, 0] < 0)
            a = a[1:, 1:] - np.outer(c[:, 0], c[:, 0]) / b[0, 0]
        else:
            p, q, s = b[0, 0], b[1, 1], b[0, 1]
            det = (p / s) * (q / s) - 1  # below zero for these pivots: one eigenvalue of each sign
            count += 1 if det < 0 else 2 * int(p < 0)
            inverse = np.array([[q / s, -1.0], [-1.0, p / s]]) / (det * s)
            a = a[2:, 2:] - c @ inverse @ c.T
        a = (a + a.T) / 2
    return count


def _inverse_step(v, shift, x):
    """x after a step of inverse iteration, as a unit vector; a singular shift is moved a little."""
    for nudge in (0.0, 1e-15, 1e-14, 1e-13):
        try:
            y = np.linalg.solve(v - (shift + nudge * (np.abs(v).max() or 1)) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(y)
        if np.isfinite(size) and size > 0:
            return y / size
    return x


def _orthogonal(x, others):
    for _ in range(2):
        for u in others:
            x = x - (u @ x) * u
    size = np.linalg.norm(x)
    return x / size if size > 0 else x


def _eigenvector(v, low, high, found, seed):
    """The unit eigenvector for the eigenvalue in [low, high), orthogonal to those found."""
    x = _orthogonal(np.random.default_rng(seed).standard_normal(len(v)), found)
    middle = (low + high) / 2
    for _ in range(3):  # towards the interval's eigenvalue, before the quotient may lead elsewhere
        x = _orthogonal(_inverse_step(v, middle, x), found)
    best, least = x, math.inf
    for _ in range(12):
        quotient = float(x @ v @ x)
        miss = np.linalg.norm(v @ x - quotient * x)
        if low <= quotient <= high and miss < least:
            best, least = x, miss
        elif least < math.inf:
            break  # no better: rounding is reached
        else:
            quotient = middle
        x = _orthogonal(_inverse_step(v, quotient, x), found)
    return best


def leading(v: np.ndarray, most: int = COMPONENTS):
    """(eigenvalues, unit eigenvectors as rows) of the leading components, by falling eigenvalue.

    Those of no variance beyond rounding are left out. Raises ArithmeticError if the
    counts do not confirm a number.
    """
    d = len(v)
    if not d or not np.trace(v) > 0:
        return np.zeros(0), np.zeros((0, d))
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    top, bottom = float((np.diag(v) + radius).max()), float((np.diag(v) - radius).min())
    width = max(top - bottom, abs(top), abs(bottom))
    top, bottom = top + 1e-9 * width, bottom - 1e-9 * width
    tiny, none = CLOSEST * width, max(CLOSEST, d * 1e-15) * width
    # Intervals [low, high) with how many eigenvalues are below either end, largest first.
    stack, parts, wanted = [(bottom, top, 0, d)], [], min(most, d)
    while stack and sum(p[3] - p[2] for p in parts) < wanted:
        low, high, under, over = stack.pop()
        if over == under:
            continue
        isolated = over - under == 1 and high - low < 1e-3 * max(abs(high), tiny)
        if isolated or high - low <= tiny:
            parts.append((low, high, under, over))
            continue
        middle = (low + high) / 2
        inside = min(max(below(v, middle), under), over)
        stack += [(low, middle, under, inside), (middle, high, inside, over)]
    values, vectors = [], []
    for low, high, under, over in parts:
        near, group = [u for e, u in zip(values, vectors) if e - high < 0.1 * width], []
        for k in range(over - under):
            x = _eigenvector(v, low, high, near + [u for _, u in group], len(values) + k)
            group.append((float(x @ v @ x), x))
        for e, x in sorted(group, key=lambda p: -p[0]):
            values.append(e)
            vectors.append(x)
        # No more than `under` lie below the results, and at least `over` up to them.
        margin = 2 * tiny
        if below(v, min(e for e, _ in group) - margin) > under or below(v, max(e for e, _ in group) + margin) < over:
            raise ArithmeticError("inertia counts do not confirm an eigenvalue's number")
    values, vectors = np.array(values[:wanted]), np.array(vectors[:wanted]).reshape(-1, d)
    keep = values > none
    return values[keep], vectors[keep]


class Whitening:
    """What `fit` found: n, exact sums, eigenvalues, unit vectors (rows), trace."""

    def __init__(self, n, total, values, vectors, trace):
        self.n, self.total, self.values, self.vectors, self.trace = n, total, values, vectors, trace
        self.centre = [(2 * s + n) // (2 * n) for s in total] if n else []
        self.rest = [s - n * c for s, c in zip(total, self.centre)]
        self.explained = values / trace if trace > 0 else values

    def parts(self, m):
        """(n * x - sum in whole numbers, whitened) of the rows of a matrix."""
        y = m - np.array(self.centre, dtype=np.int64)
        safe = self.n * top_size(y) + max(map(abs, self.rest), default=0) < 1 << 31
        kind = np.int64 if safe else object
        scaled_up = y.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        centred = scaled_up.astype(np.float64) / self.n
        return scaled_up, centred @ self.vectors.T / np.sqrt(self.values)


def fit(df: DataFrame, most: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors `x` of a table (written once, read by each pass)."""
    once = cut(df.select("x").distinct(), "whitening-fit")
    n, total = sums(once)
    v = covariance(once, n, total) if n else np.zeros((0, 0))
    values, vectors = leading(v, most)
    found = Whitening(n, total, values, vectors, float(np.trace(v)))
    found.error = identity_error(once, found) if len(values) else 0.0
    return found


def identity_error(df: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over `df`.

    Whitened vectors have mean zero, as x - S/n has: its rest of rounding is taken off as well.
    """
    k = len(found.values)
    schema = "i int, j int, total double"
    upper = np.triu_indices(k)

    def of_task(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, m in _slices(batch):
                w = found.parts(m)[1]
                first += w.sum(axis=0)
                second += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*[-1] * k, *upper[0]], pa.int32()),
                pa.array([*range(k), *upper[1]], pa.int32()),
                pa.array([*first, *second[upper]], pa.float64()),
            ],
            names=["i", "j", "total"],
        )

    rows = df.select("x").mapInArrow(of_task, schema).groupBy("i", "j").agg(F.sum("total").alias("total"))
    got = {(r["i"], r["j"]): r["total"] / found.n for r in rows.toLocalIterator()}
    return max(abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i, j in zip(*upper))


def whiten(df: DataFrame, found: Whitening, key: str = "vec_id") -> DataFrame:
    """A row for each row of `df` (key, x) and component."""
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    k = len(found.values)

    def of_task(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, m in _slices(batch):
                up, w = found.parts(m)
                small = up.dtype != object and top_size(up) ** 2 * up.shape[1] <= LONG
                squares = (up * up).sum(axis=1) if small else (up.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(s) if s <= LONG else None for s in squares], pa.int64())
                each = pa.array(np.repeat(np.arange(len(m)), k))
                count = len(m) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, len(m)).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))),
                        pa.array(np.full(count, found.n, dtype=np.int64)),
                        deviation.take(each),
                        pa.array(w.ravel()),
                        pa.array(np.tile(found.explained, len(m))),
                        pa.array(np.full(count, found.error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    if not k:
        return df.sparkSession.createDataFrame([], schema)
    return df.select(key, "x").mapInArrow(of_task, schema)


def op12_whitening(spark, sf_dir):
    rows = whole_vectors(table(spark, sf_dir, "embeddings"))
    rows = rows.select("vec_id", scaled(F.col("embedding"), FACTOR, BASE).alias("x"))
    return whiten(rows, fit(rows))
