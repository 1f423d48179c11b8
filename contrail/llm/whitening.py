"""Embedding whitening from exact polarised variances.

Entries become whole numbers x = floor(256 * c). The model is fitted on the
distinct x vectors, each once. Tasks sum, exactly, the squared centred values of
every dimension and of every sum of two dimensions; with z = n*x - S,

    2 * sum(z_i * z_j) = sum((z_i + z_j)^2) - sum(z_i^2) - sum(z_j^2),

so differences of variances give all covariances as exact fractions. They are
rounded once, assembled, and handed to ``eigh``. Inside tasks the values are
centred by the rounded mean m: with y = x - m and d = S - n*m the identity
sum(z^2) = n^2 * sum(y^2) - n * d^2 is exact and keeps the squares small. Only
the dimension-pair sums, whose number does not depend on the rows, reach the
driver.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries take no part; of the others the dimension is the commonest length (of
equally common ones the larger), and other lengths take no part. Repeated rows
stay in the result and count once in the fit. Entries beyond 64 bits are held at
their ends. A deviation that no long holds is null. A component without variance
(``e`` at most dimensions * 2^-52 of the largest) has null ``whitened`` and stays
out of ``identity_error``; without any variance that and ``explained`` are null.
Fewer dimensions than components give one component each. An empty table gives an
empty result; extra columns are not read. A vector of any length is held whole,
and the fit takes memory in proportion to the square of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contrail.llm.batches import map_pieces
from contrail.llm.store import stored

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4096
LIMB = 60
SAFE = 1 << 62
INFINITY = float("inf")


@dataclass
class Whitening:
    """Exact moments of the fit list and the unit eigenvectors (columns), by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def scales(self, components: int) -> list[float | None]:
        """1 / sqrt(e) of each component, None where it has no variance."""
        least = len(self.values) * 2.0 ** -52 * self.values[0]
        return [1 / float(np.sqrt(e)) if e > max(least, 0) else None for e in self.values[:components]]


def whole_numbers(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep`` and ``x`` (array of long) of the rows that take part."""
    c = F.col(vector)
    sound = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(INFINITY)))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    sized = rows.where(sound).select(*keep, x.alias("x"))
    common = (sized.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("d")).first())
    return sized.where(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as [row, dimension] longs."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield _matrix(batch.slice(at, BLOCK_ROWS))


def _limbs(values: list[int]) -> list[list[int]]:
    low = (1 << LIMB) - 1
    return [[v & low for v in values], [v >> LIMB & low for v in values], [v >> 2 * LIMB for v in values]]


def _column_sums(x: np.ndarray) -> list[int]:
    """Exact sums of each column, whatever the size of the numbers."""
    if x.dtype == object:
        return list(x.sum(axis=0))
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(b) for h, b in zip(high, low)]


def _less(x: np.ndarray, offset: list[int]) -> np.ndarray:
    """x - offset, in Python's numbers where longs would not hold the squares of sums of two."""
    most = max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, offset), default=0)
    if most < 1 << 30:
        return x - np.array(offset, np.int64)
    return x.astype(object) - np.array(offset, object)


def pair_squares(y: np.ndarray) -> list[int]:
    """Sums over the rows of (y_i + y_j)^2 for i < j, y_i^2 at i = j, by rows of the upper triangle."""
    out: list[int] = []
    small = y.dtype != object and (not y.size or 4 * int(np.abs(y).max()) ** 2 * len(y) < SAFE)
    for i in range(y.shape[1]):
        both = y[:, i:] + y[:, i:i + 1]
        both[:, 0] = y[:, i]
        if small:
            out += np.einsum("rc,rc->c", both, both).tolist()
        else:
            out += _column_sums(both * both)
    return out


def _gather(fit: DataFrame, per_block, names: int) -> list[int]:
    """Exact totals of ``per_block``'s numbers over the fit list: one row of each number leaves a task."""
    def run(batches):
        total = [0] * names
        seen = False
        for x in _blocks(batches):
            total = [a + b for a, b in zip(total, per_block(x))]
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(names), pa.int32()), *[pa.array(v, pa.int64()) for v in _limbs(total)]],
                                             ["k", "a", "b", "c"])

    limbs = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in "abc"]
    rows = fit.mapInArrow(run, "k int, a long, b long, c long").groupBy("k").agg(*limbs).collect()
    out = [0] * names
    for r in rows:
        out[r["k"]] = int(r["a"]) + (int(r["b"]) << LIMB) + (int(r["c"]) << 2 * LIMB)
    return out


def covariance(n: int, shift: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n) from sums of y and of squares of y_i, y_i + y_j; each entry is rounded once."""
    d = len(shift)
    spread, at = {}, 0
    for i in range(d):
        for j in range(i, d):
            moved = shift[i] if i == j else shift[i] + shift[j]
            spread[i, j] = n * squares[at] - moved * moved  # n^2 times the variance
            at += 1
    out = np.zeros((d, d))
    for (i, j), v in spread.items():
        twice = 2 * v if i == j else v - spread[i, i] - spread[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)
    return out


def fit(fit_list: DataFrame) -> Whitening | None:
    """The whitening of a list of distinct ``x`` vectors of one length; None of an empty list."""
    first = fit_list.first()
    if first is None:
        return None
    d = len(first["x"])
    n, *sums = _gather(fit_list, lambda x: [len(x), *_column_sums(x)], d + 1)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    squares = _gather(fit_list, lambda x: pair_squares(_less(x, middle)), d * (d + 1) // 2)
    values, vectors = np.linalg.eigh(cov := covariance(n, [s - n * m for s, m in zip(sums, middle)], squares))
    return Whitening(n, sums, values[::-1].copy(), vectors[:, ::-1].copy(), float(np.trace(cov)))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(x - S/n as doubles, the exact sum of (n*x - S)^2 per row or None)."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most < SAFE:
        z = x * np.int64(n) - np.array(sums, np.int64)
        top = int(np.abs(z).max())
        if top * top * z.shape[1] < SAFE:
            return z / n, np.einsum("rc,rc->r", z, z).tolist()
        exact = (z.astype(object) ** 2).sum(axis=1)
    else:
        z = x.astype(object) * n - np.array(sums, object)
        exact = (z ** 2).sum(axis=1)
    centred = np.array([[int(v) / n for v in row] for row in z], float)
    return centred, [int(v) if v < 1 << 63 else None for v in exact]


def project(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``rows`` (id, x) with ``deviation`` and the array ``whitened``."""
    scales = model.scales(components)
    axes = np.ascontiguousarray(model.vectors[:, :components])
    n, sums = model.n, model.sums

    def one(piece) -> dict:
        centred, exact = _centred(_matrix(piece), n, sums)
        out = centred @ axes
        return {"id": piece.column("id"), "deviation": exact,
                "whitened": [[v * s if s else None for v, s in zip(row, scales)] for row in out.tolist()]}

    weight = F.size("x") * 8
    return map_pieces(rows.withColumn("weight", weight), one, "id long, deviation long, whitened array<double>", column="weight")


def identity_error(fit_list: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    live = [k for k, s in enumerate(model.scales(components)) if s]
    if not live:
        return None
    at = lambda k: F.col("whitened")[k]
    pairs = [(i, j) for i in live for j in live if i <= j]
    white = project(fit_list.select(F.lit(0).cast("long").alias("id"), "x"), model, components)
    found = white.agg(*[F.covar_pop(at(i), at(j)) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def report(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row that takes part."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    used = whole_numbers(rows, "embedding", F.col("vec_id").cast("long").alias("id"))
    fit_list = stored(used.select("x").distinct(), "whitening-fit")
    model = fit(fit_list)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit_list, model, components)
    shares = [float(e) / model.trace if model.trace > 0 else None for e in model.values[:components]]
    share = F.array(*[F.lit(s).cast("double") for s in shares])
    white = project(used, model, components)
    return (white.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .select(F.col("id").alias("vec_id"), (F.col("k") + 1).cast("int").alias("component"),
                    F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error")))
