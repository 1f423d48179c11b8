"""Nearest neighbours by learned partitions.

Nearness is the inner product, so vectors are seen with their norm: divided by
the table's large norm (its 99th hundredth) and given one more coordinate that
makes them unit vectors, a query's direction then orders them as the inner
product does. On a bounded sample of them an exact neighbour graph is built
and cut into partitions of equal size by balanced label propagation; a softmax
classifier learns to tell a vector's partition, another one the partitions of
a query's neighbours. Every vector is indexed under its most probable
partition, the few of a norm beyond the large one under a partition that every
query meets. A query is routed to its most probable partitions until they hold
``PROBE_MASS`` and at least ``MET_ROWS`` vectors, and all vectors there are
reranked by the exact inner product in double precision. Partitions are scanned
in blocks of bounded size, joined with the queries by (partition, block); a
task hands on the best ``k`` candidates per query over its blocks, so neither a
large partition nor many equal vectors meet in one task. The number of
partitions grows with the root of the table.

Defined results: vectors that are null, zero, empty or hold a null or
non-finite component take no part; shorter vectors count as padded with
zeros; equal scores go to the smaller vec_id; of rows that share a vec_id all
are searched, and each is a query of its own; in a table of ``MET_ROWS``
vectors or fewer a query meets all, so the search is exact; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.llm.store import stored

SAMPLE = 8_000  # vectors the index is fitted on, or PART_SAMPLE per partition if that is more
PART_SAMPLE = 50
MET_ROWS = 2_000  # vectors a query meets at least
NEIGHBOURS = 10
PROBE_MASS = 0.98  # a query goes to partitions until their probabilities reach this
BLOCK = 2_000  # vectors scanned at once
QUERY_BLOCK = 500
HELD_ROWS = 400_000  # candidates a task holds before it hands them on


@dataclass(frozen=True)
class Router:
    """Softmax classifiers over partitions: of vectors, and of queries."""

    weight: np.ndarray  # [dimension + 2, partition]
    asking: np.ndarray  # the same for queries
    norm: float  # vectors of a larger norm are under the partition after the last

    @property
    def parts(self) -> int:
        return self.weight.shape[1]

    def probabilities(self, x: np.ndarray, asks: bool = False) -> np.ndarray:
        d = self.weight.shape[0] - 2
        x = directions(x) if asks else lifted(x, self.norm)
        x = np.c_[x[:, :-1][:, :d], np.zeros((len(x), max(0, d + 1 - x.shape[1]))), x[:, -1:]]
        weight = self.asking if asks else self.weight
        return _softmax(x @ weight[:-1] + weight[-1])

    def beyond(self, x: np.ndarray) -> np.ndarray:
        return np.linalg.norm(x, axis=1) > self.norm * (1 + 1e-6)


def _softmax(s: np.ndarray) -> np.ndarray:
    s = np.exp(s - s.max(axis=1, keepdims=True))
    return s / s.sum(axis=1, keepdims=True)


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors whose inner product with a query's direction is that of ``x`` over ``norm``."""
    y = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), norm)
    return np.c_[y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))]


def directions(x: np.ndarray) -> np.ndarray:
    return np.c_[x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.zeros(len(x))]


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS, asked: np.ndarray | None = None) -> np.ndarray:
    """[vector, k] places of the nearest others, by inner product of unit vectors, in blocks.

    ``asked`` are unit vectors to ask with in place of the vectors' own.
    """
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    asked = unit if asked is None else asked.astype(np.float32)
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        s = asked[i:i + 512] @ unit.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Labels of ``parts`` partitions of almost equal size, few graph edges cut.

    Starts from halving along the directions of largest spread; then every
    vector wishes for the label most of its neighbours (either way) have, and
    wishes are granted by their gain as far as the sizes allow.
    """
    rng = np.random.default_rng(seed)
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    while len(groups) < parts:
        halves = []
        for g in groups:
            c = unit[g] - unit[g].mean(axis=0)
            v = rng.normal(size=c.shape[1])
            for _ in range(20):
                v = c.T @ (c @ v)
                v /= max(np.linalg.norm(v), 1e-300)
            order = g[np.argsort(c @ v, kind="stable")]
            halves += [order[:len(g) // 2], order[len(g) // 2:]]
        groups = halves
    for i, g in enumerate(groups):
        label[g] = i
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    target = graph.reshape(-1)
    room = int(np.ceil(1.05 * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (source, label[target]), 1)
        np.add.at(votes, (target, label[source]), 1)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] < room:
                size[label[i]] -= 1
                size[wish[i]] += 1
                label[i] = wish[i]
                moved += 1
        if not moved:
            break
    return label


def train_router(x: np.ndarray, want: np.ndarray, steps: int = 300, rate: float = 4.0) -> np.ndarray:
    """Weights of a classifier of unit vectors; ``want`` is [vector, partition], rows that sum to one."""
    data = np.c_[x, np.ones(len(x))]
    weight = np.zeros((data.shape[1], want.shape[1]))
    speed = np.zeros_like(weight)
    for _ in range(steps):  # full-batch gradient with momentum; lightly decayed
        speed = 0.9 * speed - rate * (data.T @ (_softmax(data @ weight) - want) / len(x) + 1e-5 * weight)
        weight += speed
    return weight


def valid(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def fit(vectors: DataFrame, rows: int, norm: float) -> Router:
    """Router from a sample of the vectors, the ones of smallest id hash."""
    parts = 1
    while 8 * parts < rows ** 0.5:
        parts *= 2
    sample = max(SAMPLE, PART_SAMPLE * parts)
    got = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").toArrow().column("vec")
    x = np.unique(_matrix(got), axis=0)  # equal vectors say nothing more about the graph
    parts = min(parts, max(1, len(x) // PART_SAMPLE))
    parts = 1 << (parts.bit_length() - 1)
    if parts == 1:
        flat = np.zeros((x.shape[1] + 2, 1))
        return Router(flat, flat, norm)
    y, asked = lifted(x, norm), directions(x)
    label = balanced_partition(y, neighbour_graph(y), parts)
    near = label[neighbour_graph(y, asked=asked)]
    share = np.zeros((len(x), parts))
    np.add.at(share, (np.arange(len(x))[:, None], near), 1 / near.shape[1])
    return Router(train_router(y, np.eye(parts)[label]), train_router(asked, share), norm)


def _matrix(col) -> np.ndarray:
    """Rows padded with zeros to the longest."""
    rows = col.to_pylist()
    width = max(map(len, rows), default=1)
    return np.array([r + [0.0] * (width - len(r)) if len(r) < width else r for r in rows], np.float64).reshape(len(rows), width)


def _route(router: Router, size: np.ndarray | None = None):
    """A vector's partition; with the partitions' sizes the ones a query meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vec"))
            if size is None:
                part = np.where(router.beyond(x), router.parts, router.probabilities(x).argmax(axis=1))
                parts = [[int(p)] for p in part]
            else:
                p = router.probabilities(x, asks=True)
                order = np.argsort(-p, axis=1, kind="stable")
                ranked = np.take_along_axis(p, order, axis=1)
                met = np.cumsum(size[order], axis=1) - size[order]
                on = (np.cumsum(ranked, axis=1) - ranked < PROBE_MASS) | (met < MET_ROWS)
                parts = [[router.parts, *o[w].tolist()] for o, w in zip(order, on)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), pa.array(parts, pa.list_(pa.int32()))],
                                             ["vec_id", "vec", "parts"])
    return run


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` candidates of each query."""
    by = np.lexsort((v, -s, q))
    q, v, s = q[by], v[by], s[by]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return q[rank < k], v[rank < k], s[rank < k]


def _scan(k: int):
    def give(q, v, s) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                          ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            for i in range(b.num_rows):
                ids = np.array(b.column("ids")[i].as_py())
                qid = np.array(b.column("qids")[i].as_py())
                rows, asked = _matrix(b.column("vecs")[i].values), _matrix(b.column("qvecs")[i].values)
                width = max(rows.shape[1], asked.shape[1])
                rows, asked = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, asked))
                near = asked @ rows.T
                near[qid[:, None] == ids[None, :]] = -np.inf
                out_q, out_v, out_s = [], [], []
                for j in range(len(qid)):
                    s = near[j]
                    if len(s) > k:
                        # All that may tie with the k-th after exact scoring stay in.
                        kth = np.partition(s, len(s) - k)[len(s) - k]
                        at = np.flatnonzero(s >= kth - 1e-9 * max(1.0, abs(kth))) if np.isfinite(kth) else np.arange(len(s))
                    else:
                        at = np.arange(len(s))
                    at = at[ids[at] != qid[j]]
                    exact = np.einsum("ij,j->i", rows[at], asked[j])
                    best = np.lexsort((ids[at], -exact))[:k]
                    out_q += [int(qid[j])] * len(best)
                    out_v += ids[at][best].tolist()
                    out_s += exact[best].tolist()
                new = np.array(out_q, np.int64), np.array(out_v, np.int64), np.array(out_s, np.float64)
                held = tuple(np.concatenate(x) for x in zip(held, new))
                if len(held[0]) > HELD_ROWS:
                    held = _best(*held, k)
                    if len(held[0]) > HELD_ROWS // 2:
                        yield give(*held)
                        held = tuple(x[:0] for x in held)
        yield give(*_best(*held, k))
    return run


def search(embeddings: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row whose id is divisible by ``query_every``."""
    clean = (embeddings.where(F.col(id_col).isNotNull() & valid(F.col(vector_col)))
             .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec")))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    rows, large = clean.agg(F.count(F.lit(1)), F.percentile_approx(norm, F.lit(0.99), F.lit(10_000))).first()
    if not rows:
        return clean.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).where("false")
    router = fit(clean, rows, max(large, 1e-300))
    schema = "vec_id long, vec array<double>, parts array<int>"
    indexed = stored(clean.mapInArrow(_route(router), schema).select("vec_id", "vec", F.col("parts")[0].alias("part")), "ann")
    size = stored(indexed.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "ann-size")  # a row per partition
    count = np.zeros(router.parts + 1, np.int64)
    for r in size.collect():
        count[r["part"]] = r["n"]
    asked = (clean.where(F.col("vec_id") % query_every == 0).dropDuplicates(["vec_id", "vec"])
             .mapInArrow(_route(router, count), schema).select("vec_id", "vec", F.explode("parts").alias("part")))
    split = lambda n, block: F.greatest(F.lit(1), F.ceil(n / block)).cast("long")
    spot = lambda n, block: F.pmod(F.xxhash64("vec_id"), split(n, block))
    blocks = (indexed.join(size, "part").withColumn("spot", spot(F.col("n"), BLOCK))
              .groupBy("part", "spot").agg(F.collect_list("vec_id").alias("ids"), F.collect_list("vec").alias("vecs")))
    asked_size = asked.groupBy("part").agg(F.count(F.lit(1)).alias("asking"))
    groups = (asked.join(asked_size, "part").withColumn("qspot", spot(F.col("asking"), QUERY_BLOCK))
              .groupBy("part", "qspot").agg(F.collect_list("vec_id").alias("qids"), F.collect_list("vec").alias("qvecs"))
              .join(size, "part").withColumn("spot", F.explode(F.sequence(F.lit(0).cast("long"), split(F.col("n"), BLOCK) - 1))))
    found = (blocks.join(groups, ["part", "spot"]).select("ids", "vecs", "qids", "qvecs")
             .mapInArrow(_scan(k), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
