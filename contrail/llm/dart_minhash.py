"""DartMinHash: weighted MinHash signatures by hashed darts, and a banded near-duplicate join.

Each unit of weight of an element is a region into which darts fall as a
hash-driven Poisson process in time: the gaps between darts are exponential,
taken from the hash of (region, dart number), so equal regions of two sets
get equal darts. Each dart has a hashed coordinate and, in a fractional
region, a hashed height that must be under the weight. The signature keeps
the earliest dart of each coordinate; two signatures agree in a coordinate
with the probability of the sets' weighted Jaccard similarity. Only about
``k ln k`` darts are thrown per set: the time limit follows its total weight
and is doubled while a coordinate is still empty.

The join works on distinct texts. Band keys group likely pairs; each group
is compared with a few pivots of its own, whatever its size, and pairs are
checked on the exact shingle sets. Members of a group that are then still in
different components are compared in cells, so no two components that a link
within a group joins stay apart; only links leave a cell. Nothing but counts
reaches the driver.

Defined results: texts are equal or compared by the sets of their five-word
shingles (unit weights), similarity 0.8 or more; a text of one to four words
is one shingle; texts without words link only to equal texts; a null text is
a class of its own; rows that share an id are one document and take the
smallest class of their texts; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions.ids import dense_ids
from contrail.llm.batches import map_pieces
from contrail.llm.components import components
from contrail.llm.hashing import mix, shingles
from contrail.llm.store import stored

COORDINATES = 128
BANDS = 32
SIMILARITY = 0.8
PIVOTS = 4
BLOCK = 512
BLOCK_BYTES = 4 << 20
# A pair of similarity 0.8 agrees in under 0.64 of 128 coordinates about once in 100,000 pairs (4.5 deviations).
LIKELY = 0.64
PIECE_BYTES = 1 << 20


def signatures(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """[set, coordinate] dart ids for ``n`` sets given as (element hash, weight > 0, set) rows.

    A set without elements keeps zeros.
    """
    out = np.zeros((n, k), np.uint64)
    if not len(element):
        return out
    units = np.ceil(weight).astype(np.int64)
    row = np.repeat(np.arange(len(element)), units)
    unit = np.arange(len(row)) - np.repeat(np.cumsum(units) - units, units)
    region = mix(element[row] + mix(unit.astype(np.uint64) + np.uint64(1)))
    part = np.minimum(1.0, weight[row] - unit)
    owner = owner[row]
    total = np.bincount(owner, weights=part, minlength=n)
    limit = np.zeros(n)
    limit[total > 0] = 2.0 ** np.ceil(np.log2(k * (np.log(k) + 4) / total[total > 0]))
    best = np.full(n * k, np.inf)
    flat = out.reshape(-1)
    todo = np.arange(len(region))
    clock = np.zeros(len(region))
    number = np.zeros(len(region), np.uint64)
    while len(todo):
        # Throw on until every region's clock is past its set's limit; the clocks then stand at the next dart.
        live = todo
        keys, times, ids = [], [], []
        if not number[live[0]]:
            number[live] = 1
            clock[live] = _gap(region[live], number[live])
        live = live[clock[live] <= limit[owner[live]]]
        while len(live):
            dart = mix(region[live] ^ mix(number[live] * np.uint64(0xD6E8FEB86659FD93)))
            hit = np.ones(len(live), bool) if (part[live] == 1).all() else (mix(dart + np.uint64(7)) >> np.uint64(11)) * 2.0 ** -53 < part[live]
            keys.append(owner[live][hit] * k + (mix(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64)[hit])
            times.append(clock[live][hit])
            ids.append(dart[hit])
            number[live] += np.uint64(1)
            clock[live] += _gap(region[live], number[live])
            live = live[clock[live] <= limit[owner[live]]]
        if keys:
            key, time, dart = np.concatenate(keys), np.concatenate(times), np.concatenate(ids)
            np.minimum.at(best, key, time)
            first = time == best[key]
            flat[key[first]] = dart[first]
        empty = (np.isinf(best).reshape(n, k).any(axis=1)) & (total > 0)
        limit[empty] *= 2
        todo = todo[empty[owner[todo]]]
    return out


def _gap(region: np.ndarray, number: np.ndarray) -> np.ndarray:
    u = (mix(region + mix(number)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return -np.log1p(-u)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """[set, band] keys; equal when all coordinates of the band are."""
    n, k = sig.shape
    rows = sig.reshape(n, bands, k // bands)
    key = np.zeros((n, bands), np.uint64) + mix(np.arange(1, bands + 1).astype(np.uint64))
    for j in range(k // bands):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
    return key.view(np.int64)


def _sign(piece) -> dict:
    texts = [t.encode() for t in piece.column("text").to_pylist()]
    value, owner = shingles(texts)
    sig = signatures(value, np.ones(len(value)), owner, len(texts))
    some = np.bincount(owner, minlength=len(texts)) > 0
    keys = band_keys(sig)
    small = (sig & np.uint64(0xFF)).astype(np.uint8)
    return {"doc": piece.column("doc"), "same": piece.column("same"), "size": np.bincount(owner, minlength=len(texts)),
            "bands": [k.tolist() if s else [] for k, s in zip(keys, some)], "sig": [s.tobytes() for s in small]}


def _sets(piece) -> dict:
    texts = [t.encode() for t in piece.column("text").to_pylist()]
    value, owner = shingles(texts)
    low = (value >> np.uint64(24)).astype(np.uint64)  # 40 bits, five bytes each
    raw = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return {"doc": piece.column("doc"), "grams": [raw[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]}


def _unpack(grams: bytes) -> np.ndarray:
    raw = np.zeros((len(grams) // 5, 8), np.uint8)
    raw[:, :5] = np.frombuffer(grams, np.uint8).reshape(-1, 5)
    return raw.reshape(-1).view("<u8")


def _alike(x: bytes, y: bytes) -> bool:
    small, large = sorted((len(x), len(y)))
    if small < SIMILARITY * large - 1e-9 or not large:
        return False
    shared = len(np.intersect1d(_unpack(x), _unpack(y), assume_unique=True))
    return shared >= SIMILARITY * ((small + large) // 5 - shared) - 1e-9


def _check(batches):
    for b in batches:
        keep = [_alike(x, y) for x, y in zip(b.column("ga").to_pylist(), b.column("gb").to_pylist())]
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets_of(texts: DataFrame, need: DataFrame) -> DataFrame:
    """Shingle sets of the documents of ``need``, a stored table: Spark sees its size and broadcasts it only when small."""
    return map_pieces(texts.join(need, "doc", "left_semi"), _sets, "doc long, grams binary", max_bytes=PIECE_BYTES)


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold.

    The sets are dealt by document once; both joins read that one shuffle.
    """
    sets = _sets_of(texts, stored(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "paired"))
    first = pairs.join(sets.select(F.col("doc").alias("b"), F.col("grams").alias("gb")), "b")
    both = first.join(sets.select(F.col("doc").alias("a"), F.col("grams").alias("ga")), "a")
    return both.select("a", "b", "ga", "gb").mapInArrow(_check, "a long, b long")


def _star_pairs(bands: DataFrame) -> DataFrame:
    """Each member of a band group with the group's pivots: the members of the smallest hash under a few seeds."""
    picks = [F.min_by("doc", F.xxhash64("doc", F.lit(s))).alias(f"p{s}") for s in range(1, PIVOTS)]
    groups = (bands.groupBy("key").agg(F.min("doc").alias("p0"), *picks, F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("key", F.array_distinct(F.array(*[f"p{s}" for s in range(PIVOTS)])).alias("pivots")))
    met = bands.join(groups, "key").select("doc", F.explode("pivots").alias("pivot")).where("doc <> pivot")
    return met.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()


def _agree(pairs: DataFrame, sig: DataFrame) -> DataFrame:
    """Pairs whose signatures agree often enough to be worth the exact check."""
    both = (pairs.join(sig.select(F.col("doc").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("doc").alias("b"), F.col("sig").alias("sb")), "b"))

    def likely(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sa", "sb"))
                yield b.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= LIKELY))
    return both.select("a", "b", "sa", "sb").mapInArrow(likely, "a long, b long")


def _rest_links(bands: DataFrame, lone: DataFrame, comp: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of one band group that are in different components.

    A group's largest component stays as it is; every other member is held
    against the whole group, in the first of the bands a pair shares. A group
    is cut into cells of about ``BLOCK`` members or ``BLOCK_BYTES`` of shingles
    a side, so one of any size spreads over tasks. A cell checks the exact sets
    of the pairs whose signatures agree and gives a link only where it joins
    two components, so it gives fewer links than it has members.
    """
    member = (bands.join(comp, "doc", "left")
              .select("key", "doc", "size", F.coalesce("root", "doc").alias("root")))
    per_root = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("bytes") / BLOCK_BYTES))
    mixed = (per_root.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("n", "root")).alias("main"),
                                         F.sum("n").alias("members"), F.max("n").alias("most"), (F.sum("size") * 5).alias("bytes"))
             .where("roots > 1 AND members > 2").withColumn("blocks", blocks)
             .withColumn("odd_blocks", F.ceil(F.col("blocks") * (F.col("members") - F.col("most")) / F.col("members")))
             .select("key", "main", "blocks", "odd_blocks"))
    found = stored(member.join(mixed, "key").withColumn("odd", F.expr("root <> main"))
                   .select("key", "doc", "root", "odd", "blocks", "odd_blocks"), "mixed")
    need = stored(found.select("doc").distinct(), "mixed-docs")
    held = lone.dropDuplicates(["doc"]).select("doc", "sig", "bands").join(_sets_of(texts, need), "doc")
    rows = found.join(held, "doc")
    carried = ["odd", "doc", "root", "sig", "bands", "grams"]
    whole = rows.select("key", F.pmod(F.xxhash64("doc"), "blocks").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("odd_blocks") - 1)).alias("j"),
                        F.lit(False).alias("asks"), *carried)
    asking = rows.where("odd").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"),
                                      F.pmod(F.xxhash64("doc", F.lit(1)), "odd_blocks").alias("j"), F.lit(True).alias("asks"), *carried)
    return whole.union(asking).groupBy("key", "i", "j").applyInArrow(_join_cell, "a long, b long")


def _join_cell(cell: pa.Table) -> pa.Table:
    """Links that join components among a cell's rows: those that ask against the others."""
    asks, odd, doc, root = (cell.column(c).to_numpy() for c in ("asks", "odd", "doc", "root"))
    mine, others = np.flatnonzero(asks), np.flatnonzero(~asks)
    links: list[tuple[int, int]] = []
    if len(mine) and len(others):
        sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), np.uint8).reshape(len(doc), -1)
        bands = cell.column("bands").combine_chunks().flatten().to_numpy().reshape(len(doc), -1)
        band = int((bands[0] == cell.column("key")[0].as_py()).argmax())
        grams = cell.column("grams")
        above: dict[int, int] = {}

        def top(r: int) -> int:
            while r in above:
                r = above[r]
            return r
        for x in mine:
            # Two members outside the largest component meet twice; the smaller id asks.
            hit = others[(root[others] != root[x]) & (~odd[others] | (doc[others] > doc[x]))]
            hit = hit[(sig[hit] == sig[x]).mean(axis=1) >= LIKELY]
            hit = hit[~(bands[hit, :band] == bands[x, :band]).any(axis=1)]
            for y in hit:
                r, q = top(root[x]), top(root[y])
                if r != q and _alike(grams[int(x)].as_py(), grams[int(y)].as_py()):
                    above[r] = q
                    links.append((min(doc[x], doc[y]), max(doc[x], doc[y])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of): the smallest id of the class, and of the equal texts."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    known = rows.where("text IS NOT NULL AND doc IS NOT NULL")
    same: Column = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    signed = stored(map_pieces(known.withColumn("same", same), _sign, "doc long, same binary, size long, bands array<bigint>, sig binary",
                               max_bytes=PIECE_BYTES), "darts")
    first = stored(signed.groupBy("same").agg(F.min("doc").alias("first")), "first")
    # One row per distinct text: the signature of its first document. The hash decides which of an id's texts it is.
    lone = signed.join(first.withColumnRenamed("first", "doc"), ["doc", "same"]).dropDuplicates(["doc", "same"])
    lone = lone.select("doc", "size", "bands", "sig")
    bands = lone.select("doc", "size", F.explode("bands").alias("key"))
    sig = lone.select("doc", "sig").dropDuplicates(["doc"])
    texts = known.select("doc", "text")
    likely = stored(_agree(_star_pairs(bands), sig), "pairs")
    links = stored(_links(likely, texts).distinct(), "links")
    comp = components(links)
    more = stored(_rest_links(bands, lone, comp, texts), "more")
    if not more.isEmpty():
        comp = components(links.union(more))
    copies = signed.join(first, "same").groupBy("doc").agg(F.min("first").alias("copy_of"))
    named = (copies.join(comp.select(F.col("doc").alias("copy_of"), "root"), "copy_of", "left")
             .select("doc", F.coalesce("root", "copy_of").alias("root"), "copy_of"))
    alone = rows.where("text IS NULL OR doc IS NULL").select("doc", F.col("doc").alias("root"), F.col("doc").alias("copy_of"))
    # An id that has both a text and a null text is in ``named`` already.
    alone = alone.distinct().join(named.select("doc"), "doc", "left_anti")
    return named.union(alone).select(F.col("doc").alias("doc_id"), F.col("root").alias("class_id"), "copy_of")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document per class: the one whose id names it.

    Unlike texts that share an id are documents of their own here. Rows that
    repeat id and text come down to one, as do null texts of one id; rows of a
    null id stay.
    """
    # Rows travel as one value, so none of their columns can meet a name of this module.
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", row.alias("row"))
    rows = rows.withColumn("same", F.unhex(F.md5(F.col("text").cast("binary"))))
    named = rows.where("doc IS NOT NULL AND text IS NOT NULL").select("doc", "same").distinct()
    first = named.groupBy("doc").agg(F.min("same").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    more = stored(named.join(first, "doc").where("same <> first").select("doc", "same"), "id-repeats")
    top = rows.agg(F.coalesce(F.max("doc"), F.lit(0))).first()[0]
    # The second and later texts of an id get numbers of their own behind all ids, so an id of the table names its class.
    own = stored(dense_ids(more, ["doc", "same"], max(top, 0), name="own"), "own-ids")
    rows = rows.join(own, ["doc", "same"], "left").select(F.coalesce("own", "doc").alias("doc"), "text", "row")
    known = rows.where("doc IS NOT NULL AND text IS NOT NULL")
    found = classes(known.select(F.col("doc").alias("doc_id"), "text"))
    spare = found.where("doc_id <> class_id").select(F.col("doc_id").alias("doc"))
    kept = (known.join(spare, "doc", "left_anti").dropDuplicates(["doc"]).select("row")
            .union(rows.where("doc IS NOT NULL AND text IS NULL").dropDuplicates(["doc"]).select("row"))
            .union(rows.where("doc IS NULL").select("row")))
    return kept.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
