"""Exact n-gram Jaccard join over a token-group matrix, down to connected components.

A document is the set of its distinct five-word shingles. In one global order of
tokens, common ones last, two sets of similarity 0.8 or more share a token, and
of larger sets several, among the first fifth (and a little more) of each: their
heads. Similar documents are partitioned into groups:

1. documents with the same first token meet in blocks of bounded size, together
   with the smallest of them all; links found there make provisional components;
2. a group is a bounded part of one provisional component, of one size class;
3. the token-group matrix holds the union of a group's head tokens, with the
   sizes of the sets that hold each. Tokens met in one component only are left
   out beforehand, by a minimum and a maximum per token, and components are first
   joined by links between their central documents;
4. a document's overlap with a group's union bounds its overlap with any member.
   Tokens count where their places in the two orders, given the sizes, leave room
   for a link. Only groups of other components whose overlap reaches what a linked
   member would give are opened, and the sets are compared.

Pairs inside one component need no further check, so copies and near copies, be
they a third of all rows, never meet all pairs. Of two components the documents
of the smaller one ask the groups of the larger. Components found by opened
groups are joined on a graph of components, not of documents.

Tokens of ``COMMON_FROM`` components or more count as common; one document of
each component is counted, exactly, by packed token lists. At most ``COMMON`` of
them, the commonest, are held by every task. That changes the order, hence the
work, but no result. Rows and tokens that a step needs are named to the tasks
while they are at most ``FEW``, and joined beyond that.

Defined results: only A to Z are lower-cased; fewer than five words are one
shingle; null texts and texts without words have no shingles and link with
nothing; rows of equal text link, and stay rows of their own; rows that share an
id link only through their texts; a component without ids has a null id. A text
is held whole in one task with about twenty times its size. An empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.batches import map_pieces, pieces
from contrail.llm.components import components
from contrail.llm.hashing import shingles
from contrail.llm.store import stored

PIECE_BYTES = 1 << 20
COMMON = 1 << 20
COMMON_FROM = 8
FEW = 1 << 20
WINDOW = 1 << 21
BUCKET_TOKENS = 1 << 22
MEMBERS = 32
MEMBER_BYTES = 4 << 20
ASKING = 128
EXTRA = 64
GROUP = ["comp", "size_class", "part"]


def _least_shared(n):
    """The fewest tokens that a set of ``n`` shares with any set it links with: 80 % of ``n``, rounded up."""
    return (4 * n + 4) // 5


def head_length(n):
    return n - _least_shared(n) + 1 + n // EXTRA


def _wanted(n: str) -> Column:
    """Head tokens that a set of ``n`` shares at least with the head of any set it links with."""
    return F.expr(f"1 + ((4 * {n} + 4) div 5) div {EXTRA}")


def _may_link(n: str, place: str, least: str, most: str, first: str) -> Column:
    """Whether a shared token may be one of those that a link asks for.

    Sets of ``n`` and ``m`` tokens that link share at least 4/9 of ``n + m``, so
    their first tokens up to that, and as many more as :func:`_wanted` adds, share
    that many. The token is at ``place`` in the one; in the others, of ``least`` to
    ``most`` tokens, it is at ``first`` or later.
    """
    low, high = f"greatest({least}, (4 * {n} + 4) div 5)", f"least({most}, 5 * {n} div 4)"
    more = f"((4 * {n} + 4) div 5) div {EXTRA}"
    return F.expr(f"{low} <= {high} AND {place} <= {n} - (4 * ({n} + {low}) + 8) div 9 + {more}"
                  f" AND {first} <= {high} - (4 * ({n} + {high}) + 8) div 9 + {more}")


def _shingles(piece) -> tuple[np.ndarray, np.ndarray]:
    return shingles([t.encode().lower() for t in piece.column("text").to_pylist()])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(row, doc, key, text): a numbered row per distinct text; ``doc`` is its smallest id, ``key`` its digest."""
    once = (docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("text IS NOT NULL")
            .groupBy("text").agg(F.min("doc").alias("doc")))
    return stored(once.select(F.monotonically_increasing_id().alias("row"), "doc", _digest("text").alias("key"), "text"),
                  "join-texts", codec="zstd")


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def firsts(texts: DataFrame) -> DataFrame:
    """(row, n, first): each set's size and its least token."""
    def one(piece) -> dict:
        value, owner = _shingles(piece)
        n = np.bincount(owner, minlength=piece.num_rows)
        first = np.zeros(len(n), np.int64)
        first[n > 0] = value[(np.cumsum(n) - n)[n > 0]].view(np.int64)  # tokens are sorted within a text
        return {"row": piece.column("row"), "n": n, "first": pa.array(first, mask=n == 0)}
    return stored(map_pieces(texts.select("row", "text"), one, "row long, n long, first long", max_bytes=PIECE_BYTES), "join-firsts")


class Common:
    """Common tokens by their first ``bits`` bits, sorted, with a level: the logarithm of their count."""

    def __init__(self, bits: int, token: np.ndarray, level: np.ndarray) -> None:
        order = np.argsort(token)
        self.bits, self.token, self.level = bits, token[order], level[order]

    def levels(self, value: np.ndarray) -> np.ndarray:
        if not len(self.token):
            return np.zeros(len(value), np.int8)
        cut = value >> np.uint64(64 - self.bits)
        at = np.minimum(np.searchsorted(self.token, cut), len(self.token) - 1)
        return np.where(self.token[at] == cut, self.level[at], 0).astype(np.int8)


def common_tokens(texts: DataFrame, tokens: int, limit: int | None = None, bucket_tokens: int | None = None) -> Common:
    """The commonest tokens of ``texts``, which hold about ``tokens`` in all.

    The token space is cut into buckets of bounded size. Tasks send each bucket
    the next 32 bits of their tokens with counts, packed; a bucket adds them up.
    Tokens that agree so far count as one, which is as good for an order.
    """
    limit, low = limit or COMMON, COMMON_FROM
    bucket_bits = max(1, (tokens // (bucket_tokens or BUCKET_TOKENS)).bit_length())
    bits = bucket_bits + 32

    def pack(batches):
        held: list[np.ndarray] = []

        def packed():
            token, n = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
            bucket = token >> np.uint64(32)
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            token, n = token.astype("<u4"), np.minimum(n, 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut[:-1]].astype(np.int64)), pa.array([token[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["bucket", "tokens", "counts"])

        for piece in pieces(batches, "text", PIECE_BYTES):
            value = _shingles(piece)[0]
            if len(value):
                held.append(value)
            if sum(map(len, held)) >= WINDOW:
                yield packed()
                held.clear()
        if held:
            yield packed()

    def add(bucket: pa.Table) -> pa.Table:
        token = np.frombuffer(b"".join(bucket.column("tokens").to_pylist()), "<u4")
        n = np.frombuffer(b"".join(bucket.column("counts").to_pylist()), np.uint8)
        order = np.argsort(token, kind="stable")
        token, n = token[order], n[order].astype(np.int64)
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        total = np.add.reduceat(n, start)
        many = total >= low
        base = np.int64(bucket.column("bucket")[0].as_py()) << 32
        return pa.table({"token": pa.array(base + token[start][many].astype(np.int64)), "level": pa.array(np.log2(total[many]).astype(np.int32))})

    found = stored(texts.select("text").mapInArrow(pack, "bucket long, tokens binary, counts binary")
                   .groupBy("bucket").applyInArrow(add, "token long, level int"), "join-common")
    least, taken = None, 0
    for r in sorted(found.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # at most 64
        taken += r["n"]
        if taken > limit:
            break
        least = r["level"]
    if least is None:
        return Common(bits, np.zeros(0, np.uint64), np.zeros(0, np.int8))
    rows = found.where(F.col("level") >= least).toArrow()
    return Common(bits, rows.column("token").to_numpy().astype(np.uint64), rows.column("level").to_numpy().astype(np.int8))


def heads(texts: DataFrame, common: Common) -> DataFrame:
    """(row, n, head): each set's size and its first tokens in the global order (level, token)."""
    shared = texts.sparkSession.sparkContext.broadcast(common)  # at most COMMON tokens

    def run(batches):
        for piece in pieces(batches, "text", PIECE_BYTES):
            value, owner = _shingles(piece)
            order = np.lexsort((value, shared.value.levels(value), owner))
            value = value[order].view(np.int64)
            n = np.bincount(owner, minlength=piece.num_rows)
            begins = np.cumsum(n) - n
            length = np.where(n > 0, head_length(n), 0)
            keep = np.arange(len(value)) - begins[owner] < length[owner]
            head = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(value[keep]))
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(n, pa.int64()), head], ["row", "n", "head"])

    return texts.select("row", "text").mapInArrow(run, "row long, n long, head array<bigint>")


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, a stored table of one number a row, marked for broadcast while it holds at most ``FEW``."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _sets(piece) -> dict:
    value, owner = _shingles(piece)
    cut = np.searchsorted(owner, np.arange(piece.num_rows + 1))
    return {"row": piece.column("row"), "tokens": [value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]}


def _sets_of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, tokens) of the rows named by ``rows``, a stored table."""
    return map_pieces(texts.select("row", "text").join(_few(rows), "row", "left_semi"), _sets, "row long, tokens binary", max_bytes=PIECE_BYTES)


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, of sorted sets."""
    if not len(x) or 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 5 * shared >= 4 * (len(x) + len(y) - shared)


def _tokens(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]


def _pairs(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())})


def _within(block: pa.Table) -> pa.Table:
    """Each row of a block that is linked, with the smallest row of its component in the block."""
    block = block.sort_by("row")  # the smallest row, which all blocks of a key share, is held against the others first
    row, sets = block.column("row").to_pylist(), _tokens(block)
    top = list(range(len(row)))
    found = []
    for i in range(len(row)):
        for j in range(i + 1, len(row)):
            if top[i] != top[j] and alike(sets[i], sets[j]):
                old, new = max(top[i], top[j]), min(top[i], top[j])
                top = [new if t == old else t for t in top]
    return _pairs([(row[t], row[i]) for i, t in enumerate(top) if t != i])


def first_links(texts: DataFrame, first: DataFrame) -> DataFrame:
    """Links between documents that have the same least token, by blocks."""
    parts = F.ceil(F.greatest(F.col("members") / MEMBERS, F.col("tokens") * 8 / MEMBER_BYTES))
    keys = (first.where("n > 0").groupBy("first").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"), F.min("row").alias("least"))
            .where("members > 1").select("first", "least", parts.alias("parts")))
    keys = stored(keys, "join-keys")
    member = first.select("first", "row").join(keys, "first").select("first", "row", F.pmod(F.xxhash64("row"), "parts").alias("part"))
    least = keys.select("first", F.col("least").alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    blocks = stored(member.union(least).distinct(), "join-blocks")
    sets = _sets_of(texts, stored(blocks.select("row").distinct(), "join-block-rows"))
    return stored(blocks.join(sets, "row").groupBy("first", "part").applyInArrow(_within, "a long, b long"), "join-links")


def components_of(first: DataFrame, comp: DataFrame) -> DataFrame:
    """(row, comp, size, parts) of the rows in components of several; ``size`` counts the component."""
    linked = comp.select(F.col("doc").alias("row"), F.col("root").alias("comp"))
    roots = linked.select(F.col("comp").alias("row"), "comp").distinct()  # components() lists the other rows only
    linked = linked.union(roots).distinct().join(first.select("row", "n"), "row")
    parts = F.ceil(F.greatest(F.col("size") / MEMBERS, F.col("tokens") * 8 / MEMBER_BYTES))
    sizes = (linked.groupBy("comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens"))
             .select("comp", "size", parts.alias("parts")))
    return stored(linked.select("row", "comp").join(sizes, "comp"), "join-placed")


def members(head: DataFrame, placed: DataFrame) -> DataFrame:
    """(row, n, comp, size, size_class, part, head): every set's group."""
    one = F.lit(1).cast("long")
    return stored(head.where("n > 0").join(placed, "row", "left")
                  .select("row", "n", F.coalesce("comp", "row").alias("comp"), F.coalesce("size", one).alias("size"),
                          F.floor(F.log2("n")).cast("int").alias("size_class"),
                          F.pmod(F.xxhash64("row"), F.coalesce("parts", one)).alias("part"), "head"), "join-members")


def shared_tokens(member: DataFrame) -> DataFrame:
    """(token, place, row, n, comp, size, size_class, part) of the head tokens that several components have."""
    tokens = member.select(F.posexplode("head").alias("place", "token"), "row", "comp")
    live = tokens.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    # Of the many tokens only those of several components go on, and only then with what is known of their rows.
    met = stored(tokens.select("token", "place", "row").join(stored(live, "join-live"), "token"), "join-met")
    return stored(met.join(member.drop("head"), "row"), "join-tokens")


def join_hubs(texts: DataFrame, tokens: DataFrame) -> DataFrame:
    """(root, top) of components that a link between two central documents joins.

    A component's central document is the one that shares most of its head. It is
    held against that of the largest component which has one of the same tokens in
    its central head, if the overlap of the two lets it. That is at most one
    partner a token, and most of what belongs to a large family is joined by it.
    """
    central = (tokens.groupBy("comp", "row").agg(F.count(F.lit(1)).alias("tokens"))
               .groupBy("comp").agg(F.min_by("row", F.struct(-F.col("tokens"), "row")).alias("row")).select("row"))
    held = stored(tokens.join(central, "row").select("token", "place", "row", "n", "comp", "size"), "join-central")
    hub = held.groupBy("token").agg(F.max_by(F.struct("comp", "row", "n", "place"), F.struct("size", -F.col("comp"))).alias("hub"))
    met = (held.join(hub, "token").where("comp <> hub.comp")
           .select("row", "n", "place", F.col("comp").alias("own"), F.col("hub.comp").alias("comp"), F.col("hub.row").alias("with"),
                   F.col("hub.n").alias("m"), F.col("hub.place").alias("first"))
           .where(_may_link("n", "place", "m", "m", "first")))
    pairs = stored(met.groupBy("row", "own", "n", "comp", "with").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= _wanted("n"))
                   .select("row", "own", "comp", F.lit(0).alias("size_class"), F.col("with").alias("part")), "join-hubs")
    if pairs.isEmpty():
        return _tops(pairs.select("own", "comp"))
    return _tops(group_links(texts, pairs.select(F.col("part").alias("row"), *GROUP).distinct(), pairs))


def open_groups(tokens: DataFrame, tops: DataFrame) -> DataFrame:
    """(row, own, comp, size_class, part, shared): the groups of other components that a row's overlap bound lets it open."""
    tokens = tokens.join(tops.withColumnRenamed("root", "comp"), "comp", "left").withColumn("top", F.coalesce("top", "comp"))
    matrix = tokens.groupBy("token", *GROUP, "size", "top").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("place").alias("first"))
    ask = tokens.select("token", "place", "row", "n", F.col("comp").alias("own"), F.col("size").alias("own_size"), F.col("top").alias("own_top"))
    live = tokens.groupBy("token").agg(F.min("top").alias("lo"), F.max("top").alias("hi")).where("lo <> hi").select("token")
    met = (ask.join(live, "token").join(matrix, "token")
           .where("own_top <> top AND (own_size < size OR own_size = size AND own < comp)")
           .where(_may_link("n", "place", "least", "most", "first")))
    return stored(met.groupBy("row", "own", "n", *GROUP).agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= _wanted("n"))
                  .select("row", "own", *GROUP, "shared"), "join-open")


def _opened(cell: pa.Table) -> pa.Table:
    """(row, comp) of the asking rows that are linked with some member of the opened group."""
    asks, row, sets = cell.column("asks").to_pylist(), cell.column("row").to_pylist(), _tokens(cell)
    mine, others = [i for i, a in enumerate(asks) if a], [i for i, a in enumerate(asks) if not a]
    found = [row[i] for i in mine if any(alike(sets[i], sets[j]) for j in others)]
    comp = cell.column("comp")[0].as_py()
    return pa.table({"row": pa.array(found, pa.int64()), "comp": pa.array([comp] * len(found), pa.int64())})


def group_links(texts: DataFrame, member: DataFrame, opened: DataFrame) -> DataFrame:
    """(own, comp): components of which a row is linked with a member of another that it opened.

    A group that many rows open is read in several cells.
    """
    asked = stored(opened.groupBy(*GROUP).agg(F.ceil(F.count(F.lit(1)) / ASKING).alias("cells")), "join-asked")
    held = (member.select("row", *GROUP).join(asked, GROUP)
            .select("row", *GROUP, F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), F.lit(False).alias("asks")))
    asking = (opened.join(asked, GROUP)
              .select("row", *GROUP, F.pmod(F.xxhash64("row"), "cells").alias("cell"), F.lit(True).alias("asks")))
    rows = stored(held.union(asking), "join-cells")
    sets = _sets_of(texts, stored(rows.select("row").distinct(), "join-cell-rows"))
    found = rows.join(sets, "row").groupBy(*GROUP, "cell").applyInArrow(_opened, "row long, comp long")
    return stored(found.join(opened.select("row", "own").distinct(), "row").select("own", "comp").distinct(), "join-more-links")


def _tops(between: DataFrame) -> DataFrame:
    """(root, top) of the components that ``between`` joins to a smaller one."""
    links = stored(between.select(F.col("own").alias("a"), F.col("comp").alias("b")), "join-between")
    return components(links).select(F.col("doc").alias("root"), F.col("root").alias("top"))


def join_components(texts: DataFrame, member: DataFrame) -> DataFrame:
    """(root, top): components joined by links between them.

    Central documents are tried first. Then of two components the one row and
    group of the largest overlap are tried; most that belong together are then
    joined, and what is left to open lies between components that are still apart.
    """
    tokens = shared_tokens(member)
    tops = join_hubs(texts, tokens)
    known = tops.select(F.col("root").alias("own"), F.col("top").alias("comp"))
    opened = open_groups(tokens, tops)
    if opened.isEmpty():
        return tops
    best = (opened.groupBy("own", "comp").agg(F.max(F.struct("shared", "row", "size_class", "part")).alias("b"))
            .select("b.row", "own", "comp", "b.size_class", "b.part"))
    known = stored(known.union(group_links(texts, member, stored(best, "join-best"))), "join-known-links")
    tops = _tops(known)
    seen = opened
    for side in ("own", "comp"):
        seen = seen.join(tops.select(F.col("root").alias(side), F.col("top").alias(f"top_{side}")), side, "left")
    rest = stored(seen.where("coalesce(top_own, own) <> coalesce(top_comp, comp)").select(*opened.columns), "join-rest")
    if rest.isEmpty():
        return tops
    return _tops(known.union(group_links(texts, member, rest)).distinct())


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(distinct texts, their sizes, (row, root) of the rows that are linked and not their own root)."""
    texts = distinct_texts(docs)
    first = firsts(texts)
    comp = components(first_links(texts, first))
    placed = components_of(first, comp)
    lone = first.join(placed.where("row <> comp").select("row"), "row", "left_anti").where("n > 0")
    one_each = stored(placed.where("row <> comp").select("row"), "join-not-counted")
    counted = lone.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = common_tokens(texts.join(_few(one_each), "row", "left_anti"), counted)
    member = members(heads(texts, common), placed)
    roots = comp.select(F.col("doc").alias("row"), "root")
    top = join_components(texts, member)
    joined = roots.join(top, "root", "left").select("row", F.coalesce("top", "root").alias("root"))
    # Components that are joined to a smaller one have their own root linked as well.
    roots = stored(joined.union(top.select(F.col("root").alias("row"), F.col("top").alias("root"))).distinct(), "join-roots")
    return texts, first, roots


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts, first, roots = linked(docs)
    known = (texts.select("row", "key", "doc").join(first.select("row", "n"), "row").join(roots, "row", "left")
             .select("key", "doc", "n", F.coalesce("root", "row").alias("root")))
    named = stored(known, "join-known")
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = named.where("n > 0").join(least, "root").select("key", "n", "component_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest("text").alias("key"))
    return (rows.join(named, "key", "left")
            .select("doc_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
