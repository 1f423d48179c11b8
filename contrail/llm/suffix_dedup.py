"""Removal of byte strings that occur earlier, by bucketed suffix arrays.

A byte goes when a ``WINDOW``-byte string over it also starts earlier
(smaller doc_id, or the same document and an earlier start).

1. Every window is filed under its anchor: the ``GRAM``-byte string in it
   whose hash is smallest, leftmost among equals. Equal windows have equal
   anchors at equal places, so they meet under one anchor hash. Windows in a
   row with one anchor form a run; a run's whole text is hashed as well.
2. Runs go to their anchor's hash, one per (task, anchor, text) since the
   others are known to repeat it. There, a run whose text was seen earlier is
   a repeat throughout; runs that share an anchor but differ in their text
   are contested.
3. The texts of contested runs are cut out and filed, windows on the left and
   on the right of the anchor apart, under a longer string that such windows
   must share. The texts of a bucket are sorted by two-stage suffix sorting:
   only suffixes smaller than their successors are sorted directly, the rest
   is induced by bucket scans; adjacent common prefixes of ``WINDOW`` bytes
   or more give the classes of equal windows, and all but the earliest of a
   class repeat. The bytes of every bucket are counted first: one of more than
   ``BUCKET_BYTES`` is not sorted, its windows go one by one to the hash of
   their bytes, again one per (task, window), and the earliest there stays.
4. The repeats of a document are joined to its text and cut out.

Hashes are of 64 bits. Rows are numbered in the order of doc_id and text digest
and written with their number, which stands for the document in all steps.
The texts are dealt by it once; both joins with them read that shuffle.

Defined results: a null text counts as empty; texts under ``WINDOW`` bytes
lose nothing; rows equal in doc_id and text are read as copies at the same
places: neither is earlier than the other; of unlike texts under one doc_id
the one of smaller SHA-256 comes first; rows of a null id come before all others;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from contrail.llm.batches import pieces
from contrail.llm.hashing import Rolling, concat, mix
from contrail.llm.store import stored

WINDOW = 100
GRAM = 36
SIDE = 32  # bytes beyond the anchor, on one side, that a longer bucket key takes in
PIECE_BYTES = 1 << 20
HELD_RUNS = 1_000_000  # runs a task gathers before it files them
SORT_BYTES = 1 << 20  # text of whole buckets sorted at once
BUCKET_BYTES = 1 << 18  # text of one bucket that is sorted, at most
PLACE_BITS = np.uint64(28)


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, run-text hash, anchor place, windows before the anchor, windows) of every run."""
    data, begins = concat(texts)
    ends = begins[1:] - 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) <= WINDOW:
        return empty
    roll = Rolling(data)
    gram = roll.grams(GRAM)
    width = WINDOW - GRAM + 1
    place = np.arange(len(gram), dtype=np.uint64) & np.uint64((1 << 28) - 1)
    low = ((gram >> PLACE_BITS) << PLACE_BITS) | place
    # Minimum over ``width`` grams in a row, by doubling.
    span, best = 1, low
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[:len(best) - (width - span)], best[width - span:])
    start = np.arange(len(best))
    text = np.searchsorted(begins, start, side="right") - 1
    ok = start + WINDOW <= ends[text]
    start, text = start[ok], text[ok]
    if not len(start):
        return empty
    step = (best[ok] - (start.astype(np.uint64) & np.uint64((1 << 28) - 1))) & np.uint64((1 << 28) - 1)
    anchor = start + step.astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(start)])
    lo, a, t = start[first], anchor[first], text[first]
    body = mix(roll.slices(lo, lo + count - 1 + WINDOW) + mix((count * 256 + (a - lo)).astype(np.uint64)))
    return t, gram[a].view(np.int64), body.view(np.int64), a - begins[t], a - lo, count


def _pack(place, before, count):
    return (place << 14) | (before << 7) | count


def _unpack(packed):
    return packed >> 14, (packed >> 7) & 127, packed & 127


def _cover(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte spans of each document, overlapping and touching ones joined."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((hi, lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    far = hi.copy()
    first_of_doc = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    # Running maximum inside each document: lift each document above all ends of the ones before.
    lift = np.repeat(np.arange(len(first_of_doc)), np.diff(np.r_[first_of_doc, len(doc)])) * (int(hi.max()) + 1)
    far = np.maximum.accumulate(far + lift) - lift
    new = np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > far[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], lo[first], far[last]


# Rows between the steps: kind 0 is a run (anchor hash, text hash, doc, packed); kind 1 a byte span of repeats
# (doc hash to spread them, start, doc, end).
_ROW = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("p", pa.int64())])
_ROW_SQL = "kind int, h long, c long, doc long, p long"


def _batch(kind: int, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cols[0]), 50_000):
        part = [pa.array(np.ascontiguousarray(c[i:i + 50_000])) for c in cols]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), kind, np.int32)), *part], schema=_ROW)


def _spans(doc, lo, hi) -> Iterator[pa.RecordBatch]:
    doc, lo, hi = _cover(doc, lo, hi)
    yield from _batch(1, mix(doc.view(np.uint64)).view(np.int64), lo, doc, hi)


def _repeats(h, c, doc, place, before, count):
    """Of sorted runs: (which are first of their text, spans of the later ones)."""
    new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])] if len(h) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    later = ~new & ((doc != doc[lead]) | (place != place[lead]))
    lo = place - before
    return new, (doc[later], lo[later], (lo + count - 1 + WINDOW)[later])


def _firsts(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of gathered (anchor hash, text hash, doc, packed) runs the first of each text (kind 0), the others as spans (kind 1)."""
    h, c, doc, packed = (np.concatenate(x) for x in zip(*held))
    place, before, count = _unpack(packed)
    order = np.lexsort((place, doc, c, h))
    h, c, doc, place, before, count = (x[order] for x in (h, c, doc, place, before, count))
    new, spans = _repeats(h, c, doc, place, before, count)
    yield from _spans(*spans)
    yield from _batch(0, h[new], c[new], doc[new], _pack(place, before, count)[new])


def _file_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for piece in pieces(batches, "text", PIECE_BYTES):
        docs = piece.column("doc").to_numpy(zero_copy_only=False)
        text, h, c, place, before, count = runs([t.encode() for t in piece.column("text").to_pylist()])
        if len(h):
            held.append((h, c, docs[text], _pack(place, before, count)))
            n += len(h)
        if n >= HELD_RUNS:
            yield from _firsts(held)
            held, n = [], 0
    if held:
        yield from _firsts(held)


def _meet_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, text, place: repeats as spans (kind 1), contested runs (kind 0).

    Streams: what is kept between batches is the last first-of-its-text run.
    """
    carry, contested = None, False  # that run; whether its anchor is known to be contested (and so it is out)
    for b in batches:
        kind, h, c, doc, p = (b.column(x).to_numpy(zero_copy_only=False) for x in ("kind", "h", "c", "doc", "p"))
        span = kind == 1
        if span.any():
            yield from _batch(1, h[span], c[span], doc[span], p[span])
        h, c, doc, p = h[~span], c[~span], doc[~span], p[~span]
        if not len(h):
            continue
        held = carry is not None
        if held:
            h, c, doc, p = (np.r_[np.array([v], np.int64), x] for v, x in zip(carry, (h, c, doc, p)))
        place, before, count = _unpack(p)
        new, spans = _repeats(h, c, doc, place, before, count)
        yield from _spans(*spans)
        first = np.flatnonzero(new)
        fh = h[first]
        shared = np.zeros(len(first), bool)
        shared[1:] |= fh[1:] == fh[:-1]
        shared[:-1] |= fh[1:] == fh[:-1]
        if held and contested:
            shared |= fh == fh[0]
        out = shared.copy()
        if held and contested:
            out[0] = False  # given out before
        yield from _batch(0, h[first][out], c[first][out], doc[first][out], p[first][out])
        contested = bool(shared[-1])
        carry = tuple(int(x[first[-1]]) for x in (h, c, doc, p))


_SLICE_SQL = "key long, doc long, start long, n int, body binary"
_SLICE = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("body", pa.binary())])


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of contested runs, each side of the anchor under its longer key."""
    for piece in pieces(batches, "text", PIECE_BYTES):
        out: list[tuple] = []
        starts, stops = [], []
        texts = [(t or "").encode() if r else b"" for t, r in zip(piece.column("text").to_pylist(), piece.column("runs").to_pylist())]
        data, begins = concat(texts)
        for i, (doc, packed) in enumerate(zip(piece.column("doc").to_pylist(), piece.column("runs").to_pylist())):
            for q in packed or ():
                place, before, count = q >> 14, (q >> 7) & 127, q & 127
                lo, hi = place - before, place - before + count  # windows [lo, hi)
                middle = min(max(lo, place - SIDE), hi)  # windows from here on hold SIDE bytes after the anchor
                for a, b, k in ((lo, middle, place - SIDE - 1), (middle, hi, place)):
                    if a < b:
                        out.append((doc, a, b - a, texts[i][a:b - 1 + WINDOW]))
                        starts.append(begins[i] + k)
                        stops.append(begins[i] + k + GRAM + SIDE + (k < place))
        if out:
            key = Rolling(data).slices(np.array(starts), np.array(stops)).view(np.int64)
            doc, start, n, body = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                              pa.array(n, pa.int32()), pa.array(body, pa.binary())], schema=_SLICE)


def two_stage_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """``wanted`` (places) in the order of the suffixes of ``data`` that start there, by their first ``depth`` bytes.

    A suffix smaller than its successor is sorted directly; any other one is
    induced from its successor: inside the bucket of its first byte it stands
    as its successor stands among all, and before all directly sorted ones.
    Only suffixes that a wanted one is induced from are carried along.
    """
    n = len(data)
    x = data.astype(np.int16)
    # Smaller than the successor: decided by the next unequal byte; the empty suffix at the end is smallest.
    change = np.flatnonzero(x[1:] != x[:-1])
    nxt = np.searchsorted(change, np.arange(n))
    up = np.zeros(n, bool)
    has = nxt < len(change)
    up[has] = x[change[nxt[has]] + 1] > x[change[nxt[has]]]
    need = np.zeros(n, bool)
    need[wanted] = True
    # An induced suffix needs its successor, and so on down to a directly sorted one.
    next_up = np.minimum.accumulate(np.where(up, np.arange(n), n)[::-1])[::-1]
    reach = np.minimum(next_up[wanted], n - 1)
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, wanted, 1)
    np.add.at(delta, reach + 1, -1)
    need |= np.cumsum(delta[:n]) > 0
    direct = _sorted_directly(data, np.flatnonzero(need & up), depth)
    # Bucket scans, first bytes ascending.
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    direct_of = data[direct]
    cuts = np.searchsorted(direct_of, np.arange(257))
    order: list[np.ndarray] = []
    if n and need[n - 1] and not up[n - 1]:
        buckets[data[n - 1]].append(np.array([n - 1]))
    for byte in range(256):
        # Rounds over runs of this byte: each induces the next.
        own = [np.concatenate(buckets[byte])] if buckets[byte] else []
        while own and len(own[-1]):
            before = own[-1] - 1
            before = before[before >= 0]
            before = before[need[before] & ~up[before] & (data[before] == byte)]
            own.append(before)
        own.append(direct[cuts[byte]:cuts[byte + 1]])
        done = np.concatenate(own)
        buckets[byte] = []
        order.append(done)
        before = done[done > 0] - 1
        before = before[need[before] & ~up[before] & (data[before] > byte)]
        if len(before):
            first = data[before]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            at = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            for i, j in zip(at, np.r_[at[1:], len(first)]):
                buckets[first[i]].append(before[i:j])
    done = np.concatenate(order) if order else np.zeros(0, np.int64)
    mark = np.zeros(n, bool)
    mark[wanted] = True
    return done[mark[done]]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one big-endian number; zeros beyond the end."""
    padded = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(data)]
    return out


def _sorted_directly(data: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` bytes that start there, eight bytes a round, only ties going on."""
    if not len(at):
        return at
    word = np.r_[_words(data), np.zeros(depth + 8, np.uint64)]
    at = at[np.argsort(word[at], kind="stable")]
    value = word[at]
    group = np.cumsum(np.r_[0, (value[1:] != value[:-1]).astype(np.int64)])
    for k in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        value = word[at[tied] + k]
        by = np.lexsort((value, group[tied]))
        at[tied] = at[tied][by]
        value, g = value[by], group[tied]
        split = np.r_[False, (value[1:] != value[:-1]) & (g[1:] == g[:-1])]
        # Number the parts of every tied group apart from all others.
        mark = np.r_[False, np.diff(group) != 0]
        mark[tied[split]] = True
        group = np.cumsum(mark)
    return at


def repeated_windows(bodies: list[bytes], counts: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, place) of every window of these texts that also starts at a smaller (doc, place).

    The text ``i`` holds ``counts[i]`` windows, the first at ``start[i]`` of ``doc[i]``.
    """
    data, begins = concat(bodies)
    which = np.repeat(np.arange(len(bodies)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[which] + offset
    order = two_stage_order(data, at, WINDOW)
    # Adjacent common prefixes, eight bytes at a time, only while they go on.
    word = np.r_[_words(data), np.zeros(WINDOW, np.uint64)]
    equal = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, WINDOW - 8, 8), WINDOW - 8]:
        live = np.flatnonzero(equal)
        equal[live] = word[order[live] + k] == word[order[live + 1] + k]
    owner = np.searchsorted(begins, order, side="right") - 1
    d, p = doc[owner], start[owner] + order - begins[owner]
    group = np.cumsum(np.r_[0, (~equal).astype(np.int64)]) if len(order) else np.zeros(0, np.int64)
    by = np.lexsort((p, d, group))
    d, p, group = d[by], p[by], group[by]
    new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    later = (d != d[lead]) | (p != p[lead])
    return d[later], p[later]


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over texts sorted by key: byte spans of repeated windows. Whole buckets are sorted together, some at a time."""
    held: list[tuple] = []
    size = 0

    def flush(rows):
        seen: dict[tuple, tuple] = {}
        lone, doc, lo, hi = [], [], [], []
        for key, d, s, n, body in rows:  # in the order of (key, doc, start)
            first = seen.setdefault((key, body), (d, s))
            if first == (d, s):
                lone.append((key, d, s, n, body))
            else:
                doc.append(d)
                lo.append(s)
                hi.append(s + len(body))
        keys = np.array([r[0] for r in lone], np.int64)
        pair = np.zeros(len(keys), bool)
        pair[1:] |= keys[1:] == keys[:-1]
        pair[:-1] |= keys[1:] == keys[:-1]
        lone = [r for r, x in zip(lone, pair) if x]
        if lone:
            d, p = repeated_windows([r[4] for r in lone], np.array([r[3] for r in lone]),
                                    np.array([r[1] for r in lone], np.int64), np.array([r[2] for r in lone], np.int64))
            doc, lo, hi = np.r_[np.array(doc, np.int64), d], np.r_[np.array(lo, np.int64), p], np.r_[np.array(hi, np.int64), p + WINDOW]
        yield from _spans(np.array(doc, np.int64), np.array(lo, np.int64), np.array(hi, np.int64))

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("key", "doc", "start", "n", "body"))):
            if size >= SORT_BYTES and row[0] != held[-1][0]:
                yield from flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield from flush(held)


def _file_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of these texts as a run of its own, with its hash as anchor and its bucket's key as text."""
    held, n = [], 0
    for piece in pieces(batches, "body", PIECE_BYTES):
        key, doc, start, windows = (piece.column(x).to_numpy(zero_copy_only=False) for x in ("key", "doc", "start", "n"))
        data, begins = concat(piece.column("body").to_pylist())
        which = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begins[which] + offset
        h = Rolling(data).slices(at, at + WINDOW).view(np.int64)
        held.append((h, key[which], doc[which], _pack(start[which] + offset, 0, 1)))
        n += len(h)
        if n >= HELD_RUNS:
            yield from _firsts(held)
            held, n = [], 0
    if held:
        yield from _firsts(held)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        kept = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            data, at, gone, n, digest = (text or "").encode(), 0, 0, 0, hashlib.sha256()
            parts = []
            until = 0
            for s in sorted((x["lo"], x["hi"]) for x in spans or ()):
                lo, hi = s[0], min(s[1], len(data))
                if hi <= until:
                    continue
                if lo > until or n == 0:
                    n += 1
                    parts.append(data[until:lo])
                    gone += hi - lo
                else:
                    gone += hi - until
                until = hi
            parts.append(data[until:])
            for x in parts:
                digest.update(x)
            rows["n_bytes"].append(len(data))
            rows["n_removed"].append(gone)
            rows["n_spans"].append(n)
            rows["kept_sha256"].append(digest.hexdigest())
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(v, pa.string() if "sha" in k else pa.int64()) for k, v in rows.items()]],
                                         ["doc_id", *rows])


def repeats(by_doc: DataFrame) -> DataFrame:
    """(doc, spans) for documents that lose bytes, from (doc, text) rows with a non-null doc."""
    def meet(filed: DataFrame) -> DataFrame:
        return filed.repartition("h").sortWithinPartitions("h", "c", "doc", "p").mapInArrow(_meet_runs, _ROW_SQL)

    met = stored(meet(by_doc.mapInArrow(_file_runs, _ROW_SQL)), "runs")
    contested = met.where("kind = 0").groupBy("doc").agg(F.collect_list("p").alias("runs"))
    # The texts stand on the kept side of both joins, so that both read one shuffle of them.
    cut = stored(by_doc.join(contested, "doc", "left").select("doc", "text", "runs").mapInArrow(_cut_runs, _SLICE_SQL), "slices")
    # One key per BUCKET_BYTES of text at most, stored: Spark sees its size and broadcasts it while small.
    large = stored(cut.groupBy("key").agg(F.sum(F.col("n") + F.lit(WINDOW - 1)).alias("bytes"))
                   .where(F.col("bytes") > BUCKET_BYTES).select("key"), "large")
    small = cut.join(large, "key", "left_anti").select(*_SLICE.names)
    sorted_ = small.repartition("key").sortWithinPartitions("key", "doc", "start").mapInArrow(_sort_buckets, _ROW_SQL)
    dealt = meet(cut.join(large, "key", "left_semi").select(*_SLICE.names).mapInArrow(_file_windows, _ROW_SQL))
    found = met.union(sorted_).union(dealt).where("kind = 1").select("doc", F.col("c").alias("lo"), F.col("p").alias("hi"))
    return found.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by id and digest: a number that grows with them and is one for rows equal in both."""
    number, last = TaskContext.get().partitionId() << 33, None
    for b in batches:
        numbers = []
        for row in zip(b.column("doc_id").to_pylist(), b.column("digest").to_pylist()):
            number += last is not None and row != last
            last = row
            numbers.append(number)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), b.column("doc_id"), b.column("text")], ["doc", "doc_id", "text"])


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text), written, so that the numbers are settled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    dealt = rows.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    return stored(dealt.mapInArrow(_number, "doc long, doc_id long, text string"), "texts")


def report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, digest of what is left."""
    rows = numbered(docs)
    joined = rows.join(repeats(rows.select("doc", "text")), "doc", "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
