import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from contrail.llm import dart_minhash, hashing, suffix_dedup
from contrail.llm.components import components


def cut_repeats(rows):
    """Brute force over (doc_id, text); a repeated (doc_id, place) is no earlier one."""
    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            first = seen.setdefault(data[i:i + 100], (doc, i))
            if first != (doc, i):
                gone[i:i + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings_equal_brute_force(docs, corpus, none):
    want = cut_repeats([(r[0], r[1]) for r in corpus])
    rows = suffix_dedup.report(docs).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]
    assert suffix_dedup.report(none).count() == 0


def test_substrings_with_shared_edges(spark):
    """Passages cut at odd places, periodic texts, and a line common to all documents."""
    rng = random.Random(4)
    pool = "".join(rng.choice("abcd ") for _ in range(700))
    line = "".join(rng.choice("xyz ") for _ in range(80))
    rows = []
    for i in range(80):
        a = rng.randrange(500)
        rows.append((i, "".join(rng.choice("efgh") for _ in range(rng.randrange(60))) + pool[a:a + rng.randrange(60, 200)]
                     + line + "".join(rng.choice("mn") for _ in range(rng.randrange(90)))))
    rows += [(200, "ab" * 200), (201, "ab" * 100), (202, "a" * 101)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = cut_repeats(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.report(df).collect()} == want


def test_line_common_to_many_documents_is_not_sorted_in_one_task(spark, monkeypatch):
    """A line just under a window's length in 3,000 different contexts, some of which go on alike."""
    rng = random.Random(21)
    line = "".join(rng.choice("xyz ") for _ in range(99))
    ends = ["".join(rng.choice("abcd") for _ in range(40)) for _ in range(300)]
    rows = [(i, "".join(rng.choice("efgh") for _ in range(rng.randrange(20))) + rng.choice(ends) + line + rng.choice(ends)
             + "".join(rng.choice("mn") for _ in range(rng.randrange(20)))) for i in range(3000)]
    sort, limit = suffix_dedup._sort_buckets, 1 << 18

    def watched(batches):
        def seen():
            size = defaultdict(int)
            for b in batches:
                for key, body in zip(b.column("key").to_pylist(), b.column("body").to_pylist()):
                    size[key] += len(body)
                    assert size[key] <= limit, "a bucket of any size is sorted at once"
                yield b
        yield from sort(seen())
    monkeypatch.setattr(suffix_dedup, "_sort_buckets", watched)
    got = suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == cut_repeats(rows)


def test_unlike_texts_under_one_id_lose_their_own_repeats_only(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(150)
    rows = [(1, text(400)), (1, text(90) + shared + text(200)), (1, text(300)), (2, shared + text(250)), (2, text(500)),
            (None, text(200) + shared), (None, text(450)), (None, shared + text(30)), (3, text(120))]
    rows += [rows[1], rows[6]]
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()))
    want = cut_repeats([(i, r[1]) for i, r in enumerate(order)])
    got = suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *want[order.index(r)]) for r in rows), key=key)


def test_two_stage_order():
    rng = random.Random(3)
    for n, letters in ((1, b"a"), (60, b"a"), (500, b"ab"), (2000, b"abcdef")):
        data = np.frombuffer(bytes(rng.choice(letters) for _ in range(n)), np.uint8)
        wanted = np.array(sorted(rng.sample(range(n), max(1, n // 3))))
        got = suffix_dedup.two_stage_order(data, wanted, 100)
        keys = [data.tobytes()[i:i + 100] for i in got]
        assert sorted(got.tolist()) == wanted.tolist() and keys == sorted(keys)


def test_shingles_equal_plain_sets():
    texts = ["a b c d e f g", "a b c d e  f\tg", "", "one two", "a b c d e f g a b c d e f g", " x "]
    value, owner = hashing.shingles([t.encode() for t in texts])
    got = [set(value[owner == i].tolist()) for i in range(len(texts))]
    assert got[0] == got[1] and not got[2] and len(got[3]) == len(got[5]) == 1 and got[3] != got[5]
    assert len(got[0]) == 3 and len(got[4]) == 7 and got[0] < got[4]


def test_signatures_estimate_weighted_similarity():
    share = []
    for seed in range(8):
        element = hashing.mix(np.array([1, 2, 3, 1, 2, 4], np.uint64) + np.uint64(seed * 100))
        sig = dart_minhash.signatures(element, np.array([2.5, 1, .5, 1.5, 1, 2]), np.array([0, 0, 0, 1, 1, 1]), 2, k=2048)
        share.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(share) - 2.5 / 6) < 0.02
    assert not dart_minhash.signatures(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), 2).any()


def classes_by_brute_force(rows):
    sets, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def unite(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    text_of = {}
    for doc, text in rows:
        if doc is None:
            continue
        parent.setdefault(doc, doc)
        if text is None:
            continue
        if text in text_of:
            unite(text_of[text], doc)
        text_of.setdefault(text, doc)
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                unite(a, b)
    return {d: find(d) for d in parent}


def test_classes_equal_brute_force(docs, corpus, none):
    want = classes_by_brute_force([(r[0], r[1]) for r in corpus])
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.classes(docs).collect()}
    assert {k: v for k, v in got.items() if k is not None} == want
    assert None in got
    kept = dart_minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))
    assert dart_minhash.classes(none).count() == 0 and dart_minhash.keep_first(none).count() == 0


def test_chains_of_near_copies(spark):
    """Neighbours in a chain are alike, its ends are not; and groups larger than the pivots."""
    rng = random.Random(9)
    rows = []
    for g in range(3):
        words = [f"g{g}w{i}" for i in range(150)]
        for step in range(25):
            rows.append((g * 1000 + step, " ".join(words)))
            words = words[:]
            words[rng.randrange(150)] = f"n{g}{step}"
            words[rng.randrange(150)] = f"m{g}{step}"
    want = classes_by_brute_force(rows)
    got = dart_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want


def test_group_in_many_cells(spark, monkeypatch):
    """A group whose members are about as alike as the threshold, cut into cells of a few members."""
    monkeypatch.setattr(dart_minhash, "BLOCK", 4)
    monkeypatch.setattr(dart_minhash, "PIVOTS", 1)
    rng = random.Random(17)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = base[:]
        for _ in range(rng.randrange(2, 7)):
            words[rng.randrange(200)] = f"n{rng.random()}"
        rows.append((i, " ".join(words)))
    want = classes_by_brute_force(rows)
    assert 2 < len(set(want.values())) < 60
    got = dart_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (7, 7), (200, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    roots = defaultdict(set)
    for r in got.collect():
        roots[r["root"]].add(r["doc"])
    assert roots == {0: set(range(1, 41)) | {200}, 100: {101, 102}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert got.select(F.countDistinct("doc")).first()[0] == got.count()
