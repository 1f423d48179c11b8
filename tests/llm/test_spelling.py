import random
import re
import zlib
from collections import Counter

import pytest

from contrail.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def brute(count):
    """{word: (form, root, n, n_near, form_n)} by holding every word against every other."""
    out = {}
    for w, n in count.items():
        near = [x for x in count if one_edit(w, x)]
        best = min(near, key=lambda x: (-count[x], x), default=None)
        form = best if best is not None and count[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), count[form] if form else None]
    for w, v in out.items():
        end = w
        while out[end][0]:
            end = out[end][0]
        v[1] = end
    return {w: tuple(v) for w, v in out.items()}


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variants_equal_brute_force(docs, corpus, none):
    want = brute(words_of([(r[0], r[1]) for r in corpus]))
    assert rows_of(spelling.report(docs)) == want
    assert spelling.report(none).count() == 0


def test_variants_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute(words_of([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]))
    got = rows_of(spelling.report(docs))
    assert got == want and any(v[0] for v in got.values())


@pytest.mark.parametrize("cell", [1, 4096])
def test_near_pairs_of_hard_words(spark, cell):
    """Repeated bigrams, few letters, letters above Z, long words, every kind of edit; cells dealt in parts or not."""
    rng = random.Random(5)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randrange(5, 9))) for _ in range(300)}
    words |= {"a" * k for k in range(5, 14)} | {"ab" * 5, "ab" * 5 + "a", "ba" * 5, "a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1499}
    base = "separate"
    for i in range(9):
        words |= {base[:i] + c + base[i:] for c in "xe"} | {base[:i] + c + base[i + 1:] for c in "xe" if i < 8} | {base[:i] + base[i + 1:]}
    words = sorted(w for w in words if len(w) >= 5)
    df = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long").repartition(4)
    got = {(r["a"], r["b"]) for r in spelling.near_pairs(df, cell).collect()}
    short = [w for w in words if len(w) < 100]
    want = {(a, b) for a in short for b in short if a < b and one_edit(a, b)}
    want |= {("a" * 3000, "a" * 3001), ("a" * 3000, "a" * 1500 + "b" + "a" * 1499)}
    assert got == want


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(2)
    for _ in range(300):
        grams = [(rng.randrange(9), at, rng.randrange(1, 9)) for at in sorted(rng.sample(range(9), rng.randrange(3, 7)))]
        (_, p), (_, q) = spelling.pivots(grams)
        cost = {at: n for _, at, n in grams}
        assert q - p >= 2
        assert cost[p] + cost[q] == min(cost[x] + cost[y] for x in cost for y in cost if y - x >= 2)


def test_chain_of_forms_ends_at_the_last(spark):
    steps = ["abcde", "abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    df = spark.createDataFrame([(w, 3 * 2 ** i) for i, w in enumerate(steps)] + [("abcdx", 6)], "word string, n long")
    got = rows_of(spelling.variants(df))
    assert got == brute({w: 3 * 2 ** i for i, w in enumerate(steps)} | {"abcdx": 6})
    assert got["abcde"][0] == "abcdef" and got["abcde"][1] == steps[-1]
