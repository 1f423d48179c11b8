import random
import re

import numpy as np
from pyspark.sql import functions as F

from contrail.llm import group_join

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """[(doc_id, n, component)] by holding every text against every other."""
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and top[i] != top[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                    old, new = top[i], top[j]
                    top = [new if t == old else t for t in top]
    least = {}
    for (doc, _), t in zip(rows, top):
        if doc is not None:
            least[t] = min(least.get(t, doc), doc)
    return sorted(((d, len(s), least.get(t) if s else d) for (d, _), s, t in zip(rows, sets, top)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], "doc_id long, text string, row int, n long, key string").repartition(3)
    return sorted((tuple(r) for r in group_join.report(df).collect()), key=str)


def test_components_equal_brute_force(docs, corpus, none):
    want = brute([(r[0], r[1]) for r in corpus])
    assert sorted((tuple(r) for r in group_join.report(docs).collect()), key=str) == want
    assert group_join.report(none).count() == 0


def family(rng, base, n, changes):
    out = []
    for _ in range(n):
        words = base[:]
        for _ in range(rng.randrange(changes)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def hard_texts(seed, scale=1):
    """Families of near copies round the threshold, a passage common to a third, short texts, and unlike ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for k in range(6):
        texts += family(rng, [word() for _ in range(rng.randrange(8, 150))], 12 * scale, 2 + k % 4)
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(4, 120))]) for _ in range(40 * scale)]
    texts += family(rng, passage, 25 * scale, 4) + family(rng, passage + passage[:20], 10 * scale, 3)
    texts += [" ".join(word() for _ in range(rng.randrange(1, 80))) for _ in range(40 * scale)]
    texts += ["A b C", "a B c", "a b c", "a b", "", " \n", None, None, "x " * 300, "X " * 200, "É é É é é", "é é É é é"]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1]), (None, "only one without an id and more words"), (0, "another text of id nought, unlike the first")]


def test_hard_texts_equal_brute_force(spark, monkeypatch):
    rows = hard_texts(1)
    want = brute(rows)
    assert got(spark, rows) == want
    monkeypatch.setattr(group_join, "MEMBERS", 3)  # many blocks, groups and cells
    monkeypatch.setattr(group_join, "ASKING", 2)
    monkeypatch.setattr(group_join, "COMMON_FROM", 4)
    assert got(spark, rows) == want
    monkeypatch.setattr(group_join, "FEW", 0)  # joins in place of broadcasts
    monkeypatch.setattr(group_join, "first_links", lambda texts, first: texts.sparkSession.createDataFrame([], "a long, b long"))
    assert got(spark, rows) == want  # by the matrix alone


def test_heads_share_what_the_bound_asks():
    """Of two linked sets the heads share as many tokens as either's bound says, in any order."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        pool = rng.permutation(2000)
        shared = int(rng.integers(0, n + 1))
        x = set(pool[:n])
        y = set(pool[n - shared:n - shared + int(rng.integers(max(1, shared), n + 60))])
        both = len(x & y)
        if 5 * both < 4 * len(x | y):
            continue
        head = [set(sorted(s)[:group_join.head_length(len(s))]) for s in (x, y)]
        for s in (x, y):
            assert len(head[0] & head[1]) >= 1 + group_join._least_shared(len(s)) // group_join.EXTRA


def test_places_of_shared_tokens_keep_every_link(spark):
    """Of two linked sets enough shared tokens are where the sizes ask for them, also seen through a group."""
    rng = np.random.default_rng(2)
    rows = []
    for pair in range(1500):
        n = int(rng.integers(1, 260))
        m = int(rng.integers((4 * n + 4) // 5, 5 * n // 4 + 1))
        least = -(-4 * (n + m) // 9)
        both = least if pair % 2 else int(rng.integers(least, min(n, m) + 1))
        pool = rng.permutation(1000)
        x, y = sorted(pool[:n]), sorted([*pool[:both], *pool[n:n + m - both]])
        assert 5 * both >= 4 * (n + m - both)
        at = [{t: i for i, t in enumerate(s[:group_join.head_length(len(s))])} for s in (x, y)]
        low, high = m - int(rng.integers(0, 3)), m + int(rng.integers(0, 3))  # of other members of a group
        rows += [(pair, n, at[0][t], low, high, max(0, at[1][t] - int(rng.integers(0, 3)))) for t in at[0].keys() & at[1].keys()]
    df = spark.createDataFrame(rows, "pair int, n long, place int, least long, most long, first int")
    kept = (df.where(group_join._may_link("n", "place", "least", "most", "first")).groupBy("pair", "n").count()
            .where(F.col("count") >= group_join._wanted("n")))
    assert kept.count() == 1500


def test_near_copies_below_the_threshold_do_not_meet(spark, monkeypatch):
    """Copies of one text with four words changed in each: no two link, and few of their tokens are held together."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    rows = []
    for i in range(300):
        words = base[:]
        for j in rng.sample(range(5, 140, 10), 4):
            words[j] = f"v{i}x{j}"
        rows.append((i, " ".join(words)))
    seen = []
    inner = group_join.open_groups
    monkeypatch.setattr(group_join, "open_groups", lambda tokens, tops: seen.append(inner(tokens, tops)) or seen[-1])
    assert got(spark, rows) == brute(rows)
    assert sum(df.count() for df in seen) == 0


def test_common_tokens_are_counted_exactly_and_bounded(spark):
    texts = spark.createDataFrame([(i, f"one two three four five six n{i} m{i} " + ("a b c d e " * 3 if i % 20 == 0 else "")) for i in range(200)],
                                  "row long, text string").repartition(5)
    for bucket in (1 << 22, 50):
        common = group_join.common_tokens(texts, 1200, bucket_tokens=bucket)
        sets = [group_join.shingles([r["text"].encode()])[0] for r in texts.collect()]
        value, n = np.unique(np.concatenate(sets), return_counts=True)
        assert sorted(np.log2(n[n >= 8]).astype(int).tolist()) == sorted(common.level.tolist())
        assert (common.levels(value) > 0).tolist() == (n >= 8).tolist()
    assert set(group_join.common_tokens(texts, 1200, limit=3).level.tolist()) == {7}
    assert len(group_join.common_tokens(texts, 1200, limit=1).token) == 0
