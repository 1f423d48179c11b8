import math
import re
from collections import Counter, defaultdict

import pytest
import regex

from contrail.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def test_quality_measures_and_verdicts(docs, corpus):
    got = Counter((r["doc_id"], *[r[c] for c in quality.FEATURES], r["base_failed"]) for r in quality.report(docs).collect())
    want = Counter()
    for r in corpus:
        m = measures(r[1])
        want[(r[0], *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert got == want
    kept = {r["doc_id"]: r["kept"] for r in quality.report(docs).collect()}
    text = {r[0]: r[1] for r in corpus}
    assert all(kept[i] for i in range(60))  # plain prose stays
    assert not any(kept[i] for i, t in text.items() if t and ("SHOUT" in t or "##" in t or t.startswith("same same")))


def test_quality_keep_returns_the_rows(docs, corpus):
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    flags = Counter(r["doc_id"] for r in quality.report(docs).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == flags


def test_estimate_finds_the_planted_classes():
    rules = ("r0", "r1", "prose")
    model = quality.estimate([((0, 0, 1), 900), ((-1, 0, 0), 60), ((0, -1, 0), 40)], rules)
    assert abs(model.prior - 0.9) < 0.02
    assert model.log_odds((0, 0, 1)) > 0 > model.log_odds((-1, 0, 0))
    assert min(model.accuracy().values()) > 0.9
    assert quality.estimate([], rules).prior == 0.5


def plain_votes(text):
    """The eleven rules, counted by hand."""
    t = text or ""
    n, chars, symbols, dup, repeated = measures(text)
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    letters = len(regex.findall(r"[\p{L}\p{M}]", t))
    inside = regex.compile(r"""["'(\u201c\u00ab]*\p{L}[\p{L}\p{M}'\u2019-]*[.,;:!?)"'\u2019\u201d\u00bb\u2026]*""")
    clean = sum(inside.fullmatch(x) is not None for x in w)
    upper, bang = sum("A" <= c <= "Z" for c in t), t.count("!")
    stops = sum(t.count(c) for c in ".!?\u3002\u0964")
    kinds = len(set(w))
    bounds = [
        (symbols * 10 > n, symbols * 50 <= n), (letters * 10 < chars * 7, letters * 100 >= chars * 85),
        (clean * 10 < n * 6, clean * 10 >= n * 8), (upper * 5 > chars * 2, upper * 100 <= chars * 15),
        (bang * 5 > n, bang * 20 <= n), (repeated * 100 > n * 15, repeated * 100 <= n * 5),
        (dup * 10 > len(lines) * 3, len(lines) >= 3 and dup == 0), (n < 10, n >= 50),
        (chars < 2 * n or chars > 20 * n, 3 * n <= chars <= 10 * n), (n >= 50 and kinds * 10 < n, kinds * 5 >= n * 2),
        (n >= 100 and stops * 200 < n, stops * 60 >= n and stops * 3 <= n)]
    return [-1 if bad else 1 if good else 0 for bad, good in bounds]


def plain_posteriors(all_votes):
    """The same model fitted document by document; abstentions say nothing."""
    post = [0.05 if min(v) < 0 else 0.95 for v in all_votes]
    for _ in range(200):
        size = (len(post) - sum(post) + 1, sum(post) + 1)
        prior = min(max(size[1] / sum(size), 1e-3), 1 - 1e-3)
        odds_of = []
        for j in range(len(all_votes[0])):
            ratio = {0: 1.0}
            for x, seed in ((-1, (0.4, 0.1)), (1, (0.1, 0.4))):
                bad = seed[0] + sum(1 - p for v, p in zip(all_votes, post) if v[j] == x)
                good = seed[1] + sum(p for v, p in zip(all_votes, post) if v[j] == x)
                r = (good / size[1]) / (bad / size[0])
                ratio[x] = min(r, 1) if x < 0 else max(r, 1)
            odds_of.append(ratio)
        new = []
        for v in all_votes:
            odds = prior / (1 - prior) * math.prod(odds_of[j][x] for j, x in enumerate(v))
            new.append(odds / (1 + odds))
        done = max(abs(a - b) for a, b in zip(new, post)) < 1e-9
        post = new
        if done:
            break
    return post


@pytest.mark.parametrize("given", [False, True])
def test_every_verdict_equals_a_plain_em(spark, docs, corpus, given):
    if given:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        corpus = [(r["doc_id"], r["text"]) for r in docs.collect()]
    votes = [plain_votes(r[1]) for r in corpus]
    post = plain_posteriors(votes)
    want, fails = Counter(), {}
    for r, p in zip(corpus, post):
        m = measures(r[1])
        fails[r[0]] = m[0] < 10 or 100 * m[4] > 20 * m[0]
        want[(r[0], not fails[r[0]] and p >= 0.5, round(p, 6))] += 1
    rows = quality.report(docs).collect()
    assert Counter((r["doc_id"], r["kept"], round(r["quality"], 6)) for r in rows) == want
    good = {r[0]: p >= 0.5 for r, p in zip(corpus, post)}
    open_ = [(r[0], v) for r, v in zip(corpus, votes) if not fails[r[0]]]
    # No document without a bad vote goes, and no vote against is the verdict by itself.
    assert all(good[i] for i, v in open_ if min(v) >= 0)
    if given:
        assert any(good[i] for i, v in open_ if min(v) < 0) and not all(good[i] for i, _ in open_)
        assert any(good[i] for i, v in open_ if min(v) < 1)
        for j in range(len(votes[0])):
            assert any(good[i] != (v[j] >= 0) for i, v in open_) and any(good[i] != (v[j] > 0) for i, v in open_)


def test_verdicts_agree_with_the_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.report(docs).where("NOT base_failed").join(labels, "doc_id")
    got = Counter(tuple(r) for r in rows.select("kept", labels["quality"]).collect())
    assert sum(n for (k, q), n in got.items() if k == bool(q)) >= 0.98 * sum(got.values()) > 300


def test_rules_no_better_than_chance_count_for_nothing():
    # "odd" finds good just what four others find bad.
    rows = [((1, -1, 1, 1, 1), 800), ((-1, 1, -1, -1, -1), 200)]
    for silence in (False, True):
        model = quality.estimate(rows, ("a", "odd", "b", "c", "d"), silence=silence)
        for j in range(5):
            down, none, up = model.weights(j)
            assert down <= 0 <= up and (silence or none == 0)


def test_clean_words_take_linear_time(spark):
    text = "a" + "'" * 1_000_000 + "# " + "(" * 1_000_000 + "# ok"
    got = quality.with_features(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got["_wq_n_clean"] == 1 and got["_wq_n_letters"] == 3


def test_quality_of_nothing(none):
    assert quality.report(none).count() == 0 and quality.keep(none).count() == 0


def fill(sizes, weights, cap):
    """Rounds of sharing by weight until none is above its cap."""
    total, out, free = float(sum(sizes)), {}, set(range(len(sizes)))
    while free:
        w = sum(weights[i] for i in free)
        over = {i for i in free if total * weights[i] / w > cap * sizes[i] + 1e-9}
        if not over:
            return [out[i] if i in out else total * weights[i] / w for i in range(len(sizes))]
        for i in over:
            out[i] = cap * sizes[i]
            total -= out[i]
        free -= over
    return [out[i] for i in range(len(sizes))]


def test_mix_reaches_its_targets(docs, corpus):
    rows = mixing.report(docs).collect()
    assert len(rows) == len(corpus)
    source = {r[0]: r[3] for r in corpus}
    per = defaultdict(lambda: [0, 0, None])
    for r in rows:
        p = per[source[r["doc_id"]]]
        p[0] += r["size"]
        p[1] += r["taken"]
        p[2] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] == measures({c[0]: c[1] for c in corpus}[r["doc_id"]])[0]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    want = fill([per[s][0] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    for s, t in zip(names, want):
        assert abs(per[s][2] - t) < 1e-6 and per[s][1] == int(per[s][2])
    again = mixing.report(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_mix_repeats_whole_rows(docs, corpus):
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= set(corpus)


def test_mix_of_nothing(none):
    assert mixing.report(none).count() == 0 and mixing.mix(none).count() == 0
