import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from contrail.llm import ann, log_bilinear

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_base_scores_equal_brute_force(docs, corpus, none):
    toks = [(r[0], [lower(w) for w in WORD.findall(r[1] or "")] + [""]) for r in corpus]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for i, t in toks if not held(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in toks:
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        want[(i, held(i), len(t), sum(counts[w] > 0 for w in t), n, round(score, 6))] += 1
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in log_bilinear.report(docs).collect())
    assert got == want
    assert log_bilinear.report(none).count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in log_bilinear.report(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, log_bilinear.SYMBOLS ** 3, 500))
    table = log_bilinear.train(code, rng.integers(1, 9, len(code)), steps=20).table().reshape(-1, log_bilinear.SYMBOLS)
    assert np.allclose((10.0 ** table).sum(axis=1), 1, atol=1e-4)
    flat = log_bilinear.train(code[:0], code[:0]).table()
    assert np.allclose(flat, -math.log10(log_bilinear.SYMBOLS), atol=1e-5)


def test_training_weighs_every_triple():
    n = log_bilinear.SYMBOLS
    code = np.array([(1 * n + 2) * n + 3, (4 * n + 5) * n + 6, (8 * n + 9) * n + 10])
    table = log_bilinear.train(code, np.array([10 ** 8, 5, 5])).table().reshape(n, n, n)
    assert (table[4, 5, 6] - table[4, 5, 10]) + (table[8, 9, 10] - table[8, 9, 6]) > 1


def test_words_of_one_symbol_follow_their_contexts(spark):
    """Two words of one symbol and one count, each with its own left neighbour; fillers take the other own symbols."""
    rng, held = random.Random(3), [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 5 == 1]
    fillers = [f"f{i:02}" for i in range(log_bilinear.OWN + 5)] * 2
    texts = []
    for _ in range(60):
        rng.shuffle(fillers)
        texts.append(" ".join(["the zoned and boned the f00 and", *fillers, "the and"]))
    asked = ["the zoned", "the boned", "and zoned", "and boned"]
    docs = spark.createDataFrame([*enumerate(texts), *zip(held, asked)], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in log_bilinear.report(docs).collect()}
    the_zoned, the_boned, and_zoned, and_boned = (score[i] for i in held[:4])
    assert the_zoned > the_boned + 1 and and_boned > and_zoned + 1

    lb = log_bilinear
    training = docs.where(~lb.held_out()).selectExpr("doc_id row", "doc_id", "false held_out", "CAST(text AS binary) text")
    vocab = lb.vocabulary(lb.word_counts(training.select("text")))
    encoded = lb.encode(training, vocab).select("ids")
    code, count = lb.triple_counts(encoded, vocab)
    model, pairs = lb.train(code, count), lb.pair_counts(code, count)
    feats = lb.features(model, pairs)
    vectors = lb.word_vectors(lb.word_sums(encoded, vocab, feats), vocab, feats, pairs)
    scorer, ids = lb.token_scorer(vocab, model, feats, vectors), vocab.ids()
    assert vocab.words == len(vocab.counts) + 1  # all shipped, and the end
    last = [*range(len(vocab.counts) + 1), *range(len(vocab.counts) + 1 + lb.OWN, len(vocab.symbols))]
    for before in (b"the", b"zoned", b"never seen"):  # all words, the end, one unknown word a symbol
        logs = np.array([scorer(np.array([ids[before], i]), np.zeros(2, int))[1] for i in last])
        logs[len(vocab.counts) + 1:] += math.log10(0.5)
        assert abs((10 ** logs).sum() - 1) < 1e-4


def exact(rows, k=20, every=20):
    width = max(len(v) for _, v in rows)
    ids = np.array([i for i, _ in rows])
    x = np.array([list(v) + [0.0] * (width - len(v)) for _, v in rows])
    return {int(q): [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            for q, s in ((ids[i], x @ x[i]) for i in np.flatnonzero(ids % every == 0))}


def test_search_is_exact_on_small_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a) for a in rng.normal(size=8)]) for i in range(90)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # many equal vectors
    bad = [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None]), (304, [float("nan")] * 8), (305, [float("inf")]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad], "vec_id long, embedding array<double>, rank int, score int")
    want = exact(rows)
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [got[q][i + 1][0] for i in range(len(near))] == [v for v, _ in near]
        assert np.allclose([got[q][i + 1][1] for i in range(len(near))], [s for _, s in near], atol=1e-12)
    assert ann.search(df.limit(0)).count() == 0
    few = ann.search(df.where("vec_id IN (0, 1, 2)")).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] == [v for v, _ in exact(rows[:3])[0]]


def test_learned_partitions_are_balanced_and_recall_holds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    label = ann.balanced_partition(x, ann.neighbour_graph(x), 8)
    assert np.bincount(label, minlength=8).max() <= 1.1 * len(x) / 8
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = exact(rows)
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = np.mean([len(got[q] & {v for v, _ in near}) / len(near) for q, near in want.items()])
    assert recall >= 0.9 and all(len(v) == 20 for v in got.values())


def test_small_tables_are_partitioned_and_norms_count(spark):
    rng = np.random.default_rng(8)
    small = [(i, [float(a) for a in rng.normal(size=8)]) for i in range(500)]
    df = spark.createDataFrame(small, "vec_id long, vec array<double>")
    assert ann.fit(df, 500, 1.0).parts > 1 and ann.fit(df, 10 ** 6, 1.0).parts > ann.fit(df, 500, 1.0).parts
    # A vector's best partners are the long ones, in its own cluster or not.
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 16))) * np.exp(1.2 * rng.normal(size=(6000, 1)))
    for rows in (small, [(i, v.tolist()) for i, v in enumerate(x)]):
        got = {}
        for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        recall = np.mean([len(got[q] & {v for v, _ in near}) / len(near) for q, near in exact(rows).items()])
        assert recall >= (0.95 if len(rows) > 500 else 1)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_keep_the_columns(spark, docs, none, empty, tmp_path):
    here = none if empty else docs
    here.write.parquet(str(tmp_path / "documents.parquet"))
    at = here
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        at = stage(spark, at, str(tmp_path))
        assert i == len(corpus_pipeline.STAGES) - 1 or at.columns == docs.columns
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert ids == {r["doc_id"] for r in at.collect()} and bool(ids) != empty
