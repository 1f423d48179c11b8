"""Clashing column names, unlike texts under one id, and texts that invite quadratic work."""

import hashlib
import time

from contrail.llm import chat, dart_minhash, pii, quality
from tests.llm.conftest import prose


def test_stages_take_columns_of_any_name(docs):
    odd = docs.selectExpr("*", "7 AS _wq_words", "doc_id AS _dm_doc", "1 AS doc", "'s' AS same", "'r' AS row", "cast(null AS string) AS own", "true AS empty")
    for stage in (quality.keep, dart_minhash.keep_first, pii.redact):
        got, plain = stage(odd), stage(docs)
        assert got.dtypes == odd.dtypes
        ids = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())
        assert ids(got) == ids(plain) and len(ids(got)) > 20
        assert {(r["_wq_words"], r["same"], r["row"], r["own"], r["empty"]) for r in got.collect()} == {(7, "s", "r", None, True)}


def test_unlike_texts_under_one_id_all_stay(spark):
    import random
    rng = random.Random(5)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    near = " ".join(a.split()[:-1] + ["last"])
    rows = [(1, a), (1, b), (1, b), (1, None), (1, None), (2, c), (2, near), (3, d), (3, ""), (7, b), (None, a), (None, a), (-4, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in dart_minhash.keep_first(df).collect()), key=str)
    # a and its near copies: the copy under the least id stays; b: the first of its ids that names its class
    texts = [t for _, t in got]
    assert texts.count(None) == 1 and texts.count("") == 1 and texts.count(c) == 1 and texts.count(d) == 1 and texts.count(b) == 1
    assert sum(t in (a, near) for i, t in got if i is not None) == 1
    assert [(i, t) for i, t in got if i is None] == [(None, a)] * 2


def test_scheme_runs_take_linear_time():
    anchors = pii.automaton()
    def took(n):
        best = 1e9
        for _ in range(3):
            t0 = time.perf_counter()
            pii.find("://" * n, anchors)
            best = min(best, time.perf_counter() - t0)
        return best
    assert took(80_000) < 8 * took(20_000) + 0.2
    assert pii.find("see https://x.y/z and a://b", anchors)


def test_conversation_of_megabytes(spark):
    text = "A sentence that goes on and on, é and 日本, <|im_end|> too. " * 85_000
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (2, 0, "assistant", "hi")],
                                  "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in chat.report(turns).collect()}
    assert got[1]["loss_chars"] == len(text) > 4_900_000 and got[1]["n_turns"] == 2
    assert got[1]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got[2]["loss_chars"] == 2 and 0 < got[2]["loss_tokens"] < 3
