import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from contrail.llm import bpe, chat, language, pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
            "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), i, (kind, m.start(), m.end())))
    return [s for _, _, s in sorted(out)]


ANCHORS = pii.automaton()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.+-() @ab:/", max_size=60))
def test_base_spans_equal_a_pattern_scan(text):
    got = [s for s in pii.find(text, ANCHORS) if s[0] in pii.BASE_KINDS]
    assert got == base_spans(text)


def test_added_spans_and_mask():
    text = "see https://x.example/a?b=1. IBAN DE89370400440532013000 account no 12345678 me@x.org"
    spans = pii.find(text, ANCHORS)
    assert {s[0] for s in spans} >= {"url", "iban", "account", "email"}
    shown = pii.mask(text, [s for s in spans if s[0] in pii.REDACTED])
    assert "me@x.org" not in shown and "12345678" not in shown and "https://x.example/a?b=1" in shown
    assert pii.mask("plain", []) == "plain"


def test_pii_report_and_redact(docs, corpus, none):
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    for r in corpus:
        want = base_spans(r[1] or "")
        assert got[r[0]]["base_sha256"] == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert got[r[0]]["n_email"] == sum(s[0] == "email" for s in want)
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == len(corpus)
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out.collect())
    assert pii.report(none).count() == 0 and pii.redact(none).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return bpe.load(bpe.tokenizer_path())


def same(own, library, texts):
    for text, (ids, shown), enc in zip(texts, own.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == enc.ids, text
        assert own.decode(ids) == shown == library.decode(enc.ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5), st.lists(st.text(alphabet="abeinrst", max_size=30), max_size=5))
def test_bpe_equals_the_library(own, library, any_texts, words):
    same(own, library, any_texts + words)


def test_bpe_odd_texts(own, library, docs, corpus, none):
    same(own, library, ["<|endoftext|>a<|startoftext|>", "ΟΔΟΣ Σ", "I'LL don't 12³", "a" * 500, " \x1c \x85 ", "", "<|endoftext"])
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in bpe.report(docs).collect())
    want = Counter()
    for r in corpus:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())] += 1
    assert got == want
    assert bpe.report(none).count() == 0


def test_bpe_ids_are_made_without_decoding(library, monkeypatch):
    fresh = bpe.load(bpe.tokenizer_path())
    monkeypatch.setattr(bpe.Bpe, "decode", lambda *_: pytest.fail("decoded"))
    texts = ["The river, the rivers <|endoftext|> the", "", "Flüsse " * 50, "the"]
    for _ in range(2):  # words not seen before, then held ones
        got = [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in fresh.encode_ids(texts)]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert all(isinstance(ids, bytes) for ids in fresh.words.values())  # no decoded text beside them


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\", "<|im_end|>"]),
                          st.text(alphabet="<|\\>im_end\na ", max_size=25)), max_size=5))
def test_chat_round_trip(turns):
    shown, spans = chat.render(turns)
    assert chat.parse(shown) == turns
    assert [chat.unescape(shown[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_align_cuts_tokens_to_spans():
    starts, ends = np.array([0, 3, 3, 5, 9]), np.array([3, 5, 5, 9, 12])
    mask, cut = chat.align(starts, ends, [(2, 6), (9, 10), (12, 12)])
    assert mask.tolist() == [True, True, True, True, True] and cut == [(2, 6), (9, 10)]


def test_chat_report(spark):
    rows = [(1, 0, "user", "hi <|im_end|>", 9), (1, 1, "assistant", " \n ok <|im_start|> é日", 9), (1, 2, None, None, 9),
            (2, 1, "assistant", "b", 9), (2, 1, "assistant", "a", 9), (None, 0, "assistant", "x" * 5000, 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, weight int")
    got = {r["conv_id"]: r for r in chat.report(turns).collect()}
    for cid in (1, 2, None):
        conv = sorted((t, r or "", x or "") for c, t, r, x, _ in rows if c == cid)
        learnt = "".join(x for _, r, x in conv if r == "assistant")
        r = got[cid]
        assert r["n_turns"] == len(conv) and r["loss_chars"] == len(learnt)
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{b}\n{x}\n" for _, b, x in conv).encode()).hexdigest()
    assert chat.report(turns.limit(0)).count() == 0


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97


def test_language_mixture_and_odd_texts(spark, docs, corpus, none):
    import random
    rng = random.Random(2)
    words = {"aa": ["bana", "lamo", "kato", "miro"], "bb": ["zwix", "qurz", "vexy", "jupz"]}
    say = lambda l, n: " ".join(rng.choice(words[l]) for _ in range(n))
    rows = [(i, say(l, 30), l) for i, l in enumerate(["aa", "bb"] * 10)]
    rows += [(100, say("aa", 30) + " " + say("bb", 10), None), (101, None, None), (102, "123 !?", None), (103, "", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.report(df).collect()}
    assert got[100]["lang_pred"] == "aa" and abs(got[100]["score"] - 0.75) < 0.1
    assert [got[i]["lang_pred"] for i in (101, 102, 103)] == ["und"] * 3 and got[101]["score"] == 0
    assert language.report(docs).count() == len(corpus)
    assert language.report(none).count() == 0
