import random

import pytest

TABLE = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"


def prose(rng, n, words=("the", "and", "river", "stone", "walked", "over", "hill", "morning", "light", "quiet")):
    return " ".join(rng.choice(words) + rng.choice(["", "ly", "er", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty, very long, equal, near-equal and junk texts, ties and clashing column names."""
    rng = random.Random(11)
    passage = prose(rng, 30)
    base = prose(rng, 120).split()
    near = base[:]
    near[60] = "changed"
    texts = [prose(rng, rng.randint(12, 200)) for _ in range(60)]
    texts += [" ".join(base), " ".join(near), " ".join(base), None, None, "", "", "one two", "one two", "x"]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(4)]
    texts += ["a" * 450, "ab" * 300, prose(rng, 6000), "é" * 120 + "日本" * 60 + "é" * 120]
    texts += ["SHOUT!! LOUD!! " * 30, "st## ab*** cd%%% ef&&& " * 40, "same same same same same same " * 20]
    texts += ["mail a.b@c.de, ip 10.0.0.1 and 999.1.1.1, card 4111 1111 1111 1111, tel +49 30 1234567 x",
              "see https://x.example/a?b=1. IBAN DE89370400440532013000 account no 12345678 a@b@c.d",
              "dots 1.2.3.4.5.6.7.8 +1234567890 12-34 5555555555554444"]
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], len(t or ""), "s", "k") for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "text without an id " + prose(rng, 20), "en", "a", 5, "s", "k"))
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, TABLE).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], TABLE)
