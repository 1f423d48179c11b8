"""Quality rules by weak supervision, in DataFrame expressions only.

Eleven rules look at one measure each and vote good (+1), bad (-1) or abstain
(0) on a document; no rule decides alone. The number of documents per vote
pattern (at most 3^rules rows, whatever the corpus size) is aggregated by
Spark; expectation-maximisation over that table estimates, per class, how
often each rule casts each vote. The posterior is then a plain column
expression. Two assumptions hold the classes in place: an abstention says
nothing, and no vote speaks against its meaning (where the data say otherwise,
its rates in the two classes are pooled, so that it counts for nothing).

Defined results: a null text counts as empty; an empty text has no words and
fails the base rule; an empty table gives an empty result; repeated rows each
count and each come back; extra columns are not read. A text is measured in
one task, its words held as an array; no work is more than linear in its
length but for a sort of its repeated windows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.store import stored
from contrail.llm.words import no_space, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
# A word of letters with marks, hyphens and apostrophes, punctuation around it. Possessive: linear in any word.
CLEAN_WORD = r"""^["'(\u201c\u00ab]*+\p{L}[\p{L}\p{M}'\u2019-]*+[.,;:!?)"'\u2019\u201d\u00bb\u2026]*+$"""
STOPS = ".!?\u3002\u0964"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def with_features(df: DataFrame, text_col: str = "text", prefix: str = "_wq_") -> DataFrame:
    """``df`` plus the measures of its text, all named with ``prefix``.

    Arrays stay inside one row (never exploded), so nothing is shuffled. Each
    intermediate is its own column: an expression used in a lambda must be an
    attribute or it would be evaluated once per element.
    """
    p = prefix
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn(f"{p}words", words(text))
    df = df.withColumn(f"{p}hash", F.transform(f"{p}words", lambda w: F.xxhash64(w)))
    h, n = F.col(f"{p}hash"), F.size(f"{p}hash")
    df = df.withColumn(f"{p}win", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    win = F.col(f"{p}win")
    # Windows sorted with their places; only texts with a repeated window pay for it.
    df = df.withColumn(f"{p}sorted", F.when(
        F.size(F.array_distinct(win)) < F.size(win),
        F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col(f"{p}sorted")
    df = df.withColumn(f"{p}pos", F.sort_array(F.transform(F.filter(
        s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    pos = F.col(f"{p}pos")
    repeat = F.aggregate(
        F.transform(pos, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(pos, j + 1) - x, F.lit(WINDOW))).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn(f"{p}lines", F.filter(F.split(text, "\n"), lambda x: F.length(no_space(x)) > 0))
    lines = F.col(f"{p}lines")
    df = df.withColumns({
        f"{p}n_words": n.cast("long"),
        f"{p}n_distinct": F.size(F.array_distinct(h)).cast("long"),
        f"{p}word_chars": F.length(no_space(text)).cast("long"),
        f"{p}n_symbols": _count_of(text, SYMBOLS),
        f"{p}n_upper": _count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        f"{p}n_bang": _count_of(text, "!"),
        f"{p}n_letters": F.length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")).cast("long"),
        f"{p}n_clean": F.size(F.filter(f"{p}words", lambda w: w.rlike(CLEAN_WORD))).cast("long"),
        f"{p}n_stops": _count_of(text, STOPS),
        f"{p}n_lines": F.size(lines).cast("long"),
        f"{p}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        f"{p}n_repeat_words": F.coalesce(repeat, F.lit(0).cast("long")),
    })
    return df.drop(*[f"{p}{c}" for c in ("words", "hash", "win", "sorted", "pos", "lines")])


def base_failed(prefix: str = "_wq_") -> Column:
    """The fixed rule: too few words, or too many words in repeated windows."""
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > REPEAT_PERCENT * n)


def votes(prefix: str = "_wq_") -> dict[str, Column]:
    """Rule name -> vote column. Integer comparisons only, so votes are exact.

    Each rule has one measure and two bounds; between them it abstains.
    """
    c = {k: F.col(f"{prefix}{k}") for k in (
        "n_words", "n_distinct", "word_chars", "n_symbols", "n_upper", "n_bang", "n_letters", "n_clean",
        "n_stops", "n_lines", "n_dup_lines", "n_repeat_words")}
    n, chars = c["n_words"], c["word_chars"]
    rules = {  # rule: (bad if, good if)
        "symbols": (10 * c["n_symbols"] > n, 50 * c["n_symbols"] <= n),
        "letters": (10 * c["n_letters"] < 7 * chars, 20 * c["n_letters"] >= 17 * chars),
        "clean_words": (10 * c["n_clean"] < 6 * n, 10 * c["n_clean"] >= 8 * n),
        "capitals": (5 * c["n_upper"] > 2 * chars, 20 * c["n_upper"] <= 3 * chars),
        "exclaiming": (5 * c["n_bang"] > n, 20 * c["n_bang"] <= n),
        "repeats": (20 * c["n_repeat_words"] > 3 * n, 20 * c["n_repeat_words"] <= n),
        "lines": (10 * c["n_dup_lines"] > 3 * c["n_lines"], (c["n_lines"] >= 3) & (c["n_dup_lines"] == 0)),
        "length": (n < MIN_WORDS, n >= 50),
        "word_size": ((chars < 2 * n) | (chars > 20 * n), (chars >= 3 * n) & (chars <= 10 * n)),
        "variety": ((n >= 50) & (10 * c["n_distinct"] < n), 5 * c["n_distinct"] >= 2 * n),
        "sentences": ((n >= 100) & (200 * c["n_stops"] < n), (60 * c["n_stops"] >= n) & (3 * c["n_stops"] <= n)),
    }
    return {k: F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)) for k, (bad, good) in rules.items()}


@dataclass(frozen=True)
class VoteModel:
    """Class-conditional vote probabilities; index 0 is bad, 1 is good."""

    rules: tuple[str, ...]
    prior: float
    prob: tuple[tuple[tuple[float, float, float], ...], ...]  # [class][rule][vote + 1]
    silence: bool = True  # an abstention counts as evidence too

    def accuracy(self) -> dict[str, float]:
        """P(vote is right | the rule votes), per rule."""
        out = {}
        for j, name in enumerate(self.rules):
            b, g = self.prob[0][j], self.prob[1][j]
            right = (1 - self.prior) * b[0] + self.prior * g[2]
            out[name] = right / (right + (1 - self.prior) * b[2] + self.prior * g[0])
        return out

    def weights(self, rule: int) -> tuple[float, float, float]:
        """What a bad vote, an abstention and a good vote of the rule add to the log-odds of good."""
        down, none, up = (math.log(g / b) for b, g in zip(self.prob[0][rule], self.prob[1][rule]))
        return down, none if self.silence else 0.0, up

    def log_odds(self, vote: Sequence[int]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(self.weights(j)[v + 1] for j, v in enumerate(vote))

    def log_odds_column(self, vote: dict[str, Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, name in enumerate(self.rules):
            down, none, up = self.weights(j)
            total = total + F.when(vote[name] < 0, F.lit(down)).when(vote[name] > 0, F.lit(up)).otherwise(F.lit(none))
        return total


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: Sequence[str],
             rounds: int = 200, smooth: float = 1.0, silence: bool = True) -> VoteModel:
    """EM over (vote pattern, number of documents) rows.

    Starts from the reading "any bad vote means bad". Add-``smooth`` counts
    (bad texts expected to draw bad votes, good texts good ones) keep every
    probability inside (0, 1), and the prior is kept 1e-3 away from 0 and 1,
    so an empty or one-sided corpus still gives a usable model. Where good
    texts draw more of a rule's bad votes than bad ones do (or fewer of its
    good votes), both classes get the rate of all texts. ``silence`` says
    whether abstentions are evidence: rules that only ever cast one kind of
    vote need it, rules that cast both do not.
    """
    patterns = sorted(patterns)  # the same sums in the same order on every run
    vote = np.array([v for v, _ in patterns], np.int64).reshape(len(patterns), len(rules))
    cast = np.stack([vote == k for k in (-1, 0, 1)], axis=2).astype(np.float64)  # [pattern, rule, vote + 1]
    n = np.array([c for _, c in patterns], np.float64)
    start = smooth * np.array([[0.4, 0.5, 0.1], [0.1, 0.5, 0.4]])
    good = np.where((vote < 0).any(axis=1), 0.05, 0.95)
    model = None
    for _ in range(rounds):
        share = np.stack([n * (1 - good), n * good])  # [class, pattern]
        mass = share.sum(axis=1) + smooth
        count = np.einsum("yp,pjk->yjk", share, cast) + start[:, None, :]
        prob = count / mass[:, None, None]
        pooled = count.sum(axis=0) / mass.sum()
        for k, turned in ((0, prob[1, :, 0] > prob[0, :, 0]), (2, prob[1, :, 2] < prob[0, :, 2])):
            prob[:, :, k] = np.where(turned, pooled[:, k], prob[:, :, k])
        prob[:, :, 1] = 1 - prob[:, :, 0] - prob[:, :, 2]
        prior = float(np.clip(mass[1] / mass.sum(), 1e-3, 1 - 1e-3))
        model = VoteModel(tuple(rules), prior, tuple(tuple(map(tuple, y)) for y in prob.tolist()), silence)
        weight = np.array([model.weights(j) for j in range(len(rules))])
        log_odds = math.log(prior / (1 - prior)) + np.einsum("jk,pjk->p", weight, cast)
        new = 1 / (1 + np.exp(-np.clip(log_odds, -700, 700)))
        moved = np.abs(new - good).max(initial=0.0)
        good = new
        if moved < 1e-9:
            break
    return model


def fit(measured: DataFrame, prefix: str = "_wq_") -> VoteModel:
    """Model from all rows of ``measured`` (the output of :func:`with_features`)."""
    named = votes(prefix)
    rules = list(named)
    rows = (measured.select(*[v.alias(k) for k, v in named.items()])
            .groupBy(*rules).agg(F.count(F.lit(1)).alias("n")).collect())
    return estimate([(tuple(r[k] for k in rules), r["n"]) for r in rows], rules, silence=False)


def judged(measured: DataFrame, model: VoteModel, prefix: str = "_wq_", threshold: float = 0.5) -> DataFrame:
    """``measured`` with ``base_failed``, ``quality`` (posterior) and ``kept``, all prefixed."""
    quality = 1 / (1 + F.exp(-model.log_odds_column(votes(prefix))))
    out = measured.withColumn(f"{prefix}base_failed", base_failed(prefix))
    out = out.withColumn(f"{prefix}quality", quality)
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & (F.col(f"{prefix}quality") >= threshold))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its measures, the base verdict and the method's.

    The measures are a narrow table; it is written once, so each text is
    worked through once.
    """
    measured = stored(with_features(docs.select(F.col("doc_id").cast("long"), "text")).drop("text"), "measures")
    scored = judged(measured, fit(measured))
    return scored.select("doc_id", *[F.col(f"_wq_{c}").alias(c) for c in FEATURES],
                         F.col("_wq_base_failed").alias("base_failed"), F.col("_wq_kept").alias("kept"),
                         F.col("_wq_quality").alias("quality"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with exactly its columns."""
    # The row travels as one value, so none of its columns can meet the measures' names; rows and
    # measures are written once, so each text is worked through once.
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    measured = stored(with_features(docs.select("text", row.alias("row"))).drop("text"), "measured")
    passed = judged(measured, fit(measured)).where(F.col("_wq_kept"))
    return passed.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
