"""Language identification by multilingual mixture inference.

Per language, counts of hashed character trigrams give smoothed trigram
probabilities. A document is a mixture: each of its words (a run of letters)
is drawn from one language of the document's set, with the likelihood of the
word's trigrams. Expectation-maximisation estimates the proportions of all
documents of a piece at once (segment sums, no per-document loop); languages
are then taken out one at a time as long as the likelihood penalised by
half the log of the word count per language rises.

The trigram space is hashed to ``BUCKETS`` cells, so the model has a fixed
size per language however large the corpus is; its counts cover every
training document.

Defined results: ``und`` with score 0 for a null or letterless text; with no
training document at all every text is ``und``; equal proportions go to the
language that sorts first; repeated rows count each and come back each; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.batches import map_pieces, pieces

BUCKETS = 1 << 16
SMOOTH = 0.5
ROUNDS = 12
UNKNOWN = "und"
PIECE_BYTES = 1 << 20


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, lower-case form) by code point; of a longer form, its first character."""
    chars = np.arange(0x110000, dtype=np.uint32).view("<U1")
    letter = np.strings.isalpha(chars)
    lower = np.strings.lower(chars).astype("<U1").view(np.uint32)
    return letter, lower


def trigrams(texts: list[str], tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket per letter, word per letter, document per word) over all texts.

    Each letter stands with its neighbours; anything that is not a letter,
    text ends included, reads as a space.
    """
    letter, lower = tables
    joined = "\n" + "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Document of each position: texts may hold newlines themselves, so lengths decide.
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1 if texts else np.zeros(0, np.int64)
    is_letter = letter[code]
    sym = np.where(is_letter, lower[code], np.uint32(32)).astype(np.uint64)
    at = np.flatnonzero(is_letter)
    h = (sym[at - 1] * np.uint64(0x9E3779B97F4A7C15) + sym[at]) * np.uint64(0xC2B2AE3D27D4EB4F) + sym[at + 1]
    h *= np.uint64(0x9E3779B97F4A7C15)
    bucket = (h >> np.uint64(48)).astype(np.int64)
    new_word = np.ones(len(at), bool)
    new_word[1:] = at[1:] != at[:-1] + 1
    word = np.cumsum(new_word) - 1
    doc = np.searchsorted(ends, at[new_word], side="right")
    return bucket, word, doc


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # [bucket, language], float32


def training_rows() -> Column:
    """Documents the model may learn from (the others are held out)."""
    return F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, smooth: float = SMOOTH) -> Model:
    """Model from (text, lang) rows: one count table per task and language, added up by Spark.

    At most ``BUCKETS`` rows per language reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, totals = letter_tables(), {}
        for piece in pieces(batches, "text", PIECE_BYTES):
            lang = piece.column("lang").to_pylist()
            names = sorted(set(lang))
            code = np.array([names.index(x) for x in lang])
            bucket, word, doc = trigrams(piece.column("text").to_pylist(), tables)
            if len(bucket):
                got = np.bincount(code[doc[word]] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    totals[name] = totals.get(name, 0) + got[k * BUCKETS:(k + 1) * BUCKETS]
        for name, total in sorted(totals.items()):
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen)), pa.array(seen, pa.int32()),
                                              pa.array(total[seen], pa.int64())], ["lang", "bucket", "n"])

    counts = (docs.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    lang = counts.column("lang").to_pylist()
    names = tuple(sorted(set(lang)))
    total = np.full((BUCKETS, len(names)), smooth)
    place = {x: k for k, x in enumerate(names)}
    np.add.at(total, (counts.column("bucket").to_numpy(), [place[x] for x in lang]), counts.column("n").to_numpy())
    return Model(names, np.log(total / total.sum(axis=0)).astype(np.float32) if names else np.zeros((BUCKETS, 0), np.float32))


def _em(like: np.ndarray, starts: np.ndarray, doc: np.ndarray, theta: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood less the words' scale) after ``rounds`` steps; rows are words sorted by document."""
    n = np.add.reduceat(np.ones(len(like)), starts)[:, None]
    for _ in range(rounds):
        share = like * theta[doc]
        share /= share.sum(axis=1, keepdims=True)
        theta = np.add.reduceat(share, starts, axis=0) / n
    total = (like * theta[doc]).sum(axis=1)
    return theta, np.add.reduceat(np.log(total), starts)


def infer(texts: list[str], model: Model, tables, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions [text, language]; a row of zeros where there is nothing to go by."""
    out = np.zeros((len(texts), len(model.languages)))
    if not model.languages:
        return out
    bucket, word, doc = trigrams(texts, tables)
    if not len(bucket):
        return out
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    log_like = np.add.reduceat(model.log_prob[bucket].astype(np.float64), first, axis=0)
    # Likelihoods relative to each word's best language; a floor keeps every word possible.
    like = np.exp(np.maximum(log_like - log_like.max(axis=1, keepdims=True), -30.0))
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    present = doc[starts]
    local = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(doc)]))
    k = like.shape[1]
    penalty = 0.5 * np.log(np.maximum(np.diff(np.r_[starts, len(doc)]), 2))
    theta, fit_now = _em(like, starts, local, np.full((len(starts), k), 1.0 / k), rounds)
    active = np.ones((len(starts), k), bool)
    open_docs = np.ones(len(starts), bool)
    for _ in range(k - 1):
        if not open_docs.any():
            break
        rows = open_docs[local]
        sub = np.flatnonzero(open_docs)
        sub_local = np.cumsum(open_docs)[local[rows]] - 1
        sub_starts = np.flatnonzero(np.r_[True, sub_local[1:] != sub_local[:-1]])
        trial_active = active[sub].copy()
        weakest = np.where(trial_active, theta[sub], np.inf).argmin(axis=1)
        trial_active[np.arange(len(sub)), weakest] = False
        start = np.where(trial_active, np.maximum(theta[sub], 1e-9), 0.0)
        start /= start.sum(axis=1, keepdims=True)
        trial, fit_trial = _em(like[rows], sub_starts, sub_local, start, max(2, rounds // 3))
        better = fit_trial + penalty[sub] >= fit_now[sub]
        took = sub[better]
        theta[took], fit_now[took], active[took] = trial[better], fit_trial[better], trial_active[better]
        open_docs[sub[~better]] = False
    out[present] = theta
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (proportion of the predicted language), mixture."""
    names = model.languages

    def one(piece, tables) -> dict:
        theta = infer([t or "" for t in piece.column("text").to_pylist()], model, tables)
        known = theta.sum(axis=1) > 0
        best = theta.argmax(axis=1) if len(names) else np.zeros(len(theta), int)
        return {"doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"),
                "lang_pred": [names[b] if k else UNKNOWN for b, k in zip(best, known)],
                "score": np.clip(np.where(known, theta.max(axis=1, initial=0.0), 0.0), 0, 1),
                "mixture": [",".join(f"{names[j]}:{row[j]:.3f}" for j in np.argsort(-row, kind="stable") if row[j] > 0)
                            for row in theta]}

    return map_pieces(docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text"), one,
                      "doc_id long, held_out boolean, lang_pred string, score double, mixture string",
                      max_bytes=PIECE_BYTES, setup=letter_tables)


def report(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs.where(training_rows())))
