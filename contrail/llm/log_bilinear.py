"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are classed into ``SYMBOLS`` symbols: the text's end, the most
frequent words one each, all other words by a hash of their last letters. The
neural model predicts the next symbol from the two before it: context
vectors times position matrices give a predicted vector, whose products with
the symbols' output vectors (plus biases) are the scores. Inside a symbol of
many words a second log-bilinear model predicts the word from the symbol
before it: each of the ``SHIPPED`` most frequent words has a vector of its
own, whose product with the context's vector raises or lowers the word's
smoothed count share. Rarer words have the null vector, and one unknown word
per symbol is included, so probabilities over all words and the end sum to one.

Training uses every token of every training document, none is drawn. Spark
counts all symbol triples (a table of fixed size, ``SYMBOLS`` ** 3 at most);
each step of the trainer weighs all of them by their counts and takes the
noise at its expectation. Spark then sums, word by word, the context vectors
of all its places: with the pair counts these sums are all that the
likelihood of the word vectors depends on (what noise-contrastive estimation
comes to as noise grows); they are fitted in tasks, one symbol's words each.
Word counts are aggregated whole and stay in Spark; a bounded number of the
most frequent ones is shipped to tasks, the words beyond it reach their
counts by a join.

Defined results: a null text counts as empty (it scores its end token); with
no training document every count is 0 and every symbol equally likely; a null
doc_id trains; repeated rows each count and each come back; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.batches import map_pieces, pieces
from contrail.llm.store import stored

SYMBOLS = 128
OWN = 80  # symbols that stand for one word each
END = b""  # no word is empty
SHIPPED = 1 << 17  # most frequent words whose counts and vectors go to every task
HELD_WORDS = 400_000  # distinct words a task counts before it hands them on
DIMENSIONS = 16
STEPS = 300  # each over all triples
NOISE = 8
RATE = 0.1
WORD_STEPS = 8  # each over all words of a symbol
PRIOR = 1.0  # precision of a word vector's entries
_PUNCTUATION = b".,;:!?)\"'"


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, without the end token. Both bytes methods know ASCII only."""
    return text.lower().split()


def tail_symbol(word: bytes) -> int:
    """The symbol of a word that has none of its own."""
    return 1 + OWN + zlib.crc32((word.rstrip(_PUNCTUATION) or word)[-2:]) % (SYMBOLS - 1 - OWN)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n): words of all ``text`` rows (UTF-8 bytes), and the end token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            rows = list(held.items())
            for i in range(0, len(rows), 50_000):
                part = rows[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()),
                                                  pa.array([n for _, n in part], pa.int64())], ["word", "n"])
        for piece in pieces(batches, "text"):
            for t in piece.column("text").to_pylist():
                held.update(tokens(t))
                held[END] += 1
            if len(held) > HELD_WORDS:
                yield from out()
                held.clear()
        yield from out()
    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Ids are the ranks of the shipped words, then one a symbol for its other words (symbol 0: the end)."""

    counts: dict[bytes, int]  # the shipped words, most frequent first
    symbols: np.ndarray  # per id
    mass: np.ndarray  # per symbol: sum of (count + 0.5) over its words
    tokens: int
    words: int

    def ids(self) -> dict[bytes, int]:
        """A dict that gives any word's id, and keeps it."""
        ranks, first = {w: i for i, w in enumerate(self.counts)}, len(self.counts)

        class Ids(dict):
            def __missing__(self, word: bytes) -> int:
                i = ranks.get(word)
                self[word] = i = first + tail_symbol(word) if i is None else i
                return i
        return Ids()

    def shares(self) -> np.ndarray:
        """Per shipped word: its smoothed share of its symbol, 1 where the symbol is its own."""
        symbol = self.symbols[:len(self.counts)]
        n = np.fromiter(self.counts.values(), float, len(self.counts))
        return np.where(symbol > OWN, (n + 0.5) / (self.mass[symbol] + 0.5), 1.0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded part of the counts, and sums over all of them."""
    top = counts.where(F.length("word") > 0).orderBy(F.desc("n"), "word").limit(SHIPPED).collect()
    shipped = {bytes(r["word"]): r["n"] for r in top}
    own = {END: 0} | {bytes(r["word"]): i + 1 for i, r in enumerate(top[:OWN])}

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v, m = 0, 0, np.zeros(SYMBOLS)
        for b in batches:
            for w, c in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                s = own.get(w)
                m[tail_symbol(w) if s is None else s] += c + 0.5
                n, v = n + c, v + 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([v], pa.int64()),
                                          pa.array([m.tolist()], pa.list_(pa.float64()))], ["n", "v", "m"])
    parts = (counts.mapInArrow(masses, "n long, v long, m array<double>")
             .select("n", "v", F.posexplode("m").alias("symbol", "m")).groupBy("symbol")
             .agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("m").alias("m")).collect())
    mass = np.zeros(SYMBOLS)
    for r in parts:
        mass[r["symbol"]] = r["m"]
    symbols = np.array([own.get(w) or tail_symbol(w) for w in shipped] + list(range(SYMBOLS)), np.int64)
    return Vocabulary(shipped, symbols, mass, parts[0]["n"] if parts else 0, parts[0]["v"] if parts else 0)


_ENCODED = "row long, doc_id long, held_out boolean, ids binary, word binary, tf long"


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per document with the ids of its words and end, and one per word of it that has no id of its own."""
    shipped = len(vocab.counts)
    names, types = ("row", "doc_id", "held_out", "ids", "word", "tf"), (
        pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64())

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t)
                                           for k, t in zip(names, types)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = vocab.ids()
        for piece in pieces(batches, "text", 1 << 20):
            if len(ids) > HELD_WORDS:
                ids.clear()
            words = [tokens(t) for t in piece.column("text").to_pylist()]
            flat: list[int] = []
            for ws in words:
                flat += map(ids.__getitem__, ws)
                flat.append(shipped)
            at = np.array(flat, "<i4")
            length = np.array([len(ws) + 1 for ws in words])
            first = np.concatenate([[0], np.cumsum(length)])
            whole, cut = at.tobytes(), (first * 4).tolist()
            yield batch(len(words), row=piece.column("row"), doc_id=piece.column("doc_id"), held_out=piece.column("held_out"),
                        ids=[whole[i:j] for i, j in zip(cut, cut[1:])])
            rare = np.flatnonzero(at > shipped)
            text = np.repeat(np.arange(len(words)), length)[rare]
            tf = Counter([(i, words[i][j]) for i, j in zip(text.tolist(), (rare - first[text]).tolist())])
            if tf:
                row = piece.column("row").to_numpy()
                yield batch(len(tf), row=row[np.fromiter((i for i, _ in tf), np.int64, len(tf))],
                            word=[w for _, w in tf], tf=list(tf.values()))
    return docs.mapInArrow(run, _ENCODED)


def id_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, row of each id)"""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i4"), np.repeat(np.arange(len(rows)), [len(r) // 4 for r in rows])


def triples(symbol: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Codes of (symbol two before, one before, symbol); the end stands before a text's first word."""
    one = np.zeros_like(symbol)
    two = np.zeros_like(symbol)
    one[1:] = np.where(owner[1:] == owner[:-1], symbol[:-1], 0)
    two[2:] = np.where(owner[2:] == owner[:-2], symbol[:-2], 0)
    return (two * SYMBOLS + one) * SYMBOLS + symbol


def pair_codes(symbol: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Codes of (symbol, one before)."""
    return symbol * SYMBOLS + triples(symbol, owner) // SYMBOLS % SYMBOLS


def triple_counts(encoded: DataFrame, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(sorted triple codes, counts) over all ``ids`` rows: at most SYMBOLS ** 3 rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for piece in pieces(batches, "ids"):
            at, owner = id_rows(piece.column("ids"))
            total += np.bincount(triples(vocab.symbols[at], owner), minlength=SYMBOLS ** 3)
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 100_000):
            at = seen[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])
    got = (encoded.mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    code, n = got.column("code").to_numpy().astype(np.int64), got.column("n").to_numpy()
    order = np.argsort(code)
    return code[order], n[order]


@dataclass(frozen=True)
class LogBilinear:
    context: np.ndarray  # [symbol, d]
    position: np.ndarray  # [2, d, d]: for two before and one before
    output: np.ndarray  # [symbol, d]
    bias: np.ndarray  # [symbol]

    def table(self) -> np.ndarray:
        """log10 P(symbol | context) by code, normalised: one matrix product for all contexts."""
        before = self.context @ self.position  # [2, symbol, d]
        pred = (before[0][:, None, :] + before[1][None, :, :]).reshape(-1, self.context.shape[1])
        score = pred @ self.output.T + self.bias
        score -= score.max(axis=1, keepdims=True)
        score -= np.log(np.exp(score).sum(axis=1, keepdims=True))
        return (score / np.log(10)).astype(np.float32).reshape(-1)


def train(code: np.ndarray, count: np.ndarray, steps: int = STEPS, seed: int = 7) -> LogBilinear:
    """NCE: tell the counted triples from the same contexts with symbols of the symbol counts' distribution.

    Every triple enters every step with its count; the noise enters as its expectation.
    """
    rng = np.random.default_rng(seed)
    d = DIMENSIONS
    p = {"c": rng.normal(0, 0.1, (SYMBOLS, d)), "p": np.stack([np.eye(d) * 0.5, np.eye(d)]) + rng.normal(0, 0.01, (2, d, d)),
         "o": rng.normal(0, 0.1, (SYMBOLS, d)), "b": np.zeros(SYMBOLS)}
    if not len(code):
        p["o"][:] = 0
        return LogBilinear(p["c"], p["p"], p["o"], p["b"])
    unigram = np.bincount(code % SYMBOLS, weights=count, minlength=SYMBOLS) + 0.5
    noise = unigram / unigram.sum()
    p["b"] = np.log(noise)
    log_kn = np.log(NOISE * noise)
    contexts, row = np.unique(code // SYMBOLS, return_inverse=True)
    two, one = contexts // SYMBOLS, contexts % SYMBOLS
    data = np.zeros((len(contexts), SYMBOLS))
    np.add.at(data, (row, code % SYMBOLS), count / count.sum())
    both = data + data.sum(axis=1, keepdims=True) * (NOISE * noise)

    def by_symbol(symbol: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros((SYMBOLS, d))
        np.add.at(out, symbol, values)
        return out
    seen = {k: np.full(v.shape, 1e-24) for k, v in p.items()}
    for step in range(steps):
        pred = (p["c"] @ p["p"][0])[two] + (p["c"] @ p["p"][1])[one]
        score = pred @ p["o"].T + (p["b"] - log_kn)
        error = both / (1 + np.exp(-np.clip(score, -30, 30))) - data
        to_pred = error @ p["o"]
        to_two, to_one = by_symbol(two, to_pred), by_symbol(one, to_pred)
        grad = {"o": error.T @ pred, "b": error.sum(axis=0), "p": np.stack([p["c"].T @ to_two, p["c"].T @ to_one]),
                "c": to_two @ p["p"][0].T + to_one @ p["p"][1].T}
        rate = RATE * (1 - 0.9 * step / steps)
        for k, g in grad.items():  # Adagrad
            seen[k] += g * g
            p[k] -= rate * g / np.sqrt(seen[k])
    return LogBilinear(p["c"], p["p"], p["o"], p["b"])


def pair_counts(code: np.ndarray, count: np.ndarray) -> np.ndarray:
    """[symbol, symbol before it]"""
    out = np.zeros((SYMBOLS, SYMBOLS))
    np.add.at(out, (code % SYMBOLS, code // SYMBOLS % SYMBOLS), count)
    return out


@dataclass(frozen=True)
class Features:
    """What word vectors are multiplied with, per (symbol of many words, symbol before it): the model's vector of
    the symbol before, without its mean over the symbol's places, turned to its main axes, of mean square 1."""

    values: np.ndarray  # [symbol, symbol before, d], multiples of 2 ** -16: their sums are exact in any order
    axes: np.ndarray  # [symbol, d]: mean square along each axis


def features(model: LogBilinear, pairs: np.ndarray) -> Features:
    before = model.context @ model.position[1]
    values, axes = np.zeros((SYMBOLS, SYMBOLS, DIMENSIONS)), np.zeros((SYMBOLS, DIMENSIONS))
    for s in range(1 + OWN, SYMBOLS):
        weight = pairs[s] / max(pairs[s].sum(), 1)
        centred = before - weight @ before
        size, turn = np.linalg.eigh((centred * weight[:, None]).T @ centred)
        if size.sum() > 1e-12:  # else all places have the same context: nothing to tell apart
            values[s] = np.clip(np.round(centred @ turn / np.sqrt(size.sum()) * 65536), -2 ** 24, 2 ** 24) / 65536
            axes[s] = np.maximum(size / size.sum(), 0)
    return Features(values, axes)


def word_sums(encoded: DataFrame, vocab: Vocabulary, feats: Features) -> DataFrame:
    """(word int, symbol int, g0.. double): over all places of each shipped word, the sum of their features."""
    shipped = len(vocab.counts)
    columns = [f"g{j}" for j in range(DIMENSIONS)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_axis = [np.ascontiguousarray(feats.values[:, :, j].reshape(-1)) for j in range(DIMENSIONS)]
        total, seen = np.zeros((DIMENSIONS, shipped)), np.zeros(shipped, bool)
        for piece in pieces(batches, "ids"):
            at, owner = id_rows(piece.column("ids"))
            pair = pair_codes(vocab.symbols[at], owner)
            own = np.flatnonzero((at < shipped) & (vocab.symbols[at] > OWN))
            at, pair = at[own], pair[own]
            seen[at] = True
            for j, values in enumerate(by_axis):
                total[j] += np.bincount(at, weights=values[pair], minlength=shipped)
        found = np.flatnonzero(seen)
        for i in range(0, len(found), 50_000):
            w = found[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int32)), pa.array(vocab.symbols[w].astype(np.int32)),
                                              *(pa.array(t[w]) for t in total)], ["word", "symbol", *columns])
    return (encoded.mapInArrow(add, "word int, symbol int, " + ", ".join(f"{c} double" for c in columns))
            .groupBy("symbol", "word").agg(*(F.sum(c).alias(c) for c in columns)))


def fit_words(sums: np.ndarray, n: np.ndarray, share: np.ndarray, values: np.ndarray, axes: np.ndarray,
              weight: np.ndarray) -> np.ndarray:
    """Vectors [word, d] of one symbol's shipped words, from their feature sums: the likelihood (with a normal prior)
    of all the symbol's places, climbed in steps scaled by the words' counts and halved until they rise."""
    rest = max(1 - share.sum(), 0.0)  # words without a vector
    scale = n[:, None] * axes + PRIOR

    def value(r: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        part = np.exp(np.clip(r @ values.T, -50, 50)) * share[:, None]
        norm = part.sum(axis=0) + rest
        return float((sums * r).sum() - weight @ np.log(norm) - PRIOR / 2 * (r * r).sum()), part, norm
    r = np.zeros(sums.shape)
    best, part, norm = value(r)
    for _ in range(WORD_STEPS):
        step = (sums - (part * (weight / norm)) @ values - PRIOR * r) / scale
        for _ in range(10):
            risen = value(r + step)
            if risen[0] > best:
                r = r + step
                best, part, norm = risen
                break
            step /= 2
        else:
            break
    return r


def word_vectors(sums: DataFrame, vocab: Vocabulary, feats: Features, pairs: np.ndarray) -> np.ndarray:
    """[shipped word, d], fitted in tasks, one symbol's words each."""
    shares = vocab.shares()
    counts = np.fromiter(vocab.counts.values(), float, len(vocab.counts))

    def fit(table: pa.Table) -> pa.Table:
        word = table.column("word").to_numpy()
        order = np.argsort(word)
        word, s = word[order], table.column("symbol")[0].as_py()
        g = np.stack([table.column(f"g{j}").to_numpy()[order] for j in range(DIMENSIONS)], axis=1)
        r = fit_words(g, counts[word], shares[word], feats.values[s], feats.axes[s], pairs[s])
        return pa.table({"word": pa.array(word, pa.int32()), "r": pa.array(r.tolist(), pa.list_(pa.float64()))})
    got = sums.groupBy("symbol").applyInArrow(fit, "word int, r array<double>").toArrow()
    out = np.zeros((len(vocab.counts), DIMENSIONS), np.float32)
    if got.num_rows:
        out[got.column("word").to_numpy()] = np.array(got.column("r").to_pylist())
    return out


def log_norms(vectors: np.ndarray, vocab: Vocabulary, feats: Features) -> np.ndarray:
    """[symbol, symbol before it]: log10 of what all words of a symbol add up to, the unknown one included."""
    shares, symbols = vocab.shares(), vocab.symbols[:len(vocab.counts)]
    out = np.zeros((SYMBOLS, SYMBOLS))
    for s in range(1 + OWN, SYMBOLS):
        at = np.flatnonzero(symbols == s)
        part = np.exp(vectors[at].astype(float) @ feats.values[s].T) * shares[at, None]
        out[s] = np.log10(part.sum(axis=0) + max(1 - shares[at].sum(), 0.0))
    return out


def token_scorer(vocab: Vocabulary, model: LogBilinear, feats: Features,
                 vectors: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of (ids, text of each) that gives each token's log10 probability under the model; of an id that
    stands for many words, all but log10 of the word's (count + 0.5)."""
    shipped = len(vocab.counts)
    # Divide by the mass of symbols that stand for many words; a word's own symbol has share 1.
    log_mass = np.log10(vocab.mass + 0.5)
    log_mass[:1 + OWN] = 0
    inside = log_mass[:, None] + log_norms(vectors, vocab, feats)
    table = (model.table().reshape(SYMBOLS, SYMBOLS, SYMBOLS) - inside.T).astype(np.float32).reshape(-1)
    counts = np.fromiter(vocab.counts.values(), float, shipped)
    log_counts = np.zeros(len(vocab.symbols))
    log_counts[:shipped] = np.where(vocab.symbols[:shipped] > OWN, np.log10(counts + 0.5), 0)
    flat = (feats.values / np.log(10)).astype(np.float32).reshape(-1, DIMENSIONS)

    def score(at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        symbol = vocab.symbols[at]
        out = table[triples(symbol, owner)] + log_counts[at]
        own = np.flatnonzero((at < shipped) & (symbol > OWN))
        out[own] += np.einsum("ij,ij->i", vectors[at[own]], flat[pair_codes(symbol, owner)[own]])
        return out
    return score


def _score(encoded: DataFrame, vocab: Vocabulary, model: LogBilinear, feats: Features, vectors: np.ndarray) -> DataFrame:
    """Per document what ids can tell: without the counts of words that have no id of their own."""
    shipped = len(vocab.counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = token_scorer(vocab, model, feats, vectors)
        log_counts, known = np.zeros(len(vocab.symbols)), np.zeros(len(vocab.symbols))
        log_counts[:shipped] = np.log10(np.fromiter(vocab.counts.values(), float, shipped) + 0.5)
        log_counts[shipped] = np.log10(vocab.mass[0] or 0.5)
        known[:shipped] = 1
        known[shipped] = vocab.mass[0] > 0
        for piece in pieces(batches, "ids"):
            at, owner = id_rows(piece.column("ids"))

            def summed(values: np.ndarray) -> np.ndarray:
                return np.bincount(owner, weights=values, minlength=piece.num_rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), piece.column("doc_id"), piece.column("held_out"), pa.array(np.bincount(owner)),
                 pa.array(summed(score(at, owner))), pa.array(summed(known[at]).astype(np.int64)), pa.array(summed(log_counts[at]))],
                ["row", "doc_id", "held_out", "n_tokens", "model", "known", "log_count"])
    return encoded.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, model double, known long, log_count double")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = stored(word_counts(whole.where("NOT held_out").select("text")), "words")
    vocab = vocabulary(counts)
    # A number for each row of the input: repeated ids stay apart.
    parts = stored(encode(whole.withColumn("row", F.monotonically_increasing_id()), vocab), "token-ids")
    encoded = parts.where("ids IS NOT NULL").select("row", "doc_id", "held_out", "ids")
    training = encoded.where("NOT held_out").select("ids")
    code, count = triple_counts(training, vocab)
    model, pairs = train(code, count), pair_counts(code, count)
    feats = features(model, pairs)
    vectors = word_vectors(word_sums(training, vocab, feats), vocab, feats, pairs)
    rare = (parts.where("word IS NOT NULL").select("row", "word", "tf").join(counts, "word", "left")
            .select("row", F.when(F.col("n") > 0, F.col("tf")).otherwise(F.lit(0)).alias("known"),
                    (F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"))
            .groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("logs").alias("more_logs")))
    base = vocab.tokens + 0.5 * (vocab.words + 1)
    whole_rows = _score(encoded, vocab, model, feats, vectors).join(rare, "row", "left")
    logs = F.coalesce("more_logs", F.lit(0.0))
    return whole_rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_count") + logs - F.col("n_tokens") * F.lit(float(np.log10(base)))).alias("base_score"),
        (F.col("model") + logs).alias("score"))
