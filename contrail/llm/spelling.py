"""Spelling variants: words one edit apart, found by pivotal bigrams.

Every bigram has a place in one global order, rarest first. The three first
bigrams of a word are its prefix (with all others of the third one's kind). An
edit touches at most two overlapping bigrams, so of two disjoint bigrams of a
word one is left in any word an edit away, at the same place or one beside it.
Dynamic programming picks, of the prefix, the two disjoint bigrams that are
rarest together: the pivots. Of two near words, the one whose prefix ends first
in the order has a pivot in the other's prefix. An edit behind the first pivot
leaves the word up to it as it is, any other leaves the word from the second
pivot on; a length that grew or shrank moves that end by one. So pivots are
joined with prefixes by (bigram, length, place, hash of the side left as it is),
for the six places that edits allow, and pairs are verified. A cell of the join
with very many words is dealt in parts.

Words are counted with built-in functions; the order of bigrams holds at most
90 x 90 of them (a to z and 64 letters above). Hot words are summed before the
shuffle, and a word has no more near words than its letters allow.

Defined results: null texts have no words; a null doc_id is written as nothing
in the hash; repeated rows count again; words that differ in case above Z differ;
a text or run of any length is read whole (one row, in memory); an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import string
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.store import stored

RUN = r"([a-zÀ-ÿ]+)"
SLIPS = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
PREFIX = 3
CELL = 4096
CELL_KEY = ["gram", "length", "place", "side"]


def runs(docs: DataFrame) -> DataFrame:
    """(doc, run): every lower-cased letter run of every text."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(1))).alias("run"))


def slipped(doc: Column, run: Column) -> Column:
    """The run as it stands, or with one letter lost where the hash says so."""
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % SLIPS == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words long and frequent enough."""
    word = runs(docs).select(slipped(F.col("doc"), F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return word.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def bigram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """{bigram: (place in the global order, words it is counted in)}, rarest first."""
    gram = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    rows = words.select(F.explode(gram).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {g: (i, n) for i, (n, g) in enumerate(sorted((r["n"], r["gram"]) for r in rows))}


def prefix(word: str, order: dict[str, tuple[int, int]], size: int = PREFIX) -> list[tuple[int, int, int]]:
    """(rank, place, frequency) of the word's rarest bigrams, and of all as rare as the last of them."""
    grams = sorted((*order[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(size, len(grams)) - 1][0]
    return [(rank, at, n) for rank, n, at in grams if rank <= last]


def pivots(grams: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The two disjoint bigrams of least frequency together, as (rank, place).

    Going through the places, ``one`` is the best single bigram that ends before
    the current one, ``two`` the best pair so far.
    """
    by_place = sorted((at, n, rank) for rank, at, n in grams)
    one: tuple[int, int] | None = None  # (frequency, index)
    two: tuple[int, int, int] | None = None
    free = 0
    for k, (at, n, _) in enumerate(by_place):
        while by_place[free][0] <= at - 2:
            if one is None or by_place[free][1] < one[0]:
                one = (by_place[free][1], free)
            free += 1
        if one and (two is None or one[0] + n < two[0]):
            two = (one[0] + n, one[1], k)
    return [(by_place[k][2], by_place[k][0]) for k in (two[1:] if two else ())]


def _sides(word: str, places: list[int]) -> dict[int, tuple[int, int]]:
    """{place of a bigram: numbers for what stands before and after it}; the two kinds never agree."""
    out = {at: [0, 0] for at in places}
    for back, text in ((0, word), (1, word[::-1])):
        at, crc = 0, 0
        for place in sorted(places, reverse=bool(back)):
            end = len(word) - place - 2 if back else place
            crc, at = zlib.crc32(text[at:end].encode(), crc), end
            out[place][back] = crc << 1 | back
    return {at: tuple(v) for at, v in out.items()}


def _entries(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, n, asks, last, gram, length, place, side): prefix entries, and the places where pivots may be found."""
    def run(batches):
        for b in batches:
            out = {k: [] for k in ("of", "asks", "last", *CELL_KEY)}

            def put(*entry):
                for k, v in zip(out.values(), entry):
                    k.append(v)

            for i, word in enumerate(b.column("word").to_pylist()):
                size, grams = len(word), prefix(word, order)
                last = max(rank for rank, _, _ in grams)
                sides = _sides(word, [at for _, at, _ in grams])
                for rank, at, _ in grams:
                    for side in sides[at]:
                        put(i, False, last, rank, size, at, side)
                (first, p), (second, q) = pivots(grams)
                for grown in (-1, 0, 1):
                    put(i, True, last, first, size + grown, p, sides[p][0])
                    put(i, True, last, second, size + grown, q + grown, sides[q][1])
            at = pa.array(out["of"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("word").take(at), b.column("n").take(at), pa.array(out["asks"], pa.bool_()),
                 *[pa.array(out[k], pa.int32()) for k in ("last", "gram", "length", "place")], pa.array(out["side"], pa.int64())],
                ["word", "n", "asks", "last", *CELL_KEY])
    return words.select("word", "n").mapInArrow(
        run, "word string, n long, asks boolean, last int, gram int, length int, place int, side long")


def near_pairs(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, na, b, nb): the pairs of words one edit apart, each once, a before b."""
    entries = stored(_entries(words, bigram_order(words)), "spelling-grams")
    held, asked = entries.where("NOT asks"), entries.where("asks")
    # A cell of many words is dealt in parts; whoever asks there asks every part.
    large = stored(held.groupBy(*CELL_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
                   .select(*CELL_KEY, F.ceil(F.col("n") / cell).cast("int").alias("parts")), "spelling-cells")
    parts = F.coalesce("parts", F.lit(1))
    held = (held.join(large, CELL_KEY, "left")
            .select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("last").alias("last_b"), *CELL_KEY,
                    F.pmod(F.xxhash64("word"), parts).cast("int").alias("part")))
    asked = (asked.join(large, CELL_KEY, "left")
             .select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("last").alias("last_a"), *CELL_KEY,
                     F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")))
    met = asked.join(held, [*CELL_KEY, "part"]).where("last_a <= last_b AND a <> b")
    near = met.where(F.levenshtein("a", "b", 1) == 1)
    first = F.col("a") < F.col("b")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return near.select(pick("a", "b").alias("a"), pick("na", "nb").alias("na"),
                       pick("b", "a").alias("b"), pick("nb", "na").alias("nb")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: where following the forms ends.

    Each round doubles the steps taken. A form occurs at least twice as often as
    its word, so chains are shorter than 64 and a few rounds end it.
    """
    up = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = stored(up.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                         F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if far.where("moved").isEmpty():
            return up
        up = far.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of (word, n) rows."""
    pairs = stored(near_pairs(words), "spelling-pairs")
    both = (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n"))
            .union(pairs.select("b", "a", "na")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    named = stored(words.join(best, "word", "left")
                   .select("word", F.when(enough, F.col("best.near")).alias("form"), "n",
                           F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                           F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(named.where("form IS NOT NULL"))
    return (named.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def report(docs: DataFrame) -> DataFrame:
    return variants(stored(vocabulary(docs), "spelling-words"))
