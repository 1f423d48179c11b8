"""BPE encoding by prefix-sharing trie traversal, and decoding.

The encoding of a prefix is fixed by its last token: cut that token off and
what is left is the encoding of the shorter prefix. Within each piece the
distinct words not seen before go into a trie whose edges are byte symbols
(the last one of a word carries the end mark); a depth-first walk gives every
node its last token and the node that token starts from, so shared prefixes
are worked out once. Whether one token may follow another is decided once per
pair, by taking merges back from their border.

The tokenizer's files are only read: splitting and merge ranks are applied
here, its own encoder is not called. Only the division of a text into words
is left to the library where the text holds characters whose class differs
between Unicode versions.

Defined results: a null text counts as empty; an empty text has no tokens;
the strings of the added special tokens become their ids; repeated rows each
come back; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from contrail.llm.batches import map_pieces

END = "</w>"
# Blocks whose characters have one class and one lower-case form in every Unicode version in use.
SETTLED = r"[\x00-\u052F\u1E00-\u1EFF\u2000-\u206F\u3000-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3]*"
CACHE_WORDS = 400_000  # encodings a task keeps; the cache starts anew beyond it (speed only)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable stand-in for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in own}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


@dataclass
class Bpe:
    """Vocabulary, merge ranks and the pair checks made so far."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    added: dict[str, int]
    divide: Callable[[str], list[str]] | None = None  # the library's own division into words
    made: dict[str, tuple[int, str, str] | None] = field(default_factory=dict)
    fits: dict[tuple[str, str], bool] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import regex
        self.symbols = byte_symbols()
        self.by_symbol = {c: b for b, c in enumerate(self.symbols)}
        # The fixed split of this tokenizer; White_Space by property, as its own expression library reads \\s.
        self.split = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.settled = regex.compile(SETTLED)
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.text_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.longest = max(map(len, self.vocab), default=1)
        self.byte_map = dict(enumerate(self.symbols))

    def parts(self, token: str) -> list[str]:
        if token.endswith(END):
            body = token[:-len(END)]
            return [*body[:-1], body[-1:] + END]
        return list(token)

    def last_merge(self, token: str) -> tuple[int, str, str] | None:
        """(rank, left, right) of the merge that completes ``token``, rank -1 for one symbol.

        None when ``token`` is no token, or merging its own symbols (lowest
        rank first, leftmost among equals) does not give it back: such a
        token occurs in no encoding.
        """
        if token in self.made:
            return self.made[token]
        parts, done = self.parts(token), None
        if token in self.vocab:
            done = (-1, "", "") if len(parts) == 1 else None
            while len(parts) > 1:
                rank, at = min(((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))
                if rank == 1 << 60:
                    break
                if len(parts) == 2:
                    done = (rank, *parts)
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
        self.made[token] = done
        return done

    def follows(self, left: str, right: str) -> bool:
        """Whether the two tokens side by side are their own encoding.

        Takes the merges nearest the border back, latest first. Had the pair
        at the border been mergeable before the merge just taken back, that
        merge would have come first and the border would be gone.
        """
        key = (left, right)
        ok = self.fits.get(key)
        if ok is None:
            bound = 1 << 60
            while True:
                if self.ranks.get((left, right), 1 << 60) < bound:
                    ok = False
                    break
                l, r = self.last_merge(left), self.last_merge(right)
                if l[0] < 0 and r[0] < 0:
                    ok = True
                    break
                if l[0] > r[0]:
                    bound, left = l[0], l[2]
                else:  # among equal ranks the left one is merged first, so the right one is taken back
                    bound, right = r[0] + 1, r[1]
            self.fits[key] = ok
        return ok

    def words_of(self, text: str) -> list[str]:
        if self.divide and not self.settled.fullmatch(text):
            return self.divide(text)
        # Lower case character by character: no word-final form of sigma.
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode_words(self, words: list[str]) -> None:
        """Add the encodings of ``words`` (distinct, not cached) to ``self.words``.

        The trie is held as the sorted list of symbol strings: walking the
        list is the depth-first walk, and the part a word shares with the one
        before it is the path that stays. ``last[d]`` and ``back[d]`` are the
        last token of the path's first ``d`` symbols and where it starts.
        """
        trie = sorted([(w.encode().decode("latin-1").translate(self.byte_map), w) for w in words])
        vocab, longest, made, fits = self.vocab, self.longest, self.made, self.fits
        follows, last_merge = self.follows, self.last_merge

        last: list[str] = [""]
        back: list[int] = [0]
        before = ""
        for path, word in trie:
            inner = len(path) - 1
            keep, most = 0, min(inner, len(last) - 1)
            while keep < most and path[keep] == before[keep]:
                keep += 1
            del last[keep + 1:], back[keep + 1:]
            whole = path + END
            for depth in range(keep + 1, inner + 2):
                shown = whole if depth > inner else path[:depth]
                # The one token that ends here and may follow what is before it.
                for start in range(depth - longest if depth > longest else 0, depth):
                    token = shown[start:]
                    if token in vocab and (made[token] if token in made else last_merge(token)):
                        if not start:
                            break
                        left = last[start]
                        fit = fits.get((left, token))
                        if follows(left, token) if fit is None else fit:
                            break
                else:
                    raise ValueError(f"no token of the vocabulary ends {shown!r}")
                if depth <= inner:
                    last.append(token)
                    back.append(start)
            before = path
            ids = [vocab[token]]
            while start > 0:
                ids.append(vocab[last[start]])
                start = back[start]
            ids.reverse()
            self.words[word] = struct.pack(f"<{len(ids)}I", *ids)

    def split_text(self, text: str) -> list[tuple[bool, str]]:
        """(is an added token, piece) in order."""
        if not self.special or "<" not in text:
            return [(False, text)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [(False, text[at:m.start()]), (True, m[0])]
            at = m.end()
        return [*out, (False, text[at:])]

    def encode_ids(self, texts: list[str]) -> list[bytes]:
        """Per text: its ids as little-endian unsigned 32-bit integers."""
        split, found = [], set()
        for text in texts:
            row = []
            for added, piece in self.split_text(text):
                if added:
                    row.append((piece, None))
                else:
                    words = self.words_of(piece)
                    row.append((None, words))
                    found.update(words)
            split.append(row)
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        fresh = [w for w in found if w not in self.words]
        if fresh:
            self.encode_words(fresh)
        get, out = self.words.__getitem__, []
        for row in split:
            ids = []
            for added, words in row:
                if added is not None:
                    ids.append(struct.pack("<I", self.added[added]))
                else:
                    ids += map(get, words)
            out.append(b"".join(ids))
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Per text: its ids, and their decoding."""
        return [(ids, self.decode(ids)) for ids in self.encode_ids(texts)]

    def decode(self, ids: bytes) -> str:
        """Tokens of the ids with a space between: what the tokenizer without a decoder gives."""
        return " ".join(map(self.text_of.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


def load(path: str) -> Bpe:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return Bpe(spec["model"]["vocab"], {m: i for i, m in enumerate(merges)},
               {t["content"]: t["id"] for t in spec["added_tokens"]}, divider(path, spec))


def divider(path: str, spec: dict) -> Callable[[str], list[str]]:
    from tokenizers import Regex, Tokenizer, pre_tokenizers
    normalizer = Tokenizer.from_file(path).normalizer
    step = spec["pre_tokenizer"]["pretokenizers"][0]
    split = pre_tokenizers.Split(Regex(step["pattern"]["Regex"]), step["behavior"].lower(), step["invert"])
    return lambda text: [w for w, _ in split.pre_tokenize_str(normalizer.normalize_str(text))]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids binary): the token ids of each whole text, little-endian unsigned 32-bit."""
    path = path or tokenizer_path()

    def one(piece, bpe: Bpe) -> dict:
        return {"doc_id": piece.column("doc_id"), "ids": bpe.encode_ids([t or "" for t in piece.column("text").to_pylist()])}
    return map_pieces(docs.select(F.col("doc_id").cast("long"), "text"), one, "doc_id long, ids binary",
                      setup=lambda: load(path))


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: token count, digest of the ids, digest of their decoding."""
    path = path or tokenizer_path()

    def one(piece, bpe: Bpe) -> dict:
        rows = bpe.encode_ids([t or "" for t in piece.column("text").to_pylist()])
        return {"doc_id": piece.column("doc_id"), "n_tokens": [len(ids) // 4 for ids in rows],
                "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in rows],
                "decoded_sha256": [hashlib.sha256(bpe.decode(ids).encode()).hexdigest() for ids in rows]}
    return map_pieces(docs.select(F.col("doc_id").cast("long"), "text"), one,
                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                      setup=lambda: load(path))
