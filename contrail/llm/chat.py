"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, its turns marked by control strings;
control strings inside texts are escaped reversibly. The rendering is encoded
once with character offsets, and the sorted spans of the assistant texts are
intersected with the sorted token spans by binary search.

Template, per turn: ``<|im_start|>`` role, newline, text, ``<|im_end|>``,
newline. Escaping puts one more backslash between ``<`` and ``|`` wherever
only backslashes stand between them, so no escaped text holds ``<|``.
In roles, backslashes and newlines are escaped first.

Defined results: null text and null role are empty; turns are ordered by
(turn, role, text), so ties and repeated rows have one order and all stay; a
null conv_id is a conversation of its own; an empty table gives an empty
result; extra columns are not read. A conversation is rendered as one string,
so it must fit one row; encoding it once takes a few hundred times its
characters in bytes while it lasts, and one is encoded at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contrail.llm.batches import map_pieces, pieces

START, STOP = "<|im_start|>", "<|im_end|>"
LEARN = "assistant"
PIECE_BYTES = 128 << 10
_OPEN = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(STOP) + r"\n", re.DOTALL)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, sorted spans of the assistant texts in it)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        parts += [head, body, STOP, "\n"]
        if role == LEARN:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(STOP) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from their rendering."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def align(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(token mask, character pieces under it) for sorted token spans and sorted turn spans.

    For each turn span, binary search finds the first token ending after its
    start and the first starting at or after its end; pieces are the tokens'
    characters cut to the span, adjacent ones joined. Tokens that share a
    character (a byte-level split of it) give it once.
    """
    mask = np.zeros(len(starts), bool)
    out: list[tuple[int, int]] = []
    for a, b in spans:
        lo = int(np.searchsorted(ends, a, side="right"))
        hi = int(np.searchsorted(starts, b, side="left"))
        if hi <= lo:
            continue
        mask[lo:hi] = True
        covered = a
        for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist()):
            s, e = max(s, covered), min(e, b)
            if s < e:
                if out and out[-1][1] == s:
                    s = out.pop()[0]
                out.append((s, e))
                covered = e
    return mask, out


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, turns sorted)."""
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns")))


def _encode(piece, tok) -> dict:
    """Rendering, token ids, token mask and learnt characters of each conversation, as Arrow-ready columns.

    One conversation is encoded at a time, and its offsets become numbers of four
    bytes before the next one is, so a task never holds two encodings.
    """
    shown, ids, masks, chars = [], [], [], []
    for row in piece.column("turns").to_pylist():
        text, spans = render([(t["role"], t["text"]) for t in row])
        enc = tok.encode(text, add_special_tokens=False)
        offsets = np.array(enc.offsets, np.int32).reshape(-1, 2)
        ids.append(np.array(enc.ids, np.int32))
        del enc
        mask, cut = align(offsets[:, 0], offsets[:, 1], spans)
        shown.append(text)
        masks.append(mask)
        chars.append([{"start": a, "stop": b} for a, b in cut])
    return {"conv_id": piece.column("conv_id"), "formatted": shown, "ids": _lists(ids, np.int32), "loss_mask": _lists(masks, bool),
            "loss_chars": chars, "loss_tokens": [int(m.sum()) for m in masks]}


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, kind), *arrays])))


def format_conversations(turns: DataFrame, path: str | None = None, token_columns: bool = True) -> DataFrame:
    """conv_id, formatted text, the character pieces under the mask and the number of tokens under it;
    with ``token_columns`` also the token ids and the token loss mask."""
    path = path or tokenizer_path()

    def load():
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        tok.encode_special_tokens = True  # strings of its own special tokens in a text are ordinary text
        return tok

    conv = conversations(turns)
    # What a conversation weighs: the bytes of its rendering, escapes aside.
    weight = F.aggregate("turns", F.lit(0), lambda n, t: n + F.octet_length(t["text"]) + F.octet_length(t["role"]) + len(START + STOP) + 2)
    tokens = "ids array<int>, loss_mask array<boolean>, " if token_columns else ""
    return map_pieces(conv.withColumn("weight", weight), _encode, f"conv_id long, formatted string, {tokens}"
                      "loss_chars array<struct<start:int,stop:int>>, loss_tokens long", column="weight", max_bytes=PIECE_BYTES, setup=load)


def report(turns: DataFrame) -> DataFrame:
    """Digests read back from the formatted output."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "formatted", PIECE_BYTES):
            rows = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, cut in zip(b.column("formatted").to_pylist(), b.column("loss_chars").to_pylist()):
                got = parse(text)
                learnt = "".join(unescape(text[c["start"]:c["stop"]]) for c in cut)
                rows["n_turns"].append(len(got))
                rows["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in got).encode()).hexdigest())
                rows["loss_chars"].append(len(learnt))
                rows["loss_sha256"].append(hashlib.sha256(learnt.encode()).hexdigest())
                rows["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), *[pa.array(v, pa.string() if "sha" in k else pa.int64()) for k, v in rows.items()],
                 b.column("loss_tokens")], ["conv_id", *rows, "loss_tokens"])
    return format_conversations(turns, token_columns=False).mapInArrow(
        one, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, loss_tokens long")
