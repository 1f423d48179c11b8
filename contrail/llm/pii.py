"""Personal data by anchor expansion.

An Aho-Corasick automaton reports cheap anchors (at-signs, schemes, digits,
plus signs, identifier cues); a deterministic local parser grows each anchor
to its full extent and validates it. Work per text is linear: every parser
consumes a maximal run once and later anchors inside it are skipped.

Spans are (kind, start, end) in code points, end exclusive. The four base
kinds equal a leftmost non-overlapping scan of their patterns, failing
matches dropped; ``url``, ``iban`` and ``account`` are added by their cues
and may overlap them.

Defined results: a null text counts as empty and has no spans; repeated rows
each come back; an empty table gives an empty result; extra columns are kept
by :func:`redact` and not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from contrail.llm.batches import map_pieces

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "iban", "account")
# The character classes of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
DIGITS = frozenset("0123456789")
PHONE = frozenset(" ().0123456789-")
IBAN_CUES = ("IBAN", "iban", "Iban")
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT", "a/c", "A/C", "SSN", "ssn")

Span = tuple[str, int, int]


def automaton():
    """Anchor string -> handler name, compiled once per task."""
    import ahocorasick
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    a.add_word("://", ("url", 3))
    for d in DIGITS:
        a.add_word(d, ("digit", 1))
    for kind, cues in (("iban", IBAN_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def _run_end(text: str, i: int, chars: frozenset) -> int:
    n = len(text)
    while i < n and text[i] in chars:
        i += 1
    return i


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Extent of the address whose at-sign is at ``at``; nothing before ``floor`` is used."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        nxt = _run_end(text, end + 1, LABEL)
        if nxt == end + 1:
            break
        end, labels = nxt, labels + 1
    return (start, end) if labels else None


def dotted_from(text: str, i: int) -> tuple[list[Span], int]:
    """Addresses in the chain of dot-joined digit runs that starts at ``i``, and the chain's end."""
    runs, end = [], i
    while True:
        stop = _run_end(text, end, DIGITS)
        runs.append((end, stop))
        end = stop
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
            end += 1
        else:
            break
    found = []
    for k in range(0, len(runs) - 3, 4):
        four = runs[k:k + 4]
        # A part of over 3 significant digits is over 255; it is not converted (it may be very long).
        parts = [text[a:b].lstrip("0") for a, b in four]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", four[0][0], four[3][1]))
    return found, end


def card_from(text: str, i: int) -> tuple[Span | None, int]:
    """The chain of digits with single spaces or hyphens that starts at ``i``."""
    n, end = len(text), i + 1
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    digits = text[i:end].replace(" ", "").replace("-", "")
    return (("card", i, end) if 14 <= len(digits) <= 19 and luhn(digits) else None), end


def phone_from(text: str, plus: int) -> tuple[Span | None, int]:
    """The number led by the plus sign at ``plus``; where the scan for the next one goes on."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None, plus + 1
    end = _run_end(text, plus + 2, PHONE)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in DIGITS:
        return None, plus + 1
    count = sum(c in DIGITS for c in text[plus:end])
    return (("phone", plus, end) if 10 <= count <= 15 else None), end


_URL_TAIL = re.compile(r"[^\s<>\"'`{}|\\^\[\]]*")
_IBAN = re.compile(r"[\s:#.]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\s?(?:no|number|num|nr)\b)?[\s:.#]{0,3}([0-9][0-9-]{4,32}[0-9])(?![0-9])", re.IGNORECASE)


def url_at(text: str, colon: int, floor: int) -> tuple[int, int] | None:
    start = colon
    while start > floor and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
        start -= 1
    while start < colon and not text[start].isalpha():
        start += 1
    if start == colon:  # no scheme: the tail, which may be the rest of the text, is not looked at
        return None
    end = _URL_TAIL.match(text, colon + 3).end()
    while end > colon + 3 and text[end - 1] in ".,;:!?)":
        end -= 1
    return (start, end) if end > colon + 3 else None


def iban_valid(value: str) -> bool:
    s = value.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find(text: str, anchors) -> list[Span]:
    """All spans of one text, sorted by start, then kind as listed in KINDS."""
    out: list[Span] = []
    free = dict.fromkeys(KINDS, 0)  # per kind, where the next match may begin
    for last, (kind, size) in anchors.iter(text):
        at = last - size + 1
        if kind == "email":
            if at >= free["email"] and (hit := email_at(text, at, free["email"])):
                out.append(("email", *hit))
                free["email"] = hit[1]
        elif kind == "digit":
            if at >= free["ip"]:
                hits, free["ip"] = dotted_from(text, at)
                out += hits
            if at >= free["card"]:
                hit, free["card"] = card_from(text, at)
                if hit:
                    out.append(hit)
        elif kind == "phone":
            if at >= free["phone"]:
                hit, free["phone"] = phone_from(text, at)
                if hit:
                    out.append(hit)
        elif kind == "url":
            if at >= free["url"] and (hit := url_at(text, at, free["url"])):
                out.append(("url", *hit))
                free["url"] = hit[1]
        else:
            m = (_IBAN if kind == "iban" else _ACCOUNT).match(text, last + 1)
            if m and m.start(1) >= free[kind] and (kind == "account" or iban_valid(m[1])):
                out.append((kind, m.start(1), m.end(1)))
                free[kind] = m.end(1)
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each union of overlapping spans replaced by the tag of its first kind."""
    parts, at, tag, until = [], 0, "", -1
    for kind, a, b in spans:
        if a < until:
            until = max(until, b)
            continue
        if until >= 0:
            parts.append(tag)
            at = until
        parts.append(text[at:a])
        tag, until = f"[{kind.upper()}]", b
    if until >= 0:
        parts.append(tag)
        at = until
    parts.append(text[at:])
    return "".join(parts)


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans."""
    def one(piece, anchors) -> dict:
        out = {"doc_id": piece.column("doc_id"), "base_sha256": [], "spans": []} | {f"n_{k}": [] for k in BASE_KINDS}
        for text in piece.column("text").to_pylist():
            spans = find(text or "", anchors)
            base = [s for s in spans if s[0] in BASE_KINDS]
            for k in BASE_KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return out
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return map_pieces(docs.select(F.col("doc_id").cast("long"), "text"), one, schema, setup=automaton)


REDACTED = tuple(k for k in KINDS if k != "url")


def redact(docs: DataFrame, kinds: tuple[str, ...] = REDACTED) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and ``n_chars``, where present, following it.

    Null texts stay null. Columns and their order are those of ``docs``.
    """
    cols, types = docs.columns, dict(docs.dtypes)
    rest = [c for c in cols if c != "text"]
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))

    def one(piece, anchors) -> dict:
        texts = piece.column("text").to_pylist()
        return {"rest": piece.column("rest"),
                "text": [None if t is None else mask(t, [s for s in find(t, anchors) if s[0] in kinds]) for t in texts]}

    out = map_pieces(packed, one, f"rest {packed.schema['rest'].dataType.simpleString()}, text string", setup=automaton)
    fields = {c: F.col("rest")[c] for c in rest} | {"text": F.col("text")}
    if types.get("n_chars") in ("int", "bigint"):
        fields["n_chars"] = F.coalesce(F.length("text"), F.col("rest")["n_chars"]).cast(types["n_chars"])
    return out.select(*[fields[c].alias(c) for c in cols])
