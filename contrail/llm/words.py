"""Words as `[^\\x20\\x09-\\x0D]+`: runs without space, tab, LF, VT, FF or CR."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def no_space(text: Column) -> Column:
    return F.translate(text, SPACE_CHARS, "")


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null when it is null)."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: F.length(w) > 0)


def word_count(text: Column) -> Column:
    """Number of words, 0 for null: every word but a leading one follows a space run."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")
