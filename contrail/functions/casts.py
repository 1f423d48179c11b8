"""Lenient and strict text casts, and the rounding used for every measure.

Lenient casts follow the mart's "...OrNull" / "...OrZero" semantics: a bad
value becomes NULL (or 0) instead of failing the row. Spark's ``try_cast``
alone is more permissive than that (it takes ``'1d'`` as a double), so the
text is first checked against a plain number grammar.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted number grammars (surrounding blanks allowed),
# the unsigned / int ranges, and the boolean words (blank-trimmed, any case).
NUMBER_RE = r"^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
INTEGER_RE = r"^ *[+-]?[0-9]+ *$"
UINT32_MAX = 4294967295
UINT8_MAX = 255
INT32_MIN, INT32_MAX = -2147483648, 2147483647
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def f64_or_null(col: Column | str) -> Column:
    """Text -> double, NULL when the text is not a plain number."""
    c = _c(col)
    return F.when(c.rlike(NUMBER_RE), c.try_cast("double"))


def _as_long(c: Column) -> Column:
    """Plain integer text (``INTEGER_RE``) of at most 18 significant digits
    -> bigint, else NULL.

    Only text that cannot overflow reaches the cast, so no row goes through
    the (slow) exception path of a failing ``try_cast``.
    """
    # Digits after blanks, sign and leading zeros (character trims).
    significant = F.ltrim(F.ltrim(F.trim(c), F.lit("+-")), F.lit("0"))
    return F.when(c.rlike(INTEGER_RE) & (F.length(significant) <= 18), c.try_cast("bigint"))


def i32_or_null(col: Column | str) -> Column:
    """Text -> int, NULL when not an integer or out of int range."""
    v = _as_long(_c(col))
    return F.when(v.between(INT32_MIN, INT32_MAX), v.cast("int"))


def u32_or_null(col: Column | str) -> Column:
    """Text -> unsigned 32-bit as bigint, NULL on failure."""
    v = _as_long(_c(col))
    return F.when(v.between(0, UINT32_MAX), v)


def _unsigned_or_zero(c: Column, hi: int) -> Column:
    v = _as_long(c)
    in_range = F.when(v.between(0, hi), v)
    # NULL stays NULL; anything unparsable or out of range becomes 0.
    return F.when(c.isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce(in_range, F.lit(0).cast("bigint")))


def u32_or_zero(col: Column | str) -> Column:
    """Text -> unsigned 32-bit as bigint, 0 on failure, NULL on NULL."""
    return _unsigned_or_zero(_c(col), UINT32_MAX)


def u8_or_zero(col: Column | str) -> Column:
    """Text -> unsigned 8-bit as bigint, 0 on failure, NULL on NULL."""
    return _unsigned_or_zero(_c(col), UINT8_MAX)


def to_bool(col: Column | str, mode: str = "cast") -> Column:
    """Text -> boolean.

    ``cast``: true/false/t/f/yes/no/y/n/1/0 (blank-trimmed, any case), else
    NULL - a word lookup, so bad values cost no exception.
    ``uint8_or_zero``: the number-only reading, where the text ``true`` is 0
    and therefore false.
    """
    c = _c(col)
    if mode == "cast":
        w = F.lower(F.trim(c))
        return F.when(w.isin(*TRUE_WORDS), F.lit(True)).when(w.isin(*FALSE_WORDS), F.lit(False))
    if mode == "uint8_or_zero":
        return u8_or_zero(c) != 0
    raise ValueError(f"unknown bool mode {mode!r}")


def strict_double(col: Column | str) -> Column:
    """ANSI cast: a bad value fails the query.

    The number grammar comes first, as the cast alone takes type suffixes (``1d``).
    """
    text = _c(col).cast("string")
    bad = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    return F.when(text.isNull(), F.lit(None).cast("double")).when(text.rlike(NUMBER_RE), text.cast("double")).otherwise(bad)


def strict_int(col: Column | str) -> Column:
    return _c(col).cast("int")


def strict_bool(col: Column | str) -> Column:
    return _c(col).cast("boolean")


def round_ch(col: Column | str, digits: int = 2) -> Column:
    """Round half to even on the binary value: rint(x * 10^d) / 10^d."""
    scale = float(10 ** digits)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


# Fractional digits summed exactly, and the size below which they are. Sums of that
# many digits leave room for 10^17 rows in a decimal(38).
AVG_SCALE = 6
AVG_LIMIT = 1e15


def exact_part(col: Column | str, scale: int = AVG_SCALE) -> Column:
    """The value rounded to ``scale`` digits as a decimal; NULL when too large, NaN or infinite."""
    c = _c(col).cast("double")
    return F.when(F.abs(c) < AVG_LIMIT, c).try_cast(f"decimal(38,{scale})")


def other_part(col: Column | str, scale: int = AVG_SCALE) -> Column:
    """What :func:`exact_part` leaves of the value: under half its last digit, or all of it."""
    c = _c(col).cast("double")
    return c - F.coalesce(exact_part(c, scale).cast("double"), F.lit(0.0))


def mean_of(exact_sum: Column, other_sum: Column, count: Column) -> Column:
    """Mean from the two sums; NULL when nothing was counted."""
    total = F.coalesce(exact_sum.cast("double"), F.lit(0.0)) + F.coalesce(other_sum, F.lit(0.0))
    return F.when(count > 0, total / F.when(count > 0, count))


def exact_avg(col: Column | str, scale: int = AVG_SCALE) -> Column:
    """Mean that, for ordinary measures, does not depend on summation order.

    A floating-point ``avg`` can differ in its last bit between two runs (or
    two engines) because partial sums merge in arbitrary order, and that bit
    decides a half-even rounding to 2 places. So values are summed as
    decimals of ``scale`` fractional digits, which is exact, and what that
    leaves of them (nothing, for ordinary measures) in a double sum beside it.
    Of values of ``AVG_LIMIT`` or more only that double sum is made, so the order
    of their sums decides the last bit.
    """
    return mean_of(F.sum(exact_part(col, scale)), F.sum(other_part(col, scale)), F.count(_c(col)))
