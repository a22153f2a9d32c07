"""Numeric and text-to-number expressions used by the row normalisers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.functions.colref import col_of as _c


def int_prefix(c, default: int = 1, floor: int = 1) -> Column:
    """Integer part of a numeric text ("2.0" -> 2), floored at ``floor``.

    Empty or NULL text, or an empty integer part (".5") -> ``default``; a
    blank or non-numeric integer part -> NULL so the caller can route the
    row to rejects (the upstream ``int()`` raises there).
    """
    head = F.split_part(F.coalesce(_c(c), F.lit("")), F.lit("."), F.lit(1))
    n = strip_ws(head).try_cast("int")
    return (
        F.when(head == "", F.lit(default))  # "" or ".5": the default; blanks alone are not a number
        .when(n.isNull(), F.lit(None).cast("int"))
        .otherwise(F.greatest(F.lit(floor), n))
    )


def cycle_pick(values: Sequence[str], n) -> Column:
    """values[(n - 1) mod len] for a 1-based number n."""
    arr = F.array(*[F.lit(v) for v in values])
    n = _c(n)
    pick = F.element_at(arr, (F.pmod(n - 1, F.lit(len(values))) + 1).cast("int"))
    # guarded: element_at on a literal array returns its last element for a
    # NULL computed index (observed on Spark 4.1.2)
    return F.when(n.isNotNull(), pick)


# Decimal, exponent and nan/inf spellings (Python float() syntax without
# underscores); Java-only forms such as "1d" or "0x1p3" are not numbers here.
NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"


def strip_ws(c) -> Column:
    """Text without leading/trailing whitespace (tabs and newlines too, as Python's strip())."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def _to_double(text: Column) -> Column:
    t = strip_ws(text)
    # Python reads a signed nan as nan; Spark's cast only the bare word
    t = F.regexp_replace(t, r"(?i)^[+-](nan)$", "$1")
    return F.when(t.rlike(NUMBER_TEXT), t.try_cast("double"))


def text_to_double(c) -> Column:
    """Numeric text -> double; empty, blank or NULL -> NULL; unparseable -> NULL."""
    return _to_double(_c(c))


def clamp(x, lo: float, hi: float) -> Column:
    """max(lo, min(hi, x)), NULL-preserving (greatest/least skip NULLs)."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(lo), F.least(F.lit(hi), x))
    )


def first_number(cols: Sequence) -> Column:
    """First candidate that parses as a number; a decimal comma counts as a point."""
    return F.coalesce(*[_to_double(F.replace(_c(c), F.lit(","), F.lit("."))) for c in cols])


def round_half_away(x, digits: int = 2) -> Column:
    """Round to ``digits`` decimals, ties away from zero on ``x * 10^digits``.

    Rounding the scaled value to an integer gives the same answer in every
    engine that rounds ties away from zero, which makes the result
    reproducible outside Spark (plain decimal ``round(x, d)`` is not).
    """
    scale = float(10 ** digits)
    return F.round(_c(x) * F.lit(scale)) / F.lit(scale)


def fixed2_text(x) -> Column:
    """``%.2f`` text built from integer hundredths (engine-independent rounding)."""
    x = _c(x)
    cents = F.round(F.abs(x) * F.lit(100.0)).try_cast("decimal(38,0)")
    # integer and fractional parts from the digits of the cents (no division);
    # below 2^53 the cents fit decimal(38,0) with room to spare
    raw = cents.cast("string")
    digits = F.when(F.length(raw) < 3, F.lpad(raw, 3, "0")).otherwise(raw)  # lpad would cut longer text
    n = F.length(digits)
    whole = F.substring(digits, F.lit(1), n - 2)
    frac = F.substring(digits, n - 1, F.lit(2))
    sign = F.when((x < 0) & (cents > 0), F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, whole, F.lit("."), frac)
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            # from 2^53 up every double is an integer: no rounding; digits are the
            # shortest round-trip decimal (exact up to ~1e17, Python prints the
            # full binary expansion beyond that)
            .when(F.abs(x) >= F.lit(2.0 ** 53), F.format_string("%.2f", x))
            .otherwise(text))
