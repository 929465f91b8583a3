"""Typed coercion of raw text columns (bad values become NULL, never errors)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import strip_ws
from .once import once

# Plain decimal / scientific notation, as a numeric parser of CSV text
# accepts it. Words (nan, inf) and type suffixes (1.0d, 1f) are rejected on purpose.
NUMERIC_TEXT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Accepted date/month spellings. No text has the shape of two of them.
MONTH_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM", "yyyy/MM/dd", "MM/dd/yyyy"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c: Column | str, stripped: bool = False) -> Column:
    """Numeric coercion (P8): text gate + try_cast; NaN/inf and garbage -> NULL.

    The gate admits digits only, so NaN never passes; an overflowing exponent
    (`1e999`) casts to infinity and is dropped here. Pass `stripped=True` when the
    text was already trimmed in an earlier projection (keeps generated code small).
    """
    t = _col(c) if stripped else strip_ws(c)
    v = F.when(t.rlike(NUMERIC_TEXT_PATTERN), t).try_cast("double")
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def coerce_int_truncated(c: Column | str, stripped: bool = False) -> Column:
    """Numeric coercion then truncation toward zero, as int(float(x)) does."""
    v = coerce_double(c, stripped)
    return F.when(F.abs(v) < F.lit(2.0**31), v.cast("int"))


def _shape(fmt: str) -> str:
    """Pattern of every text that the format can parse: years may have a sign and more than four digits."""
    return "^" + re.sub("MM|dd|HH|mm|ss", "[0-9]{2}", fmt.replace("yyyy", "[+-]?[0-9]{4,}")) + "$"


def month_floor(c: Column | str, stripped: bool = False) -> Column:
    """Parse a date/time text and floor it to the first day of its month."""
    t = _col(c) if stripped else strip_ws(c)
    # Drop fractional seconds so one pattern covers `... HH:mm:ss[.ffffff]`.
    t = F.regexp_replace(t, r"(\d{2}:\d{2}:\d{2})\.\d+$", "$1")
    # A format that does not fit costs an exception a row inside the parser, so only the one of the text's shape is tried.
    parsed = once(t, lambda t: F.coalesce(*[F.when(t.rlike(_shape(fmt)), F.try_to_timestamp(t, F.lit(fmt))) for fmt in MONTH_FORMATS]))
    return F.trunc(F.to_date(parsed), "MM")
