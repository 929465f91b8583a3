"""Entity-key normalisation as Column expressions (no Python per row).

Three rules exist on purpose (SURVEY X12): loaders accept 1-5 digits, the
monthly loader first reads numbers written as decimals, and requests also
accept a 6-digit key with one leading zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import once

# Fixed value: key width of the built-in data sets; wider keys are an argument.
KEY_WIDTH = 5


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim all ASCII white space (Spark `trim` only removes blanks)."""
    return F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", "")


def digits_only(c: Column | str) -> Column:
    """Keep ASCII digits only."""
    return F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")


def _pad_if_fits(d: Column, width: int) -> Column:
    return once(d, lambda d: F.when((F.length(d) >= 1) & (F.length(d) <= width), F.lpad(d, width, "0")))


def normalize_key(c: Column | str, width: int = KEY_WIDTH) -> Column:
    """Loader rule (P3, P6): keep digits; 1..width digits -> left-pad to width; else NULL."""
    return _pad_if_fits(digits_only(c), width)


def normalize_key_numeric(c: Column | str, width: int = KEY_WIDTH) -> Column:
    """Monthly-loader rule (P4): text like `39049.0` is read as a number first.

    A stripped value made of digits with exactly one '.' becomes its integer part
    (leading zeros dropped, as int(float(x)) does); then the loader rule applies.
    """
    def as_text(t: Column) -> Column:
        is_decimal_text = t.rlike(r"^([0-9]+\.[0-9]*|\.[0-9]+)$")
        int_part = F.regexp_replace(F.regexp_extract(t, r"^([0-9]*)\.", 1), "^0+", "")
        as_number = once(int_part, lambda i: F.when(i == "", F.lit("0")).otherwise(i))
        return F.when(is_decimal_text, as_number).otherwise(t)

    return normalize_key(once(strip_ws(c), as_text), width)


def normalize_key_request(c: Column | str, width: int = KEY_WIDTH) -> Column:
    """Request rule (P5): width + 1 digits with a leading 0 keep the last ones; more than width otherwise invalid."""
    def fitted(d: Column) -> Column:
        last = F.when(d.startswith("0"), F.substring(d, 2, width))
        return F.when(F.length(d) == width + 1, last).when((F.length(d) >= 1) & (F.length(d) <= width), F.lpad(d, width, "0"))

    return once(digits_only(c), fitted)


def repad_key(c: Column | str) -> Column:
    """Re-pad a key read back from text (P7): like str.zfill(5), never truncates."""
    t = strip_ws(c)
    signed = t.rlike(r"^[+-]")
    body = F.when(signed, F.substring(t, 2, 1 << 30)).otherwise(t)
    sign = F.when(signed, F.substring(t, 1, 1)).otherwise(F.lit(""))
    padded = F.when(
        signed & (F.length(body) < KEY_WIDTH - 1), F.lpad(body, KEY_WIDTH - 1, "0")
    ).when(~signed & (F.length(body) < KEY_WIDTH), F.lpad(body, KEY_WIDTH, "0")).otherwise(body)
    return F.when(t.isNotNull(), F.concat(sign, padded))
