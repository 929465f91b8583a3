"""Text forms of metrics (report tables) and display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _half_up(c: Column, digits: int) -> Column:
    """Half-up rounding in binary arithmetic (same result in every engine)."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def pct_text(c: Column | str) -> Column:
    """Ratio as percent text with one decimal, e.g. 0.4167 -> '41.7%'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.format_string("%.1f%%", _half_up(c * F.lit(100.0), 1)))


def auc_text(c: Column | str) -> Column:
    """AUC with three decimals; 'N/A' when NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.3f", _half_up(c, 3)))
