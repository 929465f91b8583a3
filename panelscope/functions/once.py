"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` computed once however often `body` reads it.

    Written as an expression over a list of one element, it stays of one size where Spark copies it, as
    for a filter that moves below its projection; a plain nested expression would be computed at every place
    that reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)
