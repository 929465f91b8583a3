"""Linear and logistic scores from explicit parameters, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_margin(intercept: float, coefficients: Mapping[str, float]) -> Column:
    """b0 + sum(b_i * x_i), added left to right in the mapping's order."""
    total = F.lit(float(intercept))
    for name, b in coefficients.items():
        total = total + F.lit(float(b)) * F.col(name)
    return total


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logistic_score(intercept: float, coefficients: Mapping[str, float]) -> Column:
    """M8 with explicit parameters: 1 / (1 + exp(-(b0 + sum(b_i * x_i))))."""
    return sigmoid(linear_margin(intercept, coefficients))
