"""Logistic fits by Newton steps, each step one aggregate (M5, M6, M7).

A fit minimises  sum(w * loss(y, margin)) + penalty / 2 * |b|^2  (the intercept b0 is not
penalised). A step needs the gradient and the Hessian, which are sums over the rows of a few products of
features: one map-side-combined aggregate with one row as its result, whatever the number
of rows. Several penalties share the pass, so a search over C reads the rows once a
step for all of them. What is solved on the driver is a system of one row per feature.
Labels may be fractions (smoothed targets): a row then counts for both classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 60
#: A fit is done when a step promises less than this share of the objective; the step itself is still taken.
TOLERANCE = 1e-14


@dataclass
class _Fit:
    penalty: float
    beta: np.ndarray
    before: np.ndarray | None = None
    least: float = float("inf")
    done: bool = False

    def step(self, loss: float, gradient: np.ndarray, hessian: np.ndarray) -> None:
        own = self.beta.copy()
        own[0] = 0.0
        loss = loss + 0.5 * self.penalty * float(own @ own)
        if self.before is not None and loss > self.least + 1e-12 * abs(self.least):
            self.beta = (self.beta + self.before) / 2  # too far: half the way
            return
        gradient = gradient + self.penalty * own
        hessian = hessian + self.penalty * np.diag([0.0] + [1.0] * (len(own) - 1))
        scale = np.sqrt(np.maximum(np.diag(hessian), 1e-300))
        move = np.linalg.lstsq(hessian / np.outer(scale, scale), gradient / scale, rcond=1e-13)[0] / scale
        self.before, self.least = self.beta, loss
        self.beta = self.beta - move
        self.done = float(gradient @ move) <= TOLERANCE * max(abs(loss), 1e-300)


def _sums(fits: Sequence[_Fit], xs: Sequence[Column]) -> list[Column]:
    """Loss, gradient and upper half of the Hessian of every fit, as sums."""
    out = []
    for f in fits:
        margin = F.lit(float(f.beta[0]))
        for b, x in zip(f.beta[1:], xs[1:], strict=True):
            margin = margin + F.lit(float(b)) * x
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        w, y = F.col("__w"), F.col("__y")
        out.append(F.sum(w * (F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - y * margin)))
        out += [F.sum(w * (p - y) * x) for x in xs]
        out += [F.sum(w * p * (F.lit(1.0) - p) * a * b) for i, a in enumerate(xs) for b in xs[i:]]
    return out


def fit_logits(rows: DataFrame, features: Sequence[str], penalties: Sequence[float], label: str = "y",
               weight: str | None = None) -> list[tuple[float, list[float]]]:
    """(intercept, coefficients) for each penalty. `rows` are read once a step: pass them persisted or written."""
    used = [F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(features, start=1)]
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    data = rows.select(*used, F.col(label).cast("double").alias("__y"), w.alias("__w"))
    n = len(features) + 1
    xs = [F.lit(1.0), *(F.col(f"__x{i}") for i in range(1, n))]
    fits = [_Fit(float(p), np.zeros(n)) for p in penalties]
    upper = np.triu_indices(n)
    for _ in range(MAX_STEPS):
        active = [f for f in fits if not f.done]
        if not active:
            break
        got = data.agg(F.sum("__w"), *_sums(active, xs)).first()
        if not got[0]:
            raise ValueError("cannot fit on an empty training set")
        each = (len(got) - 1) // len(active)
        for k, f in enumerate(active):
            part = np.array(got[1 + k * each : 1 + (k + 1) * each], float)
            hessian = np.zeros((n, n))
            hessian[upper] = part[1 + n :]
            hessian = hessian + np.triu(hessian, 1).T
            f.step(float(part[0]), part[1 : 1 + n], hessian)
    return [(float(f.beta[0]), [float(b) for b in f.beta[1:]]) for f in fits]
