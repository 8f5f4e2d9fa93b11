"""Maximum-likelihood fits by Newton steps, each one aggregate over the rows.

A model says, for given coefficients, what a row adds to the log-likelihood, to its
gradient and to the information (the negative second derivatives), as column
expressions. A step sums them in one JVM aggregate with partial sums per task, brings
one row to the driver, and solves a system as small as the model. The inverse
information at the end gives the standard errors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the rows' parts of: log-likelihood, gradient, upper triangle of the information row by row
Parts = tuple[Column, list[Column], list[Column]]


class Fit(NamedTuple):
    coefficients: list[float]
    std_errors: list[float]
    log_likelihood: float
    steps: int
    rank: int
    converged: bool


def newton(df: DataFrame, start: Sequence[float], parts: Callable[[list[float]], Parts],
           tol: float = 1e-8, max_steps: int = 25) -> Fit:
    """Climb from ``start`` until the log-likelihood changes by less than ``tol`` of itself.

    A step that lowers the likelihood is halved. Directions that the rows say nothing
    about (singular information) stay at their start; ``rank`` counts the others.
    Without rows the start comes back, not converged.
    """
    p = len(start)
    upper = [(i, j) for i in range(p) for j in range(i, p)]

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        value, gradient, second = parts([float(b) for b in beta])
        row = df.agg(*[F.sum(c).alias(f"s{n}") for n, c in enumerate([value, *gradient, *second])]).first()
        got = [math.nan if v is None else float(v) for v in row]
        info = np.zeros((p, p))
        for (i, j), v in zip(upper, got[1 + p:]):
            info[i, j] = info[j, i] = v
        return got[0], np.array(got[1:1 + p]), info

    beta, steps, done = np.array(start, float), 0, False
    value, gradient, info = at(beta)
    while math.isfinite(value) and not done and steps < max_steps:
        move = np.linalg.pinv(info, rcond=1e-14, hermitian=True) @ gradient if np.linalg.matrix_rank(info, hermitian=True) < p \
            else np.linalg.solve(info, gradient)
        for _ in range(30):
            new = at(beta + move)
            if math.isfinite(new[0]) and new[0] >= value - tol * (abs(value) + 0.1):
                break
            move = move / 2
        else:
            break
        done = abs(new[0] - value) < tol * (abs(new[0]) + 0.05)
        beta, steps = beta + move, steps + 1
        value, gradient, info = new
    known = math.isfinite(value)
    rank = int(np.linalg.matrix_rank(info, hermitian=True)) if known else 0
    spread = np.diag(np.linalg.pinv(info, hermitian=True) if rank < p else np.linalg.inv(info)) if known else np.full(p, math.nan)
    return Fit(beta.tolist(), np.sqrt(np.maximum(spread, 0)).tolist(), value, steps, rank, done)


def _linear(x: Sequence[Column], beta: Sequence[float]) -> Column:
    out = F.lit(0.0)
    for c, b in zip(x, beta):
        out = out + c * F.lit(b)
    return out


def logistic(y: Column, x: Sequence[Column], weight: Column | None = None) -> Callable[[list[float]], Parts]:
    """0/1 outcome ``y`` with P(y = 1) = 1 / (1 + exp(-x'beta)); give a constant column for the intercept."""
    w = F.lit(1.0) if weight is None else weight

    def parts(beta: list[float]) -> Parts:
        mu = 1 / (1 + F.exp(-_linear(x, beta)))
        value = w * F.when(y == 1, F.log(mu)).otherwise(F.log(1 - mu))
        second = [w * mu * (1 - mu) * a * b for i, a in enumerate(x) for b in x[i:]]
        return value, [w * (y - mu) * a for a in x], second

    return parts


def weibull(log_time: Column, event: Column, x: Sequence[Column], weight: Column | None = None) -> Callable[[list[float]], Parts]:
    """Weibull survival times in the form in which the likelihood is concave.

    The coefficients are (theta, tau) with e = tau log t - x'theta; a subject adds
    event * (e + log tau) - exp(e). Scale 1 / tau and theta / tau are the accelerated
    failure time model's.
    """
    w = F.lit(1.0) if weight is None else weight

    def parts(beta: list[float]) -> Parts:
        tau = beta[-1]
        if tau <= 0:  # outside the model: no likelihood
            nothing = F.lit(None).cast("double")
            return nothing, [nothing] * len(beta), [nothing] * (len(beta) * (len(beta) + 1) // 2)
        e = log_time * F.lit(tau) - _linear(x, beta[:-1])
        hazard = F.exp(e)
        value = w * (event * (e + F.lit(math.log(tau))) - hazard)
        gradient = [w * (hazard - event) * a for a in x] + [w * (event * (log_time + F.lit(1 / tau)) - log_time * hazard)]
        second = []
        for i, a in enumerate(x):
            second += [w * hazard * a * b for b in x[i:]] + [-w * hazard * a * log_time]
        return value, gradient, [*second, w * (event * F.lit(1 / tau ** 2) + log_time * log_time * hazard)]

    return parts


def normal_tails(z: float) -> float:
    """P(|Z| > |z|) of a standard normal Z."""
    return math.erfc(abs(z) / math.sqrt(2))
