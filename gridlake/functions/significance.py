"""Two-sided Student t probability, the one function Spark lacks here.

It runs on already aggregated rows (one per test), as an Arrow-batched Pandas UDF.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship this module's code with the task, so executors need no install of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lgamma(values: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in values.ravel()]).reshape(values.shape)


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, terms: int = 10_000) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by its continued fraction (modified Lentz)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    # The fraction converges fast below the mean; above it use I_x(a,b) = 1 - I_{1-x}(b,a).
    flip = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    log_beta = _lgamma(p) + _lgamma(q) - _lgamma(p + q)
    with np.errstate(divide="ignore", invalid="ignore", under="ignore"):
        front = np.exp(p * np.log(z) + q * np.log1p(-z) - log_beta) / p
    tiny = 1e-300

    def away_from_zero(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(z)
    d = 1 / away_from_zero(1 - (p + q) * z / (p + 1))
    value = d.copy()
    for m in range(1, terms):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1 / away_from_zero(1 + step * d)
            c = away_from_zero(1 + step / c)
            value = value * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    if np.any(np.abs(d * c - 1) > 1e-10):
        raise ArithmeticError("the continued fraction did not converge")
    result = np.where(z <= 0, 0.0, front * value)
    return np.where(flip, 1 - result, result)


# Degrees of freedom from which the fraction loses digits to cancellation and the expansion is exact.
LARGE_DF = 1e5


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|): incomplete beta, or for many degrees of freedom Hill's normalising expansion (1970)."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    large = df >= LARGE_DF
    out = np.empty_like(t)
    small_t, small_df = t[~large], df[~large]
    out[~large] = incomplete_beta(small_df / 2, np.full_like(small_df, 0.5), small_df / (small_df + small_t * small_t))
    shifted = df[large] - 0.5
    z = np.sqrt(shifted * np.log1p(t[large] * t[large] / df[large]))
    z = z + (z**3 + 3 * z) / (48 * shifted * shifted)
    out[large] = [math.erfc(v / math.sqrt(2)) for v in z]
    return out


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(|T| >= |t|); NULL where either input is."""
    known = t.notna() & df.notna()
    out = pd.Series(np.nan, index=t.index, dtype="float64")
    if known.any():
        out[known] = t_two_sided(t[known].to_numpy(), df[known].to_numpy())
    return out.astype(object).where(out.notna(), None)
