"""Row-level vector expressions and the scoring chain."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.binding import let

# The epsilon of the norm and the factor on the scoring chain's result.
NORM_EPS = 1e-6
OUTPUT_SCALE = 0.01

MOST_WEIGHT_BYTES = 256 * 1024 * 1024


def rms_norm(vector: Column, eps: float = NORM_EPS) -> Column:
    """``x / sqrt(mean(x^2) + eps)``."""
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return let(
        F.sqrt(squares / F.size(vector) + F.lit(eps)),
        lambda scale: F.transform(vector, lambda x: x.cast("double") / scale),
    )


def _gelu(x: np.ndarray) -> np.ndarray:
    erf = np.fromiter(map(math.erf, (x / math.sqrt(2.0)).ravel()), dtype=np.float64, count=x.size)
    return 0.5 * x * (1.0 + erf.reshape(x.shape))


def project_vectors(vector: Column, w1: np.ndarray, b1: np.ndarray, w2: np.ndarray, b2: np.ndarray) -> Column:
    """RMS norm, linear, GELU, linear, scaled down; weights are ``(out, in)`` matrices.

    The weights travel with the function, so their size is checked.
    """
    size = sum(part.nbytes for part in (w1, b1, w2, b2))
    if size > MOST_WEIGHT_BYTES:
        raise ValueError(f"{size} bytes of weights are too many to send to every task")

    def score(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=object)
        rows = np.stack(vectors.to_numpy()).astype(np.float64)
        rows = rows / np.sqrt((rows**2).mean(axis=1, keepdims=True) + NORM_EPS)
        hidden = _gelu(rows @ w1.T + b1)
        return pd.Series(list((hidden @ w2.T + b2) * OUTPUT_SCALE))

    return F.pandas_udf(score, "array<double>")(vector)
