"""M1, M3: the pooled linear autoregression from lagged products.

The normal equations of all windows need, for each pair of lags ``i <= j``, the sum of ``s[t-i] * s[t-j]`` over the
windows' targets ``t = a..b``.  That is the sum of the products at distance ``d = j - i`` over ``u = a-i..b-i``: one running
sum for each distance gives all pairs of lags, with the edges of the range taken off.  So no window of L values is
built: a chunk of n values costs n * L additions instead of n * L², and what leaves a chunk is the matrix alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.operators.features import series_chunks, train_cut


class LinearFit(NamedTuple):
    """Weights of the L values before a target (oldest first), the constant, and what the fit leaves over."""

    coefficients: list[float]
    intercept: float
    n: int
    loss: float          # mean squared error of the fitted rows


def window_products(v: np.ndarray, a: int, b: int, L: int) -> np.ndarray:
    """Sums over the targets ``t = a..b`` (places in ``v``, ``a >= L``) of the products of
    ``(v[t], v[t-1], ..., v[t-L], 1)``, as a matrix."""
    g = np.zeros((L + 2, L + 2))
    if b < a:
        return g
    for d in range(L + 1):
        run = np.concatenate([[0.0], np.cumsum(v[d:] * v[:len(v) - d])])       # run[u - d + 1]: products up to u
        i = np.arange(L + 1 - d)
        g[i, i + d] = g[i + d, i] = run[b - i - d + 1] - run[a - i - d]
    run = np.concatenate([[0.0], np.cumsum(v)])
    i = np.arange(L + 1)
    g[i, L + 1] = g[L + 1, i] = run[b - i + 1] - run[a - i]
    g[L + 1, L + 1] = b - a + 1
    return g


def gram_matrix(scaled: DataFrame, L: int = 60, frac: float = 0.8, value: str = "s", chunk: int = 4096) -> np.ndarray:
    """The matrix of :func:`window_products` over the train samples of all tickers.

    A window with a missing value takes no part; a chunk that has one adds its whole windows one by one.
    Only the (L + 2)² sums reach the driver.
    """
    d = series_chunks(scaled, L, value, chunk, extra=("n",)).withColumn(
        "_last", F.lit(L) + train_cut(F.greatest(F.col("n") - L, F.lit(0)), frac))

    def run(batches):
        total = np.zeros((L + 2, L + 2))
        for batch in batches:
            for first, own, last, values in zip(*(batch.column(i) for i in range(4))):
                v = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                # targets: own places with L values before them, up to the last train position
                a = max(own.as_py() - first.as_py(), L + 1 - first.as_py(), L)
                b = min(len(v) - 1, last.as_py() - first.as_py())
                if b < a:
                    continue
                if np.isnan(v).any():
                    w = np.lib.stride_tricks.sliding_window_view(v[a - L:b + 1], L + 1)[:, ::-1]
                    w = w[~np.isnan(w).any(axis=1)]
                    w = np.hstack([w, np.ones((len(w), 1))])
                    total += w.T @ w
                else:
                    total += window_products(v, a, b, L)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "g"])

    sums = d.select("first_pos", "own_pos", "_last", "values").mapInArrow(run, "i long, j long, g double")
    out = np.zeros((L + 2, L + 2))
    for r in sums.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = r["g"]
    return out


def solve(g: np.ndarray) -> LinearFit:
    """Least squares out of the sums: the target is first, the lags follow, the constant is last."""
    n = int(round(g[-1, -1]))
    L = len(g) - 2
    if n == 0:
        raise ValueError("no sample to train on")
    w, *_ = np.linalg.lstsq(g[1:, 1:], g[1:, 0], rcond=1e-13)
    loss = (g[0, 0] - 2 * w @ g[1:, 0] + w @ g[1:, 1:] @ w) / n
    return LinearFit([float(x) for x in w[:L][::-1]], float(w[L]), n, float(max(loss, 0.0)))


def fit_linear_gram(scaled: DataFrame, L: int = 60, frac: float = 0.8, value: str = "s") -> LinearFit:
    """M1: the pooled linear model of the train samples, in one pass over the series."""
    return solve(gram_matrix(scaled, L, frac, value))
