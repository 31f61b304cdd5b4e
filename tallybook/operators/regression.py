"""Kernel regression and least squares."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..functions.vectors import zscore

CELL = 4096


def kernel_predict(query: DataFrame, train: DataFrame, c: float = 2.0, key: str = "t", cell: int = CELL) -> DataFrame:
    """(key, yhat): mean of the train targets weighted by exp(c * correlation of the two windows).

    Every query row meets every train row, so the two sides are laid out on a grid of cells of about
    ``cell`` x ``cell`` rows. Each cell is one small matrix product that returns partial sums per
    query row; no pair of rows is ever emitted, and the sums are added up in one aggregation.
    """
    nq, nt = max(query.count(), 1), max(train.count(), 1)
    gq, gt = math.ceil(nq / cell), math.ceil(nt / cell)

    def side(df: DataFrame, own: str, n_own: int, other: str, n_other: int, *cols):
        spread = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        return df.select(F.pmod(draw(key), F.lit(n_own)).cast("int").alias(own), zscore("x").alias("z"), *cols, spread)

    def cell_sums(q: pd.DataFrame, tr: pd.DataFrame) -> pd.DataFrame:
        if q.empty or tr.empty:
            return pd.DataFrame({key: [], "num": [], "den": []})
        w = np.exp(c * (np.stack(q["z"].to_numpy()) @ np.stack(tr["z"].to_numpy()).T))
        return pd.DataFrame({key: q[key], "num": w @ tr["y"].to_numpy(), "den": w.sum(axis=1)})

    left = side(query, "i", gq, "j", gt, F.col(key)).groupBy("i", "j")
    right = side(train, "j", gt, "i", gq, F.col("y")).groupBy("i", "j")
    sums = left.cogroup(right).applyInPandas(cell_sums, f"{key} long, num double, den double")
    return sums.groupBy(key).agg((F.sum("num") / F.sum("den")).alias("yhat"))


def stack_horizons(preds: dict[str, DataFrame], target: DataFrame, key: str = "t") -> DataFrame:
    """One column per horizon plus the target ``y``, joined on the row key."""
    out = target.select(key, "y")
    for name, df in preds.items():
        out = out.join(df.select(key, F.col("yhat").alias(name)), key)
    return out


class Fit:
    """Least squares of one target: coefficients, standard errors and residual sum of squares."""

    def __init__(self, terms, coef, se, rss, n):
        self.terms, self.coef, self.se, self.rss, self.n = terms, coef, se, rss, n

    def column(self):
        """Prediction as a column expression."""
        out = F.lit(0.0)
        for name, b in zip(self.terms, self.coef):
            out = out + (F.lit(float(b)) if name == "const" else F.col(name) * float(b))
        return out

    def table(self, spark, equation: str) -> DataFrame:
        rows = [
            (equation, n, float(b), float(s), float(b / s) if s > 0 else None)
            for n, b, s in zip(self.terms, self.coef, self.se)
        ]
        return spark.createDataFrame(rows, "equation string, term string, coef double, se double, t double")


def least_squares(df: DataFrame, ys: list[str], xs: list[str], const: bool = True) -> dict[str, Fit]:
    """Fit every target in ``ys`` on the same regressors.

    Two aggregations over the data, one for means and scales and one for the cross products of the
    scaled columns; only (k+1)^2 sums reach the driver.
    """
    cols = [*xs, *[y for y in ys if y not in xs]]
    d = lambda c: F.col(c).cast("double")
    first = df.agg(
        F.count("*").alias("n"), *[F.avg(d(c)).alias(f"m_{c}") for c in cols], *[F.stddev_pop(d(c)).alias(f"s_{c}") for c in cols]
    ).first()
    n = first["n"]
    shift = {c: first[f"m_{c}"] if const else 0.0 for c in cols}
    scale = {c: first[f"s_{c}"] or 1.0 for c in cols}
    std = {c: (d(c) - shift[c]) / scale[c] for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = df.agg(*[F.sum(std[a] * std[b]).alias(f"g{i}") for i, (a, b) in enumerate(pairs)]).first()
    g = {}
    for (a, b), v in zip(pairs, sums):
        g[a, b] = g[b, a] = v
    k = len(xs)
    gram = np.array([[g[a, b] for b in xs] for a in xs], dtype=float).reshape(k, k)
    inv = np.linalg.inv(gram) if k else gram
    fits = {}
    for y in ys:
        xy = np.array([g[a, y] for a in xs], dtype=float)
        beta = inv @ xy
        rss = g[y, y] - beta @ xy
        s2 = rss / (n - k - int(const))
        sx = np.array([scale[a] for a in xs])
        coef = list(beta * scale[y] / sx)
        cov = inv * s2 * scale[y] ** 2 / np.outer(sx, sx) if k else inv
        se = list(np.sqrt(np.diag(cov)))
        terms = list(xs)
        if const:
            mx = np.array([shift[a] for a in xs])
            coef.append(shift[y] - float(np.dot(coef, mx)))
            se.append(float(np.sqrt(s2 * scale[y] ** 2 / n + mx @ cov @ mx)))
            terms.append("const")
        fits[y] = Fit(terms, coef, se, rss * scale[y] ** 2, n)
    return fits


def ols(df: DataFrame, y: str, xs: list[str]) -> Fit:
    return least_squares(df, [y], xs)[y]


def ols_predict(df: DataFrame, fit: Fit, y: str = "y") -> DataFrame:
    """Actual next to predicted."""
    return df.withColumn("actual", F.col(y)).withColumn("predicted", fit.column())
