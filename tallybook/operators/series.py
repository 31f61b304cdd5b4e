"""Lags, windows, moving range and control limits of a keyed series ``t, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import quantiles


def lagged(series: DataFrame, cols: list[str], p: int, t: str = "t") -> DataFrame:
    """Lagged design table: ``<col>`` and ``<col>_l1 .. _lp``, rows with all lags present.

    Every row is sent to the p+1 time points that need it and collected there: one shuffle on ``t``,
    no ordered window over the whole series.
    """
    shifted = series.select(t, *cols, F.explode(F.sequence(F.lit(0), F.lit(p))).alias("_k")).withColumn(
        "_at", F.col(t) + F.col("_k")
    )
    picks = [
        F.max(F.when(F.col("_k") == k, F.col(c))).alias(c if k == 0 else f"{c}_l{k}") for k in range(p + 1) for c in cols
    ]
    full = shifted.groupBy("_at").agg(F.count("*").alias("_n"), *picks).where(F.col("_n") == p + 1)
    return full.drop("_n").withColumnRenamed("_at", t)


def windows(series: DataFrame, value: str, size: int, t: str = "t") -> DataFrame:
    """(t, x, y): x = the last ``size`` values up to t in time order, y = the next change."""
    shifted = series.select(t, value, F.explode(F.sequence(F.lit(-1), F.lit(size - 1))).alias("_k")).select(
        (F.col(t) + F.col("_k")).alias(t), (-F.col("_k")).alias("_k"), F.col(value).alias("_v")
    )
    got = shifted.groupBy(t).agg(
        F.count("*").alias("_n"),
        F.sort_array(F.collect_list(F.when(F.col("_k") <= 0, F.struct("_k", "_v")))).alias("_w"),  # size rows
        F.max(F.when(F.col("_k") == 1, F.col("_v"))).alias("_next"),
    ).where(F.col("_n") == size + 1)
    x = F.transform("_w", lambda w: w["_v"])
    return got.select(t, x.alias("x"), (F.col("_next") - F.element_at(x, -1)).alias("y"))


def pair_consecutive(df: DataFrame, t: str = "t", parts: int | None = None) -> DataFrame:
    """(s0,s1),(s1,s2)...: each row next to its successor, columns of the successor end in ``_next``.

    ``parts``: tasks of the join, left to the session without it.
    """
    nxt = df.select((F.col(t) - 1).alias(t), *[F.col(c).alias(f"{c}_next") for c in df.columns if c != t])
    if parts is not None:
        df, nxt = df.repartition(parts, t), nxt.repartition(parts, t)
    return df.join(nxt, t)


def moving_range(series: DataFrame, value: str, t: str = "t") -> DataFrame:
    """Mean absolute first difference."""
    return pair_consecutive(series.select(t, value), t).agg(
        F.avg(F.abs(F.col(f"{value}_next") - F.col(value))).alias("moving_range")
    )


def control_limits(series: DataFrame, value: str = "sim", t: str = "t", sigmas: float = 3.0) -> DataFrame:
    """median -/+ ``sigmas`` x mean moving range, one row."""
    mr = moving_range(series, value, t).scalar()
    return quantiles(series, value, {"median": 0.5}).withColumn("moving_range", mr).select(
        "median", "moving_range",
        (F.col("median") - sigmas * F.col("moving_range")).alias("low"), (F.col("median") + sigmas * F.col("moving_range")).alias("high"),
    )


def find_outliers(series: DataFrame, limits: DataFrame, value: str = "sim") -> DataFrame:
    """Rows outside the control limits."""
    low, high = limits.select("low").scalar(), limits.select("high").scalar()
    return series.where((F.col(value) < low) | (F.col(value) > high))
