"""Running sums, ranks, indexes and exact quantiles without a single-partition window.

Rows are range-partitioned on (keys, order), so even one huge key spreads over many tasks. Sums are
taken inside each (key, range) piece and shifted by the total of the earlier pieces of that key; the
table of pieces has one row per key and range and is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut

#: Rows of a range, about, where their number is known.
RANGE_ROWS = 1_000_000


def ranges_for(df: DataFrame, rows: int) -> int:
    """Ranges of about ``RANGE_ROWS``, one for each core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // RANGE_ROWS))


def running(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column], rows: int | None = None) -> DataFrame:
    """Add inclusive running sums ``name -> expression`` over ``order`` within ``keys``.

    ``rows``, the number of rows or a bound of it: ranges then grow in number, not in size, so a task's memory does not depend on the input.
    Without it their number is left to the session and to adaptive execution.
    """
    parts = [] if rows is None else [ranges_for(df, rows)]
    pieces = (
        df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()])
        .repartitionByRange(*parts, *[F.col(k).asc() for k in keys], *order)
        .withColumn("_pid", F.spark_partition_id())
    )
    # the piece id depends on sampled range bounds, so it is fixed in a table before it is used twice
    pieces = cut(pieces)
    placed = pieces.repartitionById(*parts, F.col("_pid")) if parts else pieces
    at = ["_pid", *keys]
    inside = Window.partitionBy(*at).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        pieces.groupBy(*at)
        .agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
        .select(*at, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums])
    )
    own = placed.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_r_{n}") for n in sums])
    return own.join(shift, at).select(
        *df.columns, *[(F.col(f"_r_{n}") + F.col(f"_s_{n}")).alias(n) for n in sums]
    )


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank", rows: int | None = None) -> DataFrame:
    """1-based position of each row inside its key, for an order without ties; ``rows`` as in :func:`running`.

    Ranges are sorted before they are written, so a row's place in its range comes with it and rows are shuffled once.
    """
    parts = [] if rows is None else [ranges_for(df, rows)]
    by = [*[F.col(k).asc() for k in keys], *order]
    placed = df.repartitionByRange(*parts, *by).sortWithinPartitions(*by)
    placed = cut(placed.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_at")))
    at = ["_pid", *keys]
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy(*at).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).select(
        *at, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    # written, so that the planner sees how small it is and leaves the rows where they are
    return placed.join(cut(first), at).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def dense_index(df: DataFrame, key: str, name: str = "idx", rows: int | None = None) -> DataFrame:
    """Distinct values of ``key`` numbered 0..n-1 in sorted order; ``rows`` as in :func:`running`."""
    return rank_within(df.select(key).distinct(), [], [F.col(key).asc()], name, rows).withColumn(name, F.col(name) - 1)


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles per group (position (n-1)p between order statistics)."""
    by = by or []
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    cum = running(hist, by, [F.col(value).asc()], {"_cum": F.col("_n")})
    if by:
        cum = cum.join(hist.groupBy(*by).agg(F.sum("_n").alias("_all")), by)
    else:
        cum = cum.withColumn("_all", hist.agg(F.sum("_n")).scalar())
    grouped = cum.groupBy(*by)
    picks = []
    for name, p in probs.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        picks += [
            F.min(F.when(F.col("_cum") > F.floor(at), F.col(value).cast("double"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > F.ceil(at), F.col(value).cast("double"))).alias(f"_hi_{name}"),
        ]
    out = grouped.agg(F.max("_all").alias("_all"), *picks)
    cols = []
    for name, p in probs.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return out.select(*by, *cols)


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows: each task keeps its own n best, then those are merged."""
    return df.orderBy(*order).limit(n)


def summarize(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: n, min, quartiles, mean, max."""
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("r")
    ).select("r.name", "r.value")
    q = quantiles(long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=["name"])
    base = long.groupBy("name").agg(
        F.count("value").alias("n"), F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    return base.join(q, "name").select("name", "n", "min", "q1", "median", "mean", "q3", "max")
