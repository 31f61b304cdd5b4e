"""Relational core: aliases, splits, totals, set operations, candidate items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import col, draw, unit
from .ordering import rank_within, top_rows

CHUNK = 10_000


def resolve_alias(facts: DataFrame, alias: DataFrame, key: str = "item_id") -> DataFrame:
    """Replace ``key`` by its canonical id, one hop. Rows without an alias stay, duplicates stay.

    No hint: the planner broadcasts the alias table only if its size is under the session threshold,
    otherwise the skew-aware shuffle join takes over.
    """
    a = alias.select(F.col("bad_id").alias(key), F.col("good_id").alias("_good"))
    return facts.join(a, key, "left").select(
        *[F.coalesce("_good", key).alias(key) if c == key else F.col(c) for c in facts.columns]
    )


def split_label(df: DataFrame, weights: dict[str, float], seed: int, key_cols: list[str]) -> DataFrame:
    """Add ``split``, drawn from a hash of the key columns: stable under any partitioning."""
    total = sum(weights.values())
    u, edge, label = unit(*key_cols, seed), 0.0, None
    names = list(weights)
    for n in names[:-1]:
        edge += weights[n] / total
        label = F.when(u < edge, n) if label is None else label.when(u < edge, n)
    label = F.lit(names[-1]) if label is None else label.otherwise(names[-1])
    return df.withColumn("split", label)


def permute(df: DataFrame, seq: str, trials: int, seed: int = 0) -> DataFrame:
    """One shuffled copy of an ordered log per trial: adds ``trial`` and the new position ``pos``."""
    many = df.withColumn("trial", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(trials - 1).cast("bigint"))))
    return rank_within(
        many.withColumn("_draw", draw("trial", seq, seed)), ["trial"], [F.col("_draw").asc(), F.col(seq).asc()], "pos"
    ).drop("_draw")


def user_totals(plays: DataFrame) -> DataFrame:
    """Total plays and mean plays per fact row, per user."""
    return plays.groupBy("user_id").agg(
        F.sum("plays").alias("total_plays"), F.avg("plays").alias("mean_plays")
    )


def top_users(totals: DataFrame, k: int = 3) -> DataFrame:
    return top_rows(totals, [F.desc("total_plays"), F.asc("user_id")], k)


def preview(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """First rows of a table in a stated order."""
    return top_rows(df, order, n)


def items_by_user(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Item lists per user in item order, ``chunk`` places a row: row k holds places k * chunk + 1 to (k + 1) * chunk.

    The rule is the same for all users, and no task has to hold all items of a huge one.
    """
    pairs = df.select("user_id", "item_id").distinct()
    placed = rank_within(pairs, ["user_id"], [F.col("item_id").asc()], "place")
    return placed.groupBy("user_id", F.floor((F.col("place") - 1) / chunk).alias("chunk")).agg(
        F.sort_array(F.collect_list("item_id")).alias("items")
    )


def distinct_entities(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of several columns as (kind, id)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("id")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.kind", "p.id").distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def intersect_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), keys, "left_semi")


def except_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")


def with_names(df: DataFrame, dim: DataFrame, key: str = "item_id") -> DataFrame:
    """Id to name lookup."""
    return df.join(dim, key)


def expand(df: DataFrame, count: Column | str, name: str, step: int = CHUNK) -> DataFrame:
    """Repeat each row ``count`` times with ``name`` = 1..count, in two levels so that no array grows
    past ``step`` entries."""
    n = col(count)
    blocks = df.withColumn("_n", n.cast("bigint")).where("_n > 0").withColumn(
        "_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / step)))
    )
    return blocks.withColumn(
        name, F.explode(F.sequence(F.col("_b") * step + 1, F.least(F.col("_n"), (F.col("_b") + 1) * step)))
    ).drop("_n", "_b")


def candidates_by_rank(need: DataFrame, ranked: DataFrame) -> DataFrame:
    """For each user the first ``need`` items of a common ranking.

    ``need(user_id, need)``, ``ranked(item_id, rank, ...)``. The number of rows is the sum of the needs,
    not users times items.
    """
    return expand(need, "need", "rank").drop("need").join(ranked, "rank")


def candidate_items(users: DataFrame, ranked: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """First ``k`` items of a common ranking that the user does not have in ``train``.

    The first k + |train items| ranks must hold k free items (or all there are), so nothing is missed.
    """
    seen = train.select("user_id", "item_id").distinct()
    need = (
        users.select("user_id").distinct()
        .join(seen.groupBy("user_id").agg(F.count("*").alias("_seen")), "user_id", "left")
        .select("user_id", (F.coalesce("_seen", F.lit(0)) + k).alias("need"))
    )
    free = except_keys(candidates_by_rank(need, ranked), seen, ["user_id", "item_id"])
    return rank_within(free, ["user_id"], [F.col("rank").asc()], "place").where(F.col("place") <= k)
