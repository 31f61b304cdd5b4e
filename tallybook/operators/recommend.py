"""Implicit-feedback recommendation and ranked-overlap evaluation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..session import cut
from .facts import candidates_by_rank, except_keys
from .inner_product import best_products
from .ordering import dense_index, rank_within


#: Rows of a factor block, at least 16 blocks.
BLOCK_ROWS = 4_000_000


@dataclass
class ImplicitModel:
    """Factors of the users (user_id, vec) and of the items (item_id, vec) by their own ids."""

    users: DataFrame
    items: DataFrame


def train_implicit(train: DataFrame, rank: int, seed: int = 345, blocks: int | None = None) -> ImplicitModel:
    """Implicit matrix factorisation with 5 iterations, lambda 0.01 and alpha 0.01. Repeated pairs are
    summed first. Ids of any size are numbered for the fit. The model depends on the number of factor
    blocks, which follows the rows and not the cores."""
    plays = cut(train.groupBy("user_id", "item_id").agg(F.sum("plays").cast("float").alias("plays")))
    users, items = cut(dense_index(plays, "user_id", "u")), cut(dense_index(plays, "item_id", "i"))
    blocks = blocks or max(16, -(-plays.count() // BLOCK_ROWS))
    als = ALS(
        rank=rank, maxIter=5, regParam=0.01, alpha=0.01, implicitPrefs=True, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks, userCol="u", itemCol="i", ratingCol="plays",
    )
    model = als.fit(plays.join(users, "user_id").join(items, "item_id").select(F.col("u").cast("int"), F.col("i").cast("int"), "plays"))
    vec = F.transform("features", lambda x: x.cast("double")).alias("vec")
    return ImplicitModel(
        cut(users.join(model.userFactors, F.col("u") == F.col("id")).select("user_id", vec)),
        cut(items.join(model.itemFactors, F.col("i") == F.col("id")).select("item_id", vec)))


def score(model: ImplicitModel, cands: DataFrame) -> DataFrame:
    """Score given pairs; pairs unknown to the model vanish."""
    u = model.users.withColumnRenamed("vec", "_u")
    i = model.items.withColumnRenamed("vec", "_i")
    return cands.join(u, "user_id").join(i, "item_id").withColumn("score", dot("_u", "_i")).drop("_u", "_i")


def recommend(model: ImplicitModel, users: DataFrame, n: int) -> DataFrame:
    """Top ``n`` items per user, exactly; items of the training set are not removed."""
    wanted = model.users.join(users.select("user_id").distinct(), "user_id", "left_semi").withColumn("need", F.lit(n))
    best = best_products(wanted, model.items)
    return best.select("user_id", F.posexplode(F.arrays_zip("items", "scores")).alias("place", "r")).select(
        "user_id", (F.col("place") + 1).alias("place"), F.col("r.items").alias("item_id"), F.col("r.scores").alias("score"))


def needs(truth: DataFrame, train: DataFrame) -> DataFrame:
    """How far down a user's ranking the evaluation looks: truth items plus train items."""
    t = truth.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count("*").alias("x"))
    s = train.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count("*").alias("seen"))
    return t.join(s, "user_id", "left").select("user_id", (F.col("x") + F.coalesce("seen", F.lit(0))).alias("need"))


def model_scores(model: ImplicitModel, truth: DataFrame, train: DataFrame) -> DataFrame:
    """Scores deep enough for an exact overlap: each user's list is as long as that user needs."""
    best = best_products(model.users.join(needs(truth, train), "user_id"), model.items)
    return best.select("user_id", F.explode(F.arrays_zip("items", "scores")).alias("r")).select("user_id", F.col("r.items").alias("item_id"), F.col("r.scores").alias("score"))


def popularity_scores(ranked: DataFrame, truth: DataFrame, train: DataFrame) -> DataFrame:
    """The same depth of candidates for a ranking that is common to all users."""
    return candidates_by_rank(needs(truth, train), ranked).select("user_id", "item_id", "score")


def top_x_per_user(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """The best X items per user, X = number of the user's truth items; ties by item id."""
    x = truth.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count("*").alias("x"))
    ranked = rank_within(scores, ["user_id"], [F.col("score").desc(), F.col("item_id").asc()], "place")
    return ranked.join(x, "user_id").where(F.col("place") <= F.col("x"))


def overlap_per_user(scores: DataFrame, truth: DataFrame, train: DataFrame) -> DataFrame:
    """hits / X per user. Train items are not recommended but stay in X."""
    keys = ["user_id", "item_id"]
    t = truth.select(*keys).distinct()
    free = except_keys(scores, train, keys)
    hits = (
        top_x_per_user(free, t).join(t, keys, "left_semi").groupBy("user_id").agg(F.count("*").alias("hits"))
    )
    x = t.groupBy("user_id").agg(F.count("*").alias("x"))
    return x.join(hits, "user_id", "left").select(
        "user_id", "x", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"),
        (F.coalesce("hits", F.lit(0)) / F.col("x")).alias("overlap"),
    )


def overlap_at_x(scores: DataFrame, truth: DataFrame, train: DataFrame) -> DataFrame:
    """Mean overlap over users that have truth items."""
    return overlap_per_user(scores, truth, train).agg(
        F.count("*").alias("users"), F.sum("hits").alias("hits"), F.avg("overlap").alias("overlap")
    )


def sweep(train: DataFrame, val: DataFrame, ranks: tuple[int, ...] = (2, 10, 20), seed: int = 345) -> tuple[DataFrame, ImplicitModel]:
    """Fit one model per rank, score each on ``val``; returns the table and the best model."""
    rows, best = [], (-math.inf, None)
    for r in ranks:
        model = train_implicit(train, r, seed)
        s = overlap_at_x(model_scores(model, val, train), val, train).first()["overlap"]
        rows.append((r, s))
        if s > best[0]:
            best = (s, model)
    return train.sparkSession.createDataFrame(rows, "rank int, overlap double"), best[1]
