"""Graph snapshots: weighted vertex sets, fingerprints and their similarity over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import token_bits
from ..functions.vectors import bit_similarity
from .ordering import rank_within
from .series import pair_consecutive


def snapshot_vertices(edges: DataFrame) -> DataFrame:
    """Vertices that touch an edge of their snapshot."""
    return edges.select("snap", F.explode(F.array("src", "dst")).alias("id")).distinct()


def shingle(edges: DataFrame) -> DataFrame:
    """(snap, token, weight): each vertex once with its degree; parallel edges count."""
    ends = edges.select("snap", F.explode(F.array("src", "dst")).alias("token"))
    return ends.groupBy("snap", "token").agg(F.count("*").alias("weight"))


def rank_vertices(ranks: DataFrame, by: str = "snap", digits: int = 12) -> DataFrame:
    """Vertices of each snapshot by falling quality, ties by id."""
    q = ranks.withColumn("_q", F.round("rank", digits))
    return rank_within(q, [by], [F.desc("_q"), F.asc("id")], "place").drop("_q")


def simhash(tokens: DataFrame, by: str = "snap", bits: int = 64) -> DataFrame:
    """(by, bits): one signed weighted sum per bit, all in one aggregation; bit = sum >= 0. Any number of bits."""
    signs = token_bits(F.col("token").cast("string"), bits)
    sums = [F.sum(F.col("weight") * (2 * b - 1)).alias(f"_s{i}") for i, b in enumerate(signs)]
    flags = [F.when(F.col(f"_s{i}") >= 0, 1).otherwise(0) for i in range(bits)]
    return tokens.groupBy(by).agg(*sums).select(by, F.array(*flags).alias("bits"))


def snapshot_similarity(prints: DataFrame, by: str = "snap") -> DataFrame:
    """(t, sim): share of equal bits of each snapshot and its successor."""
    pairs = pair_consecutive(prints.select(by, "bits"), by)
    return pairs.select(F.col(by).alias("t"), bit_similarity("bits", "bits_next").alias("sim"))
