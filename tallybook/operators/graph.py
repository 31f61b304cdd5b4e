"""Edge tables: clean-up, heterogeneous graph, components, page rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import round_rating
from ..session import cut
from .facts import union_all
from .ordering import dense_index, ranges_for


def swapped(edges: DataFrame) -> DataFrame:
    return edges.withColumns({"src": F.col("dst"), "dst": F.col("src")})


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, without duplicates and self loops; duplicates are found among pairs in one order, half the rows."""
    one = consistent(edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")))
    both = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return one.select(F.explode(both).alias("e")).select("e.src", "e.dst")


def consistent(edges: DataFrame) -> DataFrame:
    """Distinct neighbours, no self loops."""
    return edges.where("src <> dst").select("src", "dst").distinct()


def has_self_loops(edges: DataFrame) -> DataFrame:
    return edges.agg(F.coalesce(F.bool_or(F.col("src") == F.col("dst")), F.lit(False)).alias("has_self_loops"))


def subgraph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends in ``nodes(id)``."""
    ends = nodes.select("id").distinct()
    return edges.join(ends.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ends.withColumnRenamed("id", "dst"), "dst", "left_semi"
    ).select(*edges.columns)


def has_edge(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(src, dst)`` with a flag: adjacent in either direction."""
    both = edges.select("src", "dst").unionByName(swapped(edges.select("src", "dst"))).distinct()
    return pairs.join(both.withColumn("_hit", F.lit(True)), ["src", "dst"], "left").withColumn(
        "has_edge", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def degree(edges: DataFrame) -> DataFrame:
    """(id, degree) of an edge table that holds both directions."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


def graph_size(edges: DataFrame) -> DataFrame:
    """Nodes and edges (half the degree sum) of an edge table that holds both directions."""
    return degree(edges).agg(F.count("*").alias("nodes"), (F.sum("degree") / 2).cast("bigint").alias("edges"))


def clique(spark: SparkSession, n: int) -> DataFrame:
    """Complete graph on 1..n."""
    return spark.range(n * n).select(
        (F.floor(F.col("id") / n) + 1).alias("src"), (F.col("id") % n + 1).alias("dst")
    ).where("src <> dst")


def edges_from_coo(df: DataFrame, i: str, j: str) -> DataFrame:
    """Edges of sparse-matrix triples; values are ignored."""
    return df.select(F.col(i).alias("src"), F.col(j).alias("dst")).distinct()


def link_dims(movies: DataFrame, dim: DataFrame) -> DataFrame:
    """Dimension rows of known movies only."""
    return dim.join(movies.select("movie").distinct(), "movie", "left_semi")


def last_ratings(lines: DataFrame, rows: int | None = None) -> DataFrame:
    """(user, movie, rating): rounded half away from zero, the last line of a pair wins.

    ``rows``, the number of lines: they are then grouped in parts that grow in number, not in size.
    """
    if rows is not None:
        lines = lines.repartition(ranges_for(lines, rows), "user", "movie")
    return lines.groupBy("user", "movie").agg(round_rating(F.max_by("rating", "line_no")).alias("rating"))


def typed(kind: str, c: Column | str) -> Column:
    return F.concat(F.lit(kind + ":"), F.col(c) if isinstance(c, str) else c)


def records_to_graph(ratings: DataFrame, movies: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Users, movies, five rating nodes per movie and dimension entities.

    Returns ``nodes(key, type)`` and ``edges(src, dst)`` in both directions. Entities of unknown
    movies become nodes without edges. Dimension keys carry their type so that a name in two roles
    stays two nodes.
    """
    user, movie = F.concat(F.lit("u"), "user"), F.concat(F.lit("m"), "movie")
    known = union_all(movies.select("movie"), ratings.select("movie")).distinct()
    stars = known.select("movie", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("r"))
    star = F.concat(movie, F.lit("_"), F.col("r").cast("string"))
    links = [
        ratings.select(user.alias("src"), F.concat(movie, F.lit("_"), F.col("rating").cast("string")).alias("dst")),
        stars.select(star.alias("src"), movie.alias("dst")),
    ]
    node_sets = [
        ratings.select(user.alias("key"), F.lit("user").alias("type")).distinct(),
        known.select(movie.alias("key"), F.lit("movie").alias("type")),
        stars.select(star.alias("key"), F.lit("rating").alias("type")),
    ]
    for kind, dim in dims.items():
        linked = link_dims(movies, dim)
        links.append(linked.select(movie.alias("src"), typed(kind, "name").alias("dst")))
        node_sets.append(dim.select(typed(kind, "name").alias("key"), F.lit(kind).alias("type")).distinct())
    return union_all(*node_sets), undirected(union_all(*links))


def components(edges: DataFrame) -> DataFrame:
    """(id, comp), comp = smallest id of the component.

    Alternates two star steps: every vertex hands its larger neighbours, then its smaller ones, to the
    smallest vertex it knows. The edge table shrinks to one star per component in a logarithmic
    number of rounds; each round is two aggregations and two joins. Texts are numbered in their order
    first, so that rounds move and compare numbers.
    """
    edges = cut(edges.select("src", "dst"))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    e, numbers = edges.where("src <> dst"), None
    if edges.schema["src"].dataType == edges.schema["dst"].dataType == StringType():
        numbers = cut(dense_index(vertices.where("id IS NOT NULL"), "id", "n"))
        a, b = numbers.toDF("src", "a"), numbers.toDF("dst", "b")
        e = e.join(a, "src").join(b, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    e = cut(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    last = None
    while True:
        both = e.unionByName(swapped(e))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.where("src <> dst").distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        e = cut(small.unionByName(low.select("src", F.col("low").alias("dst"))).distinct())
        sig = e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if sig == last:
            break
        last = sig
    root = e.select(F.col("src").alias("id"), F.col("dst").alias("comp"))
    if numbers is not None:
        root = root.join(numbers.toDF("_id", "id"), "id").join(numbers.toDF("_comp", "comp"), "comp").select(F.col("_id").alias("id"), F.col("_comp").alias("comp"))
    return vertices.join(root, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def pagerank(
    edges: DataFrame, by: str = "snap", iters: int = 20, damping: float = 0.85, cut_every: int = 10, tol: float | None = None,
) -> DataFrame:
    """(by, id, rank) of every undirected multigraph ``by`` at once; ranks of a graph sum to 1.

    The edges of a hub are joined with its rank like any skewed key, so adaptive execution may split them. With ``tol``
    rounds go on past ``iters``, ``cut_every`` at a time, until no rank moved by more in the last of them.
    """
    both = edges.select(by, "src", "dst").unionByName(swapped(edges.select(by, "src", "dst")))
    parallel = both.groupBy(by, "src", "dst").agg(F.count("*").alias("w"))
    deg = both.groupBy(by, "src").agg(F.count("*").alias("deg"))
    size = deg.groupBy(by).agg(F.count("*").alias("n"))
    flow = cut(parallel.join(deg, [by, "src"]).select(by, "src", "dst", (F.col("w") / F.col("deg")).alias("p")))
    base = cut(deg.join(size, by).select(by, F.col("src").alias("id"), "n"))
    rank = base.select(by, "id", (F.lit(1.0) / F.col("n")).alias("rank"))
    n = base.groupBy(by).agg(F.max("n").alias("n"))

    def step(rank: DataFrame) -> DataFrame:
        inflow = (
            flow.join(rank.withColumnRenamed("id", "src"), [by, "src"])
            .groupBy(by, "dst").agg(F.sum(F.col("rank") * F.col("p")).alias("got"))
        )
        # every vertex has an edge, so each gets an inflow
        return inflow.join(n, by).select(
            by, F.col("dst").alias("id"), ((1 - damping) / F.col("n") + damping * F.col("got")).alias("rank")
        )

    i = 0
    while True:
        i += 1
        rank = step(rank)
        if i % cut_every == 0 or i == iters:
            rank = cut(rank)
        if i >= iters and (tol is None or i % cut_every == 0):
            if tol is None:
                break
            moved = step(rank).withColumnRenamed("rank", "_next").join(rank, [by, "id"]).agg(F.max(F.abs(F.col("_next") - F.col("rank")))).first()[0]
            if moved is None or moved <= tol:
                break
    return rank
