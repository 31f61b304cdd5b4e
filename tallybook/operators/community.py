"""Attributed communities: modularity and similarity gains, local moves, contraction, influence spread.

Vertices carry ``(id, size, vec)``: the number of original vertices and the sum of their unit attribute
vectors. Mean pairwise cosine similarity of a group follows from those two alone, so groups are never
expanded into pairs.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw, unit
from ..functions.vectors import dot, norm2, unit_vector
from ..session import cut
from .facts import expand
from .graph import swapped
from .metrics import churn
from .ordering import dense_index


def vertices(attrs: DataFrame) -> DataFrame:
    """Start vertices from ``attrs(id, attrs)``."""
    return attrs.select("id", F.lit(1).cast("bigint").alias("size"), unit_vector("attrs").alias("vec"))


def mean_similarity(vec: Column, size: Column) -> Column:
    """Mean pairwise cosine of a group from the sum of its unit vectors; 0 for a single member."""
    return F.when(size > 1, (norm2(vec) - size) / (size * (size - 1))).otherwise(0.0)


def _vec_sum(dims: int) -> Column:
    return F.expr("array(" + ", ".join(f"sum(vec[{i}])" for i in range(dims)) + ")")


def _dims(verts: DataFrame) -> int:
    row = verts.select(F.size("vec")).first()
    return row[0] if row else 0


def modularity(edges: DataFrame, comm: DataFrame) -> DataFrame:
    """Weighted modularity; ``edges(src, dst, weight)`` holds each undirected edge once."""
    m = edges.agg(F.sum("weight")).scalar()
    a = comm.select(F.col("id").alias("src"), F.col("comm").alias("ca"))
    b = comm.select(F.col("id").alias("dst"), F.col("comm").alias("cb"))
    ends = edges.join(a, "src").join(b, "dst").select(
        F.explode(F.array(
            F.struct(F.col("ca").alias("comm"), F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0.0).alias("inside"), F.col("weight").alias("deg")),
            F.struct(F.col("cb").alias("comm"), F.lit(0.0).alias("inside"), F.col("weight").alias("deg")),
        )).alias("e")
    ).select("e.*")
    per = ends.groupBy("comm").agg(F.sum("inside").alias("inside"), F.sum("deg").alias("deg"))
    return per.agg(F.sum(F.col("inside") / m - F.pow(F.col("deg") / (2 * m), 2)).alias("modularity"))


def community_similarity(verts: DataFrame, comm: DataFrame) -> DataFrame:
    """(comm, size, similarity)."""
    g = verts.join(comm, "id").groupBy("comm").agg(F.sum("size").alias("size"), _vec_sum(_dims(verts)).alias("vec"))
    return g.select("comm", "size", mean_similarity(F.col("vec"), F.col("size")).alias("similarity"))


def degrees(edges: DataFrame) -> DataFrame:
    """Weighted degree per vertex; a loop counts twice."""
    ends = edges.select("src", "dst", "weight").unionByName(swapped(edges.select("src", "dst", "weight")))
    return ends.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("k"))


class Level:
    """What stays fixed while communities change: both edge directions, vertices with degree, total weight.

    ``ids(id)``: the vertices whose ties are asked for; edges that leave from others are not kept. Degrees and the total weight are those of all edges.
    """

    def __init__(self, edges: DataFrame, verts: DataFrame, ids: DataFrame | None = None):
        self.dims = _dims(verts)
        self.m = edges.agg(F.sum("weight")).first()[0] or 0.0
        e = edges.where("src <> dst").select("src", "dst", "weight")
        both = e.unionByName(swapped(e)).withColumnRenamed("src", "id")
        self.both = cut(both if ids is None else both.join(ids.select("id").distinct(), "id", "left_semi"))
        loops = edges.where("src = dst").groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("loop"))
        self.verts = cut(
            verts.join(degrees(edges), "id", "left").join(loops, "id", "left").fillna(0.0, ["k", "loop"])
            .select("id", "k", "loop", "size", "vec")
        )

    def ties(self, comm: DataFrame) -> DataFrame:
        """(id, comm, w): weight between a vertex and each community next to it."""
        return self.both.join(comm.select(F.col("id").alias("dst"), "comm"), "dst").groupBy("id", "comm").agg(F.sum("weight").alias("w"))

    def stats(self, comm: DataFrame, ties: DataFrame | None) -> DataFrame:
        """One row per community: degree, inner weight, size, members, attribute sum. Without ``ties`` the inner weight is that of loops."""
        own = self.verts.join(comm, "id").groupBy("comm").agg(
            F.sum("k").alias("deg"), F.sum("loop").alias("loops"), F.sum("size").alias("csize"), F.count("*").alias("members"),
            _vec_sum(self.dims).alias("cvec"),
        )
        if ties is None:
            return own.select("comm", "deg", "csize", "members", "cvec", F.col("loops").alias("inside"))
        inner = ties.join(comm, ["id", "comm"]).groupBy("comm").agg((F.sum("w") / 2).alias("inner"))
        return own.join(inner, "comm", "left").select(
            "comm", "deg", "csize", "members", "cvec", (F.coalesce("inner", F.lit(0.0)) + F.col("loops")).alias("inside")
        )

    def objective(self, stats: DataFrame, alpha: float) -> tuple[float, int]:
        """alpha * modularity + (1 - alpha) * mean similarity / C, and C."""
        q, s, n = stats.agg(
            F.sum(F.col("inside") / self.m - F.pow(F.col("deg") / (2 * self.m), 2)),
            F.avg(mean_similarity(F.col("cvec"), F.col("csize"))), F.count("*"),
        ).first()
        return alpha * q + (1 - alpha) * s / n, n

    def gains(self, comm: DataFrame, ties: DataFrame, stats: DataFrame, n: int, alpha: float) -> DataFrame:
        """(id, cur, comm, dq, ds, gain) per vertex and neighbouring community."""
        m = self.m
        # what needs no pair is computed once per vertex and community
        me = self.verts.withColumn("norm", norm2("vec")).join(comm.withColumnRenamed("comm", "cur"), "id")
        there = stats.select("comm", "deg", "csize", "cvec", norm2("cvec").alias("cnorm"), mean_similarity(F.col("cvec"), F.col("csize")).alias("csim"))
        home = stats.select(F.col("comm").alias("cur"), F.col("deg").alias("deg_cur"), F.col("members").alias("members_cur"))
        own = ties.join(comm, ["id", "comm"]).select("id", F.col("w").alias("w_cur"))
        c = (
            ties.join(me.join(home, "cur").join(own, "id", "left").fillna(0.0, ["w_cur"]), "id")
            .where("comm <> cur").join(there, "comm")
        )
        dq = (F.col("w") - F.col("w_cur")) / m - F.col("k") * (F.col("deg") - F.col("deg_cur") + F.col("k")) / (2 * m * m)
        size = F.col("csize") + F.col("size")
        merged = F.col("cnorm") + 2 * dot("cvec", "vec") + F.col("norm")
        ds = F.when(size > 1, (merged - size) / (size * (size - 1))).otherwise(0.0) - F.col("csim")
        after = F.lit(n) - F.when(F.col("members_cur") == 1, 1).otherwise(0)
        out = c.select("id", "cur", "comm", dq.alias("dq"), ds.alias("ds"), after.alias("after"))
        like = (1 - alpha) * F.col("ds") / F.pow("after", 2)
        gain = F.col("dq") if alpha == 1 else like if alpha == 0 else alpha * F.col("dq") + like
        return out.withColumn("gain", gain).drop("after")


def move_gain(edges: DataFrame, verts: DataFrame, comm: DataFrame, alpha: float) -> DataFrame:
    """(id, cur, comm, dq, ds, gain) of moving a vertex to each neighbouring community.

    gain = alpha * change of modularity + (1 - alpha) * change of the target's similarity / C^2, where C is
    the number of communities after the move. Both changes are closed forms of community sums.
    """
    level = Level(cut(edges), verts, verts)
    stats = cut(level.stats(comm, None))  # inner weights play no part in a gain
    return level.gains(comm, cut(level.ties(comm)), stats, stats.count(), alpha)


def best_moves(gains: DataFrame, down: bool | None = None) -> DataFrame:
    """The best positive gain per vertex, ties to the lowest community.

    ``down`` lets vertices move only to lower (or only to higher) community ids, so that two vertices cannot swap places.
    """
    g = gains.where("gain > 0")
    if down is not None:
        g = g.where("comm < cur" if down else "comm > cur")
    best = F.max(F.struct("gain", (-F.col("comm")).alias("neg"))).alias("b")
    return g.groupBy("id").agg(best).select("id", (-F.col("b.neg")).alias("comm"), F.col("b.gain").alias("gain"))


def apply_moves(comm: DataFrame, moves: DataFrame) -> DataFrame:
    return comm.join(moves.select("id", F.col("comm").alias("_new")), "id", "left").select(
        "id", F.coalesce("_new", "comm").alias("comm")
    )


def harmless(level: Level, moves: DataFrame, alpha: float) -> DataFrame:
    """The ``moves(id, cur, comm, gain)`` whose gain outweighs what they may cost each other when all are made at once.

    Gains are those of a single move. Two movers that join or leave the same community count its degree too low or too high, by k_i k_j / 2m^2; a tie
    between two movers is lost if one joins what the other leaves. Half of the first cost is put on either mover and all of the second on the one
    of the smaller gain, so of two vertices that would swap places the better one moves. Each cost is borne by a mover whose gain outweighs all
    it bears, so the modularity of the moves that are left rises by more than nothing, whichever they are. Without modularity nothing is borne.
    """
    m = level.m
    k = moves.join(level.verts.select("id", "k"), "id")
    if alpha == 0:
        return k.where("gain > 0 AND cur IS NOT NULL").select("id", "comm", "gain")
    into = k.groupBy("comm").agg(F.sum("k").alias("k_in"))
    out = k.groupBy("cur").agg(F.sum("k").alias("k_out"))
    a = moves.select("id", F.col("cur").alias("cur_a"), F.col("comm").alias("to_a"), F.struct("gain", "id").alias("rank_a"))
    b = moves.select(F.col("id").alias("dst"), F.col("cur").alias("cur_b"), F.col("comm").alias("to_b"), F.struct("gain", "id").alias("rank_b"))
    crossed = (F.col("to_a") == F.col("cur_b")).cast("int") + (F.col("cur_a") == F.col("to_b")).cast("int")
    ties = level.both.join(a, "id").join(b, "dst").where("rank_a < rank_b").groupBy("id").agg(F.sum(F.col("weight") * crossed).alias("lost"))
    cost = F.coalesce("lost", F.lit(0.0)) / m + F.col("k") * (F.col("k_in") + F.col("k_out") - 2 * F.col("k")) / (4 * m * m)
    return k.join(into, "comm").join(out, "cur").join(ties, "id", "left").where(F.col("gain") > alpha * cost).select("id", "comm", "gain")


def local_move(edges: DataFrame, verts: DataFrame, comm: DataFrame, alpha: float, passes: int = 15, trace: list[float] | None = None) -> DataFrame:
    """Rounds of simultaneous moves that never lower the objective, until no move gains or helps.

    A round takes each vertex's best move, of those the ones that are harmless together. Similarities have no such bound, so a round whose
    objective falls is taken back and tried with an eighth of the vertices (by hash draws), at last with the best move alone.
    ``passes`` bounds the rounds. ``trace`` receives the objective at the start and after each round. Under similarity alone the
    objective is that of the vertices, so ties are only made for communities that a round starts from.
    """
    level = Level(edges, verts, comm)

    def measured(comm: DataFrame) -> tuple:
        ties = cut(level.ties(comm)) if alpha else None
        stats = cut(level.stats(comm, ties))
        return comm, ties, stats, *level.objective(stats, alpha)

    comm, ties, stats, score, n = measured(comm)
    trace = trace if trace is not None else []
    trace.append(score)
    for r in range(passes):
        best = best_moves(level.gains(comm, cut(level.ties(comm)) if ties is None else ties, stats, n, alpha))
        best = cut(best.join(comm.withColumnRenamed("comm", "cur"), "id").select("id", "cur", "comm", "gain"))
        movers = best.count()
        if not movers:
            break
        after, t, last = None, 0, -(-movers.bit_length() // 3)
        while after is None and t <= last:
            few = best.where(unit("id", r, t) < 8.0**-t) if t < last else cut(best.orderBy(F.desc("gain"), "id").limit(1))
            good = cut(harmless(level, few, alpha))
            t += 1
            if good.take(1):
                tried = measured(cut(apply_moves(comm, good)))
                if tried[3] >= score - 1e-12:
                    after = tried
        if after is None:
            break
        comm, ties, stats, score, n = after
        trace.append(score)
    return comm


def relabel(comm: DataFrame) -> DataFrame:
    """Communities renumbered 0..n-1 in order."""
    return comm.join(dense_index(comm, "comm", "_i"), "comm").select("id", F.col("_i").alias("comm"))


def contract(edges: DataFrame, verts: DataFrame, comm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Communities become vertices: parallel edges are summed, loops are kept, attributes are pooled."""
    a = comm.select(F.col("id").alias("src"), F.col("comm").alias("ca"))
    b = comm.select(F.col("id").alias("dst"), F.col("comm").alias("cb"))
    e = edges.join(a, "src").join(b, "dst").groupBy(
        F.least("ca", "cb").alias("src"), F.greatest("ca", "cb").alias("dst")
    ).agg(F.sum("weight").alias("weight"))
    v = verts.join(comm, "id").groupBy(F.col("comm").alias("id")).agg(
        F.sum("size").alias("size"), _vec_sum(_dims(verts)).alias("vec")
    )
    return e, v


def sac(edges: DataFrame, verts: DataFrame, alpha: float, levels: int = 15, passes: int = 15) -> DataFrame:
    """Local moves and contraction until nothing moves; (id, comm) over the original vertices."""
    e, v = cut(edges), cut(verts)
    member = cut(verts.select("id", F.col("id").alias("comm")))
    for _ in range(levels):
        start = v.select("id", F.col("id").alias("comm"))
        moved = local_move(e, v, start, alpha, passes)
        if not churn(start, moved).first()[0]:
            break
        step = cut(relabel(moved))
        member = cut(
            member.join(step.select(F.col("id").alias("comm"), F.col("comm").alias("_c")), "comm").select("id", F.col("_c").alias("comm"))
        )
        e, v = (cut(x) for x in contract(e, v, step))
    return member


def seeds_per_community(comm: DataFrame, seed: int = 0, trials: int = 1) -> DataFrame:
    """(trial, comm, id): one vertex per community and trial, the one with the lowest hash draw."""
    many = expand(comm, F.lit(trials), "trial").withColumn("trial", F.col("trial") - 1)
    pick = F.min(F.struct(draw("trial", "id", seed), F.col("id").alias("id"))).alias("p")
    return many.groupBy("trial", "comm").agg(pick).select("trial", "comm", "p.id")


def cascade(
    edges: DataFrame, comm: DataFrame, seeds: DataFrame, alpha: float = 0.7, beta: float = 0.75, steps: int = 15,
    seed: int = 0, retry: bool = True,
) -> DataFrame:
    """(trial, step, covered, ratio) of a seeded spread, all trials side by side.

    Per step each reached vertex turns inside its community with chance ``alpha``, else outside, and
    reaches each such neighbour with chance ``beta``. Every reached vertex tries again each step;
    ``retry=False`` lets only the newly reached ones try. Coins are hash draws.
    """
    both = edges.select("src", "dst").unionByName(swapped(edges.select("src", "dst"))).where("src <> dst").distinct()
    a = comm.select(F.col("id").alias("src"), F.col("comm").alias("ca"))
    b = comm.select(F.col("id").alias("dst"), F.col("comm").alias("cb"))
    ways = cut(both.join(a, "src").join(b, "dst").select("src", "dst", (F.col("ca") == F.col("cb")).alias("same")))
    n, trials = comm.count(), seeds.select("trial").distinct().count()
    ends = cut(ways.select(F.col("dst").alias("id")).distinct())
    reached = cut(seeds.select("trial", "id", F.lit(1).alias("step")))
    for k in range(2, steps + 2):
        # no coins are thrown for vertices that every trial has reached
        everywhere = reached.groupBy("id").agg(F.countDistinct("trial").alias("_t")).where(F.col("_t") == trials)
        free = cut(ends.join(everywhere, "id", "left_anti").withColumnRenamed("id", "dst"))
        if not free.take(1):
            break
        active = reached if retry else reached.where(F.col("step") == k - 1)
        turn = active.select(
            "trial", F.col("id").alias("src"), (unit("trial", F.lit(k), "id", seed, F.lit("side")) < alpha).alias("same")
        )
        hit = (
            ways.join(free, "dst", "left_semi").join(turn, ["src", "same"])
            .where(unit("trial", F.lit(k), "src", "dst", seed) < beta)
            .select("trial", F.col("dst").alias("id")).distinct()
            .join(reached.select("trial", "id"), ["trial", "id"], "left_anti")
        )
        reached = cut(reached.unionByName(hit.select("trial", "id", F.lit(k).alias("step"))))
    per = reached.groupBy("trial", "step").agg(F.count("*").alias("n"))
    # every reached step counts for itself and all later ones; steps and trials are few
    later = per.select("trial", "n", F.explode(F.sequence(F.col("step"), F.lit(steps + 1))).alias("step"))
    return later.groupBy("trial", "step").agg(F.sum("n").alias("covered")).withColumn("ratio", F.col("covered") / n)


def attr_clusters(attrs: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(id, comm) by k-means on cosine distance."""
    x = attrs.select("id", array_to_vector(F.transform("attrs", lambda v: v.cast("double"))).alias("features"))
    m = KMeans(k=k, seed=seed, distanceMeasure="cosine", featuresCol="features", predictionCol="comm").fit(x)
    return m.transform(x).select("id", F.col("comm").cast("bigint").alias("comm"))


def compare_spread(a: DataFrame, b: DataFrame) -> DataFrame:
    """Coverage of two spreads next to each other, mean over trials per step."""
    mean = lambda df, name: df.groupBy("step").agg(F.avg("covered").alias(name))
    return mean(a, "covered_a").join(mean(b, "covered_b"), "step", "full")


