"""Vector autoregression, stationarity and normality checks, causal graphs."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import map_stream
from ..session import cut
from .ordering import running
from .regression import Fit, least_squares
from .series import lagged

ADF_5_PERCENT = -1.95  # critical value without constant


class VarModel:
    def __init__(self, cols: list[str], design: DataFrame, fits: dict[str, Fit]):
        self.cols, self.design, self.fits = cols, design, fits

    def coefficients(self) -> DataFrame:
        """(equation, term, coef, se, t)."""
        spark = self.design.sparkSession
        out = None
        for c in self.cols:
            part = self.fits[c].table(spark, c)
            out = part if out is None else out.unionByName(part)
        return out

    def residuals(self, t: str = "t") -> DataFrame:
        return self.design.select(t, *[(F.col(c) - self.fits[c].column()).alias(c) for c in self.cols])


def var_fit(series: DataFrame, cols: list[str], p: int = 1, trend: bool = False, t: str = "t") -> VarModel:
    """VAR(p) with constant and optional linear trend, equation by equation."""
    design = lagged(series, cols, p, t)
    xs = [f"{c}_l{k}" for k in range(1, p + 1) for c in cols]
    if trend:
        design = design.withColumn("trend", F.col(t).cast("double"))
        xs.append("trend")
    return VarModel(cols, design, least_squares(design, cols, xs))


def adf(series: DataFrame, cols: list[str], t: str = "t") -> DataFrame:
    """Augmented Dickey-Fuller statistic per column: no constant, one lagged difference."""
    spark, rows = series.sparkSession, []
    for c in cols:
        d = lagged(series.select(t, c), [c], 2, t).select(
            (F.col(c) - F.col(f"{c}_l1")).alias("dy"), F.col(f"{c}_l1").alias("level"),
            (F.col(f"{c}_l1") - F.col(f"{c}_l2")).alias("dy_l1"),
        )
        fit = least_squares(d, ["dy"], ["level", "dy_l1"], const=False)["dy"]
        tau = fit.coef[0] / fit.se[0]
        rows.append((c, fit.n, float(tau), ADF_5_PERCENT, bool(tau < ADF_5_PERCENT)))
    return spark.createDataFrame(rows, "name string, n long, tau double, critical double, stationary boolean")


def ks_p_value(d, n, m):
    """Asymptotic p-value of the two-sample statistic as a column."""
    lam2 = d * d * n * m / (n + m)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * lam2 * k.cast("double") * k.cast("double")),
    )
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def ks_two_sample(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """Two-sample Kolmogorov-Smirnov: largest gap between the two distribution functions."""
    one = lambda df, x, y: df.select(F.col(value).cast("double").alias("v"), F.lit(x).alias("a"), F.lit(y).alias("b"))
    hist = one(a, 1, 0).unionByName(one(b, 0, 1)).groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n, m = hist.agg(F.sum("a")).scalar(), hist.agg(F.sum("b")).scalar()
    cum = running(hist, [], [F.col("v").asc()], {"ca": F.col("a"), "cb": F.col("b")})
    out = cut(cum.agg(F.max(F.abs(F.col("ca") / n - F.col("cb") / m)).alias("d")).withColumn("n", n).withColumn("m", m))  # one row
    return out.withColumn("p_value", ks_p_value(F.col("d"), F.col("n"), F.col("m")))


def ks_norm(df: DataFrame, value: str, standardize: bool = False) -> DataFrame:
    """One-sample test against N(0,1); ``standardize`` scales the values first."""
    x = df.select(F.col(value).cast("double").alias(value))
    if standardize:
        m, s = x.agg(F.avg(value), F.stddev(value)).first()
        x = x.select(((F.col(value) - m) / s).alias(value))
    r = KolmogorovSmirnovTest.test(x, value, "norm", 0.0, 1.0)
    return r.select(F.col("statistic").alias("d"), F.col("pValue").alias("p_value"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlations (a, b, r) of all column pairs a < b, from one aggregation."""
    pairs = list(itertools.combinations(sorted(cols), 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def normal_cut(alpha: float) -> float:
    """Two-sided normal quantile by bisection."""
    lo, hi = 0.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if math.erfc(mid / math.sqrt(2)) > alpha else (lo, mid)
    return (lo + hi) / 2


def partial_correlations(tests: DataFrame, corr: DataFrame, n: int, alpha: float) -> DataFrame:
    """(a, b, cond, r, z, independent) of ``tests(a, b, cond)``: Fisher's z of the partial correlation of a and b given ``cond``.

    The correlation table has a row for each pair of columns, whatever the rows, so it goes to all tasks; the tests stay rows.
    """
    rows = corr.collect()
    names = sorted({r["a"] for r in rows} | {r["b"] for r in rows})
    at, m = {c: i for i, c in enumerate(names)}, np.eye(len(names))
    for r in rows:
        m[at[r["a"]], at[r["b"]]] = m[at[r["b"]], at[r["a"]]] = r["r"]
    crit = normal_cut(alpha)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            picks = [[at[x], at[y], *(at[c] for c in cond)] for x, y, cond in zip(*(b.column(c).to_pylist() for c in ("a", "b", "cond")), strict=True)]
            size, r = np.array([len(p) - 2 for p in picks]), np.empty(len(picks))
            for k in np.unique(size):
                rows_ = np.flatnonzero(size == k)
                ix = np.array([picks[i] for i in rows_])
                prec = np.linalg.inv(m[ix[:, :, None], ix[:, None, :]])
                r[rows_] = -prec[:, 0, 1] / np.sqrt(prec[:, 0, 0] * prec[:, 1, 1])
            z = np.sqrt(np.maximum(n - size - 3, 0)) * np.abs(np.arctanh(np.clip(r, -1 + 1e-15, 1 - 1e-15)))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("cond"), pa.array(r), pa.array(z), pa.array(z < crit)], ["a", "b", "cond", "r", "z", "independent"])

    return map_stream(tests.select("a", "b", "cond"), score, "a string, b string, cond array<string>, r double, z double, independent boolean")


def _longer(sets: DataFrame, nbrs: DataFrame) -> DataFrame:
    """``sets(a, cond)`` with each later neighbour of a added: all sets of one more column, each once."""
    return sets.join(nbrs, "a").where((F.size("cond") == 0) | (F.col("b") > F.get("cond", F.size("cond") - 1))).select("a", F.concat("cond", F.array("b")).alias("cond"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def ci_tests(corr: DataFrame, n: int, alpha: float = 0.05, max_cond: int | None = None) -> DataFrame:
    """Gaussian conditional-independence tests (a, b, cond, r, z, independent) for all pairs and all sets of up to ``max_cond`` other columns."""
    pairs = corr.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    nbrs = _both_ways(pairs)
    columns = nbrs.agg(F.count_distinct("a")).first()[0]
    sets = nbrs.select("a").distinct().withColumn("cond", F.array().cast("array<string>"))
    tests = pairs.withColumn("cond", F.array().cast("array<string>"))
    for _ in range(min(columns - 2, columns if max_cond is None else max_cond)):
        sets = _longer(sets, nbrs)
        tests = tests.unionByName(pairs.join(sets, "a").where(~F.array_contains("cond", F.col("b"))))
    return partial_correlations(tests, corr, n, alpha)


def pc_tests(corr: DataFrame, n: int, alpha: float = 0.05, max_cond: int | None = None) -> DataFrame:
    """The tests that the skeleton search needs, level by level: (a, b, cond, r, z, independent).

    At level k a pair that is still joined is tested given each set of k columns that are all neighbours of a or all neighbours of b, as the
    level finds them; pairs with an independent test are parted before the next one. Sets grow by a join of the former level's sets
    with the neighbours that are left, so nothing is enumerated on the driver.
    """
    edges = cut(corr.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nbrs = _both_ways(edges)
    sets = nbrs.select("a").distinct().withColumn("cond", F.array().cast("array<string>"))
    out, level = None, 0
    while True:
        open_ = _both_ways(edges).join(sets, "a").where(~F.array_contains("cond", F.col("b")))
        tests = open_.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cond").distinct()
        found = cut(partial_correlations(tests, corr, n, alpha))
        if not found.take(1):
            return found if out is None else out
        out = found if out is None else out.unionByName(found)
        if level == max_cond:
            return out
        edges = cut(edges.join(found.where("independent").select("a", "b").distinct(), ["a", "b"], "left_anti"))
        nbrs, level = _both_ways(edges), level + 1
        # sets of the former level whose columns are all neighbours still, and one neighbour more
        left = sets.join(nbrs.groupBy("a").agg(F.collect_set("b").alias("_all")), "a").where(F.size(F.array_except("cond", "_all")) == 0).drop("_all")
        sets = cut(_longer(left, nbrs))


def pc_graph(ci: DataFrame) -> DataFrame:
    """Skeleton and v-structures from the test table: (a, b, kind), kind ``a->b`` or ``undirected``.

    Levels are deleted by anti-joins, with the neighbours taken at the start of each level. All
    tables here are bounded by the number of columns.
    """
    spark = ci.sparkSession
    edges = ci.select("a", "b").distinct()
    sepsets = None
    depth = ci.agg(F.max(F.size("cond"))).first()[0]
    for level in range(depth + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nbrs = both.groupBy("a").agg(F.collect_set("b").alias("nb"))
        na = nbrs.withColumnRenamed("nb", "na")
        nb = nbrs.select(F.col("a").alias("b"), F.col("nb"))
        hit = (
            ci.where((F.size("cond") == level) & F.col("independent"))
            .join(edges, ["a", "b"], "left_semi").join(na, "a").join(nb, "b")
            .where((F.size(F.array_except("cond", "na")) == 0) | (F.size(F.array_except("cond", "nb")) == 0))
            .groupBy("a", "b").agg(F.min("cond").alias("sepset"))
        )
        rows = hit.select("a", "b", "sepset").collect()
        found = spark.createDataFrame(rows, "a string, b string, sepset array<string>")
        sepsets = found if sepsets is None else sepsets.unionByName(found)
        edges = edges.join(found, ["a", "b"], "left_anti")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = both.select(F.col("a").alias("x"), F.col("b").alias("k"))
    right = both.select(F.col("a").alias("y"), F.col("b").alias("k"))
    colliders = (
        left.join(right, "k").where("x < y")
        .join(sepsets.select(F.col("a").alias("x"), F.col("b").alias("y"), "sepset"), ["x", "y"])
        .where(~F.array_contains("sepset", F.col("k")))
    )
    arrows = colliders.select(F.explode(F.array("x", "y")).alias("from"), F.col("k").alias("to")).distinct()
    fwd = arrows.select(F.col("from").alias("a"), F.col("to").alias("b"), F.lit(True).alias("fwd"))
    bwd = arrows.select(F.col("to").alias("a"), F.col("from").alias("b"), F.lit(True).alias("bwd"))
    kind = (
        F.when(F.col("fwd") & F.col("bwd"), "a<->b").when(F.col("fwd"), "a->b").when(F.col("bwd"), "b->a").otherwise("undirected")
    )
    return edges.join(fwd, ["a", "b"], "left").join(bwd, ["a", "b"], "left").select("a", "b", kind.alias("kind"))


def lingam(df: DataFrame, cols: list[str]) -> tuple[list[str], DataFrame]:
    """Causal order and direct effects of a linear non-Gaussian model.

    Each round one aggregation measures, for every ordered pair, how independent the regression
    residual is of the regressor (entropy approximation by two moments); the most exogenous column
    is taken next and the others are replaced by their residuals on it.
    """
    k1, k2, gamma = 79.047, 7.4129, 0.37457
    h_gauss = (1 + math.log(2 * math.pi)) / 2

    def entropy(a: float, b: float) -> float:
        return h_gauss - k1 * (a - gamma) ** 2 - k2 * b**2

    def moments(c):
        return F.avg(F.abs(c) + F.log1p(F.exp(-2 * F.abs(c))) - math.log(2.0)), F.avg(c * F.exp(-c * c / 2))

    data, left, order = df.select(*[F.col(c).cast("double") for c in cols]), list(cols), []
    while len(left) > 1:
        st = data.agg(*[F.avg(c).alias(f"m_{c}") for c in left], *[F.stddev_pop(c).alias(f"s_{c}") for c in left]).first()
        z = {c: (F.col(c) - st[f"m_{c}"]) / st[f"s_{c}"] for c in left}
        pairs = list(itertools.combinations(left, 2))
        rho = dict(zip(pairs, data.agg(*[F.avg(z[a] * z[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first()))
        aggs, names = [], []
        for c in left:
            aggs += moments(z[c])
            names.append((c, None))
        for a, b in pairs:
            for x, y in ((a, b), (b, a)):
                aggs += moments((z[x] - z[y] * rho[a, b]) / math.sqrt(max(1e-12, 1 - rho[a, b] ** 2)))
                names.append((x, y))
        v = data.agg(*[c.alias(f"v{i}") for i, c in enumerate(aggs)]).first()
        h = {nm: entropy(v[2 * i], v[2 * i + 1]) for i, nm in enumerate(names)}
        cost = dict.fromkeys(left, 0.0)
        for a, b in pairs:
            diff = (h[b, None] + h[a, b]) - (h[a, None] + h[b, a])
            cost[a] += min(0.0, diff) ** 2
            cost[b] += min(0.0, -diff) ** 2
        root = min(left, key=lambda c: (cost[c], c))
        order.append(root)
        left.remove(root)
        beta = {c: rho[tuple(p for p in pairs if set(p) == {c, root})[0]] * st[f"s_{c}"] / st[f"s_{root}"] for c in left}
        data = data.select(*[(F.col(c) - F.col(root) * beta[c]).alias(c) for c in left])
    order += left
    rows = []
    for i, c in enumerate(order[1:], 1):
        fit = least_squares(df, [c], order[:i])[c]
        rows += [(src, c, float(b), i) for src, b in zip(fit.terms, fit.coef) if src != "const"]
    return order, df.sparkSession.createDataFrame(rows, "cause string, effect string, weight double, effect_place int")
