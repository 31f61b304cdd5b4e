"""Queries over the hourly event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import causality as C
from ..operators import metrics as M
from ..operators import regression as G
from ..operators import series as S
from ..session import cut
from . import views as V
from .registry import query
from .views import HOURLY

H = f"WITH {HOURLY}"
HORIZONS = {"d6": 6, "d12": 12, "d24": 24}
#: The series is cut at a third and two thirds of its span.
LOW, HIGH = "(SELECT (max(t) + 1) // 3 FROM hourly)", "(SELECT 2 * (max(t) + 1) // 3 FROM hourly)"


def cuts(t) -> tuple[int, int, int]:
    """A third, two thirds and the end of the hourly series."""
    end = (V.hourly(t).agg(F.max("t")).first()[0] or 0) + 1
    return end // 3, 2 * end // 3, end


def sql_windows(name: str, size: int) -> str:
    return f"""{name}_w AS (SELECT t, array_agg(total) OVER (ORDER BY t ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) AS x,
  lead(total) OVER (ORDER BY t) - total AS y FROM hourly),
{name}_d AS (SELECT t, y, list_transform(x, lambda v: v - list_avg(x)) AS dev FROM {name}_w WHERE len(x) = {size} AND y IS NOT NULL),
{name} AS (SELECT t, y, list_transform(dev, lambda v: v / sqrt(list_dot_product(dev, dev))) AS z FROM {name}_d)"""


def sql_kernel(out: str, win: str, where: str) -> str:
    return f"""{out} AS (SELECT q.t, sum(r.y * exp(2 * list_dot_product(q.z, r.z))) / sum(exp(2 * list_dot_product(q.z, r.z))) AS yhat
  FROM {win} q, {win} r WHERE {where} AND r.t < {LOW} GROUP BY 1)"""


def horizon_predictions(t, low: int, high: int):
    """Kernel estimates of all horizons for rows low <= t < high, trained on the first third, with the target."""
    first = F.col("t") < cuts(t)[0]
    series = V.hourly(t)
    preds, target = {}, None
    for name, size in HORIZONS.items():
        w = S.windows(series, "total", size)
        target = w.where((F.col("t") >= low) & (F.col("t") < high))
        preds[name] = G.kernel_predict(target, w.where(first), 2.0)
    return G.stack_horizons(preds, target)


@query("kernel_predict", f"{H},\n{sql_windows('w', 12)},\n{sql_kernel('k', 'w', 'q.t >= ' + LOW)} SELECT t, round(yhat, 5) AS yhat FROM k")
def kernel_predict(t):
    w = S.windows(V.hourly(t), "total", 12)
    low = cuts(t)[0]
    return G.kernel_predict(w.where(F.col("t") >= low), w.where(F.col("t") < low), 2.0).withColumn("yhat", F.round("yhat", 5))


HORIZON_SQL = H + "".join(
    f",\n{sql_windows(n, k)},\n{sql_kernel('p' + n, n, 'q.t >= ' + LOW + ' AND q.t < ' + HIGH)}" for n, k in HORIZONS.items()
)


@query("horizon_stack", HORIZON_SQL + """
SELECT t, round(y, 5) AS y, round(pd6.yhat, 5) AS d6, round(pd12.yhat, 5) AS d12, round(pd24.yhat, 5) AS d24
FROM d24 JOIN pd6 USING (t) JOIN pd12 USING (t) JOIN pd24 USING (t)""")
def horizon_stack(t):
    low, high, _ = cuts(t)
    return horizon_predictions(t, low, high).select("t", *[F.round(c, 5).alias(c) for c in ("y", "d6", "d12", "d24")])


@query("forecast_mse")
def forecast_mse(t):
    """Weights fitted on the second period, error measured on the third."""
    low, high, end = cuts(t)
    fit = G.ols(horizon_predictions(t, low, high), "y", list(HORIZONS))
    test = G.ols_predict(horizon_predictions(t, high, end), fit)
    return M.mse(test, "actual", "predicted")


@query("ols", """WITH d AS (SELECT l_extendedprice AS y, l_quantity AS x1, l_discount AS x2 FROM lineitem),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y,
  var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12 FROM d),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)
SELECT 'l_quantity' AS term, round(b1, 4) AS coef FROM b UNION ALL SELECT 'l_discount', round(b2, 4) FROM b
UNION ALL SELECT 'const', round(my - b1 * m1 - b2 * m2, 4) FROM b""")
def ols(t):
    fit = G.ols(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount"])
    return fit.table(t.spark, "price").select("term", F.round("coef", 4).alias("coef"))


@query("mse", """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg((l_extendedprice - a - b * l_quantity) ** 2), 2) AS mse FROM lineitem, m""")
def mse(t):
    fit = G.ols(t.lineitem, "l_extendedprice", ["l_quantity"])
    return M.mse(G.ols_predict(t.lineitem, fit, "l_extendedprice"), "actual", "predicted").withColumn("mse", F.round("mse", 2))


# ---- vector autoregression ------------------------------------------------------------------------

VAR = H + """,
d AS (SELECT a.t, a.click, a.view, b.click AS c1, b.view AS v1 FROM hourly a JOIN hourly b ON b.t = a.t - 1),
long AS (SELECT t, 'click' AS eq, click AS y, c1, v1 FROM d UNION ALL SELECT t, 'view', view, c1, v1 FROM d),
m AS (SELECT eq, avg(y) AS my, avg(c1) AS mc, avg(v1) AS mv, covar_pop(c1, y) AS scy, covar_pop(v1, y) AS svy,
  var_pop(c1) AS scc, var_pop(v1) AS svv, covar_pop(c1, v1) AS scv FROM long GROUP BY 1),
b AS (SELECT *, (scy * svv - svy * scv) / (scc * svv - scv * scv) AS bc, (svy * scc - scy * scv) / (scc * svv - scv * scv) AS bv FROM m)"""


def _var(t):
    return C.var_fit(V.hourly(t).select("t", "click", "view"), ["click", "view"])


@query("var_fit", VAR + """
SELECT eq AS equation, 'click_l1' AS term, round(bc, 6) AS coef FROM b UNION ALL SELECT eq, 'view_l1', round(bv, 6) FROM b
UNION ALL SELECT eq, 'const', round(my - bc * mc - bv * mv, 6) FROM b""")
def var_fit(t):
    return _var(t).coefficients().select("equation", "term", F.round("coef", 6).alias("coef"))


@query("var_errors", VAR + """,
e AS (SELECT long.eq, sum((y - (my - bc * mc - bv * mv) - bc * c1 - bv * v1) ** 2) / (count(*) - 3) AS s2, count(*) AS n FROM long JOIN b USING (eq) GROUP BY 1),
q AS (SELECT *, scc * svv - scv * scv AS d FROM b JOIN e USING (eq)),
o AS (SELECT eq, 'click_l1' AS term, bc AS coef, sqrt(s2 / n * svv / d) AS se FROM q UNION ALL SELECT eq, 'view_l1', bv, sqrt(s2 / n * scc / d) FROM q
  UNION ALL SELECT eq, 'const', my - bc * mc - bv * mv, sqrt(s2 / n * (1 + (mc * mc * svv - 2 * mc * mv * scv + mv * mv * scc) / d)) FROM q)
SELECT eq AS equation, term, round(se, 6) AS se, round(coef / se, 5) AS t FROM o""")
def var_errors(t):
    """Standard errors and t values of the vector autoregression."""
    return _var(t).coefficients().select("equation", "term", F.round("se", 6).alias("se"), F.round("t", 5).alias("t"))


@query("var_residuals", VAR + """,
r AS (SELECT t, eq, y - (my - bc * mc - bv * mv) - bc * c1 - bv * v1 AS e FROM long JOIN b USING (eq))
SELECT t, round(max(e) FILTER (eq = 'click'), 5) AS click, round(max(e) FILTER (eq = 'view'), 5) AS view FROM r GROUP BY 1""")
def var_residuals(t):
    return _var(t).residuals().select("t", F.round("click", 5).alias("click"), F.round("view", 5).alias("view"))


@query("adf", H + """,
d AS (SELECT c.nm, c.v - b.v AS dy, b.v AS x, b.v - a.v AS dx FROM
  (UNPIVOT (SELECT t, click, view FROM hourly) ON click, view INTO NAME nm VALUE v) c
  JOIN (UNPIVOT (SELECT t, click, view FROM hourly) ON click, view INTO NAME nm VALUE v) b ON b.nm = c.nm AND b.t = c.t - 1
  JOIN (UNPIVOT (SELECT t, click, view FROM hourly) ON click, view INTO NAME nm VALUE v) a ON a.nm = c.nm AND a.t = c.t - 2),
s AS (SELECT nm, count(*) AS n, sum(x * x) AS xx, sum(x * dx) AS xd, sum(dx * dx) AS dd, sum(x * dy) AS xy, sum(dx * dy) AS dy, sum(dy * dy) AS yy FROM d GROUP BY 1),
b AS (SELECT *, (xy * dd - dy * xd) / (xx * dd - xd * xd) AS b1, (dy * xx - xy * xd) / (xx * dd - xd * xd) AS b2 FROM s)
SELECT nm AS name, CAST(n AS BIGINT) AS n, round(b1 / sqrt((yy - b1 * xy - b2 * dy) / (n - 2) * dd / (xx * dd - xd * xd)), 5) AS tau,
  tau < -1.95 AS stationary FROM b""")
def adf(t):
    return C.adf(V.hourly(t), ["click", "view"]).select("name", "n", F.round("tau", 5).alias("tau"), "stationary")


KS = """WITH u AS (SELECT value AS v, 1 AS a, 0 AS b FROM events WHERE event_type = 'click'
  UNION ALL SELECT value, 0, 1 FROM events WHERE event_type = 'view'),
h AS (SELECT v, sum(a) AS a, sum(b) AS b FROM u GROUP BY 1),
c AS (SELECT sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb, sum(a) OVER () AS n, sum(b) OVER () AS m FROM h)"""


@query("ks", KS + " SELECT round(max(abs(ca / n - cb / m)), 6) AS d, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM c")
def ks(t):
    kind = lambda k: t.events.where(F.col("event_type") == k).select("value")
    return C.ks_two_sample(kind("click"), kind("view")).select(F.round("d", 6).alias("d"), "n", "m")


@query("ks_p_value", KS + """,
s AS (SELECT max(abs(ca / n - cb / m)) AS d, max(n) AS n, max(m) AS m FROM c)
SELECT round(least(1.0, greatest(0.0, (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * d * d * n * m / (n + m) * k * k)) FROM range(1, 101) x(k)))), 6) AS p_value FROM s""")
def ks_p_value(t):
    """Asymptotic p-value of the two-sample test."""
    kind = lambda k: t.events.where(F.col("event_type") == k).select("value")
    return C.ks_two_sample(kind("click"), kind("view")).select(F.round("p_value", 6).alias("p_value"))


@query("ks_norm")
def ks_norm(t):
    return C.ks_norm(_var(t).residuals(), "click")


NAMES = ("click", "purchase", "total", "view")
CORR = H + ",\nc AS (" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, count(*) AS n FROM hourly"
    for i, a in enumerate(NAMES) for b in NAMES[i + 1:]
) + ")"


@query("corr_matrix", CORR + " SELECT a, b, round(r, 6) AS r FROM c")
def corr_matrix(t):
    return C.corr_matrix(V.hourly(t), list(NAMES)).withColumn("r", F.round("r", 6))


@query("ci_tests", CORR + """,
f AS (SELECT a, b, r, n FROM c UNION ALL SELECT b, a, r, n FROM c),
p AS (SELECT a, b, '' AS cond, r, n, 0 AS k FROM c
  UNION ALL SELECT c.a, c.b, x.b, (c.r - x.r * y.r) / sqrt((1 - x.r * x.r) * (1 - y.r * y.r)), c.n, 1
  FROM c JOIN f x ON x.a = c.a JOIN f y ON y.a = c.b AND y.b = x.b WHERE x.b <> c.b),
one AS (SELECT f.a, f.b, x.b AS x, (f.r - x.r * y.r) / sqrt((1 - x.r * x.r) * (1 - y.r * y.r)) AS r, f.n
  FROM f JOIN f x ON x.a = f.a JOIN f y ON y.a = f.b AND y.b = x.b WHERE x.b <> f.b),
two AS (SELECT o.a, o.b, o.x || ',' || p.b AS cond, (o.r - p.r * q.r) / sqrt((1 - p.r * p.r) * (1 - q.r * q.r)) AS r, o.n, 2 AS k
  FROM one o JOIN one p ON p.a = o.a AND p.x = o.x JOIN one q ON q.a = o.b AND q.x = o.x AND q.b = p.b WHERE o.a < o.b AND p.b <> o.b AND o.x < p.b),
z AS (SELECT a, b, cond, r, sqrt(n - k - 3) * abs(atanh(r)) AS z FROM (SELECT * FROM p UNION ALL SELECT * FROM two))
SELECT a, b, cond, round(r, 6) AS r, round(z, 5) AS z, z < 1.959963984540054 AS independent FROM z""")
def ci_tests(t):
    h = V.hourly(t)
    out = C.ci_tests(C.corr_matrix(h, list(NAMES)), h.count(), 0.05)
    return out.select("a", "b", F.concat_ws(",", "cond").alias("cond"), F.round("r", 6).alias("r"), F.round("z", 5).alias("z"), "independent")


WIDE = [f"e{i:02d}" for i in range(30)]


def wide(t):
    """Thirty columns: the first places of the embeddings."""
    return t.embeddings.select(*[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(WIDE)])


@query("pc_levels", f"""WITH e AS (SELECT vec_id, 'e' || lpad(CAST(d - 1 AS VARCHAR), 2, '0') AS d, v FROM
  (SELECT vec_id, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) WHERE d <= {len(WIDE)}),
c AS MATERIALIZED (SELECT x.d AS a, y.d AS b, corr(x.v, y.v) AS r, count(*) AS n FROM e x JOIN e y ON y.vec_id = x.vec_id AND x.d < y.d GROUP BY ALL),
f AS (SELECT a, b, r FROM c UNION ALL SELECT b, a, r FROM c),
z0 AS MATERIALIZED (SELECT a, b, '' AS cond, r, sqrt(n - 3) * abs(atanh(r)) AS z FROM c),
nb AS (SELECT a, b FROM z0 WHERE z >= 1.959963984540054 UNION ALL SELECT b, a FROM z0 WHERE z >= 1.959963984540054),
s AS (SELECT least(p.a, p.b) AS a, greatest(p.a, p.b) AS b, q.b AS k FROM nb p JOIN nb q ON q.a = p.a AND q.b <> p.b GROUP BY ALL),
z1 AS (SELECT s.a, s.b, k AS cond, (c.r - x.r * y.r) / sqrt((1 - x.r * x.r) * (1 - y.r * y.r)) AS r, n FROM s JOIN c ON c.a = s.a AND c.b = s.b
  JOIN f x ON x.a = s.a AND x.b = k JOIN f y ON y.a = s.b AND y.b = k),
z AS (SELECT a, b, cond, r, z FROM z0 UNION ALL SELECT a, b, cond, r, sqrt(n - 4) * abs(atanh(r)) FROM z1)
SELECT a, b, cond, round(r, 6) AS r, round(z, 5) AS z, z < 1.959963984540054 AS independent FROM z""")
def pc_levels(t):
    """Tests of the first two levels over thirty columns."""
    x = cut(wide(t))
    out = C.pc_tests(C.corr_matrix(x, WIDE), x.count(), 0.05, max_cond=1)
    return out.select("a", "b", F.concat_ws(",", "cond").alias("cond"), F.round("r", 6).alias("r"), F.round("z", 5).alias("z"), "independent")


@query("pc_graph")
def pc_graph(t):
    h = V.hourly(t)
    return C.pc_graph(C.pc_tests(C.corr_matrix(h, list(NAMES)), h.count()))


@query("lingam")
def lingam(t):
    return C.lingam(V.hourly(t), ["click", "purchase", "view", "total"])[1]


# ---- control limits -------------------------------------------------------------------------------

LIMITS = H + """,
mr AS (SELECT avg(d) AS moving_range FROM (SELECT abs(total - lag(total) OVER (ORDER BY t)) AS d FROM hourly)),
lim AS (SELECT quantile_cont(total, 0.5) AS median, max(moving_range) AS moving_range FROM hourly, mr)"""


@query("control_limits", LIMITS + """ SELECT round(median, 5) AS median, round(moving_range, 5) AS moving_range,
  round(median - 3 * moving_range, 5) AS low, round(median + 3 * moving_range, 5) AS high FROM lim""")
def control_limits(t):
    lim = S.control_limits(V.hourly(t), "total")
    return lim.select(*[F.round(c, 5).alias(c) for c in lim.columns])


@query("outliers", LIMITS + """ SELECT t, round(total, 5) AS total FROM hourly, lim
WHERE total < median - 1 * moving_range OR total > median + 1 * moving_range""")
def outliers(t):
    h = V.hourly(t)
    lim = S.control_limits(h, "total", sigmas=1.0)
    return S.find_outliers(h, lim, "total").select("t", F.round("total", 5).alias("total"))
