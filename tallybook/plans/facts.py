"""Queries of the relational core and the recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facts as O
from ..operators import metrics as M
from ..operators import ordering as R
from ..operators import recommend as REC
from ..session import cut
from . import views as V
from .registry import query
from .views import ALIAS, CANON, PLAYS, sql_draw

WITH = f"WITH {PLAYS},\n{ALIAS},\n{CANON}"


def canonical_plays(t):
    return O.resolve_alias(V.plays(t), V.alias(t))


@query("alias_top_users", WITH + """
SELECT user_id, CAST(sum(plays) AS BIGINT) AS total_plays, round(avg(plays), 6) AS mean_plays
FROM canon GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def alias_top_users(t):
    return O.top_users(O.user_totals(canonical_plays(t)), 3).withColumn("mean_plays", F.round("mean_plays", 6))


@query("user_totals", WITH + """
SELECT user_id, CAST(sum(plays) AS BIGINT) AS total_plays, round(avg(plays), 6) AS mean_plays FROM canon GROUP BY 1""")
def user_totals(t):
    return O.user_totals(canonical_plays(t)).withColumn("mean_plays", F.round("mean_plays", 6))


@query("alias_effect", WITH + """
SELECT item_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(plays) AS BIGINT) AS plays FROM canon GROUP BY 1""")
def alias_effect(t):
    return canonical_plays(t).groupBy("item_id").agg(F.count("*").alias("n_rows"), F.sum("plays").alias("plays"))


SPLIT = WITH + f""",
drawn AS (SELECT *, {sql_draw('user_id', 'item_id', '13')} / 4294967296.0 AS u FROM canon),
parts AS (SELECT user_id, item_id, plays, CASE WHEN u < 0.4 THEN 'train' WHEN u < 0.8 THEN 'val' ELSE 'test' END AS split FROM drawn)"""


def split_plays(t):
    return O.split_label(canonical_plays(t), {"train": 0.4, "val": 0.4, "test": 0.2}, 13, ["user_id", "item_id"])


@query("split_sizes", SPLIT + """
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(plays) AS BIGINT) AS plays FROM parts GROUP BY 1""")
def split_sizes(t):
    return split_plays(t).groupBy("split").agg(F.count("*").alias("n"), F.sum("plays").alias("plays"))


@query("preview", WITH + " SELECT user_id, item_id, plays FROM canon ORDER BY 1, 2, 3 LIMIT 3")
def preview(t):
    return O.preview(canonical_plays(t), 3, [F.asc("user_id"), F.asc("item_id"), F.asc("plays")])


@query("items_by_user", WITH + """
SELECT user_id, CAST((place - 1) // 10000 AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_items,
  string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY item_id) AS items
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS place FROM (SELECT DISTINCT user_id, item_id FROM canon)) GROUP BY ALL""")
def items_by_user(t):
    return O.items_by_user(canonical_plays(t)).select(
        "user_id", "chunk", F.size("items").cast("bigint").alias("n_items"), F.concat_ws(" ", F.col("items").cast("array<string>")).alias("items")
    )


@query("entities", WITH + """
SELECT 'user_id' AS kind, CAST(user_id AS VARCHAR) AS id FROM canon
UNION SELECT 'item_id', CAST(item_id AS VARCHAR) FROM canon""")
def entities(t):
    return O.distinct_entities(canonical_plays(t), ["user_id", "item_id"])


@query("set_operations", SPLIT + """,
k AS (SELECT DISTINCT user_id, item_id, split FROM parts),
tr AS (SELECT DISTINCT item_id FROM parts WHERE split = 'train'),
te AS (SELECT DISTINCT item_id FROM parts WHERE split = 'test')
SELECT 'union' AS op, item_id FROM (SELECT * FROM tr UNION SELECT * FROM te)
UNION ALL SELECT 'intersect', item_id FROM (SELECT * FROM tr INTERSECT SELECT * FROM te)
UNION ALL SELECT 'except', item_id FROM (SELECT * FROM te EXCEPT SELECT * FROM tr)""")
def set_operations(t):
    parts = split_plays(t).select("item_id", "split")
    tr = parts.where("split = 'train'").select("item_id").distinct()
    te = parts.where("split = 'test'").select("item_id").distinct()
    tag = lambda name, df: df.select(F.lit(name).alias("op"), "item_id")
    return O.union_all(
        tag("union", O.union_distinct(tr, te)),
        tag("intersect", O.intersect_keys(tr, te, ["item_id"])),
        tag("except", O.except_keys(te, tr, ["item_id"])),
    )


@query("dense_index", """SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS idx FROM
  (SELECT DISTINCT p_name || '|' || p_brand || '|' || p_type || '|' || p_size AS word FROM part)""")
def dense_index(t):
    return R.dense_index(t.part.select(V._keyword().alias("word")), "word")


@query("permute", f"WITH {V.BIDS}, {V.QUERY_LOG}" + f""",
many AS (SELECT trial, seq FROM qlog, range(3) r(trial))
SELECT trial, seq, CAST(row_number() OVER (PARTITION BY trial ORDER BY {sql_draw('trial', 'seq', '7')}, seq) AS BIGINT) AS pos FROM many""")
def permute(t):
    return O.permute(V.query_log(t).select("seq"), "seq", 3, 7)


@query("summarize", WITH + """
SELECT count(*)::BIGINT AS n, min(plays)::DOUBLE AS min, quantile_cont(plays, 0.25)::DOUBLE AS q1, quantile_cont(plays, 0.5)::DOUBLE AS median,
  round(avg(plays), 6) AS mean, quantile_cont(plays, 0.75)::DOUBLE AS q3, max(plays)::DOUBLE AS max, 'plays' AS name FROM canon
UNION ALL SELECT count(*)::BIGINT, min(l_extendedprice), round(quantile_cont(l_extendedprice, 0.25), 4), round(quantile_cont(l_extendedprice, 0.5), 4),
  round(avg(l_extendedprice), 6), round(quantile_cont(l_extendedprice, 0.75), 4), max(l_extendedprice), 'l_extendedprice' FROM lineitem""")
def summarize(t):
    a = R.summarize(canonical_plays(t), ["plays"])
    b = R.summarize(t.lineitem, ["l_extendedprice"])
    return a.unionByName(b).select(
        "name", "n", "min", F.round("q1", 4).alias("q1"), F.round("median", 4).alias("median"),
        F.round("mean", 6).alias("mean"), F.round("q3", 4).alias("q3"), "max",
    )


RANKED = """ranked AS (SELECT item_id, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS BIGINT) AS rank, score
  FROM (SELECT item_id, CAST(sum(plays) AS DOUBLE) AS score FROM parts WHERE split = 'train' GROUP BY 1))"""


def ranked_items(train):
    """Items by total plays."""
    pop = train.groupBy("item_id").agg(F.sum("plays").cast("double").alias("score"))
    return R.rank_within(pop, [], [F.desc("score"), F.asc("item_id")])


@query("candidate_items", SPLIT + f",\n{RANKED}," + """
u AS (SELECT DISTINCT user_id FROM parts),
free AS (SELECT user_id, item_id, rank FROM u, ranked WHERE (user_id, item_id) NOT IN (SELECT user_id, item_id FROM parts WHERE split = 'train')),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rank) AS BIGINT) AS place FROM free)
SELECT user_id, item_id, place FROM placed WHERE place <= 5""")
def candidate_items(t):
    p = cut(split_plays(t))
    train = p.where("split = 'train'")
    return O.candidate_items(p, ranked_items(train), train, 5).select("user_id", "item_id", "place")


@query("overlap_at_x", SPLIT + f",\n{RANKED}," + """
truth AS (SELECT DISTINCT user_id, item_id FROM parts WHERE split = 'val'),
x AS (SELECT user_id, count(*) AS x FROM truth GROUP BY 1),
free AS (SELECT user_id, item_id, rank FROM x, ranked WHERE (user_id, item_id) NOT IN (SELECT user_id, item_id FROM parts WHERE split = 'train')),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS place FROM free),
hits AS (SELECT placed.user_id, count(*) AS hits FROM placed JOIN x USING (user_id) JOIN truth USING (user_id, item_id) WHERE place <= x GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS users, CAST(sum(coalesce(hits, 0)) AS BIGINT) AS hits, round(avg(coalesce(hits, 0) / x), 6) AS overlap
FROM x LEFT JOIN hits USING (user_id)""")
def overlap_at_x(t):
    p = cut(split_plays(t))
    train, val = p.where("split = 'train'"), p.where("split = 'val'")
    scores = REC.popularity_scores(ranked_items(train), val, train)
    return REC.overlap_at_x(scores, val, train).withColumn("overlap", F.round("overlap", 6))


@query("als_sweep")
def als_sweep(t):
    p = cut(split_plays(t))
    table, _ = REC.sweep(p.where("split = 'train'"), p.where("split = 'val'"))
    return table


@query("als_recommend")
def als_recommend(t):
    p = cut(split_plays(t))
    model = REC.train_implicit(p.where("split = 'train'"), 10)
    return O.with_names(REC.recommend(model, p, 5), V.items(t))


@query("als_scores")
def als_scores(t):
    """Model scores of the validation pairs; pairs with an unknown user or item vanish."""
    p = cut(split_plays(t))
    model = REC.train_implicit(p.where("split = 'train'"), 10)
    return REC.score(model, p.where("split = 'val'").select("user_id", "item_id").distinct())


@query("named_items", WITH + """, best AS (SELECT item_id, CAST(sum(plays) AS BIGINT) AS plays FROM canon GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT item_id, p_name AS name, plays FROM best JOIN part ON item_id = p_partkey""")
def named_items(t):
    best = R.top_rows(
        canonical_plays(t).groupBy("item_id").agg(F.sum("plays").alias("plays")), [F.desc("plays"), F.asc("item_id")], 5
    )
    return O.with_names(best, V.items(t)).select("item_id", "name", "plays")


@query("rating_metrics", f"""WITH {V.RATINGS},
mean AS (SELECT m, CAST(round(avg(rating)) AS BIGINT) AS predicted FROM rate GROUP BY 1)
SELECT rating, """ + ", ".join(f"CAST(count(*) FILTER (predicted = {c}) AS BIGINT) AS pred_{c}" for c in range(1, 6)) + """,
  round(avg(CASE WHEN rating = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg(pow(rating - predicted, 2)), 6) AS mse FROM rate JOIN mean USING (m) GROUP BY 1""")
def rating_metrics(t):
    from ..operators.graph import last_ratings

    r = last_ratings(V.ratings(t))
    mean = r.groupBy("movie").agg(F.round(F.avg("rating")).cast("bigint").alias("predicted"))
    scored = r.join(mean, "movie")
    table = M.confusion(scored, "rating", "predicted", [1, 2, 3, 4, 5])
    per = scored.groupBy("rating").agg(
        F.round(F.avg((F.col("rating") == F.col("predicted")).cast("double")), 6).alias("accuracy"),
        F.round(F.avg(F.pow(F.col("rating") - F.col("predicted"), 2)), 6).alias("mse"),
    )
    return table.join(per, "rating")
