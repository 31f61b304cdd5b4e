"""Queries over edge tables, walks and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import metrics as M
from ..operators import series as SR
from ..operators import snapshots as SN
from ..operators import walks as W
from ..session import cut
from . import views as V
from .registry import query
from .views import CHAIN, RATINGS, SNAPS, sql_draw

HETERO = f"""WITH {RATINGS},
movies AS (SELECT 'm' || p_partkey AS m FROM part), known AS (SELECT m FROM movies UNION SELECT m FROM rate),
stars AS (SELECT m, r FROM known, range(1, 6) x(r)),
links AS (SELECT u AS src, m || '_' || rating AS dst FROM rate
  UNION ALL SELECT m || '_' || r, m FROM stars
  UNION ALL SELECT 'm' || p_partkey, 'director:' || p_brand FROM part
  UNION ALL SELECT 'm' || l_partkey, 'actor:supplier' || l_suppkey FROM lineitem WHERE 'm' || l_partkey IN (SELECT m FROM movies)
  UNION ALL SELECT 'm' || p_partkey, 'genre:' || p_type FROM part),
he AS (SELECT src, dst FROM links WHERE src <> dst UNION SELECT dst, src FROM links WHERE src <> dst)"""


def hetero(t):
    r = G.last_ratings(V.ratings(t))
    movies = t.part.select(F.col("p_partkey").cast("string").alias("movie"))
    return G.records_to_graph(r, movies, V.movie_dims(t))


@query("hetero_graph", HETERO + " SELECT src, dst FROM he")
def hetero_graph(t):
    return hetero(t)[1]


@query("hetero_nodes", HETERO + """,
nodes AS (SELECT DISTINCT u AS key, 'user' AS type FROM rate UNION ALL SELECT m, 'movie' FROM known
  UNION ALL SELECT m || '_' || r, 'rating' FROM stars
  UNION ALL SELECT DISTINCT 'director:' || p_brand, 'director' FROM part
  UNION ALL SELECT DISTINCT 'actor:supplier' || l_suppkey, 'actor' FROM lineitem
  UNION ALL SELECT DISTINCT 'genre:' || p_type, 'genre' FROM part)
SELECT key, type FROM nodes""")
def hetero_nodes(t):
    return hetero(t)[0]


BOTH = f"WITH {CHAIN},\nboth_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)"


@query("undirected", BOTH + " SELECT src, dst FROM both_ways")
def undirected(t):
    return G.undirected(G.edges_from_coo(V.chain_edges(t), "src", "dst"))


@query("subgraph", BOTH + """, n AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 0)
SELECT src, dst FROM both_ways WHERE src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n)""")
def subgraph(t):
    return G.subgraph(G.undirected(V.chain_edges(t)), t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("id")))


@query("degree", HETERO + " SELECT src AS id, CAST(count(*) AS BIGINT) AS degree FROM he GROUP BY 1")
def degree(t):
    return G.degree(hetero(t)[1])


@query("graph_size", HETERO + """
SELECT CAST(count(DISTINCT src) AS BIGINT) AS nodes, CAST(count(*) // 2 AS BIGINT) AS edges, false AS has_self_loops FROM he""")
def graph_size(t):
    e = cut(hetero(t)[1])  # read twice
    return G.graph_size(e).withColumn("has_self_loops", G.has_self_loops(e).scalar())


@query("has_edge", BOTH + """, p AS (SELECT DISTINCT l_suppkey AS src, l_suppkey + 1 AS dst FROM lineitem)
SELECT src, dst, (src, dst) IN (SELECT (src, dst) FROM both_ways) AS has_edge FROM p""")
def has_edge(t):
    pairs = t.lineitem.select(F.col("l_suppkey").alias("src"), (F.col("l_suppkey") + 1).alias("dst")).distinct()
    return G.has_edge(V.chain_edges(t), pairs)


@query("components", """WITH RECURSIVE e AS (SELECT DISTINCT p_name AS a, p_brand || '|' || p_type || '|' || p_size AS b FROM part),
s AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
reach AS (SELECT x AS id, x AS other FROM s UNION SELECT r.id, s.y FROM reach r JOIN s ON r.other = s.x)
SELECT id, min(other) AS comp FROM reach GROUP BY 1""")
def components(t):
    """Components of the name - (brand, type, size) graph of the parts."""
    e = t.part.select(F.col("p_name").alias("src"), F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("dst"))
    return G.components(e)


# ---- walks ----------------------------------------------------------------------------------------

LENGTH, PATHS, ALPHA, SEED = 40, 10, 0.15, 11
LEVELS = (LENGTH - 1).bit_length()


def _walk_sql() -> str:
    seed = str(SEED)
    back = sql_draw("w.start", "w.rep", "k", seed, "'r'")

    def merge(r: int) -> str:
        pick = sql_draw("a.v", "a.c", "a.j", "a.i", str(r), seed, "'m'")
        return f"""s{r} AS MATERIALIZED (SELECT a.j, a.i // 2 AS i, a.v, a.c, a.moves || ' ' || b.moves AS moves, b.e
  FROM (SELECT a.*, 1 + {pick} % k.copies AS pick FROM s{r - 1} a JOIN cps k ON k.src = a.e AND k.j = a.j WHERE a.j >= {r} AND a.i % 2 = 0) a
  JOIN s{r - 1} b ON b.j = a.j AND b.i = a.i + 1 AND b.v = a.e AND b.c = a.pick)"""

    def stitch(j: int) -> str:
        pick = sql_draw("p.start", "p.rep", "p.spot", str(j), seed, "'s'")
        return f"""p{j} AS MATERIALIZED (SELECT p.start, p.rep, p.spot, p.len, coalesce(t.e, p.cur) AS cur, p.path || coalesce(' ' || t.moves, '') AS path
  FROM (SELECT p.*, CASE WHEN (p.len >> {j}) & 1 = 1 THEN 1 + {pick} % k.copies ELSE -1 END AS pick FROM p{j + 1} p LEFT JOIN cps k ON k.src = p.cur AND k.j = {j}) p
  LEFT JOIN s{j} t ON t.j = {j} AND t.v = p.cur AND t.c = p.pick)"""

    return HETERO.replace("he AS (", "he AS MATERIALIZED (") + f""",
deg AS MATERIALIZED (SELECT src, count(*) AS deg FROM he GROUP BY 1),
nb AS MATERIALIZED (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS pos FROM he),
con AS (SELECT count(*) AS nv, CAST(sum(deg) AS BIGINT) AS flow FROM deg),
w AS (SELECT src AS start, r AS rep FROM deg, range(1, {PATHS + 1}) x(r)),
bk AS MATERIALIZED (SELECT start, rep, list_filter(range(1, {LENGTH}), lambda k: {back} / 4294967296.0 < {ALPHA}) AS b FROM w),
pc AS MATERIALIZED (SELECT start, rep, spot, z - spot - 1 AS len FROM (SELECT start, rep, unnest(list_concat([0], b)) AS spot, unnest(list_concat(b, [{LENGTH}])) AS z FROM bk)),
lv AS MATERIALIZED (SELECT j, CAST(sum((len >> j) & 1) AS BIGINT) AS d FROM pc, range({LEVELS}) x(j) GROUP BY 1),
cps AS MATERIALIZED (SELECT src, deg, CAST(j AS BIGINT) AS j, 1 + greatest((d * deg) // flow, d // nv) AS copies FROM deg, lv, con WHERE d > 0),
s0 AS MATERIALIZED (SELECT m.j, m.i, m.v, m.c, nb.dst AS moves, nb.dst AS e FROM (SELECT j, i, v, c, 1 + {sql_draw("v", "c", "j", "i", seed)} % deg AS pos
  FROM (SELECT j, i, src AS v, deg, unnest(range(1, copies + 1)) AS c FROM (SELECT *, unnest(range(CAST(1 << j AS BIGINT))) AS i FROM cps))) m JOIN nb ON nb.src = m.v AND nb.pos = m.pos),
""" + ",\n".join(merge(r) for r in range(1, LEVELS)) + f""",
p{LEVELS} AS (SELECT *, start AS cur, start AS path FROM pc),
""" + ",\n".join(stitch(j) for j in reversed(range(LEVELS))) + """,
walks AS (SELECT start, CAST(rep AS BIGINT) AS rep, string_agg(path, ' ' ORDER BY spot) AS path FROM p0 GROUP BY ALL)"""


WALKS = _walk_sql()


def walks(t):
    return W.stitched_walks(hetero(t)[1], PATHS, LENGTH, ALPHA, SEED)


@query("random_walks", WALKS + " SELECT start, rep, path FROM walks")
def random_walks(t):
    return walks(t).select("start", "rep", F.concat_ws(" ", "path").alias("path"))


@query("walk_vocab", WALKS + """ SELECT word, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(string_split(path, ' ')) AS word FROM walks) GROUP BY 1 HAVING count(*) >= 5""")
def walk_vocab(t):
    return W.vocab(walks(t), 5)


@query("node_vectors")
def node_vectors(t):
    """Walks, embeddings, predicted ratings of all rated pairs, metrics."""
    vecs = cut(W.node_vectors(walks(t), 64, 5, seed=SEED))
    return M.rating_metrics(W.predict_rating(vecs, G.last_ratings(V.ratings(t))))


@query("predict_rating", f"""WITH {RATINGS},
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT DISTINCT o_custkey AS usr, l_partkey AS movie FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT count(*) AS n FROM e),
s AS (SELECT usr, movie, r, list_cosine_similarity(a.v, b.v) AS sim FROM p, n, range(1, 6) x(r)
  JOIN e a ON a.vec_id = usr % n JOIN e b ON b.vec_id = (movie + 7 * r) % n)
SELECT CAST(usr AS VARCHAR) AS user, CAST(movie AS VARCHAR) AS movie, CAST(arg_max(r, round(sim, 9) * 100 - r * 1e-9) AS BIGINT) AS predicted FROM s GROUP BY ALL""")
def predict_rating(t):
    """Nearest rating node with vectors taken from the embedding table."""
    n = t.embeddings.count()
    e = t.embeddings.select(F.col("vec_id").alias("_k"), F.col("embedding").alias("vector"))
    r = V.ratings(t).select("user", "movie").distinct()
    users = r.select("user").distinct().withColumn("_k", F.col("user").cast("bigint") % n).join(e, "_k")
    stars = r.select("movie").distinct().select("movie", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("r"))
    stars = stars.withColumn("_k", (F.col("movie").cast("bigint") + 7 * F.col("r")) % n).join(e, "_k")
    vecs = users.select(F.concat(F.lit("u"), "user").alias("key"), "vector").unionByName(
        stars.select(F.concat(F.lit("m"), "movie", F.lit("_"), F.col("r").cast("string")).alias("key"), "vector")
    )
    return W.predict_rating(vecs, r)


# ---- snapshots ------------------------------------------------------------------------------------

TOKENS = f"""WITH {SNAPS},
ends AS (SELECT snap, src AS token FROM snaps UNION ALL SELECT snap, dst FROM snaps),
tokens AS (SELECT snap, token, count(*) AS weight FROM ends GROUP BY ALL)"""


@query("snapshot_degrees", TOKENS + " SELECT snap, token, CAST(weight AS BIGINT) AS weight FROM tokens")
def snapshot_degrees(t):
    return SN.shingle(V.snapshot_edges(t))


@query("snapshot_vertices", TOKENS + " SELECT DISTINCT snap, token AS id FROM tokens")
def snapshot_vertices(t):
    return SN.snapshot_vertices(V.snapshot_edges(t))


ROUNDS = 5
PR = TOKENS + """,
both_ways AS (SELECT snap, src, dst FROM snaps UNION ALL SELECT snap, dst, src FROM snaps),
flow AS (SELECT snap, src, dst, count(*) / max(weight) AS p FROM both_ways b JOIN tokens t USING (snap) WHERE t.token = b.src GROUP BY ALL),
sz AS (SELECT snap, count(*) AS n FROM tokens GROUP BY 1),
r0 AS (SELECT snap, token AS id, 1.0::DOUBLE / n AS rank FROM tokens JOIN sz USING (snap))""" + "".join(
    f""",
r{k} AS (SELECT f.snap, f.dst AS id, 0.15::DOUBLE / max(n) + 0.85::DOUBLE * sum(rank * p) AS rank
  FROM flow f JOIN r{k - 1} r ON r.snap = f.snap AND r.id = f.src JOIN sz ON sz.snap = f.snap GROUP BY ALL)"""
    for k in range(1, ROUNDS + 1)
)


@query("pagerank", PR + f" SELECT snap, id, round(rank, 8) AS rank FROM r{ROUNDS}")
def pagerank(t):
    return G.pagerank(V.snapshot_edges(t), "snap", ROUNDS).withColumn("rank", F.round("rank", 8))


@query("pagerank_converged")
def pagerank_converged(t):
    return SN.rank_vertices(G.pagerank(V.snapshot_edges(t), "snap", 20, tol=1e-9))


@query("rank_vertices", PR + f""" SELECT snap, id, CAST(row_number() OVER (PARTITION BY snap ORDER BY round(rank, 12) DESC, id) AS BIGINT) AS place FROM r{ROUNDS}""")
def rank_vertices(t):
    return SN.rank_vertices(G.pagerank(V.snapshot_edges(t), "snap", ROUNDS)).select("snap", "id", "place")


SIMHASH = TOKENS + """,
b AS (SELECT snap, i, sum(weight * (2 * ((CAST('0x' || substr(md5(CAST(token AS VARCHAR)), CAST(1 + i // 4 AS INT), 1) AS INT) >> CAST(3 - i % 4 AS INT)) & 1) - 1)) AS s
  FROM tokens, range(64) x(i) GROUP BY ALL),
h AS (SELECT snap, string_agg(CASE WHEN s >= 0 THEN '1' ELSE '0' END, '' ORDER BY i) AS bits FROM b GROUP BY 1),
sims AS (SELECT a.snap AS t, 1 - CAST(hamming(a.bits, b.bits) AS DOUBLE) / 64 AS sim FROM h a JOIN h b ON b.snap = a.snap + 1)"""


def similarity(t):
    return SN.snapshot_similarity(SN.simhash(SN.shingle(V.snapshot_edges(t))))


@query("simhash", SIMHASH + " SELECT snap, bits FROM h")
def simhash(t):
    return SN.simhash(SN.shingle(V.snapshot_edges(t))).select("snap", F.concat_ws("", F.col("bits").cast("array<string>")).alias("bits"))


@query("snapshot_similarity", SIMHASH + " SELECT t, sim FROM sims")
def snapshot_similarity(t):
    return similarity(t)


@query("snapshot_limits", SIMHASH + """,
mr AS (SELECT avg(abs(b.sim - a.sim)) AS m FROM sims a JOIN sims b ON b.t = a.t + 1)
SELECT round(quantile_cont(sim, 0.5), 8) AS median, round(max(m), 8) AS moving_range,
  round(quantile_cont(sim, 0.5) - 3 * max(m), 8) AS low, round(quantile_cont(sim, 0.5) + 3 * max(m), 8) AS high FROM sims, mr""")
def snapshot_limits(t):
    lim = SR.control_limits(similarity(t))
    return lim.select(*[F.round(c, 8).alias(c) for c in lim.columns])
