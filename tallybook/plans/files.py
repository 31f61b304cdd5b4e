"""Queries that write a view with a sink and read it back with the matching reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facts as O
from ..operators import graph as G
from ..operators import textclass as TC
from ..operators.ordering import ranges_for
from ..session import scratch
from ..sources import messages as MSG
from ..sources import readers as R
from ..sources import sinks as S
from ..streaming import polarity as P
from . import graphs as PG
from . import text as TX
from . import views as V
from .registry import query
from .views import ALIAS, BIDS, CANON, DOCS, HOURLY, PLAYS, QUERY_LOG, RATINGS, SNAPS, TAGS


def _text(df, path, *cols, sep=" "):
    S.write_lines(df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value")), path)
    return path


@query("src_plays", f"WITH {PLAYS},\n{ALIAS},\n{CANON}" + """ SELECT p_name AS name, CAST(count(*) AS BIGINT) AS n, CAST(sum(plays) AS BIGINT) AS plays
FROM canon JOIN part ON item_id = p_partkey GROUP BY 1""")
def src_plays(t):
    """Play facts, dimension and alias table through their text formats."""
    d = scratch(t.spark, "plays")
    facts = R.read_plays(t.spark, _text(V.plays(t), f"{d}/plays", "user_id", "item_id", "plays"))
    alias = R.read_alias(t.spark, _text(V.alias(t), f"{d}/alias", "bad_id", "good_id", sep="\t"))
    dim = R.read_dim(t.spark, _text(V.items(t), f"{d}/items", "item_id", "name", sep="\t"))
    named = O.with_names(O.resolve_alias(facts, alias), dim)
    return named.groupBy("name").agg(F.count("*").alias("n"), F.sum("plays").alias("plays"))


@query("src_wordlist", r"SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents) WHERE word <> ''")
def src_wordlist(t):
    d = scratch(t.spark, "words")
    S.write_lines(t.documents.select("text"), d)
    return R.read_wordlist(t.spark, d)


@query("src_series", f"WITH {HOURLY} SELECT t, round(click, 4) AS click, round(view, 4) AS view FROM hourly")
def src_series(t):
    d = scratch(t.spark, "series")
    S.write_csv(V.hourly(t).select("t", F.round("click", 4).alias("click"), F.round("view", 4).alias("view")), d)
    return R.read_series(t.spark, d, "t", ["click", "view"])


@query("sink_series", f"WITH {HOURLY} SELECT t AS line, CAST(round(total, 4) AS DOUBLE) AS total FROM hourly")
def sink_series(t):
    """One value per line; the line number must come back as the time."""
    d = scratch(t.spark, "series")
    S.write_series(V.hourly(t).withColumn("total", F.round("total", 4)), d, "total")
    return R.number_lines(t.spark, d, "line").select("line", F.col("value").cast("double").alias("total"))


@query("src_features", """SELECT split, CAST(h AS BIGINT) AS horizon, CAST(count(*) AS BIGINT) AS n, round(sum(y), 4) AS y, round(sum(x), 4) AS x FROM
(SELECT CASE WHEN l_returnflag = 'A' THEN 'test' WHEN l_returnflag = 'N' THEN 'train1' ELSE 'train2' END AS split, l_extendedprice AS y, l_quantity + l_discount AS x FROM lineitem),
(VALUES (90), (180), (360)) v(h) GROUP BY ALL""")
def src_features(t):
    d = scratch(t.spark, "features")
    names = {"A": "test", "N": "train1", "R": "train2"}
    for flag, split in names.items():
        rows = t.lineitem.where(F.col("l_returnflag") == flag).select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), "l_quantity", "l_discount", F.col("l_extendedprice").alias("Yi")
        )
        for horizon in (90, 180, 360):
            S.write_csv(rows, f"{d}/{split}_{horizon}.csv")
    f = R.read_features(t.spark, d, 2)
    return f.groupBy("split", F.col("horizon").cast("bigint").alias("horizon")).agg(
        F.count("*").alias("n"), F.round(F.sum("y"), 4).alias("y"), F.round(F.sum(F.col("x")[0] + F.col("x")[1]), 4).alias("x")
    )


@query("src_labeled_docs", f"WITH {DOCS}" + """ SELECT CASE label WHEN 1 THEN 'pos' ELSE 'neg' END AS label, split, CAST(count(*) AS BIGINT) AS docs,
  CAST(sum(len(tokens)) AS BIGINT) AS tokens FROM docs GROUP BY ALL""")
def src_labeled_docs(t):
    d = scratch(t.spark, "docs")
    docs = V.labeled_docs(t).select("doc_id", "label", "split").join(t.documents.select("doc_id", "text"), "doc_id")
    for split in ("train", "test"):
        for label, name in ((1, "pos"), (0, "neg")):
            part = docs.where((F.col("split") == split) & (F.col("label") == label))
            S.write_lines(part.select(F.regexp_replace("text", r"\s+", " ").alias("value")), f"{d}/{split}-{name}.txt")
    return R.read_labeled_docs(t.spark, d).groupBy("label", "split").agg(
        F.count("*").alias("docs"), F.sum(F.size("tokens").cast("bigint")).alias("tokens")
    )


@query("src_corpus", r"""WITH lines AS (SELECT lang, doc_id, unnest(string_split_regex(text, '\r?\n')) AS line FROM documents),
w AS (SELECT lang, unnest(string_split_regex(regexp_replace(regexp_replace(lower(line), '^\s+|\s+$', '', 'g'), '^[[:punct:]]+|[[:punct:]]+$', '', 'g'), '\s+')) AS word FROM lines)
SELECT lang AS category, word, CAST(count(*) AS BIGINT) AS n FROM w WHERE word <> '' GROUP BY ALL""")
def src_corpus(t):
    """Documents written under language folders and read as a corpus of categories."""
    d = scratch(t.spark, "corpus")
    t.documents.select("lang", F.regexp_replace("text", "\r?\n", "\n").alias("value")).write.partitionBy("lang").text(d)
    c = R.read_corpus(t.spark, d)
    return TC.term_counts(c.withColumn("category", F.regexp_replace("category", "^lang=", "")), ["category"])


@query("src_edges", PG.BOTH + " SELECT src, dst FROM both_ways")
def src_edges(t):
    d = scratch(t.spark, "edges")
    return R.read_edges(t.spark, _text(V.chain_edges(t), d, "src", "dst"))


@query("src_vertex_attrs", """SELECT vec_id AS id, CAST(i AS BIGINT) AS attr, round(embedding[i + 1]::DOUBLE, 6) AS value FROM embeddings, range(64) r(i)""")
def src_vertex_attrs(t):
    """Attributes with an id column, and as bare rows whose number is the id."""
    d = scratch(t.spark, "attrs")
    attrs = [F.round(F.col("embedding")[i].cast("double"), 6).alias(f"a{i}") for i in range(64)]
    rows = t.embeddings.select(F.col("vec_id").alias("id"), *attrs)
    S.write_csv(rows, f"{d}/keyed")
    rows.orderBy("id").drop("id").write.option("header", True).csv(f"{d}/rows")
    keyed, bare = R.read_vertex_attrs(t.spark, f"{d}/keyed", 64), R.read_vertex_rows(t.spark, f"{d}/rows")
    both = keyed.join(bare.withColumnRenamed("attrs", "b"), "id").where("attrs = b")
    return both.select("id", F.posexplode("attrs").alias("attr", "value")).withColumn("attr", F.col("attr").cast("bigint"))


@query("src_communities", "SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS comm FROM supplier")
def src_communities(t):
    d = scratch(t.spark, "comm")
    S.write_communities(V.nation_communities(t), d)
    return R.read_communities(t.spark, d)


@query("src_bidders", f"WITH {BIDS} SELECT adv_id, CAST(count(*) AS BIGINT) AS n_bids, round(sum(bid), 4) AS bid_sum, max(budget) AS budget FROM bids JOIN budgets USING (adv_id) GROUP BY 1")
def src_bidders(t):
    d = scratch(t.spark, "bidders")
    flat = V.bids(t).join(V.budgets(t), "adv_id")
    first = flat.groupBy("adv_id").agg(F.min("keyword").alias("_first"))
    S.write_csv(
        flat.join(first, "adv_id").select("adv_id", "keyword", "bid", F.when(F.col("keyword") == F.col("_first"), F.col("budget")).alias("budget")), d
    )
    bids, budgets = R.read_bidders(t.spark, d)
    return bids.groupBy("adv_id").agg(F.count("*").alias("n_bids"), F.round(F.sum("bid"), 4).alias("bid_sum")).join(budgets, "adv_id")


@query("src_queries", f"WITH {BIDS},\n{QUERY_LOG} SELECT seq, keyword FROM qlog")
def src_queries(t):
    d = scratch(t.spark, "queries")
    return R.read_queries(t.spark, _text(V.query_log(t), d, "seq", "keyword", sep="\t"))


@query("src_snapshots", f"WITH {SNAPS} SELECT snap, src, dst, CAST(count(*) AS BIGINT) AS n FROM snaps GROUP BY ALL")
def src_snapshots(t):
    d = scratch(t.spark, "snaps")
    e = V.snapshot_edges(t)
    e.select("snap", F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value")).write.partitionBy("snap").text(d)
    return R.read_snapshots(t.spark, d).groupBy("snap", "src", "dst").agg(F.count("*").alias("n"))


@query("src_image_tags", f"WITH {TAGS} SELECT name, CAST(count(*) AS BIGINT) AS n_tags, string_agg(tag, ' ' ORDER BY tag) AS tags FROM tag_rows GROUP BY 1")
def src_image_tags(t):
    d = scratch(t.spark, "tags")
    S.write_lines(V.image_tags(t).select(F.concat_ws(" ", "name", "tags").alias("value")), d)
    return R.read_image_tags(t.spark, d).select("name", F.size("tags").cast("bigint").alias("n_tags"), F.array_join(F.sort_array("tags"), " ").alias("tags"))


@query("src_movie_dims", """SELECT 'movie' AS kind, CAST(p_partkey AS VARCHAR) AS movie, string_split(p_name, ' ')[1] AS name FROM part
UNION ALL SELECT 'director', CAST(p_partkey AS VARCHAR), p_brand FROM part
UNION ALL SELECT 'genre', CAST(p_partkey AS VARCHAR), p_type FROM part
UNION ALL SELECT DISTINCT 'actor', CAST(l_partkey AS VARCHAR), 'supplier' || l_suppkey FROM lineitem""")
def src_movie_dims(t):
    """Only the first word of a movie's name survives the format."""
    d = scratch(t.spark, "movies")
    dims = V.movie_dims(t) | {"movie": t.part.select(F.col("p_partkey").cast("string").alias("movie"), F.col("p_name").alias("name"))}
    for kind, stem in (("movie", "movies"), ("director", "movie_directors"), ("actor", "movie_actors"), ("genre", "movie_genres")):
        dims[kind].select(F.concat_ws("\t", "movie", "name").alias("id_name")).write.option("header", True).option("quote", "").csv(f"{d}/{stem}.dat")
    out = R.read_movie_dims(t.spark, d)
    return O.union_all(*[df.select(F.lit(k).alias("kind"), "movie", "name") for k, df in out.items()])


@query("src_ratings", f"WITH {RATINGS} SELECT u AS user, m AS movie, rating FROM rate")
def src_ratings(t):
    """Rating lines in file order; the last line of a pair wins."""
    d = scratch(t.spark, "ratings")
    n = t.lineitem.count()  # from the files' footers
    lines = V.ratings(t)
    # ranges of lines grow in number, not in size
    ordered = lines.repartitionByRange(ranges_for(lines, n), "line_no").sortWithinPartitions("line_no")
    ordered.select("user", "movie", "rating").write.option("header", True).option("sep", "\t").csv(d)
    return G.last_ratings(R.read_ratings(t.spark, d), n).select(
        F.concat(F.lit("u"), "user").alias("user"), F.concat(F.lit("m"), "movie").alias("movie"), "rating"
    )


@query("sink_graph", PG.HETERO + " SELECT src, dst FROM he")
def sink_graph(t):
    """Adjacency and node files; every edge comes back."""
    d = scratch(t.spark, "graph")
    nodes, edges = PG.hetero(t)
    S.write_graph(nodes.select(F.col("key").alias("id"), F.col("key").alias("name"), "type"), edges, d)
    return R.read_adjacency(t.spark, f"{d}/adjacency")


@query("sink_walks", PG.WALKS + " SELECT path FROM walks")
def sink_walks(t):
    d = scratch(t.spark, "walks")
    S.write_walks(PG.walks(t), d)
    return R.read_walks(t.spark, d).select(F.array_join("path", " ").alias("path"))


@query("sink_messages", "SELECT 1704067200 + conv_id * 10 + turn AS sec, text AS value FROM conversations")
def sink_messages(t):
    d = scratch(t.spark, "messages")
    MSG.write_messages(V.messages(t), "parquet", d)
    return t.spark.read.schema(MSG.SCHEMA).parquet(d).select(F.unix_timestamp("ts").alias("sec"), "value")


@query("src_patches", f"""WITH {TAGS} SELECT CAST(vec_id AS VARCHAR) AS name, CAST(len(embedding) AS BIGINT) AS n FROM embeddings
WHERE CAST(vec_id AS VARCHAR) IN (SELECT name FROM tag_rows)""")
def src_patches(t):
    """Embeddings written as a patch file each, read as binary files of tagged images."""
    d = scratch(t.spark, "patches")
    name = F.col("vec_id").cast("string").alias("name")
    t.embeddings.select(name, F.concat_ws(",", F.col("embedding").cast("array<string>")).alias("value")).write.partitionBy("name").text(d)
    patches = R.read_patches(t.spark, d, V.image_tags(t))
    return patches.select("name", F.size(F.split(F.decode("content", "UTF-8"), ",")).cast("bigint").alias("n"))


@query("polarity_stream", TX.POLAR + ", s AS (SELECT sum(p) AS positive, sum(n) AS negative FROM flags)" + TX.UNFOLD.format(k=""))
def polarity_stream(t):
    """The message feed as a drained file stream: per-batch counts, summed."""
    d = scratch(t.spark, "stream")
    MSG.write_messages(V.messages(t).repartition(4), "parquet", f"{d}/in")
    feed = MSG.read_messages(t.spark, "parquet", f"{d}/in", maxFilesPerTrigger="2")
    q = P.record_batches(feed, V.positive_words(t), V.negative_words(t), f"{d}/out", f"{d}/chk", interval=None)
    q.awaitTermination()
    return t.spark.read.parquet(f"{d}/out").groupBy("polarity").agg(F.sum("cnt").alias("cnt"))
