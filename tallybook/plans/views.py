"""Stand-in views: business inputs read from the given tables, each with its SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import text_key
from ..operators.ordering import rank_within, ranges_for
from ..operators.series import pair_consecutive
from .registry import Tables

# ---- plays, items, aliases ------------------------------------------------------------------------


def plays(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("plays"),
    )


def alias(t: Tables) -> DataFrame:
    """Parts of equal name and brand are one product; its lowest id is canonical."""
    good = t.part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("good_id"))
    return t.part.join(good, ["p_name", "p_brand"]).where("p_partkey <> good_id").select(
        F.col("p_partkey").alias("bad_id"), "good_id"
    )


def items(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))


PLAYS = """plays AS (SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(l_quantity AS BIGINT) AS plays
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ALIAS = """alias AS (SELECT p_partkey AS bad_id, good_id FROM
  (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS good_id FROM part) WHERE p_partkey <> good_id)"""
CANON = """canon AS (SELECT user_id, coalesce(good_id, item_id) AS item_id, plays
  FROM plays LEFT JOIN alias ON item_id = bad_id)"""


def sql_draw(*parts: str, word: int = 0) -> str:
    """SQL form of a hash draw over SQL expressions."""
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({key}), {1 + 8 * word}, 8) AS BIGINT)"


# ---- messages and lexicons ------------------------------------------------------------------------


def messages(t: Tables) -> DataFrame:
    return t.conversations.select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 10 + F.col("turn")).alias("ts"),
        F.col("text").alias("value"),
    )


def positive_words(t: Tables) -> DataFrame:
    """Whitespace tokens of the benchmark passages."""
    return t.benchmark.select(F.explode(X.words("text")).alias("word")).distinct()


def negative_words(t: Tables) -> DataFrame:
    """Whitespace tokens of the toxic documents."""
    toxic = t.documents.join(t.labels.where("toxic = 1"), "doc_id", "left_semi")
    return toxic.select(F.explode(X.words("text")).alias("word")).distinct()


LEXICONS = r"""pos AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM benchmark) WHERE word <> ''),
neg AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) WHERE word <> '')"""
MESSAGE_WORDS = r"""msg_words AS (SELECT conv_id * 10 + turn AS sec,
  lower(regexp_replace(unnest(string_split(regexp_replace(text, '[^\x00-\x7F]', '', 'g'), ' ')), '[[:punct:]]', '', 'g')) AS word
  FROM conversations)"""

# ---- labeled documents ----------------------------------------------------------------------------


def labeled_docs(t: Tables) -> DataFrame:
    """(doc_id, label, split, tokens): label = quality, split by a hash of the id."""
    return t.documents.join(t.labels.select("doc_id", F.col("quality").cast("bigint").alias("label")), "doc_id").select(
        "doc_id", "label",
        F.when(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) < "c", "train").otherwise("test").alias("split"),
        X.tokens("text", sep=None, min_len=3).alias("tokens"),
    )


DOCS = r"""docs AS (SELECT d.doc_id, CAST(quality AS BIGINT) AS label,
    CASE WHEN substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 1) < 'c' THEN 'train' ELSE 'test' END AS split,
    list_transform(list_filter(string_split_regex(text, '\s+'), lambda w: length(w) >= 3), lambda w: lower(w)) AS tokens
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
doc_words AS (SELECT doc_id, label, split, unnest(tokens) AS word FROM docs)"""

# ---- keyword bids and query log -------------------------------------------------------------------


def _keyword():
    return text_key("p_name", "p_brand", "p_type", "p_size").alias("keyword")


def bids(t: Tables) -> DataFrame:
    """Suppliers bid on the products they have sold: 0.1 plus their best discount."""
    return (
        t.lineitem.join(t.part.select("p_partkey", _keyword()), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_suppkey").alias("adv_id"), "keyword")
        .agg(F.round(F.max("l_discount") + F.lit(0.1), 2).alias("bid"))
    )


def budgets(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("adv_id"), (F.floor(F.abs("s_acctbal") * 5) / 100).alias("budget")
    )


def query_log(t: Tables) -> DataFrame:
    """One query per sold line, in order of order and line."""
    lines = t.lineitem.join(t.part.select("p_partkey", _keyword()), F.col("l_partkey") == F.col("p_partkey")).select(
        "keyword", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return rank_within(lines, [], order, "seq").select("seq", "keyword")


BIDS = """kw AS (SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type || '|' || p_size AS keyword FROM part),
bids AS (SELECT l_suppkey AS adv_id, keyword, round(max(l_discount) + 0.1, 2) AS bid
  FROM lineitem JOIN kw ON l_partkey = p_partkey GROUP BY ALL),
budgets AS (SELECT s_suppkey AS adv_id, floor(abs(s_acctbal) * 5) / 100 AS budget FROM supplier)"""
QUERY_LOG = """qlog AS (SELECT keyword, CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS seq
  FROM lineitem JOIN kw ON l_partkey = p_partkey)"""

# ---- hourly series --------------------------------------------------------------------------------


def hourly(t: Tables) -> DataFrame:
    """(t, one sum of value per event type, total) on a gapless hourly spine."""
    types = ("click", "view", "purchase", "signup", "error")
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600)
    sums = t.events.groupBy(hour.alias("hour")).agg(
        *[F.sum(F.when(F.col("event_type") == k, F.col("value")).otherwise(0.0)).alias(k) for k in types],
        F.sum("value").alias("total"),
    )
    first = t.events.agg(F.min(hour)).scalar()
    span = t.events.agg(F.sequence(F.min(hour), F.max(hour)).alias("s"))
    spine = span.select(F.explode("s").alias("hour"))
    return spine.join(sums, "hour", "left").select(
        (F.col("hour") - first).alias("t"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in (*types, "total")],
    )


HOURLY = """h AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour,
    """ + ",\n    ".join(
    f"sum(CASE WHEN event_type = '{k}' THEN value ELSE 0 END) AS {k}" for k in ("click", "view", "purchase", "signup", "error")
) + """, sum(value) AS total FROM events GROUP BY 1),
spine AS (SELECT unnest(range(min(hour), max(hour) + 1)) AS hour, min(hour) AS h0 FROM h),
hourly AS (SELECT spine.hour - h0 AS t, """ + ", ".join(
    f"coalesce({k}, 0.0) AS {k}" for k in ("click", "view", "purchase", "signup", "error", "total")
) + """ FROM spine LEFT JOIN h ON spine.hour = h.hour)"""

# ---- graphs ---------------------------------------------------------------------------------------


def chain_edges(t: Tables) -> DataFrame:
    """Supplier graph: suppliers of consecutive lines of an order; weight = how often, src < dst."""
    cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    n = t.lineitem.count()  # from the files' footers
    lines = rank_within(t.lineitem.select(*cols), [], [F.col(c).asc() for c in cols], "i", n).select("i", "l_orderkey", "l_suppkey")
    return (
        pair_consecutive(lines, "i", ranges_for(lines, n))  # no window per order, so an order of any length is split
        .where("l_orderkey = l_orderkey_next AND l_suppkey <> l_suppkey_next")
        .groupBy(F.least("l_suppkey", "l_suppkey_next").alias("src"), F.greatest("l_suppkey", "l_suppkey_next").alias("dst"))
        .agg(F.count("*").cast("double").alias("weight"))
    )


def supplier_attrs(t: Tables) -> DataFrame:
    return t.supplier.join(t.embeddings, F.col("s_suppkey") == F.col("vec_id")).select(
        F.col("s_suppkey").alias("id"), F.col("embedding").alias("attrs")
    )


def nation_communities(t: Tables) -> DataFrame:
    """A starting partition: suppliers grouped by nation."""
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("bigint").alias("comm"))


CHAIN = """steps AS (SELECT l_suppkey AS a, lead(l_suppkey) OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM lineitem),
edges AS (SELECT least(a, b) AS src, greatest(a, b) AS dst, CAST(count(*) AS DOUBLE) AS weight
  FROM steps WHERE b IS NOT NULL AND a <> b GROUP BY ALL),
comm AS (SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS comm FROM supplier)"""


def snapshot_edges(t: Tables) -> DataFrame:
    """Per day one edge per event: user to item key of the event."""
    day = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 86400)
    return t.events.select(
        day.alias("snap"), F.col("user_id").alias("src"),
        (F.lit(1000000) + F.get_json_object("props", "$.k").cast("bigint")).alias("dst"),
    )


SNAPS = """snaps AS (SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS snap, user_id AS src,
  1000000 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst FROM events)"""


def ratings(t: Tables) -> DataFrame:
    """(user, movie, rating, line_no) as raw rating lines."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user"), F.col("l_partkey").cast("string").alias("movie"),
        F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.col("l_quantity") / 10)).alias("rating"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("line_no"),
    )


def movie_dims(t: Tables) -> dict[str, DataFrame]:
    """Director = brand, actor = suppliers of the part, genre = type."""
    movie = F.col("p_partkey").cast("string").alias("movie")
    actors = t.lineitem.select(F.col("l_partkey").cast("string").alias("movie"), F.concat(F.lit("supplier"), F.col("l_suppkey")).alias("name"))
    return {
        "director": t.part.select(movie, F.col("p_brand").alias("name")),
        "actor": actors.distinct(),
        "genre": t.part.select(movie, F.col("p_type").alias("name")),
    }


RATINGS = """rate0 AS (SELECT 'u' || o_custkey AS u, 'm' || l_partkey AS m,
    CAST(round(least(5.0, greatest(1.0, l_quantity / 10))) AS BIGINT) AS rating,
    row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rate AS (SELECT u, m, rating FROM rate0 WHERE rn = 1)"""

# ---- image tags -----------------------------------------------------------------------------------


def image_tags(t: Tables) -> DataFrame:
    """(name, tags): the distinct tokens of the document with the image's id."""
    return t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id"), "left_semi").select(
        F.col("doc_id").cast("string").alias("name"),
        F.array_distinct(X.tokens("text", sep=None, min_len=3)).alias("tags"),
    ).where(F.size("tags") > 0)


TAGS = r"""tag_rows AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS name,
    unnest(list_transform(list_filter(string_split_regex(text, '\s+'), lambda w: length(w) >= 3), lambda w: lower(w))) AS tag
  FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings))"""
