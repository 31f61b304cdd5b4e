"""Queries over documents, messages and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions import text as X
from ..functions import vectors as VEC
from ..functions.hashing import draw
from ..operators import metrics as M
from ..operators import textclass as TC
from ..operators.facts import union_all
from ..session import cut
from ..sources.messages import filter_feed
from ..streaming import polarity as S
from . import views as V
from .registry import query
from .views import DOCS, LEXICONS, MESSAGE_WORDS

# fixed values: function words of the four languages in the documents
STOPWORDS = ("the", "and", "that", "for", "der", "die", "und", "les", "des", "que", "los", "las")


def stopwords(t):
    return t.spark.createDataFrame([(w,) for w in STOPWORDS], "word string")


STOP_SQL = "stop(word) AS (VALUES " + ", ".join(f"('{w}')" for w in STOPWORDS) + ")"


@query("text_functions", r"""
SELECT doc_id, CAST(length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS BIGINT) AS ascii_len,
  CAST(length(regexp_replace(text, '[[:punct:]]', '', 'g')) AS BIGINT) AS nopunct_len,
  CAST(length(regexp_replace(text, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) AS BIGINT) AS edge_len,
  CAST(len(string_split(text, ' ')) AS BIGINT) AS n_blank_tokens,
  CAST(len(list_filter(string_split_regex(text, '\s+'), lambda w: length(w) >= 3)) AS BIGINT) AS n_words,
  md5(lower(text)) AS lower_md5,
  coalesce(list_sum(list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: coalesce(TRY_CAST(x AS BIGINT) % 1000003, 0))), 0)::BIGINT AS ints,
  CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, true AS same
FROM documents""")
def text_functions(t):
    ints = F.aggregate(X.extract_ints("text"), F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x % 1000003, F.lit(0)))
    n = lambda c: F.length(c).cast("bigint")
    return t.documents.select(
        "doc_id", n(X.strip_non_ascii("text")).alias("ascii_len"), n(X.strip_punct("text")).alias("nopunct_len"),
        n(X.strip_edge_punct("text")).alias("edge_len"),
        F.size(X.tokens("text", " ")).cast("bigint").alias("n_blank_tokens"),
        F.size(X.words("text", 3)).cast("bigint").alias("n_words"),
        F.md5(F.lower("text").cast("binary")).alias("lower_md5"), ints.alias("ints"),
        n(X.to_utf8("text")).alias("n_bytes"), (X.from_utf8(X.to_utf8("text")) == F.col("text")).alias("same"),
    )


@query("filter_feed", """SELECT doc_id, lang, n_chars FROM documents
WHERE lang IN ('en') AND regexp_matches(text, '(^|\\W)(the|that)(\\W|$)', 'i')""")
def feed(t):
    return filter_feed(t.documents, ["en"], text="text", track=["the", "that"]).select("doc_id", "lang", "n_chars")


@query("vector_functions", """WITH p AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
s AS (SELECT *, list_transform(x, lambda v: v > 0) AS sx, list_transform(y, lambda v: v > 0) AS sy FROM p)
SELECT vec_id, round(list_cosine_similarity(x, y), 6) AS cosine, round(list_dot_product(x, y), 6) AS dot,
  CAST(len(list_filter(list_zip(sx, sy), lambda z: z[1] = z[2])) AS BIGINT) AS matches,
  CAST(len(list_filter(list_zip(sx, sy), lambda z: z[1] <> z[2])) AS BIGINT) AS hamming,
  round(ln(1 + exp(-list_dot_product(x, y))), 6) AS loss_linked, round(ln(1 + exp(list_dot_product(x, y))), 6) AS loss_unlinked,
  round(1 - exp(abs(list_cosine_similarity(x, y)) - 1), 6) AS psi FROM s""")
def vector_functions(t):
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    sign = lambda c: F.transform(c, lambda v: v > 0)
    return t.embeddings.withColumnRenamed("embedding", "x").join(b, "vec_id").select(
        "vec_id", F.round(VEC.cosine("x", "y"), 6).alias("cosine"), F.round(VEC.dot("x", "y"), 6).alias("dot"),
        VEC.match_count(sign("x"), sign("y")).alias("matches"), VEC.hamming(sign("x"), sign("y")).alias("hamming"),
        F.round(VEC.pair_loss("x", "y", F.lit(1.0)), 6).alias("loss_linked"),
        F.round(VEC.pair_loss("x", "y", F.lit(-1.0)), 6).alias("loss_unlinked"),
        F.round(P.psi(F.abs(VEC.cosine("x", "y"))), 6).alias("psi"),
    )


# ---- polarity -------------------------------------------------------------------------------------

POLAR = f"WITH {LEXICONS},\n{MESSAGE_WORDS}," + """
flags AS (SELECT sec, CASE WHEN p.word IS NULL THEN 0 ELSE 1 END AS p, CASE WHEN n.word IS NULL THEN 0 ELSE 1 END AS n
  FROM msg_words m LEFT JOIN pos p ON m.word = p.word LEFT JOIN neg n ON m.word = n.word)"""
UNFOLD = """ SELECT {k} 'positive' AS polarity, CAST(positive AS BIGINT) AS cnt FROM s
UNION ALL SELECT {k} 'negative', CAST(negative AS BIGINT) FROM s"""


def _lex(t):
    return V.messages(t), V.positive_words(t), V.negative_words(t)


@query("polarity_running", POLAR + ", s AS (SELECT sum(p) AS positive, sum(n) AS negative FROM flags)" + UNFOLD.format(k=""))
def polarity_running(t):
    return S.polarity_running(*_lex(t))


WINDOWED = POLAR + """,
s AS (SELECT CAST(1704067200 + sec // 10 * 10 AS BIGINT) AS start, sum(p) AS positive, sum(n) AS negative FROM flags GROUP BY 1)"""


@query("polarity_windows", WINDOWED + UNFOLD.format(k="start,"))
def polarity_windows(t):
    return S.polarity_counts(*_lex(t), window="10 seconds")


@query("polarity_series", WINDOWED + """, spine AS (SELECT unnest(range(min(start), max(start) + 10, 10)) AS start FROM s)
SELECT CAST((start - (SELECT min(start) FROM s)) // 10 AS BIGINT) AS step, CAST(coalesce(positive, 0) AS BIGINT) AS positive,
  CAST(coalesce(negative, 0) AS BIGINT) AS negative FROM spine LEFT JOIN s USING (start)""")
def polarity_series(t):
    return S.polarity_series(S.polarity_counts(*_lex(t), window="10 seconds"))


@query("lexicon", f"WITH {LEXICONS}" + """
SELECT word, CAST(max(p) AS BIGINT) AS is_pos, CAST(max(n) AS BIGINT) AS is_neg FROM
(SELECT word, 1 AS p, 0 AS n FROM pos UNION ALL SELECT word, 0, 1 FROM neg) GROUP BY 1""")
def lexicon(t):
    return S.lexicon_flags(V.positive_words(t), V.negative_words(t))


# ---- classification -------------------------------------------------------------------------------

WORDS = f"WITH {DOCS},\n{STOP_SQL}"


@query("stopword_counts", WORDS + """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM doc_words WHERE word NOT IN (SELECT word FROM stop) GROUP BY 1""")
def stopword_counts(t):
    return TC.drop_stopwords(TC.term_counts(V.labeled_docs(t)), stopwords(t))


@query("doc_freq", WORDS + " SELECT label, word, CAST(count(DISTINCT doc_id) AS BIGINT) AS df FROM doc_words GROUP BY ALL")
def doc_freq(t):
    return TC.doc_freq(V.labeled_docs(t), ["label"])


VOCAB = WORDS + """,
cc AS (SELECT word, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM doc_words
  WHERE word NOT IN (SELECT word FROM stop) GROUP BY 1),
tot AS (SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg FROM docs),
vocab AS (SELECT word, pos, neg FROM cc, tot
  WHERE (pos >= n_pos * 0.01 AND pos >= neg * 2) OR (neg >= n_neg * 0.01 AND neg >= pos * 2)),
vidx AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM vocab)"""


def vocab(t, docs=None):
    return TC.select_features(V.labeled_docs(t) if docs is None else docs, stopwords(t))


@query("class_vocab", VOCAB + " SELECT word, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg FROM vocab")
def class_vocab(t):
    return vocab(t)


@query("class_vocab_train", VOCAB.replace("FROM doc_words\n  WHERE", "FROM (SELECT label, unnest(tokens) AS word FROM docs WHERE split = 'train')\n  WHERE").replace(
    "AS n_neg FROM docs)", "AS n_neg FROM docs WHERE split = 'train')") + " SELECT word, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg FROM vocab")
def class_vocab_train(t):
    """The vocabulary of the training documents alone."""
    return TC.select_features(V.labeled_docs(t), stopwords(t), fit_on="train")


@query("bow_vectors", VOCAB + """,
f AS (SELECT DISTINCT doc_id, idx FROM doc_words JOIN vidx USING (word))
SELECT d.doc_id, label, split, CAST(count(idx) AS BIGINT) AS n_features, coalesce(string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY idx), '') AS features
FROM docs d LEFT JOIN f ON d.doc_id = f.doc_id GROUP BY ALL""")
def bow_vectors(t):
    d = cut(V.labeled_docs(t))
    return TC.vectorize(d, vocab(t, d)).select(
        "doc_id", "label", "split", F.size("features").cast("bigint").alias("n_features"),
        F.concat_ws(" ", F.col("features").cast("array<string>")).alias("features"),
    )


NB = VOCAB + """,
n AS (SELECT CAST(count(*) FILTER (label = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS n1 FROM docs WHERE split = 'train'),
seen AS (SELECT word, count(DISTINCT doc_id) FILTER (label = 0) AS c0, count(DISTINCT doc_id) FILTER (label = 1) AS c1
  FROM doc_words WHERE split = 'train' GROUP BY 1),
probs AS (SELECT word, (coalesce(c0, 0) + 1) / (n0 + 2) AS p0, (coalesce(c1, 0) + 1) / (n1 + 2) AS p1 FROM vocab LEFT JOIN seen USING (word), n),
base AS (SELECT sum(ln(1 - p0)) + max(ln(n0 / (n0 + n1))) AS b0, sum(ln(1 - p1)) + max(ln(n1 / (n0 + n1))) AS b1 FROM probs, n),
gain AS (SELECT doc_id, sum(ln(p0) - ln(1 - p0)) AS g0, sum(ln(p1) - ln(1 - p1)) AS g1
  FROM (SELECT DISTINCT doc_id, word FROM doc_words) JOIN probs USING (word) GROUP BY 1),
scored AS (SELECT d.doc_id, label, b0 + coalesce(g0, 0) AS s0, b1 + coalesce(g1, 0) AS s1
  FROM docs d LEFT JOIN gain g ON d.doc_id = g.doc_id, base WHERE split = 'test'),
pred AS (SELECT *, CASE WHEN s0 >= s1 THEN 0 ELSE 1 END AS pred FROM scored)"""


def nb_scored(t):
    d = cut(V.labeled_docs(t))
    weights, base = TC.nb_bernoulli(d.where("split = 'train'"), cut(vocab(t, d)), [0, 1])
    return TC.nb_predict(d.where("split = 'test'"), weights, base, [0, 1])


@query("nb_bernoulli", NB + " SELECT doc_id, label, round(s1 - s0, 4) AS margin, CAST(pred AS BIGINT) AS pred FROM pred")
def nb_bernoulli(t):
    return nb_scored(t).select("doc_id", "label", F.round(F.col("s_1") - F.col("s_0"), 4).alias("margin"), F.col("pred").cast("bigint").alias("pred"))


@query("confusion", NB + """
SELECT label, CAST(count(*) FILTER (pred = 0) AS BIGINT) AS pred_0, CAST(count(*) FILTER (pred = 1) AS BIGINT) AS pred_1,
  round(avg(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)) OVER (), 6) AS mean_recall FROM pred GROUP BY 1""")
def confusion(t):
    scored = nb_scored(t).select("label", "pred")
    table = M.confusion(scored, "label", "pred", [0, 1])
    recall = scored.groupBy("label").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("r"))
    return table.withColumn("mean_recall", F.round(recall.agg(F.avg("r")).scalar(), 6))


@query("nb_gaussian", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
l AS (SELECT vec_id, label, generate_subscripts(x, 1) AS d, unnest(x) AS v FROM e),
fl AS (SELECT max(vp) * 1e-9 AS f FROM (SELECT var_pop(v) AS vp FROM l GROUP BY d)),
m AS (SELECT label, d, avg(v) AS mu, var_pop(v) + max(f) AS vr FROM l, fl GROUP BY ALL),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM e)) AS prior FROM e GROUP BY 1),
s AS (SELECT vec_id, l.label, m.label AS cand, sum(-ln(2 * pi() * vr) / 2 - (v - mu) ** 2 / (2 * vr)) AS ll FROM l JOIN m USING (d) GROUP BY ALL),
r AS (SELECT vec_id, s.label, cand, row_number() OVER (PARTITION BY vec_id ORDER BY ll + prior DESC, cand) AS rn FROM s JOIN pr ON cand = pr.label)
SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(cand AS BIGINT) AS pred FROM r WHERE rn = 1""")
def nb_gaussian(t):
    model = TC.gaussian_model(t.embeddings, 64)
    return TC.gaussian_predict(t.embeddings, model).select(
        "vec_id", F.col("label").cast("bigint").alias("label"), F.col("pred").cast("bigint").alias("pred")
    )


@query("logreg")
def logreg(t):
    """Logistic regression on binary features, next to the library's Bernoulli naive Bayes."""
    d = V.labeled_docs(t)
    words = [r[0] for r in vocab(t).select("word").collect()]  # bounded by the frequency threshold
    x = TC.binary_bow(d, words).select("doc_id", F.col("label").cast("double").alias("label"), "split", "features")
    x = cut(x)
    train, test = x.where("split = 'train'"), x.where("split = 'test'")
    both = union_all(
        *[
            m.transform(test).select(F.lit(name).alias("model"), F.col("label"), F.col("prediction").alias("pred"))
            for name, m in (("logreg", TC.logreg(train)), ("nb", TC.nb_bernoulli_ml(train)))
        ]
    )
    return both.groupBy("model").agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))


@query("doc_vectors")
def doc_vectors(t):
    d = TC.doc_vectors(V.labeled_docs(t), size=100, window=10, iters=5, seed=5)
    train = d.select("doc_id", F.col("label").cast("double").alias("label"), "split", F.col("vector").alias("features"))
    train = cut(train)
    m = TC.logreg(train.where("split = 'train'"))
    return m.transform(train.where("split = 'test'")).select("doc_id", "label", F.col("prediction").alias("pred"))


# ---- windows and frequent words -------------------------------------------------------------------


@query("context_pairs", f"WITH {DOCS}," + """
w AS (SELECT tokens, unnest(range(1, len(tokens) - 3)) AS i FROM docs WHERE len(tokens) >= 5),
c AS (SELECT tokens[i + 2] AS center, tokens[i] || '|' || tokens[i + 1] || '|' || tokens[i + 3] || '|' || tokens[i + 4] AS ctx FROM w)
SELECT center, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST('0x' || substr(md5(ctx), 1, 8) AS BIGINT)) AS BIGINT) AS ctx_sum FROM c GROUP BY 1""")
def context_pairs(t):
    pairs = TC.context_pairs(V.labeled_docs(t), 5)
    return pairs.groupBy("center").agg(
        F.count("*").alias("n"), F.sum(draw(F.concat_ws("|", "contexts"))).alias("ctx_sum")
    )


@query("top_words", f"WITH {DOCS} SELECT word, CAST(count(*) AS BIGINT) AS n FROM doc_words GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1000")
def top_words(t):
    return TC.top_words(TC.corpus_counts(V.labeled_docs(t)), 1000)
