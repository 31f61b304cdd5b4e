"""Word statistics, discriminative vocabulary, naive Bayes, logistic regression, document vectors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import dense_index, top_rows
from .skipgram import mean_vectors, skip_gram


def doc_words(docs: DataFrame) -> DataFrame:
    """One row per token occurrence."""
    return docs.select(*[c for c in docs.columns if c != "tokens"], F.explode("tokens").alias("word"))


def term_counts(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Occurrences per word; a word counts each time it occurs in a document."""
    return doc_words(docs).groupBy(*(by or []), "word").agg(F.count("*").alias("n"))


def doc_freq(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Documents per word: duplicates go away inside the row, so no distinct shuffle is needed."""
    once = docs.withColumn("tokens", F.array_distinct("tokens"))
    return term_counts(once, by).withColumnRenamed("n", "df")


corpus_counts = term_counts


def drop_stopwords(counts: DataFrame, stopwords: DataFrame) -> DataFrame:
    return counts.join(stopwords.select("word"), "word", "left_anti")


def class_counts(docs: DataFrame, pos, neg, unique: bool = False) -> DataFrame:
    """(word, pos, neg) with 0 where a class lacks the word."""
    rows = docs.withColumn("tokens", F.array_distinct("tokens")) if unique else docs
    return doc_words(rows).groupBy("word").agg(
        F.count(F.when(F.col("label") == pos, 1)).alias("pos"), F.count(F.when(F.col("label") == neg, 1)).alias("neg")
    )


def select_features(
    docs: DataFrame, stopwords: DataFrame, pos=1, neg=0, min_frac: float = 0.01, ratio: float = 2.0,
    fit_on: str | None = None, unique: bool = False,
) -> DataFrame:
    """Words frequent in one class and at least ``ratio`` times as frequent as in the other.

    By default train and test documents are used, and occurrences are counted; ``fit_on='train'``
    and ``unique=True`` (documents instead of occurrences) are the cleaner variants.
    """
    d = docs if fit_on is None else docs.where(F.col("split") == fit_on)
    n_pos = d.where(F.col("label") == pos).select(F.count("*")).scalar()
    n_neg = d.where(F.col("label") == neg).select(F.count("*")).scalar()
    c = drop_stopwords(class_counts(d, pos, neg, unique), stopwords)
    p, n = F.col("pos"), F.col("neg")
    return c.where(
        ((p >= n_pos * min_frac) & (p >= n * ratio)) | ((n >= n_neg * min_frac) & (n >= p * ratio))
    )


def vectorize(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Binary vectors as sorted index lists over the sorted vocabulary; documents without a feature keep an empty list."""
    idx = dense_index(vocab, "word")
    once = docs.withColumn("tokens", F.array_distinct("tokens"))
    hits = doc_words(once.select("doc_id", "tokens")).join(idx, "word").groupBy("doc_id").agg(
        F.sort_array(F.collect_list("idx")).alias("features")
    )
    return docs.drop("tokens").join(hits, "doc_id", "left").withColumn(
        "features", F.coalesce("features", F.array().cast("array<bigint>"))
    )


def binary_bow(docs: DataFrame, vocab: list[str], out: str = "features") -> DataFrame:
    """Sparse 0/1 vectors for ``pyspark.ml``. The vocabulary comes from :func:`select_features`, whose
    frequency threshold bounds its size whatever the number of documents."""
    m = CountVectorizerModel.from_vocabulary(sorted(vocab), inputCol="tokens", outputCol=out)
    return m.setBinary(True).transform(docs)


def nb_bernoulli(train: DataFrame, vocab: DataFrame, classes: list, alpha: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Bernoulli naive Bayes by aggregation.

    Returns ``weights(word, w_<class>)``, the gain of seeing a word, and the one-row
    ``base(b_<class>)``, the score of an empty document.
    """
    per_class = train.groupBy().agg(*[F.count(F.when(F.col("label") == c, 1)).cast("double").alias(f"n_{c}") for c in classes])
    n = {c: per_class.select(f"n_{c}").scalar() for c in classes}
    once = train.withColumn("tokens", F.array_distinct("tokens"))
    seen = doc_words(once).groupBy("word").agg(*[F.count(F.when(F.col("label") == c, 1)).alias(f"c_{c}") for c in classes])
    p = {c: (F.coalesce(f"c_{c}", F.lit(0)) + alpha) / (n[c] + 2 * alpha) for c in classes}
    probs = vocab.select("word").join(seen, "word", "left").select("word", *[p[c].alias(f"p_{c}") for c in classes])
    weights = probs.select("word", *[(F.log(f"p_{c}") - F.log1p(-F.col(f"p_{c}"))).alias(f"w_{c}") for c in classes])
    total = sum((n[c] for c in classes), F.lit(0.0))
    base = probs.agg(*[(F.sum(F.log1p(-F.col(f"p_{c}"))) + F.log(F.max(n[c] / total))).alias(f"b_{c}") for c in classes])
    return weights, base


def nb_predict(docs: DataFrame, weights: DataFrame, base: DataFrame, classes: list) -> DataFrame:
    """(doc_id, label, s_<class>, pred); ties go to the first class."""
    once = docs.withColumn("tokens", F.array_distinct("tokens"))
    gain = doc_words(once.select("doc_id", "tokens")).join(weights, "word").groupBy("doc_id").agg(
        *[F.sum(f"w_{c}").alias(f"g_{c}") for c in classes]
    )
    s = docs.drop("tokens").join(gain, "doc_id", "left").withColumns(
        {f"s_{c}": F.coalesce(f"g_{c}", F.lit(0.0)) + base.select(f"b_{c}").scalar() for c in classes}
    ).drop(*[f"g_{c}" for c in classes])
    best = F.greatest(*[F.col(f"s_{c}") for c in classes])
    pred = F.coalesce(*[F.when(F.col(f"s_{c}") == best, F.lit(c)) for c in classes])
    return s.withColumn("pred", pred)


def nb_bernoulli_ml(train: DataFrame, features: str = "features"):
    return NaiveBayes(modelType="bernoulli", smoothing=1.0, featuresCol=features).fit(train)


def gaussian_model(train: DataFrame, dims: int, smoothing: float = 1e-9) -> DataFrame:
    """One row per class: label, log prior, means, variances. Variances get a floor of ``smoothing``
    times the largest variance of any dimension."""
    x = [F.col("embedding")[i].cast("double") for i in range(dims)]
    per = train.groupBy("label").agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in x]).alias("mu"), F.array(*[F.var_pop(c) for c in x]).alias("var")
    )
    # a single row of scalars: class and dimension counts do not grow with the data
    floor, n = train.agg(F.array_max(F.array(*[F.var_pop(c) for c in x])) * smoothing, F.count("*")).first()
    return per.select(
        "label", F.log(F.col("n") / n).alias("prior"), "mu", F.transform("var", lambda v: v + floor).alias("var")
    )


def gaussian_predict(df: DataFrame, model: DataFrame) -> DataFrame:
    """Adds ``pred``. The model (classes x dimensions numbers) enters as literals, so rows are not joined."""
    pred = None
    for m in model.orderBy("label").collect():
        terms = F.zip_with(
            F.zip_with(F.col("embedding"), F.lit(m["mu"]), lambda a, b: F.pow(a.cast("double") - b, F.lit(2.0))),
            F.lit(m["var"]), lambda d, v: -F.log(v * 6.283185307179586) / 2 - d / (v * 2),
        )
        s = F.struct((F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) + m["prior"]).alias("s"), F.lit(-m["label"]).alias("c"))
        pred = s if pred is None else F.greatest(pred, s)
    return df.withColumn("pred", -pred["c"])


def logreg(train: DataFrame, features: str = "features"):
    """L2-regularised logistic regression equal to unit penalty strength on the summed loss."""
    n = train.count()
    return LogisticRegression(
        featuresCol=features, regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=100
    ).fit(train)


def doc_vectors(
    docs: DataFrame, size: int = 100, window: int = 10, iters: int = 5, seed: int = 0, negative: int = 5, sample: float | None = 1e-4,
) -> DataFrame:
    """Document vectors: the mean of skip-gram word vectors trained on the same documents."""
    return mean_vectors(docs, skip_gram(docs, size, window, iters, negative, sample, 1, seed), size)


def context_pairs(docs: DataFrame, n: int = 5) -> DataFrame:
    """Sliding windows of ``n`` tokens: the centre and its n-1 neighbours; shorter documents give none."""
    mid = n // 2
    starts = F.when(F.size("tokens") >= n, F.sequence(F.lit(1), F.size("tokens") - (n - 1)))
    win = docs.select("doc_id", "tokens", F.explode(starts).alias("pos")).select(
        "doc_id", "pos", F.slice("tokens", F.col("pos"), n).alias("w")
    )
    return win.select(
        "doc_id", "pos", F.col("w")[mid].alias("center"),
        F.concat(F.slice("w", 1, mid), F.slice("w", mid + 2, n - mid - 1)).alias("contexts"),
    )


def top_words(counts: DataFrame, k: int = 1000) -> DataFrame:
    """Most frequent words, ties in word order."""
    return top_rows(counts, [F.desc("n"), F.asc("word")], k)
