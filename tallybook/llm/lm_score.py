"""Cross-entropy difference of a target and a background language model.

Both are word bigram models of one vocabulary with the same smoothing, counted over all documents: the target over the documents
marked as such, the background over all others. Each document is scored by the models of the other half of the documents (by a hash
of doc_id), so its own words do not speak for it.

1. Words are named by 8-byte digests, so no task holds the vocabulary. Word pairs are counted per task and summed by Spark; word and context
   counts and the kinds of followers are sums over all pairs. Nothing is left out at any size.
2. log P(w | v), by Witten-Bell weights, is log(rest of v) + log P(w) + log(1 + c(v, w) / (kinds of v * P(w))). So a document's entropy is a sum of
   weights of its words, contexts and pairs. The last one is 0 where the other half does not have the pair, so the table of weights
   holds the pairs that stand in both halves, and all words.
3. The ``HOT`` most frequent entries of that table are sent to all tasks; what a task does not find there it sends to the table, by a join. Where
   an entry is found changes nothing in the sums; frequent ones would only crowd a key of the join.
4. A document's score is the mean over its tokens of log P(target) - log P(background).

Defined results: a text without words scores 0 with null entropies; a null label or none is background; repeated labels of a document
count as target if one does; without target or background documents a model knows only the uniform distribution.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BYTES, blob, cut, map_stream, table
from .registry import query

#: Entries of the weights that all tasks hold; the others are joined.
HOT = 1_000_000
_FLUSH, _REMEMBERED = 4_000_000, 500_000


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Digests(dict):
    """Word -> 8-byte digest, remembered up to a bound; 0 stands for the start of a text."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = got = int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True) or 1
        return got

    def of(self, text: bytes | None) -> np.ndarray:
        return np.array([self[w] for w in words(text)], np.int64)


def contexts_of(w: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), w[:-1]))


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights are kept by key: w for a word, ~v for a context, this for a pair."""
    u = w.view(np.uint64)
    return v ^ (u << np.uint64(1) | u >> np.uint64(63)).view(np.int64)


def _pair_key(v: Column, w: Column) -> Column:
    return v.bitwiseXOR(F.shiftleft(w, 1).bitwiseOR(F.shiftrightunsigned(w, 63)))


def _each(expr, names: str = "c") -> list[Column]:
    """``expr(k)`` of the four models (2 * target + half) as columns ``names`` + k."""
    return [expr(k).alias(f"{names}{k}") for k in range(4)]


def frequent(counts: DataFrame, limit: int) -> Column:
    """Which rows of ``counts(.., n)`` are those from the least count on that leaves at most ``limit`` rows."""
    kinds = sorted(((r["n"], r["rows"]) for r in counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("rows")).collect()), reverse=True)
    total, least = 0, 100_001
    for n, rows in kinds:  # at most 100,000 of them
        if total + rows > limit:
            break
        total, least = total + rows, n
    return F.col("n") >= least


def pair_counts(rows: DataFrame) -> DataFrame:
    """(v, w, c0..c3): counts of the word pairs of ``rows(_t, c)``; column 2 * target + half."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, held, tokens = Digests(), [], 0

        def out() -> pa.RecordBatch:
            v, w, c = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            _, at, back = np.unique(pair_keys(v, w), return_index=True, return_inverse=True)
            n = np.bincount(back * 4 + c, minlength=4 * len(at)).reshape(-1, 4)
            return pa.RecordBatch.from_arrays([pa.array(v[at]), pa.array(w[at]), *[pa.array(n[:, k].astype(np.int64)) for k in range(4)]], ["v", "w", "c0", "c1", "c2", "c3"])

        for b in batches:
            for t, c in zip(blob(b.column("_t")), b.column("c").to_pylist(), strict=True):
                w = digests.of(t)
                if len(w):
                    held.append((contexts_of(w), w, np.full(len(w), c, np.int8)))
                    tokens += len(w)
                if tokens > _FLUSH:
                    yield out()
                    tokens = 0
        if held:
            yield out()

    long = map_stream(rows.select("_t", "c"), count, "v bigint, w bigint, c0 bigint, c1 bigint, c2 bigint, c3 bigint")
    return long.groupBy("v", "w").agg(*_each(lambda k: F.sum(f"c{k}")))


def pair_codes(ids: bytes, size: int) -> np.ndarray:
    """Pairs (v, w) of word numbers of two bytes as v * size + w, v = size at the start."""
    w = np.frombuffer(ids, "<u2").astype(np.int64)
    return np.concatenate(([size], w[:-1])) * size + w


class Model:
    """Log-probabilities of one class and half over numbered words, in one process: what the weights add up to."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, words_: np.ndarray, contexts: np.ndarray, size: int):
        """``words_`` and ``contexts``: how often each word stands at all, and before another one (or the start)."""
        first, second = pairs // size, pairs % size
        kinds = np.bincount(first[counts > 0], minlength=size + 1) + 1.0
        alone = (words_ + 1.0) / (words_.sum() + size)
        mass = kinds / (contexts + kinds)
        self.alone, self.rest = np.log(alone).astype(np.float32), np.log(mass).astype(np.float32)
        self.pair = np.log((counts + kinds[first] * alone[second]) / (contexts[first] + kinds[first])).astype(np.float32)

    def log(self, at: np.ndarray, known: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.where(known, self.pair[at], self.rest[first] + self.alone[second])


def looked_up(pairs: DataFrame, by: str, entries: DataFrame, hot: DataFrame) -> DataFrame:
    """``pairs`` with ``entries(by, ..)``, of which the rows ``hot`` are sent to all tasks as they have most pairs."""
    near = F.broadcast(hot)
    return pairs.join(near, by).unionByName(pairs.join(near.select(by), by, "left_anti").join(entries.join(near.select(by), by, "left_anti"), by))


def weights(counts: DataFrame, hot_words: int) -> DataFrame:
    """(key, n, b0..b3): log-probability that each of ``n`` uses of a word, context or pair adds in each model."""
    seconds = cut(counts.groupBy("w").agg(*_each(lambda k: F.sum(f"c{k}"))).withColumn("n", F.expr("c0 + c1 + c2 + c3")))
    total = seconds.agg(F.count("*").alias("v"), *_each(lambda k: F.coalesce(F.sum(f"c{k}"), F.lit(0)))).first()
    size = total["v"] + 1  # with a place for words that no text has
    alone = seconds.select("w", "n", *_each(lambda k: (F.col(f"c{k}") + 1.0) / (total[f"c{k}"] + size), "p"))
    firsts = cut(counts.groupBy("v").agg(
        *_each(lambda k: F.sum(f"c{k}")), *_each(lambda k: F.count_if(F.col(f"c{k}") > 0) + 1.0, "q")).withColumn("n", F.expr("c0 + c1 + c2 + c3")))
    kinds = firsts.select("v", *_each(lambda k: F.col(f"q{k}"), "q"))
    both = counts.where("c0 + c2 > 0 and c1 + c3 > 0").withColumn("n", F.expr("c0 + c1 + c2 + c3"))
    both = looked_up(both, "v", kinds, kinds.join(firsts.where(frequent(firsts, hot_words)).select("v"), "v", "left_semi"))
    second = alone.drop("n")
    both = looked_up(both, "w", second, alone.where(frequent(seconds, hot_words)).drop("n"))
    return (
        alone.select(F.col("w").alias("key"), "n", *_each(lambda k: F.log(f"p{k}"), "b"))
        .unionByName(firsts.select(F.bitwise_not("v").alias("key"), "n", *_each(lambda k: F.log(F.col(f"q{k}") / (F.col(f"c{k}") + F.col(f"q{k}"))), "b")))
        .unionByName(both.select(_pair_key(F.col("v"), F.col("w")).alias("key"), "n", *_each(lambda k: F.log1p(F.col(f"c{k}") / (F.col(f"q{k}") * F.col(f"p{k}"))), "b")))
    )


def summed(rows: DataFrame, shared) -> DataFrame:
    """``rows(uid, doc_id, half, _t)`` with tokens ``n``, sums ``s0..s3`` over the entries at hand, and ``keys`` and ``uses`` of all other ones."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, (known, values) = Digests(), shared.value
        for b in batches:
            texts = [digests.of(t) for t in blob(b.column("_t"))]
            n = np.array([len(w) for w in texts], np.int64)
            sums, far = np.zeros((4, len(n))), []
            if n.sum():
                w = np.concatenate(texts)
                v = np.concatenate([contexts_of(x) for x in texts if len(x)])
                doc = np.repeat(np.arange(len(n)), n)
                for keys in (w, ~v, pair_keys(v, w)):
                    kinds, back = np.unique(keys, return_inverse=True)
                    at = np.minimum(np.searchsorted(known, kinds), max(0, len(known) - 1))
                    here = known[at] == kinds if len(known) else np.zeros(len(kinds), bool)
                    for k in range(4):
                        value = np.where(here, values[k][at], 0.0) if len(known) else np.zeros(len(kinds))
                        sums[k] += np.bincount(doc, value[back], len(n))
                    open_ = np.flatnonzero(~here[back])
                    codes, uses = np.unique(doc[open_] * len(kinds) + back[open_], return_counts=True)
                    far.append((codes // len(kinds), kinds[codes % len(kinds)], uses))
            d, keys, uses = (np.concatenate(x) for x in zip(*far, strict=True)) if far else [np.zeros(0, np.int64)] * 3
            order = np.argsort(d, kind="stable")
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(d, minlength=len(n))))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("doc_id"), b.column("half"), pa.array(n), *[pa.array(x) for x in sums],
                 pa.ListArray.from_arrays(ends, pa.array(keys[order], pa.int64())), pa.ListArray.from_arrays(ends, pa.array(uses[order], pa.int64()))],
                ["uid", "doc_id", "half", "n", "s0", "s1", "s2", "s3", "keys", "uses"])

    return map_stream(rows, add, "uid bigint, doc_id bigint, half int, n bigint, s0 double, s1 double, s2 double, s3 double, keys array<bigint>, uses array<bigint>")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_tokens, ce_target, ce_background, score) per row of ``docs``; ``target(doc_id)`` lists the target documents.

    ``hot``: most entries of the models that a task holds; it does not change the scores.
    """
    spark = docs.sparkSession
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("_t")).withColumn("half", half)
    marked = target.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(1).alias("y")).distinct()
    rows = named.join(marked.hint("shuffle_hash"), "doc_id", "left").select("_t", (2 * F.coalesce("y", F.lit(0)) + F.col("half")).alias("c"))
    entries = cut(weights(cut(pair_counts(rows)), min(hot, 200_000)))
    often = frequent(entries, hot)
    near = entries.where(often).drop("n").toArrow()  # at most ``hot`` rows
    order = np.argsort(near.column("key").to_numpy())
    shared = spark.sparkContext.broadcast((near.column("key").to_numpy()[order], [near.column(f"b{k}").to_numpy()[order] for k in range(4)]))
    found = cut(summed(named.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "half", "_t"), shared))

    def of(first: int, kind: str) -> Column:
        """The model of the other half; ``first``: 0 for the background, 2 for the target."""
        return F.when(F.col("half") == 0, F.col(f"{kind}{first + 1}")).otherwise(F.col(f"{kind}{first}"))

    far = found.select("uid", "half", F.explode(F.arrays_zip("keys", "uses")).alias("x")).select("uid", "half", "x.keys", "x.uses")
    far = far.join(entries.where(~often).drop("n"), F.col("keys") == F.col("key")).select(
        "uid", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("n"), (F.col("uses") * of(2, "b")).alias("a"), (F.col("uses") * of(0, "b")).alias("z"))
    whole = found.select("uid", "doc_id", "n", of(2, "s").alias("a"), of(0, "s").alias("z")).unionByName(far)
    whole = whole.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n_tokens"), F.sum("a").alias("a"), F.sum("z").alias("z"))
    per = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    out = whole.select("doc_id", "n_tokens", (-F.col("a") / per).alias("ce_target"), (-F.col("z") / per).alias("ce_background"))
    return out.withColumn("score", F.coalesce(F.col("ce_background") - F.col("ce_target"), F.lit(0.0)))


@query("op10_lm_score")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of good quality are the target."""
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, folder, "documents"), good)
