"""Exact ranked lexical search: inner products over sparse ball trees.

1. The distinct terms of the items are numbered in Spark and form blocks of about ``BLOCK_TERMS`` rows (or one item); each block is a pass over the
   documents, whose terms outside the block add nothing to a score. A pass writes the length of each document and its counts of the block's terms.
2. Document count, total length and document frequencies are sums over all documents; they give the integer weight that a term adds to each document's
   score. These weights are the document's vector, and an item is the sum over its terms: an inner product.
3. Documents are range-partitioned by their two heaviest terms (then a hash, so no key is hot), so that neighbours in order are alike. A task reads its
   rows in chunks of ``CHUNK`` documents; each gets a ball tree over the order: ``FAN`` neighbours to a leaf, ``FAN`` nodes to the next. A node has the
   mean of its vectors and the largest distance from it, so a score below it is at most (item . mean) + |item| * radius. Only the item's
   terms count: the radius in their space is at most the root of the sum of each term's largest squared distance, which is kept beside its mean.
4. An item descends best-first: the node of the highest bound is opened next, until that bound is below its 50th best score. Bounds are computed in
   doubles and raised by far more than any rounding error; leaves are scored in integers. A bound equal to the score sought stays, as ties go by doc_id.
5. Each task keeps the best of its chunks for each item; the lists of the tasks, at most 50 rows an item and task, are merged by Spark.

Defined results: a null or empty text has no terms and is never found; null doc_ids come after all others; repeated documents are found each; items that
are equal in id and text are one, those of the same id and different texts are ranked apart; an item without terms finds nothing, nor does an empty
table. Further columns are ignored. Weights are exact below 2^53, which holds for counts up to 10^12 documents.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ordering import running
from .common import WORD_BYTES, blob, cut, lower_ascii, map_stream, table
from .registry import query

TOP = 50
#: Distinct terms of items (counted an item) that one pass over the documents serves, about.
BLOCK_TERMS = 100_000
#: Documents of a tree, and children of a node.
CHUNK, FAN = 8192, 16
#: Bounds are raised by this share of themselves and by one more: rounding of n terms in doubles is below n * 2^-52 of the sums.
SLACK = 1e-7
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def term_counts(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with terms: length, and numbers and counts of those in ``vocabulary`` (a broadcast dict)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in batches:
            n, ids, tfs = [], [], []
            for t in blob(b.column(1)):
                w = terms(t)
                n.append(len(w))
                own = Counter(filter(known.__contains__, w))
                ids.append(np.fromiter((known[x] for x in own), np.uint32, len(own)).tobytes())
                tfs.append(np.fromiter(own.values(), np.uint32, len(own)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_stream(rows, count, "doc_id bigint, n bigint, terms binary, counts binary").where("n > 0")


def document_frequencies(rows: DataFrame, size: int) -> DataFrame:
    """(term, df) of the ``size`` numbered terms, summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.uint32), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(df[at])], ["term", "df"])

    return map_stream(rows.select("terms"), count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def term_weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def parts_of(n: np.ndarray, counts: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What ``counts`` occurrences add per unit of term weight, in documents of ``n`` terms (each per count)."""
    m = 50 + np.array([50 * int(x) * n_docs // total for x in n], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


def weighted(rows: DataFrame, weights, n_docs: int, total: int) -> DataFrame:
    """(doc_id, place, terms, adds): what each term adds to a score, without zeros; documents of similar heaviest terms have close places."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            place, ids, adds, kept = [], [], [], []
            for k, (n, t, c) in enumerate(zip(b.column("n").to_pylist(), b.column("terms").to_pylist(), b.column("counts").to_pylist(), strict=True)):
                t, c = np.frombuffer(t, np.uint32), np.frombuffer(c, np.uint32).astype(np.int64)
                a = w[t] * parts_of(np.array([n]), c, n_docs, total)
                order = np.argsort(-a, kind="stable")
                order = order[a[order] > 0]
                if not len(order):
                    continue  # no item can find it
                t, a = t[order], a[order]
                kept.append(k)
                place.append(int(t[0]) << 31 | (int(t[1]) if len(t) > 1 else 0))
                ids.append(t.tobytes())
                adds.append(a.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(place, pa.int64()), pa.array(ids, pa.binary()), pa.array(adds, pa.binary())], ["doc_id", "place", "terms", "adds"])

    return map_stream(rows, weigh, "doc_id bigint, place bigint, terms binary, adds binary")


class BallTree:
    """Sparse vectors in order under nodes of ``FAN`` children; ``search`` improves the best documents of an item."""

    def __init__(self, terms_: list[np.ndarray], adds: list[np.ndarray]):
        self.start = np.concatenate(([0], np.cumsum([len(t) for t in terms_])))
        self.term, self.add = np.concatenate(terms_).astype(np.int64), np.concatenate(adds)
        n, value = len(terms_), self.add.astype(np.float64)
        doc = np.repeat(np.arange(n), np.diff(self.start))
        square = np.bincount(doc, value * value, n)
        self.known, local = np.unique(self.term, return_inverse=True)
        self.levels: list[np.ndarray] = []  # radius of each node, leaves first
        self.means: list[tuple[np.ndarray, ...]] = []  # by term: start, node, mean, largest squared distance from it
        wide = FAN
        while True:
            node, nodes = doc // wide, -(-n // wide)
            size = np.minimum(wide, n - np.arange(nodes) * wide)
            cells, back, uses = np.unique(local * nodes + node, return_inverse=True, return_counts=True)
            mean = np.bincount(back, value) / size[cells % nodes]
            off = np.zeros(len(cells))
            np.maximum.at(off, back, (value - mean[back]) ** 2)
            off = np.where(uses < size[cells % nodes], np.maximum(off, mean * mean), off) * (1 + SLACK)  # documents without the term
            norm = np.bincount(cells % nodes, mean * mean, nodes)
            apart = square - 2 * np.bincount(doc, value * mean[back], n) + norm[np.arange(n) // wide]
            # |x - c|^2 is a difference of larger numbers, so the error allowed for is a share of those
            apart = np.maximum(apart, 0) + SLACK * (square + norm[np.arange(n) // wide])
            self.levels.append(np.sqrt(np.maximum.reduceat(apart, np.arange(nodes) * wide)))
            self.means.append((np.searchsorted(cells // nodes, np.arange(len(self.known) + 1)), cells % nodes, mean, off))
            if nodes == 1:
                break
            wide *= FAN

    def bounds(self, item: np.ndarray) -> list[np.ndarray]:
        """For each level, more than any score of ``item`` (sorted terms) below its nodes."""
        at = np.searchsorted(self.known, item)
        at = at[(at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == item)]
        out = []
        for radius, (start, node, mean, off) in zip(self.levels, self.means, strict=True):
            dot, apart, here = np.zeros(len(radius)), np.zeros(len(radius)), np.zeros(len(radius))
            for k in at.tolist():
                x = slice(start[k], start[k + 1])
                y = node[x]  # a node stands once for a term
                dot[y] += mean[x]
                apart[y] += off[x]
                here[y] += 1
            out.append((dot + np.sqrt(here * np.minimum(apart, radius * radius))) * (1 + SLACK) + 1)
        return out

    def search(self, item: np.ndarray, flag: np.ndarray, least: int, visit) -> int:
        """Call ``visit(first document, scores)`` on the leaves that may hold a score of ``least`` or more; it returns the new ``least``.

        ``flag`` marks the item's terms among all. The number of leaves scored is returned.
        """
        bounds, top, seen = self.bounds(item), len(self.levels) - 1, 0
        heap = [(-bounds[top][0], top, 0)]
        while heap and -heap[0][0] >= least:
            _, level, node = heapq.heappop(heap)
            if level:
                below = bounds[level - 1]
                for child in range(node * FAN, min(len(below), (node + 1) * FAN)):
                    if below[child] >= least:
                        heapq.heappush(heap, (-below[child], level - 1, child))
                continue
            first = node * FAN
            rows = self.start[first : first + FAN + 1]
            span = slice(rows[0], rows[-1])
            # every document has an entry, so no piece is empty
            least, seen = visit(first, np.add.reduceat(np.where(flag[self.term[span]], self.add[span], 0), rows[:-1] - rows[0])), seen + 1
        return seen


class Best:
    """The highest (score, smallest doc_id) of one item."""

    def __init__(self, top: int):
        self.top, self.score, self.doc = top, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> int:
        """A document of a lower score can't enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def offer(self, score: np.ndarray, doc: np.ndarray) -> int:
        good = score >= self.least
        if good.any():
            score, doc = np.concatenate((self.score, score[good])), np.concatenate((self.doc, doc[good]))
            order = np.lexsort((doc, -score))[: self.top]
            self.score, self.doc = score[order], doc[order]
        return self.least


_NO_ID = np.iinfo(np.int64).max


def found_in(placed: DataFrame, items, size: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best of each task for ``items`` (a broadcast list of sorted term numbers), below ``size``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = items.value
        best = [Best(top) for _ in wanted]
        docs: list[int | None] = []
        terms_: list[np.ndarray] = []
        adds: list[np.ndarray] = []
        flag = np.zeros(size, bool)

        def chunk() -> None:
            tree = BallTree(terms_, adds)
            names = np.array([_NO_ID if d is None else d for d in docs], np.int64)
            for item, own in zip(wanted, best, strict=True):
                flag[item] = True
                tree.search(item, flag, own.least, lambda first, score, own=own: own.offer(score, names[first : first + len(score)]))
                flag[item] = False
            for x in (docs, terms_, adds):
                x.clear()

        for b in batches:
            for d, t, a in zip(b.column("doc_id").to_pylist(), b.column("terms").to_pylist(), b.column("adds").to_pylist(), strict=True):
                docs.append(d)
                terms_.append(np.frombuffer(t, np.uint32))
                adds.append(np.frombuffer(a, np.int64))
                if len(docs) == CHUNK:
                    chunk()
        if docs:
            chunk()
        for k, own in enumerate(best):
            if len(own.score):
                none = own.doc == _NO_ID
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(none), k, np.int64)), pa.array(own.doc, mask=none), pa.array(own.score)], ["item", "doc_id", "score"])

    return map_stream(placed, search, "item bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, item_text, rank, doc_id, score): the ``top`` documents of each item, by score and then doc_id."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("item_text")).distinct()
    found = F.array_distinct(F.regexp_extract_all(lower_ascii("item_text"), F.lit(_TERM), 0))
    wanted = cut(running(wanted.withColumn("words", found).where(F.size("words") > 0), [], [F.col("item_id"), F.col("item_text")], {
        "item": F.lit(1).cast("bigint"), "upto": F.size("words").cast("bigint")}).withColumn("block", F.floor(F.col("upto") / BLOCK_TERMS)))
    blocks = [r["block"] for r in wanted.select("block").distinct().orderBy("block").collect()]
    n_docs, total, out = None, None, None
    for block in blocks:
        here = wanted.where(F.col("block") == block)
        rows = here.select("item", "words").orderBy("item").collect()  # about BLOCK_TERMS words
        vocabulary = {w: k for k, w in enumerate(sorted({w for r in rows for w in r["words"]}))}
        shared = spark.sparkContext.broadcast({w.encode(): k for w, k in vocabulary.items()})
        counted = cut(term_counts(docs, shared, doc_id, text))
        if n_docs is None:
            n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        weights = np.zeros(len(vocabulary), np.int64)
        for r in document_frequencies(counted, len(vocabulary)).collect():  # a row a term of the block
            weights[r["term"]] = term_weight(n_docs, r["df"])
        ready = weighted(counted, spark.sparkContext.broadcast(weights), n_docs, total)
        parts = -(-n_docs // (2 * CHUNK))
        placed = ready.repartitionByRange(parts, F.col("place"), F.xxhash64("doc_id")).sortWithinPartitions("place", F.xxhash64("doc_id"))
        lists = spark.sparkContext.broadcast([np.sort(np.array([vocabulary[w] for w in r["words"]], np.int64)) for r in rows])
        best = found_in(placed.select("doc_id", "terms", "adds"), lists, len(vocabulary), top)
        first = rows[0]["item"]
        best = cut(best.withColumn("item", F.col("item") + first))
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = out.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(wanted.select("item", "item_id", "item_text"), "item").select("item_id", "item_text", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), s AS (SELECT count(*) AS big, sum(n)::HUGEINT AS l FROM n),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM i) GROUP BY 1, 2),
w AS (SELECT t, floor(1000 * ln((2 * big + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY t, big),
p AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big) // l))))::BIGINT AS score
  FROM tf JOIN w USING (t) JOIN i USING (t) JOIN n USING (doc_id), s GROUP BY 1, 2)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM p WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


@query("op13_ranked_search", SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("item_text")
