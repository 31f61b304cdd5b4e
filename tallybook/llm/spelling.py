"""Spelling variants by a dictionary of trie-node pairs.

1. Words are counted per task and summed by Spark; those of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences form the dictionary.
2. The nodes of the dictionary's trie (prefixes) and of the trie of the reversed words (suffixes) get integers. Words are range-partitioned
   in order, so a node's words are neighbours: the first word of a range that has the prefix names its node, by its place in the sorted
   dictionary. A node that reaches over the border of two ranges is named after its leftmost border; the border words are all that the driver sees.
3. A word w gives the pairs (node of w[:i], node of w[i+1:]), its letter i skipped, and (node of w[:i], node of w[i:]), a letter
   inserted at i. Two words differ by a replaced letter if they share a skipped pair, by an inserted one if a skipped pair of the longer is an
   inserted pair of the shorter. A node with a single word can't be shared, so only pairs of two nodes of several words are kept; nothing is lost.
4. The words of a pair differ in one letter, so there are at most as many as letters and one more. Each learns how many others there are and the best of
   them; the pairs of words themselves are never written. The same deletion in a run of equal letters ("abbb") counts at the run's start only.

Defined results: a null or empty text has no words; a null doc_id is hashed as an empty one; repeated rows are counted each; further columns are
ignored; an empty table gives no rows. A deletion may hit any code point of a word, also in words of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blob, cut, map_stream, table
from .registry import query

MIN_LENGTH, MIN_COUNT = 5, 3
#: A word of a document whose hash this divides loses one code point.
TYPO_EVERY = 97
#: A form has at least so many times the occurrences of its variant.
FORM_RATIO = 2
#: Words of a range of the sorted dictionary, about.
RANGE_WORDS = 20_000
_FLUSH = 400_000
#: UTF-8 bytes of A-Z (as a-z), a-z and U+00C0..U+00FF stay, all else is a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 128 <= b <= 191 or b == 0xC3 else 32 for b in range(256))
_OTHER = re.compile(rb"[\xc2\xc4-\xf7][\x80-\xbf]+")


def runs(text: bytes | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0..U+00FF, A-Z lower-cased."""
    return _OTHER.sub(b" ", text).translate(_BYTES).split() if text else []


def misspelt(run: bytes, h: int) -> bytes:
    """The run without its code point ``h`` modulo its length."""
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with planted deletions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            long = [w for w in total if len(w) - w.count(b"\xc3") >= min_length]
            return pa.RecordBatch.from_arrays([pa.array(long, pa.binary()).cast(pa.string()), pa.array([total[w] for w in long], pa.int64())], ["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), blob(b.column(1)), strict=True):
                start = crc32(f"{'' if i is None else i}:".encode())
                for w, n in Counter(runs(t)).items():
                    if len(w) < min_length:
                        continue
                    h = crc32(w, start)
                    total[misspelt(w, h) if h % TYPO_EVERY == 0 else w] += n
                if len(total) > _FLUSH:
                    yield out()
                    total.clear()
        if total:
            yield out()

    rows = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string"))
    return map_stream(rows, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class Borders:
    """What a range must know of the others: where its words start in the sorted dictionary, and the nodes that reach over its borders."""

    def __init__(self, parts: list[tuple[int, bytes, bytes, int]]):
        """``parts``: (number, first word, last word, length of all words and one each) of the ranges in order."""
        self.of: dict[int, tuple] = {}
        shared: list[list[int]] = [[]]  # names of the nodes over the border before each range
        named, offset = 0, 0
        for k in range(1, len(parts)):
            both = common_prefix(parts[k - 1][2], parts[k][1])
            back = common_prefix(parts[k - 2][2], parts[k - 1][2]) if k > 1 else -1
            before = shared[-1]
            shared.append([before[i] if i <= back and i < len(before) else -(named + i) - 1 for i in range(both + 1)])
            named += both + 1
        shared.append([])
        for k, (number, _, _, length) in enumerate(parts):
            left = parts[k - 1][2] if k else None
            right = parts[k + 1][1] if k + 1 < len(parts) else None
            self.of[number] = offset, left, right, shared[k], shared[k + 1]
            offset += length


def nodes_of(words: list[bytes], offset: int, left: bytes | None, right: bytes | None, left_ids: list[int], right_ids: list[int]) -> list[list[int]]:
    """For each word of a range, in order, the nodes of its prefixes as far as another word shares them (the root at least)."""
    n = len(words)
    # common prefixes of neighbours, over the borders too; -1 where there is none
    near = [common_prefix(left, words[0]) if left is not None else -1, *map(common_prefix, words, words[1:]), common_prefix(words[-1], right) if right is not None else -1]
    to_right = near[1:]
    for k in range(n - 2, -1, -1):
        to_right[k] = min(to_right[k], to_right[k + 1])
    to_left, firsts, out, start = near[0], [], [], offset
    for k, w in enumerate(words):
        to_left = min(to_left, near[k])
        firsts[max(near[k], -1) + 1 if k else 0 :] = [start] * (len(w) + 1 - (max(near[k], -1) + 1 if k else 0))
        depth = max(near[k], near[k + 1], 0)
        out.append([left_ids[i] if i <= to_left else right_ids[i] if i <= to_right[k] else firsts[i] + i for i in range(depth + 1)])
        start += len(w) + 1
    return out


def numbered(words: DataFrame, ranges: int, back: bool) -> DataFrame:
    """(word, id, nodes) of ``words(word)``: nodes of the shared prefixes, or of the shared suffixes by length with ``back``.

    ``id`` is the place of the (reversed) word in the sorted dictionary.
    """
    key = F.reverse("word") if back else F.col("word")
    placed = words.select(key.alias("key")).repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id())
    placed = cut(placed)  # range bounds are sampled, so they are fixed before the rows are read twice
    ends = placed.groupBy("part").agg(F.min("key").alias("a"), F.max("key").alias("z"), F.sum(F.char_length("key") + 1).alias("length"))
    parts = sorted((r["part"], r["a"].encode("latin-1"), r["z"].encode("latin-1"), r["length"]) for r in ends.collect())  # one row a range
    borders = words.sparkSession.sparkContext.broadcast(Borders(parts).of)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            offset = borders.value[part][0]
            nodes = nodes_of(held, *borders.value[part])
            for k in range(0, len(held), 5000):
                some, ids = held[k : k + 5000], []
                for w in some:
                    ids.append(offset)
                    offset += len(w) + 1
                names = [(w[::-1] if back else w).decode("latin-1") for w in some]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ids, pa.int64()), pa.array(nodes[k : k + 5000], pa.list_(pa.int64()))], ["word", "id", "nodes"])

        for b in batches:
            for p, w in zip(b.column("part").to_pylist(), b.column("key").to_pylist(), strict=True):
                if p != part:
                    if held:
                        yield from out()
                    part, held = p, []
                held.append(w.encode("latin-1"))
        if held:
            yield from out()

    return map_stream(placed.repartition("part").sortWithinPartitions("part", "key").select("part", "key"), number, "word string, id bigint, nodes array<bigint>")


def node_pairs(dictionary: DataFrame) -> DataFrame:
    """(p, s, id, n, skip, head) of ``dictionary(word, n, id, prefixes, suffixes)``: pairs of shared nodes around a skipped or an inserted letter.

    ``head``: the skipped letter differs from the one before it.
    """
    length, letters = F.char_length("word"), F.split("word", "")
    low, high = length - F.size("suffixes"), F.size("prefixes") - 1  # letters i with a shared prefix w[:i] and a shared suffix w[i+1:]

    def of(lo, hi, skipped: bool):
        span = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return F.transform(span, lambda i: F.struct(
            F.get("prefixes", i).alias("p"), F.get("suffixes", length - i - (1 if skipped else 0)).alias("s"), F.lit(skipped).alias("skip"),
            (F.lit(skipped) & ((i == 0) | (F.get("_letters", i) != F.get("_letters", i - 1)))).alias("head")))

    skips = of(F.greatest(low, F.lit(0)), F.least(high, length - 1), True)
    inserts = of(F.greatest(low + 1, F.lit(0)), F.least(high, length), False)
    return dictionary.withColumn("_letters", letters).select("id", "n", F.explode(F.concat(skips, inserts)).alias("x")).select("x.p", "x.s", "id", "n", "x.skip", "x.head")


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): number of near words, and the best of them as (n, -id)."""
    one = F.struct("n", (-F.col("id")).alias("neg"), "skip", "head")
    met = pairs.groupBy("p", "s").agg(F.collect_list(one).alias("m")).where(F.size("m") > 1)  # at most one word a letter and one more
    met = met.select(F.filter("m", lambda x: ~x["skip"]).alias("ins"), F.reverse(F.array_sort(F.filter("m", lambda x: x["skip"]))).alias("skips"))
    met = met.withColumn("heads", F.filter("skips", lambda x: x["head"]))

    def best(x):
        return F.when(x.isNotNull(), F.struct(x["n"].alias("n"), x["neg"].alias("neg")))

    first, second, longer, shorter = F.get("skips", F.lit(0)), F.get("skips", F.lit(1)), F.get("heads", F.lit(0)), F.get("ins", F.lit(0))
    of_skip = F.transform("skips", lambda x: F.struct(
        x["neg"].alias("neg"), (F.size("skips") - 1 + F.when(x["head"], F.size("ins")).otherwise(0)).alias("c"),
        F.greatest(F.when(x["neg"] == first["neg"], best(second)).otherwise(best(first)), F.when(x["head"], best(shorter))).alias("best")))
    of_insert = F.transform("ins", lambda x: F.struct(x["neg"].alias("neg"), F.size("heads").alias("c"), best(longer).alias("best")))
    each = met.select(F.explode(F.concat(of_skip, of_insert)).alias("x")).where("x.c > 0")
    return each.groupBy((-F.col("x.neg")).alias("id")).agg(F.sum("x.c").alias("n_near"), F.max("x.best").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """(id, root) of ``forms(id, form)``: the end of the chain, whose known part doubles each round."""
    at = cut(forms.select("id", F.col("form").alias("root")))
    while True:
        step = at.join(at.select(F.col("id").alias("root"), F.col("root").alias("_next")), "root", "left")
        step = cut(step.select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        at = step.select("id", "root")
        if not step.where("moved").take(1):
            return at


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of the dictionary."""
    words = cut(word_counts(docs, doc_id, text, min_length, min_count))
    ranges = -(-words.count() // RANGE_WORDS) or 1
    forward = numbered(words, ranges, back=False).withColumnRenamed("nodes", "prefixes")
    backward = numbered(words, ranges, back=True).select("word", F.col("nodes").alias("suffixes"))
    dictionary = cut(words.join(forward, "word").join(backward, "word"))
    near = near_words(node_pairs(dictionary))
    names = dictionary.select("id", "word", "n")
    known = cut(names.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.neg")).alias("form")))
    chains = cut(known.where("form is not null").select("id", "form"))
    chains = chains.join(followed(chains), "id")
    for name in ("form", "root"):
        chains = chains.join(names.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n")), name)
    return known.drop("form").join(chains.select("id", F.col("form_word").alias("form"), "form_n", F.col("root_word").alias("root")), "id", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


# CRC-32 by a table of 256 entries that SQL builds
SQL = r"""
WITH RECURSIVE bits AS (SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) x(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY 1, 2),
b AS (SELECT *, list_transform(string_split(regexp_replace(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)), '(..)', '\1 ', 'g')[:-2], ' '), lambda x: ('0x' || x)::UBIGINT) AS bytes FROM r),
h AS (SELECT w, n, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c & 255, x))::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) AS h FROM b, tab),
d AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1
  HAVING length(word) >= 5 AND sum(n) >= 3),
s AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM d)),
g AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 2)) AS i FROM d)),
p AS (SELECT a.word, b.word AS near, b.n FROM s a JOIN s b ON a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM s a JOIN g b ON a.k = b.k UNION SELECT a.word, b.word, b.n FROM g a JOIN s b ON a.k = b.k),
q AS (SELECT word, count(*) AS n_near, max(n) AS best, arg_max(near, (n, [-unicode(x) FOR x IN string_split(near, '')])) AS near FROM p GROUP BY 1),
f AS (SELECT d.word, d.n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 2 * d.n THEN near END AS form, CASE WHEN best >= 2 * d.n THEN best END AS form_n FROM d LEFT JOIN q USING (word)),
walk AS (SELECT word, word AS root, form AS onward FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.onward)
SELECT f.word, n, n_near, form, form_n, root FROM f JOIN walk ON walk.word = f.word AND walk.onward IS NULL
"""


@query("op11_spelling", SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))
