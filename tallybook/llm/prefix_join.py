"""Exact set similarity of word shingles by a grouped prefix join.

1. One pass counts all shingles of all documents in a fixed table of counters (by hash). The counters order the shingles, rare ones first, ties by
   hash; any order gives right results, this one keeps common passages out of the prefixes.
2. A second pass writes each document's set size, a 128-bit key of its set, its prefix in that order and a parity bitmap of its set. Documents of equal
   sets are one class; only its smallest doc_id goes on. Classes of equal size and equal prefix are one group, and only a group's prefix is spread.
3. Two sets that reach the threshold have their first common shingle in both prefixes (for the smaller set in its shorter part). Groups that share one are
   paired and filtered by size and position, which holds for all members alike. In shingles of up to ``SMALL`` groups all pairs are made; in larger
   ones each group first meets, in ``STARS`` rounds, the leader that it shares most shingles with.
4. Group pairs are expanded: leaders are verified first, and members against their leader. What is then in one component needs no more
   comparison. The members of all other groups meet in blocks of bounded size inside tasks: pairs of different components that pass size,
   position and the bitmap's bound are verified, first the best one of a member and another component, then all that are left.
5. Verified means: on the full sets of words. The bitmap's bound (equal shingles cancel, so differing bits are at most the differing shingles) is exact, so
   no link is lost.

Defined results: a null or empty text, or one of white space, has no shingles and is linked with nothing; a text of fewer words than ``SHINGLE`` is one
shingle; repeated rows are one class; of rows with one doc_id and different texts one stands for the id; a null doc_id represents no class. Further
columns are ignored; an empty table gives no rows. Two shingles of one 64-bit hash (5e-20 a pair) are taken as one in the search, not in the verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import blob, cut, map_batches, map_stream, table
from .registry import query

SHINGLE, THRESHOLD = 3, (90, 100)
#: Counters that order the shingles (2^COUNTER_BITS), and those of one row of counts.
COUNTER_BITS, SLICE_BITS = 20, 13
#: Groups under a shingle that all meet; rounds against leaders in larger ones; members of a block.
SMALL, STARS, BLOCK = 16, 2, 1024
#: Bits of the parity bitmap.
BITMAP = 1024
_ODD = np.random.default_rng(3).integers(0, 1 << 63, 64, np.uint64) | np.uint64(1)
_REMEMBERED = 500_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None, width: int, known: WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of ``width`` words, sorted."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    k = min(n, width)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h += w[i : n - k + 1 + i] * _ODD[i]
    return np.unique(mixed(h))


def shingle_sets(text: bytes, width: int) -> set[bytes]:
    w = text.lower().split()
    return {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


class Rule:
    """Jaccard similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def short_prefix(self, n: Column) -> Column:
        """Of a set that meets no smaller one."""
        return n - F.ceil(2 * self.num * n / F.lit(self.num + self.den)) + 1

    def may(self, x: Column, y: Column) -> Column:
        """Whether rows (n, pos) that share a shingle at ``pos`` may hold their first common one there."""
        common = F.least(x["n"] - x["pos"], y["n"] - y["pos"])
        return (F.greatest(x["n"], y["n"]) * self.num <= F.least(x["n"], y["n"]) * self.den) & (common * (self.num + self.den) >= self.num * (x["n"] + y["n"])) & F.when(
            (x["n"] < y["n"]) | ((x["n"] == y["n"]) & (x["group"] < y["group"])), x["pos"] < self.short_prefix(x["n"])).otherwise(y["pos"] < self.short_prefix(y["n"]))

    def apart(self, differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether so many differing shingles are too many for sets of together ``sizes``."""
        return differing * (self.num + self.den) > (self.den - self.num) * sizes

    def holds(self, one: set, two: set) -> bool:
        common = len(one & two)
        return common > 0 and self.den * common >= self.num * (len(one) + len(two) - common)


def counters(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """How many distinct shingles of documents fall on each counter, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordHashes(), np.zeros(1 << COUNTER_BITS, np.int64)
        for b in batches:
            sets = [shingles(t, width, known) for t in blob(b.column(0))]
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
        rows = total.astype(np.uint32 if total.max() < 1 << 32 else np.uint64).reshape(-1, 1 << SLICE_BITS)
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([rows[k].astype(np.int64).tobytes() for k in at], pa.binary())], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(x, np.int64)
                total[k] = total[k] + x if k in total else x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    out = np.zeros((1 << (COUNTER_BITS - SLICE_BITS), 1 << SLICE_BITS), np.int64)
    tasks = map_stream(docs.select(F.col(text).cast("string")), count, schema)
    for r in map_stream(tasks.repartition("slice"), add, schema).collect():  # 8 MB at any size
        out[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def sketches(docs: DataFrame, order, doc_id: str, text: str, width: int, rule: Rule) -> DataFrame:
    """(doc_id, n, k1, k2, p1, p2, prefix, bits); null but for n = 0 without shingles. ``order`` broadcasts the counters."""

    def sketch(b: pa.RecordBatch) -> pa.RecordBatch:
        known, count = WordHashes(), order.value
        n, keys, prefixes, bits = [], [], [], []
        for t in blob(b.column(1)):
            s = shingles(t, width, known)
            n.append(len(s))
            if not len(s):
                keys.append((None,) * 4)
                prefixes.append(None)
                bits.append(None)
                continue
            first = s[np.lexsort((s, count[s >> np.uint64(64 - COUNTER_BITS)]))[: rule.prefix(len(s))]]
            keys.append(tuple(int(x.view(np.int64)) for y in (s, first) for x in (y.sum(), np.bitwise_xor.reduce(mixed(y)))))
            prefixes.append(first.view(np.int64))
            bits.append(np.packbits((np.bincount((s & np.uint64(BITMAP - 1)).astype(np.int64), minlength=BITMAP) & 1).astype(np.uint8)).tobytes())
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), *[pa.array([k[i] for k in keys], pa.int64()) for i in range(4)], pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
            ["doc_id", "n", "k1", "k2", "p1", "p2", "prefix", "bits"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, sketch, "doc_id bigint, n bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, prefix array<bigint>, bits binary")


def _bitmaps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITMAP // 64)


def bounded(pairs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """The ``pairs(a, b)`` that size and bitmaps leave open."""

    def run(x: pa.RecordBatch) -> pa.RecordBatch:
        na, nb = (x.column(c).to_numpy() for c in ("na", "nb"))
        differing = np.maximum(np.bitwise_count(_bitmaps(x.column("ba")) ^ _bitmaps(x.column("bb"))).sum(axis=1, dtype=np.int64), np.abs(na - nb))
        return x.select(["a", "b"]).take(pa.array(np.flatnonzero(~rule.apart(differing, na + nb))))

    one = members.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    two = members.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    return map_batches(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ba", "bb"), run, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, width: int, rule: Rule) -> DataFrame:
    """The ``pairs(a, b)`` whose full sets reach the threshold, by ``texts(node, text)``."""

    def run(x: pa.RecordBatch) -> pa.RecordBatch:
        ok, last, one = [], None, set()
        for i, (a, ta, tb) in enumerate(zip(x.column("a").to_pylist(), blob(x.column("ta")), blob(x.column("tb")), strict=True)):
            if a != last:
                last, one = a, shingle_sets(ta, width)
            if rule.holds(one, shingle_sets(tb, width)):
                ok.append(i)
        return x.select(["a", "b"]).take(pa.array(ok, pa.int64()))

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")
    return map_batches(both, run, "a bigint, b bigint")


class _Rows:
    """Rows of one pair of blocks."""

    def __init__(self, t: pa.Table, rule: Rule):
        self.rule = rule
        self.node, self.comp, self.n, self.pos, self.own = (t.column(c).to_numpy() for c in ("node", "comp", "n", "pos", "own"))
        self.bits = _bitmaps(t.column("bits"))

    def pairs(self, i: int, j: int, best: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows of block ``i`` and of block ``j`` (or two of one block) that the filters leave; with ``best`` one for each row and other component."""
        left, right = np.flatnonzero(self.own == i), np.flatnonzero(self.own == j)
        total = self.rule.num + self.rule.den
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for k, x in enumerate(left.tolist()):
            y = right[k + 1 :] if i == j else right
            y = y[self.comp[y] != self.comp[x]]
            sizes = self.n[y] + self.n[x]
            y = y[np.minimum(self.n[y] - self.pos[y], self.n[x] - self.pos[x]) * total >= self.rule.num * sizes]
            differing = np.maximum(np.bitwise_count(self.bits[y] ^ self.bits[x]).sum(axis=1, dtype=np.int64), np.abs(self.n[y] - self.n[x]))
            stay = ~self.rule.apart(differing, self.n[y] + self.n[x])
            y, differing = y[stay], differing[stay]
            if best and len(y) > 1:
                order = np.lexsort((y, differing, self.comp[y]))
                y = y[order][np.concatenate(([True], np.diff(self.comp[y][order]) != 0))]
            out.append((np.full(len(y), x), y))
        return tuple(np.concatenate(z) for z in zip(*out, strict=True)) if out else (left[:0], left[:0])


def block_pairs(rest: DataFrame, rule: Rule, best: bool) -> DataFrame:
    """(a, b) of different components that may reach the threshold, among members under one key of ``rest(key, m, node, comp, n, pos, bits)``."""
    blocks = F.ceil(F.col("m") / BLOCK)
    cols = ["key", "node", "comp", "n", "pos", "bits", "own"]
    placed = rest.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), blocks)).select(*cols, F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other"))
    placed = placed.select(*cols, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    at = ["key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compare() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            held.clear()
            x = _Rows(t, rule)
            a, b = x.pairs(t.column("i")[0].as_py(), t.column("j")[0].as_py(), best)
            a, b = x.node[a], x.node[b]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        last = None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in at]
            ends = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for s, e in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows], strict=True):
                here = tuple(int(k[s]) for k in keys)
                if here != last and held:
                    yield from compare()
                last = here
                held.append(batch.slice(s, e - s))
        if held:
            yield from compare()

    return map_stream(placed.repartition(*at).sortWithinPartitions(*at), run, "a bigint, b bigint").distinct()


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, small: int = SMALL,
) -> DataFrame:
    """(doc_id, n_shingles, class_id, group_id, component_id) per row of ``docs``.

    ``class_id`` and ``group_id`` are the smallest doc_id of the same set and of the same size and prefix, ``component_id`` the smallest that links reach.
    """
    rule = Rule(*threshold)
    order = docs.sparkSession.sparkContext.broadcast(counters(docs, text, width))
    every = cut(sketches(docs, order, doc_id, text, width, rule))
    same_set, same_prefix = ["n", "k1", "k2"], ["n", "p1", "p2"]
    classes = cut(every.where("k1 is not null").groupBy(*same_set).agg(F.min("doc_id").alias("node")))
    reps = every.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("node")).agg(
        F.max(F.struct(*same_set, "p1", "p2", "prefix", "bits")).alias("x")).select("node", "x.*")
    reps = cut(reps)
    groups = reps.groupBy(*same_prefix).agg(F.min("node").alias("group"), F.count("*").alias("size"))
    members = cut(reps.join(groups, same_prefix).select(
        "node", "group", "size", "n", "bits", F.when(F.col("node") == F.col("group"), F.col("prefix")).alias("prefix")))
    spread = members.where("node = group").select("group", "n", F.posexplode("prefix").alias("pos", "key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    at = cut(spread.join(shared, "key").withColumn("pos", F.col("pos").cast("bigint")))

    few = at.where(F.col("m") <= small).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("group", "n", "pos"))).alias("g"))
    met = few.select(F.explode(F.flatten(F.transform("g", lambda x, i: F.transform(
        F.filter(F.slice("g", i + 2, small), lambda y: rule.may(x, y)), lambda y: F.struct(x["group"].alias("a"), y["group"].alias("b")))))).alias("p"))
    met = cut(met.select("p.a", "p.b").distinct())
    own = members.where("node <> group").select(F.col("group").alias("a"), F.col("node").alias("b"))
    at = at.where(F.col("m") > small)
    involved = met.select(F.explode(F.array("a", "b")).alias("group")).unionByName(at.select("group")).unionByName(own.select(F.col("a").alias("group"))).distinct()
    active = members.join(involved, "group", "left_semi")
    texts = cut(docs.select(F.col(doc_id).cast("bigint").alias("node"), F.col(text).cast("string").alias("text")).join(
        active.select("node"), "node", "left_semi").groupBy("node").agg(F.max("text").alias("text")))
    comp = cut(active.select("node", F.col("node").alias("comp")))

    def linked(pairs: DataFrame) -> DataFrame:
        return cut(verified(cut(bounded(pairs, members, rule)), texts, width, rule))

    def joined(links: DataFrame, comp: DataFrame) -> DataFrame:
        """``comp`` after the components that ``links`` connect became one."""
        if not links.take(1):
            return comp
        ends = links.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("src")), "a").join(
            comp.select(F.col("node").alias("b"), F.col("comp").alias("dst")), "b")
        new = components(ends.select("src", "dst").where("src <> dst")).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        return cut(comp.join(new, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))

    def spans(comp: DataFrame) -> DataFrame:
        """(group, low, high): the least and the greatest component of a group's members."""
        return members.join(comp, "node").groupBy("group").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"))

    def open_keys(at: DataFrame, span: DataFrame) -> DataFrame:
        """Rows (key, group, n, pos) of shingles whose groups are not all in one component."""
        apart = at.join(span, "group").groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
        return at.join(apart.select("key"), "key", "left_semi")

    comp = joined(linked(met.unionByName(own)), comp)
    for k in range(STARS):
        heads = at.join(comp.withColumnRenamed("node", "group"), "group")
        pick = (F.min_by, F.max_by)[k % 2]
        lead = heads.groupBy("key").agg(pick(F.struct("group", "n", "pos", "comp"), "group").alias("h"))
        x, y = F.struct("group", "n", "pos"), F.struct(F.col("h.group").alias("group"), F.col("h.n").alias("n"), F.col("h.pos").alias("pos"))
        star = heads.join(lead, "key").where(F.col("comp") != F.col("h.comp")).where(rule.may(x, y)).groupBy("group", F.col("h.group").alias("head")).agg(F.count("*").alias("c"))
        best = star.groupBy("group").agg(F.max_by("head", F.struct("c", "head")).alias("head"))
        comp = joined(linked(best.select(F.least("group", "head").alias("a"), F.greatest("group", "head").alias("b"))), comp)
        at = cut(open_keys(at, spans(comp)))
    for best in (True, False):
        span = cut(spans(comp))
        # the members of a group, of a pair of groups and of a shingle's groups that may still hold a link
        alone = span.where("low <> high and size > 2").select("group").select(F.xxhash64("group").alias("key"), "group", F.lit(0).cast("bigint").alias("pos"))
        low, high = span.select(F.col("group").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("low", "high", "size")]), span.select(
            F.col("group").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("low", "high", "size")])
        two = met.join(low, "a").join(high, "b").where("least(low_a, low_b) <> greatest(high_a, high_b) and size_a + size_b > 2")
        two = two.select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("group"), F.lit(0).cast("bigint").alias("pos"))
        many = open_keys(at, span).select("key", "group", "pos")
        rest = cut(alone.unionByName(two).unionByName(many).join(members.select("node", "group", "n", "bits"), "group").join(comp, "node"))
        rest = rest.join(rest.groupBy("key").agg(F.count("*").alias("m")), "key")
        comp = joined(linked(block_pairs(rest, rule, best)), comp)
    found = classes.join(members.select("node", "group"), "node", "left").join(comp, "node", "left").select(*same_set, "node", "group", "comp")
    return every.select("doc_id", *same_set).join(found, same_set, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("node", "doc_id").alias("class_id"), F.coalesce("group", "node", "doc_id").alias("group_id"),
        F.coalesce("comp", "node", "doc_id").alias("component_id"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS pos, g FROM s JOIN (SELECT g, count(*) AS df FROM s GROUP BY 1) USING (g) JOIN n USING (doc_id)),
f AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  WHERE 100 * a.pos <= 10 * a.n + 100 AND 100 * b.pos <= 10 * b.n + 100),
l AS (SELECT f.a, f.b FROM f JOIN s x ON x.doc_id = f.a JOIN s y ON y.doc_id = f.b AND y.g = x.g JOIN n p ON p.doc_id = f.a JOIN n q ON q.doc_id = f.b
  GROUP BY f.a, f.b, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a AS id, a AS other FROM e UNION SELECT r.id, e.b FROM reach r JOIN e ON r.other = e.a),
comp AS (SELECT id, min(other) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON id = d.doc_id
"""


@query("op12_prefix_join", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
