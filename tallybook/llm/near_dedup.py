"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts writes for each document the number of its shingles, a 128-bit key of its shingle set, a
   signature of one byte per hash function and the band keys of the full hash values.
2. Documents with equal sets are one class; only its smallest doc_id goes on.
3. Classes that share a band key are candidates. In a bucket of up to ``SMALL`` classes all meet. In larger ones each class first
   meets, in ``STARS`` rounds, one of its buckets' leaders, the one that it shares most bands with, so a group of copies costs a pair per
   copy. Only classes of a large bucket that are in different components after that meet each other: in blocks of bounded
   size inside a task, which compares signatures, then full shingle sets, and returns no more links than join components.
4. A candidate pair is compared one batch of signature bytes after another and pruned as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold is below ``MISS``. Survivors are confirmed on
   their full shingle sets, as sets of words, so no false link gets through.

Miss probability: a pair at exactly the threshold shares no band with probability (1 - 0.75^4)^28 = 2.4e-5 (2.4e-6 at 0.78), and is pruned
with about ``MISS`` per batch.

Defined results: a null or empty text, or one of white space, has no shingles and is linked with nothing; a text of fewer
words than ``SHINGLE`` is one shingle; repeated rows fall into one class; ``doc_id`` is taken as the key of a document, a
null one never represents others and is its own (null) component. Further columns pass through ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import blob, cut, map_batches, map_stream, table
from .registry import query

SHINGLE, BANDS, ROWS, BATCH = 5, 28, 4, 16
THRESHOLD = (75, 100)
MISS = 1e-7
#: Classes of a bucket that all meet; rounds against leaders (smallest, then largest member) in larger buckets.
SMALL, STARS = 16, 1
#: Members of a bucket that meet in one group of the block round, and rows of such groups compared at once.
BLOCK, CHUNK_ROWS = 256, 4096
_SEED = np.random.default_rng(20240601)
_A = _SEED.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32) | np.uint32(1)
_B = _SEED.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)
_C = _SEED.integers(0, 1 << 63, SHINGLE + ROWS + 1, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def shingle_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Distinct 64-bit shingle hashes, sorted."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    k = min(n, SHINGLE)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h += w[i : n - k + 1 + i] * _C[i]
    return np.unique(mix(h + np.uint64(k)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash function, over blocks of shingles."""
    x = mix(shingles).astype(np.uint32)
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, (_A[:, None] * x[None, i : i + 2048] + _B[:, None]).min(axis=1), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = mix(sig.astype(np.uint64)).reshape(BANDS, ROWS)
    return mix((rows * _C[SHINGLE : SHINGLE + ROWS]).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * _C[-1]).view(np.int64)


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, k1, k2, sig, bands); no keys, signature or bands without shingles."""

    def sketch(b: pa.RecordBatch) -> pa.RecordBatch:
        known = WordHashes()
        n, k1, k2, sigs, bands = [], [], [], [], []
        for t in blob(b.column(1)):
            s = shingle_hashes((t or b"").lower().split(), known)
            n.append(len(s))
            if not len(s):
                for x in (k1, k2, sigs, bands):
                    x.append(None)
                continue
            k1.append(int(s.sum().view(np.int64)))
            k2.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)))
            sig = signature(s)
            sigs.append((sig & np.uint32(255)).astype(np.uint8).tobytes())
            bands.append(band_keys(sig))
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
             pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "k1", "k2", "sig", "bands"],
        )

    return map_batches(
        docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), sketch,
        "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary, bands array<bigint>",
    )


@lru_cache
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """For each number of compared batches the least number of equal bytes that keeps a pair.

    With m of n equal and a uniform prior, P(p >= t) = P(Binomial(n + 1, t) <= m); a byte also agrees by chance, once in 256.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Indexes of the pairs (rows of ``a`` and ``b``) that no batch prunes."""
    left, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches(threshold, miss)):
        at = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (a[left, at] == b[left, at]).sum(axis=1, dtype=np.int32)
        stay = equal >= least
        left, equal = left[stay], equal[stay]
    return left


def _stack(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), BANDS * ROWS)


def prune(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The ``pairs(a, b)`` whose signatures leave a chance of reaching the threshold."""

    def run(x: pa.RecordBatch) -> pa.RecordBatch:
        sa, sb = _stack(x.column("sa").to_pylist()), _stack(x.column("sb").to_pylist())
        return pa.RecordBatch.from_pydict({c: x.column(c) for c in ("a", "b")}).take(pa.array(plausible(sa, sb, threshold, miss)))

    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
    return map_batches(both, run, "a bigint, b bigint")


def word_shingles(text: bytes) -> set[bytes]:
    """The shingles themselves, for exact sets."""
    w = text.lower().split()
    return {b" ".join(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()


def confirm(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs(a, b)`` whose full shingle sets reach the threshold, by ``texts(node, text)``."""

    def run(x: pa.RecordBatch) -> pa.RecordBatch:
        ok, last, one = [], None, set()
        for i, (a, ta, tb) in enumerate(zip(x.column("a").to_pylist(), blob(x.column("ta")), blob(x.column("tb")), strict=True)):
            if a != last:
                last, one = a, word_shingles(ta)
            two = word_shingles(tb)
            common = len(one & two)
            if common and den * common >= num * (len(one) + len(two) - common):
                ok.append(i)
        return pa.RecordBatch.from_pydict({c: x.column(c) for c in ("a", "b")}).take(pa.array(ok, pa.int64()))

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")
    return map_batches(both, run, "a bigint, b bigint")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, set): the distinct 64-bit shingle hashes of ``texts(node, text)``, sorted, as bytes."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        known = WordHashes()
        sets = [shingle_hashes((t or b"").lower().split(), known).tobytes() for t in blob(b.column("text"))]
        return pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], ["node", "set"])

    return map_batches(texts.select("node", "text"), run, "node bigint, set binary")


class _Block:
    """Rows of block groups, compared together: ``links`` joins components of which a pair reaches the threshold."""

    def __init__(self, t: pa.Table, threshold: tuple[int, int], miss: float):
        self.num, self.den, self.miss = *threshold, miss
        self.key, self.node, self.comp, self.own, self.i, self.j = (t.column(c).to_numpy() for c in ("key", "node", "comp", "own", "i", "j"))
        self.sig = _stack(t.column("sig").to_pylist())
        self.bands = np.stack(t.column("bands").to_numpy(zero_copy_only=False))
        self.raw = t.column("set").to_pylist()
        self.sets: dict[int, set[int]] = {}

    def set_of(self, x: int) -> set[int]:
        if x not in self.sets:
            self.sets[x] = set(np.frombuffer(self.raw[x], np.uint64).tolist())
        return self.sets[x]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Plausible pairs of different components, each only under the least band key that its members share."""
        n = len(self.key)
        new = np.flatnonzero((self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])) + 1
        ends = np.repeat(np.append(new, n), np.diff(np.concatenate(([0], new, [n]))))
        count = ends - np.arange(n) - 1
        x = np.repeat(np.arange(n), count)
        y = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count) + x + 1
        ok = (self.comp[x] != self.comp[y]) & ((self.i[x] == self.j[x]) | (self.own[x] != self.own[y]))
        x, y = x[ok], y[ok]
        least = least_matches(self.num / self.den, self.miss)
        equal = np.zeros(len(x), np.int32)
        for k, m in enumerate(least):
            at = slice(k * BATCH, (k + 1) * BATCH)
            equal = equal + (self.sig[x, at] == self.sig[y, at]).sum(axis=1, dtype=np.int32)
            stay = equal >= m
            x, y, equal = x[stay], y[stay], equal[stay]
        first = np.where(self.bands[x] == self.bands[y], self.bands[x], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        ok = first == self.key[x]
        return x[ok], y[ok]

    def links(self) -> list[tuple[int, int]]:
        up: dict[int, int] = {}

        def root(c: int) -> int:
            while up.get(c, c) != c:
                up[c] = c = up.get(up[c], up[c])
            return c

        out = []
        for x, y in zip(*(v.tolist() for v in self.candidates()), strict=True):
            p, q = root(int(self.comp[x])), root(int(self.comp[y]))
            if p == q:
                continue
            one, two = self.set_of(x), self.set_of(y)
            common = len(one & two)
            if self.den * common >= self.num * (len(one) + len(two) - common):
                up[max(p, q)] = min(p, q)
                out.append((int(self.node[x]), int(self.node[y])))
        return out


def _block_links(rest: DataFrame, threshold: tuple[int, int], miss: float) -> DataFrame:
    """Links (a, b) between different components among ``rest(key, n, node, comp, sig, bands, set)``, block against block."""
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks)
    cols = ["key", "node", "comp", "sig", "bands", "set", "own"]
    placed = rest.withColumn("own", own).select(*cols, F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other")).select(
        *cols, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    at = ["key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            held.clear()
            whole = t.num_rows
            if not last:  # the last group may go on
                key, i, j = (t.column(c).to_numpy() for c in at)
                before = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
                whole = int(before[-1]) + 1 if len(before) else 0
                held.extend(t.slice(whole).to_batches())
            if whole:
                found = _Block(t.slice(0, whole), threshold, miss).links()
                yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()), pa.array([max(p) for p in found], pa.int64())], ["a", "b"])

        for b in batches:
            for k in range(0, b.num_rows, CHUNK_ROWS):
                held.append(b.slice(k, CHUNK_ROWS))
                if sum(h.num_rows for h in held) >= CHUNK_ROWS:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return map_stream(placed.repartition(*at).sortWithinPartitions(*at), run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD, miss: float = MISS,
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) per row of ``docs``.

    ``class_id`` is the smallest doc_id with the same shingle set, ``component_id`` the smallest that links reach.
    """
    share = threshold[0] / threshold[1]
    every = cut(sketches(docs, doc_id, text))
    keys = ["n_shingles", "k1", "k2"]
    classes = cut(every.where("k1 is not null").groupBy(*keys).agg(F.min("doc_id").alias("node")))
    reps = every.select("doc_id", "sig", "bands").join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    reps = cut(reps.groupBy(F.col("doc_id").alias("node")).agg(F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    sigs = reps.select("node", "sig")
    banded = reps.select("node", F.explode("bands").alias("key"))
    size = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    at = cut(banded.join(size, "key").withColumn("comp", F.col("node")))
    members = at.select("node").distinct()
    texts = cut(docs.select(F.col(doc_id).cast("bigint").alias("node"), F.col(text).cast("string").alias("text"))
                .join(members, "node", "left_semi").dropDuplicates(["node"]))
    comp = cut(members.withColumn("comp", F.col("node")))

    def linked(pairs: DataFrame) -> DataFrame:
        return cut(confirm(cut(prune(pairs, sigs, share, miss)), texts, *threshold))

    def joined(links: DataFrame, comp: DataFrame) -> DataFrame:
        """``comp`` after the components that ``links`` connect became one."""
        if not links.take(1):
            return comp
        ends = links.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("src")), "a").join(
            comp.select(F.col("node").alias("b"), F.col("comp").alias("dst")), "b")
        new = components(ends.select("src", "dst").where("src <> dst")).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        return cut(comp.join(new, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))

    def open_buckets(at: DataFrame, comp: DataFrame) -> DataFrame:
        """Members of buckets that still hold more than one component."""
        at = at.drop("comp").join(comp, "node")
        apart = at.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
        return cut(at.join(apart, "key", "left_semi"))

    few = at.where(F.col("n") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list("node")).alias("m"))
    met = few.select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b"))))))
                     .alias("p")).select("p.a", "p.b").distinct()
    at = at.where(F.col("n") > SMALL)
    for k in range(STARS):
        pick = (F.min_by, F.max_by)[k % 2]
        heads = at.groupBy("key").agg(pick("node", "node").alias("head"), pick("comp", "node").alias("head_comp"))
        star = at.join(heads, "key").where("comp <> head_comp").groupBy("head", "node").agg(F.count("*").alias("c"))
        best = star.groupBy("node").agg(F.max_by("head", F.struct("c", "head")).alias("head"))
        pairs = best.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
        comp = joined(linked((pairs.unionByName(met) if k == 0 else pairs).distinct()), comp)
        at = open_buckets(at, comp)
    nodes = at.select("node").distinct()
    rest = at.join(reps.join(shingle_sets(texts.join(nodes, "node", "left_semi")), "node"), "node")
    comp = joined(linked(_block_links(rest, threshold, miss)), comp).withColumnRenamed("node", "id")
    found = classes.join(comp.withColumnRenamed("id", "node"), "node", "left").select(*keys, "node", "comp")
    return every.select("doc_id", *keys).join(found, keys, "left").select(
        "doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("class_id"), F.coalesce("comp", "node", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; repeated rows of one doc_id and null ids stay."""
    gone = near_duplicates(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a AS id, a AS other FROM e UNION SELECT r.id, e.b FROM reach r JOIN e ON r.other = e.a),
comp AS (SELECT id, min(other) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, d.doc_id = coalesce(c, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON id = d.doc_id
"""


@query("op7_near_dedup", SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
