"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The words of a document stream through the automaton, which gives at each word the length of the longest
match that ends there. Every match of ``window`` words or more marks its words; an item of fewer words is one
window as a whole. The automaton of a block of items is broadcast: a block holds at most ``BLOCK_CHARS`` characters
(or one item), and further blocks are further passes over the documents, so nothing unbounded is shipped.

Defined results: a null or empty text has no words and no hits; an item without words never occurs; repeated
items and repeated documents count each by itself; further columns of either table pass through or are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BYTES, blob, cut, fresh, map_batches, shielded, table
from .registry import query

WINDOW = 10
#: Characters of item text in one automaton; it has at most two states per word of it.
BLOCK_CHARS = 8_000_000
_FILTER_BITS = 20


class Automaton:
    """Suffix automaton of word sequences: ``scan`` yields the spans that windows cover and the items they come from."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.next, self.link, self.length, self.at = [{}], [-1], [0], [set()]
        whole: list[tuple[int, int, str]] = []
        pairs, shortest = set(), window
        for name, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if not ids:
                continue
            last = 0
            for n, c in enumerate(ids, 1):
                last = self._extend(last, c)
                if n >= window:
                    self.at[last].add(name)
            if len(ids) < window:
                whole.append((last, len(ids), name))
            shortest = min(shortest, len(ids))
            pairs.update(zip(ids, ids[1:], strict=False))
        self.shortest = shortest
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        if pairs:
            p = np.array(sorted(pairs), np.int64)
            self.seen[self._slot(p[:, 0], p[:, 1])] = True
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True)
        for v in order:  # items that end a window in a longer string end it in its suffixes, too
            up = self.link[v]
            if up and self.length[up] >= window:
                self.at[up] |= self.at[v]
        # states of whole short items: a word is cut off by the links only below its own length
        self.short: dict[int, list[tuple[int, str]]] = {}
        own: dict[int, list[tuple[int, str]]] = {}
        for state, n, name in whole:
            own.setdefault(state, []).append((n, name))
        if own:
            for v in reversed(order):
                got = self.short.get(self.link[v], []) + own.get(v, [])
                if got:
                    self.short[v] = got

    def _add(self, length: int, link: int, nxt: dict) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.at.append(set())
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the strings that end in state ``p`` plus ``c``."""
        copy = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # the string is known from an earlier item
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._add(self.length[last] + 1, 0, {}), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7_919) & ((1 << _FILTER_BITS) - 1)

    def regions(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of known word pairs, long enough for a window; every window lies inside one of them."""
        if self.shortest <= 1:
            return [(0, len(ids))]
        good = (ids[:-1] >= 0) & (ids[1:] >= 0) & self.seen[self._slot(ids[:-1], ids[1:])]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], good, [False])).view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        long = stop - start >= self.shortest - 1
        return [(int(a), int(b) + 1) for a, b in zip(start[long], stop[long], strict=True)]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered spans [start, stop), merged and in order, and the names of items with an occurring window."""
        if len(words) < self.shortest or not self.vocab:
            return [], set()
        get, window = self.vocab.get, self.window
        ids = np.array([get(w, -1) for w in words], np.int64)
        nxt, link, length, short = self.next, self.link, self.length, self.short
        spans: list[list[int]] = []
        names: set[str] = set()

        def cover(a: int, b: int) -> None:
            while spans and a <= spans[-1][1]:
                a = min(a, spans.pop()[0])
            spans.append([a, b])

        for a, b in self.regions(ids):
            v = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while v and c not in nxt[v]:
                    v = link[v]
                    n = length[v]
                v = nxt[v].get(c, 0)
                n = n + 1 if v else 0
                if n >= window:
                    cover(i + 1 - n, i + 1)
                    u = v
                    while length[link[u]] >= window:
                        u = link[u]
                    names |= self.at[u]
                if short and v in short:
                    for k, name in short[v]:
                        if k <= n:
                            cover(i + 1 - k, i + 1)
                            names.add(name)
        return [(x, y) for x, y in spans], names


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def item_blocks(items: DataFrame, item_id: str, text: str) -> list[list[tuple[str, list[bytes]]]]:
    """Items in blocks of bounded size; the driver streams them in order and holds them as the stated query set."""
    blocks, size = [[]], 0
    rows = items.select(F.col(item_id).cast("string"), F.col(text).cast("string")).where(F.col(text).isNotNull())
    for name, body in rows.toLocalIterator():
        if size + len(body) > BLOCK_CHARS and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append(("null" if name is None else name, split_words(body.encode())))
        size += len(body)
    return blocks


def find_overlap(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (array of word spans start, stop) and ``hit_items`` (sorted item ids as strings).

    ``keep`` names the columns to carry (all by default); columns of these three names are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "hits", "hit_items")]
    body = fresh(docs, "_t")
    span = "array<struct<start:bigint,stop:bigint>>"
    found = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(body), F.lit(None).cast("bigint").alias("n_words"),
                        F.lit(None).cast(span).alias("hits"), F.lit(None).cast("array<string>").alias("hit_items"))
    schema = found.schema
    blocks = item_blocks(items, item_id, item_text)
    for k, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast((block, window))

        def scan(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            auto = _automaton(shared)
            n, hits, names = [], [], []
            old_hits, old_names = b.column("hits").to_pylist(), b.column("hit_items").to_pylist()
            for t, h, m in zip(blob(b.column(body)), old_hits, old_names, strict=True):
                words = split_words(t)
                spans, got = auto.scan(words)
                if h:
                    spans = _merged(spans + [(x["start"], x["stop"]) for x in h])
                n.append(len(words))
                hits.append([{"start": x, "stop": y} for x, y in spans])
                names.append(sorted(got | set(m or [])))
            out = {c: b.column(c) for c in keep} | {
                body: b.column(body),
                "n_words": pa.array(n, pa.int64()),
                "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                "hit_items": pa.array(names, pa.list_(pa.string())),
            }
            if k + 1 == len(blocks):
                del out[body]
            return pa.RecordBatch.from_pydict(out)

        last = k + 1 == len(blocks)
        found = map_batches(found, scan, found.drop(body).schema if last else schema)
        if not last:
            found = cut(found)
    return found


_BUILT: list = [None, None]


def _automaton(shared) -> Automaton:
    """Built once per Python worker and block."""
    block, window = shared.value
    if _BUILT[0] is not block:
        _BUILT[:] = [block, Automaton(block, window)]
    return _BUILT[1]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, x: s + x["stop"] - x["start"])


def remove_overlap(
    docs: DataFrame, items: DataFrame, max_span: int = WINDOW, max_coverage: float = 0.5, window: int = WINDOW,
) -> DataFrame:
    """``docs`` without benchmark passages: spans of ``max_span`` words or more are cut out of the text, and a document
    of which more than ``max_coverage`` of the words are covered goes as a whole. Columns stay as they are."""
    docs, named_back = shielded(docs, {"n_words", "hits", "hit_items", "_hit"})
    cols = docs.columns
    schema = docs.schema
    found = find_overlap(docs, items, window=window).withColumn("_hit", n_hit())
    kept = found.where("_hit = 0 or _hit <= n_words * " + repr(float(max_coverage)))

    def clean(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for t, hits in zip(blob(b.column("text")), b.column("hits").to_pylist(), strict=True):
            texts.append(_without(t, [(h["start"], h["stop"]) for h in hits if h["stop"] - h["start"] >= max_span]))
        return pa.RecordBatch.from_pydict({c: pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in cols})

    return named_back(map_batches(kept.select(*[F.col(f"`{c}`") for c in cols], "hits"), clean, schema))


def _without(text: bytes | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the bytes from the first to the last word of each span."""
    if text is None:
        return None
    if spans:
        flat, at, places = text.translate(WORD_BYTES), 0, []
        for w in flat.split():
            at = flat.index(w, at)
            places.append((at, at + len(w)))
            at += len(w)
        for a, b in reversed(spans):
            text = text[: places[a][0]] + text[places[b - 1][1]:]
    return text.decode()


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN win ON dw.s = win.s AND dw.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op1_decontaminate", SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = find_overlap(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
