"""Histogram sort into shards of near-equal bytes.

Rows are ordered by (hash of the text, doc_id), so equal texts lie side by side. The splitters of that order are found by
counting exact bytes and rows below candidate key boundaries in all partitions: each round divides the bracket of every
open splitter into ``PROBES`` equal parts, counts them, and keeps the part that holds the splitter, until a boundary lies
within the tolerance of its target. Inside a bracket of one text (a large group of copies) the probes go on over doc_id.
Only then do rows move, once: they go to the key ranges between splitters, each shard being ``ranges`` consecutive ranges,
so that numbering the rows of a shard is not one task's work.

Defined results: a null text counts as empty; a null doc_id sorts as the smallest; rows equal in both keys can't be
told apart and stay in one range; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, shielded, table
from .registry import query

PROBES = 1024
#: Allowed distance of a boundary from its target, as a part of one range's bytes.
TOLERANCE = 0.001
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _below(h: int, i: int) -> Column:
    return (F.col("_h") < h) | ((F.col("_h") == h) & (F.col("_i") < i))


def _range_of(splitters: list[tuple[int, int]], first: int = 0) -> Column:
    """Number of the range of a row, as a balanced tree of comparisons."""
    if not splitters:
        return F.lit(first)
    m = len(splitters) // 2
    return F.when(_below(*splitters[m]), _range_of(splitters[:m], first)).otherwise(_range_of(splitters[m + 1 :], first + m + 1))


class _Splitter:
    """One boundary being sought: the bracket of keys it lies in and what is known to be below the bracket."""

    def __init__(self, target: float):
        self.target, self.done, self.at = target, False, None
        self.level, self.h, self.low, self.high, self.under = "_h", None, _LOW, _HIGH, 0

    def bracket(self) -> tuple:
        return (self.level, self.h, self.low, self.high)

    def refine(self, counts: dict[int, tuple[int, int, int]], tolerance: float) -> None:
        """``counts``: part -> (bytes, smallest key, largest key), all parts of the bracket that have rows."""
        below, best = self.under, None
        for _part_no, (size, least, most) in sorted(counts.items()):
            for bound, key in ((below, least), (below + size, most + 1)):
                if best is None or abs(bound - self.target) < abs(best[0] - self.target):
                    best = (bound, key)
            if below + size > self.target:
                # the splitter lies inside this part
                if abs(best[0] - self.target) <= tolerance:
                    break
                if least < most:
                    self.low, self.high, self.under = least, most, below
                    return
                if self.level == "_h":
                    self.level, self.h, self.low, self.high, self.under = "_i", least, _LOW, _HIGH, below
                    return
                break
            below += size
        key = best[1] if best else self.low
        self.done = True
        if self.level == "_h":
            self.at = (min(key, _HIGH), _LOW) if key <= _HIGH else (_HIGH, _HIGH)
        else:
            self.at = (self.h, key) if key <= _HIGH else (self.h + 1, _LOW)


def find_splitters(keys: DataFrame, targets: list[float], tolerance: float) -> list[tuple[int, int]]:
    """Boundaries (h, i) below which the bytes of ``keys(_h, _i, _size)`` are within ``tolerance`` of the targets."""
    open_ = [_Splitter(t) for t in targets]
    every = list(open_)
    while open_:
        # all open splitters are equally deep in the same tree of parts, so their brackets are disjoint
        brackets = sorted({s.bracket() for s in open_}, key=_start)
        n = F.col("n") + 1
        by_text, text, low, high, width = (
            F.element_at(F.array(*[F.lit(x).cast(t) for x in xs]), n)
            for t, xs in (
                ("boolean", [b[1] is None for b in brackets]),
                ("bigint", [b[1] or 0 for b in brackets]),
                ("bigint", [b[2] for b in brackets]),
                ("bigint", [b[3] for b in brackets]),
                ("decimal(20,0)", [str((b[3] - b[2]) // PROBES + 1) for b in brackets]),
            )
        )
        rows = (
            keys.withColumn("n", _range_of([_start(b) for b in brackets[1:]]))
            .withColumn("key", F.when(by_text, F.col("_h")).otherwise(F.col("_i")))
            .where(F.col("key").between(low, high) & (by_text | (F.col("_h") == text)))
            # exact distance; rounding of the quotient is monotone, and parts are told apart by their own keys
            .withColumn("part", F.floor((F.col("key").cast("decimal(20,0)") - low.cast("decimal(20,0)")) / width).cast("int"))
            .groupBy("n", "part").agg(F.sum("_size").alias("size"), F.min("key").alias("least"), F.max("key").alias("most"))
            .collect()  # at most PROBES + 1 rows a bracket
        )
        counts: dict[tuple, dict[int, tuple[int, int, int]]] = {}
        for r in rows:
            counts.setdefault(brackets[r["n"]], {})[r["part"]] = (r["size"], r["least"], r["most"])
        for s in open_:
            s.refine(counts.get(s.bracket(), {}), tolerance)
        open_ = [s for s in open_ if not s.done]
    return sorted(s.at for s in every)


def _start(bracket: tuple) -> tuple[int, int]:
    _, h, low, _ = bracket
    return (low, _LOW) if h is None else (h, low)


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, ranges: int = 1, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` with ``size`` (bytes of the text plus 1), ``shard`` and ``slot`` (gapless from 0 in each shard); such columns are replaced."""
    docs, named_back = shielded(docs.drop("size", "shard", "slot"), {"_h", "_i", "_size", "_r", "_n"})
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.withColumns({
        "_h": F.xxhash64(body), "_i": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LOW)),
        "_size": F.octet_length(body).cast("bigint") + 1,
    })
    keys = cut(keyed.select("_h", "_i", "_size"))
    total = keys.agg(F.sum("_size")).first()[0] or 0
    n = shards * ranges
    splitters = find_splitters(keys, [total * j / n for j in range(1, n)], tolerance * total / n) if total else []
    of = _range_of(splitters) if splitters else F.lit(0)
    rows = {r["r"]: r["n"] for r in keys.groupBy(of.alias("r")).agg(F.count("*").alias("n")).collect()}
    start, at = [], 0
    for r in range(n):
        at = 0 if r % ranges == 0 else at
        start.append(at)
        at += rows.get(r, 0)
    place = Window.partitionBy("_r").orderBy("_h", "_i")
    return named_back(keyed.withColumn("_r", of).withColumn("_n", F.row_number().over(place)).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("_size").alias("size"),
        F.floor(F.col("_r") / ranges).cast("int").alias("shard"),
        (F.element_at(F.array(*[F.lit(s).cast("bigint") for s in start]), F.col("_r") + 1) + F.col("_n") - 1).alias("slot"),
    ))


@query("op8_shard")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return shard_by_bytes(docs, 16, ranges=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
