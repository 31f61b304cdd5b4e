"""Document fingerprints: invertible Bloom lookup sketches of paragraph pieces.

A text's pieces are its paragraphs, cut at sentence ends and after ``WORDS`` words; each distinct piece has a 64-bit digest. A
sketch has three tables of cells; a digest goes into one cell of each table, and a cell holds how many digests it has, their XOR
and the XOR of their checks. Sketches subtract cell by cell: what two versions share cancels out. Peeling takes a cell with one
digest left, notes the digest as differing and removes it from the other tables, until nothing is left. The likeness
is the share of common digests, (n1 + n2 - d) / (n1 + n2 + d) with d differing ones: Jaccard's measure of the piece sets.

The ``fingerprint`` string carries the sketch of the smallest size. Pairs are compared with tables sized for their pieces; where
peeling gets stuck, both are sketched again with tables twice as large and other cells, until all pairs are decoded.

Texts move once: to ranges of neighbouring ids, where the next document is the next row. The rows of cells are summed
inside these ranges without a further shuffle.

Defined results: a null text is empty; empty texts are like each other (1) and unlike any other (0); a null doc_id comes first; a
repeated doc_id is followed by its repetition (ties by text); the only document is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table
from .registry import query

WORDS = 8
#: Tables of a sketch, and cells of each in the fingerprint string.
TABLES, BASE = 4, 4
#: Rows of a range of ids, of a task, and cells of the id histogram that ranges are made of. The cells of a task's sketches are
#: summed in memory, some 100 KB a row.
RANGE_ROWS, TASK_ROWS, CELLS = 128, 256, 65_536
#: Peeling steps, one table each, before a pair counts as stuck.
PEELS = 16
_PIECE = rf"(?:[^\s]*[^\s.!?][^\S\n]+){{0,{WORDS - 1}}}[^\s]+"


def pieces(text: Column) -> Column:
    """Distinct 64-bit digests of the pieces of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), 0), lambda x: F.xxhash64(x)))


def _cell(key: Column, t: Column | int, size: Column | int, seed: int = 0) -> Column:
    place = F.xxhash64(key, (F.lit(t) if isinstance(t, int) else t).cast("int") + F.lit(seed * TABLES))
    return F.pmod(place, (F.lit(size) if isinstance(size, int) else size).cast("bigint")).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def fingerprint(keys: Column, text: Column) -> Column:
    """Number of pieces, digest of the text and the cells of the smallest sketch, in hexadecimal."""
    placed = F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("h"), *[_cell(k, t, BASE).alias(f"c{t}") for t in range(TABLES)]))
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("h"))

    def table_of(t: int) -> Column:
        def cell(c: Column) -> Column:
            return F.aggregate(
                F.filter(placed, lambda p: p[f"c{t}"] == c), empty,
                lambda s, p: F.struct((s["n"] + 1).alias("n"), s["k"].bitwiseXOR(p["k"]).alias("k"), s["h"].bitwiseXOR(p["h"]).alias("h")),
                lambda s: F.concat_ws(".", F.hex(s["n"]), F.hex(s["k"]), F.hex(s["h"].bitwiseAND(0xFFFFFFFF))))

        return F.transform(F.sequence(F.lit(0), F.lit(BASE - 1)), cell)

    cells = [table_of(t) for t in range(TABLES)]
    return F.concat_ws(":", F.hex(F.size(keys)), F.hex(F.xxhash64(text)), F.array_join(F.concat(*cells), ","))


def differing(rows: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """(keys, d, stuck) for ``rows(keys, a, b)``: number of digests in one of the arrays only, as far as peeling comes.

    Pairs without any difference are missing. ``seed`` chooses the cells; each doubles the tables. If ``rows`` are partitioned by some
    of ``keys``, nothing is shuffled.
    """
    size = ((F.size("a") + F.size("b")) * (2**seed) / 2 + 24).cast("int")

    def signed(c: str, sign: int) -> Column:
        return F.transform(c, lambda k: F.struct(k.alias("k"), F.lit(sign).alias("n")))

    at = [*keys, "s", "t", "cell"]
    sums = [F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.sum("got").alias("got")]
    left = "n <> 0 or k <> 0 or h <> 0 or got <> 0"
    one = rows.select(*keys, size.alias("s"), F.explode(F.concat(signed("a", 1), signed("b", -1))).alias("x"))
    one = one.select(*keys, "s", "x.k", F.col("x.n").cast("bigint").alias("n"), F.explode(F.array(*[F.lit(t) for t in range(TABLES)])).alias("t"))
    cells = one.select(*keys, "s", "t", _cell(F.col("k"), F.col("t"), F.col("s"), seed).alias("cell"), "n", "k",
                       _check(F.col("k")).alias("h"), F.lit(0).cast("bigint").alias("got"))
    cells = cells.groupBy(*at).agg(*sums).where(left)
    fields = ["t", "cell", "n", "k", "h", "got"]
    for step in range(PEELS):
        t = step % TABLES
        # a digest lies in one cell of a table, so it is noted once a step
        pure = (F.col("t") == t) & (F.abs("n") == 1) & (F.col("h") == _check(F.col("k")))
        none = F.lit(0).cast("bigint")
        noted = F.struct(F.lit(TABLES).alias("t"), F.lit(0).alias("cell"), none.alias("n"), none.alias("k"), none.alias("h"), F.lit(1).cast("bigint").alias("got"))
        removed = [
            F.struct(F.lit(u).alias("t"), _cell(F.col("k"), u, F.col("s"), seed).alias("cell"), (-F.col("n")).alias("n"),
                     F.col("k").alias("k"), F.col("h").alias("h"), none.alias("got"))
            for u in range(TABLES) if u != t
        ]
        same = F.struct(*[F.col(f) for f in fields])
        cells = cells.select(*keys, "s", F.explode(F.when(pure, F.array(noted, *removed)).otherwise(F.array(same))).alias("x"))
        cells = cells.select(*keys, "s", *[F.col(f"x.{f}") for f in fields]).groupBy(*at).agg(*sums).where(left)
    return cells.groupBy(*keys).agg(F.sum("got").alias("d"), F.max((F.col("t") < TABLES).cast("int")).alias("stuck"))


def likeness(n1: Column, n2: Column, d: Column) -> Column:
    return F.when(n1 + n2 + d == 0, 1.0).otherwise((n1 + n2 - d) / (n1 + n2 + d))


def _numbers(values: list[int], kind: str) -> Column:
    """A constant array, sent as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def in_ranges(docs: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` with ``_key`` (order of ids), ``_range`` and ``_border``, partitioned by range.

    The first row of a range comes again as the border of the range before.
    """
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("_key", key)
    low, high, n = keyed.agg(F.min("_key"), F.max("_key"), F.count("*")).first()
    if not n:
        return keyed.withColumn("_range", F.lit(0)).withColumn("_border", F.lit(False))
    width = (high - low) // CELLS + 1
    cell = F.floor((F.col("_key").cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)")).cast("int")
    cell = F.least(cell, F.lit(CELLS - 1))
    counts = {r["c"]: (r["n"], r["k"]) for r in keyed.groupBy(cell.alias("c")).agg(F.count("*").alias("n"), F.min("_key").alias("k")).collect()}
    of, firsts, rows = [0] * CELLS, [], RANGE_ROWS
    for c in sorted(counts):  # at most CELLS of them
        if rows >= RANGE_ROWS:
            firsts.append(counts[c][1])
            rows = 0
        rows += counts[c][0]
        of[c] = len(firsts) - 1
    before = len(firsts) - 1
    r = F.element_at(_numbers(of, "int"), cell + 1)
    first = F.element_at(_numbers(firsts, "bigint"), F.col("_r") + 1) == F.col("_key")
    back = F.struct(F.when(F.col("_r") == 0, before).otherwise(F.col("_r") - 1).alias("r"), F.lit(True).alias("b"))
    own = F.struct(F.col("_r").alias("r"), F.lit(False).alias("b"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_ROWS))
    return keyed.withColumn("_r", r).withColumn("_p", F.explode(F.when(first, F.array(own, back)).otherwise(F.array(own)))).select(
        *docs.columns, "_key", F.col("_p.r").alias("_range"), F.col("_p.b").alias("_border")).repartition(parts, "_range")


def _decoded(rows: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """``differing`` of (a, e) as d0, stuck0 and of (a, b) as d1, stuck1."""
    both = rows.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("a"), F.col("e").alias("b")), F.struct(F.lit(1).alias("kind"), F.col("a"), F.col("b")))).alias("p")
    ).select(*keys, "p.kind", "p.a", "p.b")
    found = differing(both, [*keys, "kind"], seed)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("d", "stuck")])


@contextmanager
def _plain_maps(spark: SparkSession) -> Iterator[None]:
    """Aggregations without the small map in front of each: a stage of many of them would reserve a page for each."""
    name = "spark.sql.codegen.aggregate.map.twolevel.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _texts_of(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """(i, h, text) of the ``texts(doc_id, text)`` that ``ends(i, h)`` name by id and digest, written: what follows moves these texts only."""
    return cut(texts.join(ends.distinct(), F.expr("i <=> doc_id and h = xxhash64(text)")).select("i", "h", "text").dropDuplicates(["i", "h"]))


def _edited() -> Column:
    return F.expr("concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next, 1, int(n_chars div 2)))")


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next document by doc_id.
    """
    # a column that needs no new name or type gets none: the planner drops it from one of two branches, which then shuffle the texts each for itself
    ids = F.col(doc_id) if (doc_id, "bigint") in docs.dtypes and doc_id == "doc_id" else F.col(doc_id).cast("bigint").alias("doc_id")
    texts = docs.select(ids, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    keys = ["_range", "_row"]
    order = Window.partitionBy("_range").orderBy("_border", "_key", "text")
    rows = in_ranges(texts, "doc_id")
    rows = rows.select("_range", "_border", "doc_id", "text", F.row_number().over(order).alias("_row"),
                       F.lead("text").over(order).alias("next"), F.lead("doc_id").over(order).alias("next_id"))
    rows = rows.where("not _border").withColumn("n_chars", F.char_length("text").cast("bigint")).withColumn("edited", _edited())
    rows = rows.withColumns({"a": pieces(F.col("text")), "e": pieces(F.col("edited")), "b": pieces(F.col("next"))})
    counts = [f"{c}{k}" for k in (0, 1) for c in ("d", "stuck")]
    head = rows.select(
        *keys, "doc_id", "next_id", "n_chars", F.xxhash64("text").alias("th"), F.xxhash64("next").alias("nh"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("a"), F.col("text")).alias("fingerprint"), fingerprint(F.col("e"), F.col("edited")).alias("edited_fingerprint"),
        F.size("a").alias("na"), F.size("e").alias("ne"), F.size("b").alias("nb"), *[F.lit(None).cast("bigint").alias(c) for c in counts],
    )
    # with doc_id both branches read the same columns, so the texts are shuffled once for both
    found = _decoded(rows, [*keys, "doc_id"]).select(
        *keys, *[F.lit(None).cast(t).alias(c) for c, t in head.dtypes if c not in (*keys, *counts)], *[F.col(c).cast("bigint").alias(c) for c in counts])
    with _plain_maps(docs.sparkSession):
        done = cut(head.unionByName(found).groupBy(*keys).agg(*[F.max(c).alias(c) for c in head.columns if c not in keys]))
    # pairs that got stuck are few: their texts are read again and sketched larger
    seed, open_ = 0, done.where("stuck0 = 1 or stuck1 = 1").select(*keys, "doc_id", "next_id", "th", "nh", "n_chars")
    fixed = None
    while open_.take(1):
        seed += 1
        open_ = cut(open_)  # its size on disk lets the planner send it to the texts
        found = _texts_of(texts, open_.select(F.col("doc_id").alias("i"), F.col("th").alias("h")).union(open_.select("next_id", "nh")))
        one, two = found, found.select(F.col("i").alias("j"), F.col("h").alias("g"), F.col("text").alias("next"))
        again = open_.join(one, F.expr("i <=> doc_id and h = th")).join(two, F.expr("j <=> next_id and g = nh"))
        again = again.dropDuplicates(keys).withColumn("edited", _edited())
        again = again.withColumns({"a": pieces(F.col("text")), "e": pieces(F.col("edited")), "b": pieces(F.col("next"))})
        with _plain_maps(docs.sparkSession):
            got = cut(again.select(*keys).join(_decoded(again, keys, seed), keys, "left"))
        ok = got.where("coalesce(stuck0, 0) = 0 and coalesce(stuck1, 0) = 0").select(*keys, F.col("d0").alias("f0"), F.col("d1").alias("f1"))
        fixed = ok if fixed is None else fixed.unionByName(ok)
        open_ = open_.join(got.where("stuck0 = 1 or stuck1 = 1"), keys, "left_semi")
    if fixed is not None:
        late = F.col("f0").isNotNull() | F.col("f1").isNotNull()
        done = done.join(fixed, keys, "left").withColumns({f"d{k}": F.when(late, F.col(f"f{k}")).otherwise(F.col(f"d{k}")) for k in (0, 1)})
    d0, d1 = (F.coalesce(F.col(c), F.lit(0)) for c in ("d0", "d1"))
    return done.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("na"), F.col("ne"), d0).alias("near_edited"), likeness(F.col("na"), F.col("nb"), d1).alias("near_next"))


@query("op2_fingerprints")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return compare_edits(table(spark, folder, "documents"))
