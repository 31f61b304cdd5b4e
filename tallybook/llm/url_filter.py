"""URL filter by the ratio of two character language models.

URLs that a rule decides are the examples: one variable-order Markov model of the allowed and one of the blocked ones, over
host and path, with contexts of up to ``ORDER`` characters and Witten-Bell smoothing from each order to the one below. A URL without
a rule is judged by the difference of its log-likelihoods divided by its length. The threshold is calibrated on the quarter of the
examples that the models have not seen: it balances the two error rates.

All counts cover all rows. Models are tables of distinct n-grams that are joined with the distinct n-grams of the URLs, so a frequent
host or a repeated URL is counted once per partition before anything is shuffled.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is scored as empty text; repeated rows are
judged each; if one of the classes has no examples, URLs without a rule are allowed; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, lower_ascii, shielded, table
from .registry import query

ORDER, SYMBOLS = 4, 1024
#: Cells of the score histogram for calibration, and the range of scores that they divide.
BINS, SPAN = 2000, 10.0
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null without one."""
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*fits)


def _grams(s: Column) -> Column:
    """For each character after the first the longest context of up to ORDER characters with it."""
    return F.transform(F.sequence(F.lit(2), F.char_length(s)), lambda i: F.substring(s, F.greatest(F.lit(1), i - ORDER), F.least(i, F.lit(ORDER + 1))))


def _suffixes(g: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(g)), lambda n: F.right(g, n))


def models(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(g, llr): log-probability of a gram's last character after its context when allowed less that when blocked.

    ``texts(s, a, b)``: distinct training strings with their counts in both classes. ``wanted(g)``: the grams to be scored.
    Tables of grams grow with the input while their files are small, so they are joined by shuffles and never sent through the driver; each level
    is written, so that a plan holds the joins of one level only.
    """
    top = texts.select(F.explode(_grams(F.col("s"))).alias("g"), "a", "b").groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = cut(top.select(F.explode(_suffixes(F.col("g"))).alias("g"), "a", "b").groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    context = cut(counts.groupBy(F.expr("left(g, char_length(g) - 1)").alias("c")).agg(
        F.sum("a").alias("na"), F.sum("b").alias("nb"),
        F.sum((F.col("a") > 0).cast("bigint")).alias("ta"), F.sum((F.col("b") > 0).cast("bigint")).alias("tb")))
    need = cut(wanted.select(F.explode(_suffixes(F.col("g"))).alias("g")).distinct())
    below, levels = None, []
    for n in range(1, ORDER + 2):
        level = need.where(F.char_length("g") == n).join(counts.where(F.char_length("g") == n).hint("merge"), "g", "left")
        level = level.withColumn("c", F.expr(f"left(g, {n - 1})")).join(context.where(F.char_length("c") == n - 1).hint("merge"), "c", "left")
        if below is None:
            level = level.withColumns({"qa": F.lit(1.0 / SYMBOLS), "qb": F.lit(1.0 / SYMBOLS)})
        else:
            lower = below.select(F.col("g").alias("r"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
            level = level.withColumn("r", F.expr(f"right(g, {n - 1})")).join(lower.hint("merge"), "r")
        for k in "ab":
            seen, total, kinds = (F.coalesce(F.col(c), F.lit(0)) for c in (k, "n" + k, "t" + k))
            # one more kind than seen, so that a context without any count passes on the order below
            level = level.withColumn("p" + k, (seen + (kinds + 1) * F.col("q" + k)) / (total + kinds + 1))
        below = cut(level.select("g", "pa", "pb"))
        levels.append(below)
    return reduce(DataFrame.unionByName, levels).select("g", (F.log("pa") - F.log("pb")).alias("llr"))


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (length-normalised log-likelihood difference; high: allow); such columns are replaced."""
    pages, named_back = shielded(pages.drop("host", "path", "rule", "verdict", "score"), {"_u", "_s", "_rule"})
    keep = pages.columns
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(url).cast("string").alias("_u"))
    host, path = host_and_path(F.col("_u"))
    rows = rows.withColumns({"host": host, "path": path}).withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("_s", F.concat(F.lit("\u0002"), "host", "path", F.lit("\u0003")))
    is_a, is_b = ((F.col("_rule.verdict") == v) for v in ("allow", "block"))
    distinct = cut(rows.groupBy(F.col("_s").alias("s")).agg(
        F.sum(F.coalesce(is_a.cast("bigint"), F.lit(0))).alias("a"), F.sum(F.coalesce(is_b.cast("bigint"), F.lit(0))).alias("b")))
    kept_back = F.pmod(F.xxhash64("s", F.lit("calibrate")), F.lit(4)) == 0
    grams = distinct.select("s", F.explode(_grams(F.col("s"))).alias("g"))
    ratio = models(distinct.where((F.col("a") + F.col("b") > 0) & ~kept_back), grams.select("g").distinct())
    scored = grams.join(ratio.hint("merge"), "g").groupBy("s").agg(F.avg("llr").alias("score"))
    scored = cut(distinct.join(scored.hint("merge"), "s"))
    cell = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1))
    held = scored.where(kept_back & (F.col("a") + F.col("b") > 0)).groupBy(cell.alias("cell")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    threshold = calibrate({r["cell"]: (r["a"], r["b"]) for r in held})
    judged = F.lit("allow") if threshold is None else F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return named_back(rows.join(scored.select(F.col("s").alias("_s"), "score").hint("merge"), "_s").select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", judged).alias("verdict"), "score"))


def calibrate(cells: dict[int, tuple[int, int]]) -> float | None:
    """Lower edge of the cell from which on URLs are allowed: least sum of both error rates, ties at the middle of the gap."""
    total_a, total_b = (sum(x[k] for x in cells.values()) for k in (0, 1))
    if not total_a or not total_b:
        return None
    best, ends, lost, stopped = None, [0, 0], 0, 0
    order = sorted(cells)
    for k in range(len(order) + 1):
        error = lost / total_a + (total_b - stopped) / total_b
        if best is None or error < best - 1e-12:
            best, ends = error, [order[k - 1] + 1 if k else order[0], order[k] if k < len(order) else order[-1] + 1]
        if k < len(order):
            lost, stopped = lost + cells[order[k]][0], stopped + cells[order[k]][1]
    return (ends[0] + ends[1]) / 2 / BINS * 2 * SPAN - SPAN


@query("op6_url_filter")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")
