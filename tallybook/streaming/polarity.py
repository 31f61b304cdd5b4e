"""Lexicon polarity counts, the same function for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import lexicon_tokens
from ..operators.facts import expand
from ..session import cut


def lexicon_flags(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """(word, is_pos, is_neg), one row per word of either list."""
    tag = lambda df, p, n: df.select("word", F.lit(p).alias("p"), F.lit(n).alias("n"))
    return tag(pos, 1, 0).unionByName(tag(neg, 0, 1)).groupBy("word").agg(
        F.max("p").cast("bigint").alias("is_pos"), F.max("n").cast("bigint").alias("is_neg")
    )


def polarity_flags(words: DataFrame, pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Membership of each word in both lists; a word in both counts in both."""
    return words.join(lexicon_flags(pos, neg), "word", "left").fillna(0, ["is_pos", "is_neg"])


def _unfold(df: DataFrame, keys: list[str]) -> DataFrame:
    """Both polarities as rows, also when a count is zero."""
    kept = [f"`{k}`" for k in keys]
    return df.selectExpr(*kept, "stack(2, 'positive', positive, 'negative', negative) AS (polarity, cnt)")


def _sums():
    return F.sum("is_pos").alias("positive"), F.sum("is_neg").alias("negative")


def polarity_counts(msgs: DataFrame, pos: DataFrame, neg: DataFrame, window: str | None = None, late: str | None = None) -> DataFrame:
    """Counts of positive and negative words, in total or per tumbling event-time window.

    ``late`` sets the watermark of a streaming input.
    """
    if late:
        msgs = msgs.withWatermark("ts", late)
    words = msgs.select(*[c for c in msgs.columns if c != "value"], F.explode(lexicon_tokens("value")).alias("word"))
    keys = [] if window is None else [F.window("ts", window).alias("w")]
    if msgs.isStreaming:  # a stream has one aggregation, so each occurrence meets the lexicon
        sums = polarity_flags(words, pos, neg).groupBy(*keys).agg(*_sums())
    else:  # occurrences of a word are counted first: one row a word and window meets it, however frequent
        each = words.groupBy(*keys, "word").agg(F.count("*").alias("uses"))
        sums = polarity_flags(each, pos, neg).groupBy(*(["w"] if keys else [])).agg(
            F.sum(F.col("is_pos") * F.col("uses")).alias("positive"), F.sum(F.col("is_neg") * F.col("uses")).alias("negative"))
    if window is None:
        return _unfold(sums, [])
    return _unfold(sums.select(F.unix_timestamp("w.start").alias("start"), "positive", "negative"), ["start"])


def polarity_running(msgs: DataFrame, pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Totals so far; as a stream run it in complete mode, its state is one row."""
    return polarity_counts(msgs, pos, neg)


def polarity_series(counts: DataFrame, seconds: int = 10) -> DataFrame:
    """(step, positive, negative) with 0/0 for windows without messages."""
    wide = counts.groupBy("start").pivot("polarity", ["positive", "negative"]).agg(F.sum("cnt"))
    first = counts.agg(F.min("start")).scalar()
    ends = counts.agg(F.min("start").alias("first"), F.max("start").alias("last"))
    spine = expand(ends, F.floor((F.col("last") - F.col("first")) / seconds) + 1, "k").select((F.col("first") + (F.col("k") - 1) * seconds).alias("start"))
    return spine.join(wide, "start", "left").select(
        ((F.col("start") - first) / seconds).cast("bigint").alias("step"),
        F.coalesce("positive", F.lit(0)).alias("positive"), F.coalesce("negative", F.lit(0)).alias("negative"),
    )


def record_batches(msgs: DataFrame, pos: DataFrame, neg: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds") -> StreamingQuery:
    """Per micro-batch counts appended to a table at ``path`` as (batch_id, polarity, cnt).

    ``interval=None`` drains what is available and stops. Each batch writes its own folder, so a
    repeated batch replaces itself.
    """
    lex = cut(lexicon_flags(pos, neg))  # else each batch would build it anew

    def write(batch: DataFrame, batch_id: int) -> None:
        words = batch.select(F.explode(lexicon_tokens("value")).alias("word"))
        sums = words.join(lex, "word", "left").fillna(0, ["is_pos", "is_neg"]).agg(*_sums())
        out = _unfold(sums.fillna(0), [])
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = msgs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)
    return w.start()


def run_for(q: StreamingQuery, seconds: float) -> None:
    """Run at most ``seconds``, finish the batch in flight, stop."""
    if not q.awaitTermination(seconds):
        q.processAllAvailable()
        q.stop()
