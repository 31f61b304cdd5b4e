"""Message feeds: streaming readers, sinks and the feed filter."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import from_utf8, to_utf8

SCHEMA = "ts timestamp, value string"


def read_messages(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Streaming ``(ts, value)``. ``fmt='kafka'`` decodes the record value (needs the Kafka package on the
    cluster); a file format reads a folder as files arrive."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("timestamp").alias("ts"), from_utf8("value").alias("value"))
    return reader.schema(SCHEMA).load(path)


def write_messages(df: DataFrame, fmt: str, path: str | None = None, checkpoint: str | None = None, interval: str | None = None, **options):
    """Send messages: a batch write for tables, a query for streams (every ``interval``, or drain and stop).

    For Kafka the text is encoded to bytes; failed batches are retried from the checkpoint.
    """
    if fmt == "kafka":
        df = df.select(to_utf8("value").alias("value"))
    if not df.isStreaming:
        w = df.write.format(fmt).options(**options)
        return w.save() if path is None else w.mode("append").save(path)
    w = df.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    if path is not None:
        w = w.option("path", path)
    w = w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)
    return w.start()


def start(df: DataFrame, sink: str, checkpoint: str, interval: str | None = "10 seconds", mode: str = "append", **options) -> StreamingQuery:
    """Start a query on processing-time ticks, with a checkpoint for recovery. ``interval=None`` drains and stops."""
    w = df.writeStream.format(sink).outputMode(mode).options(**options).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)
    return w.start()


def filter_feed(
    msgs: DataFrame, langs: list[str], box: tuple[float, float, float, float] | None = None,
    track: list[str] | None = None, text: str = "value",
) -> DataFrame:
    """Keep messages by language, by (west, south, east, north) box, by any of a list of words."""
    out = msgs.where(F.col("lang").isin(*langs))
    if box is not None:
        west, south, east, north = box
        out = out.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    if track:
        any_of = "|".join(re.escape(w) for w in track)
        out = out.where(F.col(text).rlike(rf"(?i)(^|\W)({any_of})(\W|$)"))
    return out
