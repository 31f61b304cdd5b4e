"""What the operators of this subpackage share: bounded Arrow batches, word splitting, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

__all__ = ["cut", "map_batches", "map_stream", "table", "fresh", "shielded", "blob", "WORD_BYTES", "lower_ascii"]

#: Bytes of one Arrow batch that a Python task holds; very long texts come alone.
BATCH_BYTES = "8m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over Arrow batches of bounded bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Like ``map_batches`` for functions that keep state over the batches of a partition."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(wraps(fn)(lambda it: fn(it)), schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(df: DataFrame, names: set[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns called like one of ``names`` renamed, and the function that names them back."""
    kept = {}
    for c in df.columns:
        if c.lower() in names:
            kept[c] = fresh(df, f"{c}_kept")
    return df.withColumnsRenamed(kept), lambda out: out.withColumnsRenamed({v: k for k, v in kept.items()})


def blob(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Byte table: A-Z to a-z; 0-9, a-z and all bytes of code points above 127 stay; the rest becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def lower_ascii(c):
    """A-Z to a-z, all else untouched."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
