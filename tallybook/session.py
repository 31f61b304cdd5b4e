"""Session defaults and the lineage cut shared by all iterative jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Shared folders of applications whose session names none (local mode only).
_OWN_ROOTS: dict[str, str] = {}
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app: str = "tallybook", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session. Cluster settings come from spark-submit; only defaults are set here."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder for tables that must outlive an executor.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a temporary folder is used in local mode
    only, where driver and executors are one process.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        if sc.applicationId not in _OWN_ROOTS:
            _OWN_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="tallybook-")
        root = _OWN_ROOTS[sc.applicationId]
    return f"{root}/tallybook-{sc.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Unlike a cached frame this survives lost executors, and the file sizes give the planner true
    statistics for the next join.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(table: DataFrame) -> None:
    """Delete the files of a table that ``cut`` wrote."""
    for file in table.inputFiles()[:1]:
        _delete(table.sparkSession, file.rsplit("/", 1)[0])


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While this holds, a job's shuffle files are deleted when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Rolling:
    """Cuts the state of a loop: each new table deletes the one that was cut before it."""

    def __init__(self) -> None:
        self._last: str | None = None

    def cut(self, df: DataFrame) -> DataFrame:
        spark, path = df.sparkSession, scratch(df.sparkSession, "roll")
        df.write.parquet(path)
        if self._last is not None:
            _delete(spark, self._last)
        self._last = path
        return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that this application cut; call it when no frame built on them is needed."""
    _delete(spark, shared_root(spark))


def use_rocksdb_state(spark: SparkSession) -> None:
    """State store needed by ``transformWithState``."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
