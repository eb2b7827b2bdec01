"""Shared folder for tables that cut lineage.

Intermediate tables are written below ``spark.checkpoint.dir`` of the session, which driver and executors share; a
lost executor is then recovered by reading the table again. Only where the setting is absent (tests on one machine)
a temporary folder is made.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: Keys that the rows of one key are spread over in a join.
SALTS = 256
#: Bytes of an Arrow batch sent to a Python worker: texts differ in length, so rows alone bound no memory.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Rows that a Parquet reader decodes at once, for the same reason: 4,096 whole texts are arrays of many MB in an executor's heap.
READ_SETTING, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 512


def bounded_batches(spark: SparkSession) -> None:
    """Makes the session read and send small batches to Python workers from now on."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    spark.conf.set(READ_SETTING, str(READ_ROWS))


def give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks and stages, and would hold the most they ever had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any) -> DataFrame:
    """``df.mapInArrow(run, schema)`` of which a worker keeps no freed memory after its task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def each(shared: list[Broadcast]) -> Iterator[Any]:
    """Broadcast values one at a time: of several, a worker reads each from its file and forgets it again."""
    for one in shared:
        path = getattr(one, "_path", None)
        yield one.load_from_path(path) if path and len(shared) > 1 else one.value


class Workspace:
    """A fresh folder for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        bounded_batches(spark)
        root = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
        if not root:
            root = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
            spark.sparkContext.setCheckpointDir(root)
        self.path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Writes ``df`` and returns the written table."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, side: DataFrame, key: str, member: str) -> DataFrame:
    """``rows`` joined with ``side``, a row a key; rows of one key are spread by a hash of ``member``."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(member), F.lit(SALTS)))
    spread = rows.select(key, "_salt").distinct().join(side, key)
    return rows.join(spread, [key, "_salt"]).drop("_salt")


def shielded(df: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns other than ``used`` renamed out of the way, and a function that gives the names back."""
    inner = {c: c if c in used else f"_x{k}" for k, c in enumerate(df.columns)}
    names = [F.col(f"`{c}`").alias(x) for c, x in inner.items()]
    return df.select(names), lambda out: out.select([F.col(x).alias(c) for c, x in inner.items()])
