"""Tables written to the folder that driver and executors share, where a plan would otherwise be computed again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: its lineage ends there, and a lost executor costs no more than reading it again."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Once:
    """Tables that several parts of one query share, each built and written once."""

    def __init__(self) -> None:
        self.tables: dict[tuple, DataFrame] = {}

    def __call__(self, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self.tables:
            self.tables[key] = written(build(), str(key[0]))
        return self.tables[key]

    def query(self, run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        """``run`` with nothing shared from queries before it."""

        def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
            self.tables.clear()
            return run(spark, sf_dir)

        return fresh
