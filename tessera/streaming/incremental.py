"""New records against a fixed index of entities: the same retrieval and decision, micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import blocking, decide


def linked(rows: DataFrame, index: DataFrame, idf: DataFrame, threshold: float, margin: float) -> DataFrame:
    """(rec, s1, p, second) for ``rows`` (id, country, words); ``idf`` holds the word statistics of the index."""
    counts = blocking.postings(rows, F.col("words"))
    raw = counts.join(idf.select("country", "token", "idf"), ["country", "token"])
    length = raw.groupBy("country", "id").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("_l"))
    weights = raw.join(length, ["country", "id"]).select("id", "country", "token", (F.col("idf") / F.col("_l")).alias("w"))
    pairs = blocking.token_scores(weights, index).withColumnRenamed("score", "p").withColumn("ord", F.col("s1"))
    return decide.select(pairs, threshold, margin).select("rec", "s1", "p", "second")


def link_stream(records: DataFrame, index: DataFrame, idf: DataFrame, out: str, checkpoint: str, threshold: float, margin: float, **trigger) -> StreamingQuery:
    """Appends the matches of a stream of records to a Parquet folder, a folder for each micro-batch.

    A batch that is run again overwrites its own folder, so each record is written once.
    """

    def write(batch: DataFrame, number: int) -> None:
        linked(batch, index, idf, threshold, margin).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
