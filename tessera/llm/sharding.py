"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

The rows are numbered 0..N-1 in the order of (doc_id, checksum, size, text hash). A keyed Feistel network permutes
[0, a*b), the smallest near-square rectangle that holds N; values outside [0, N) are walked on until they fall inside,
which keeps it a permutation of [0, N). Position p then has shard ``p % shards`` and slot ``p // shards``: counts
differ by one at most (law ``rows``) and slots have no gaps. Anyone who knows N, the seed and a row number can compute
the place without the data.

Only built-in functions are used. The text is read once; what is shuffled is (doc_id, size, two hashes) a row.

Defined cases: a null text counts as empty (size 16, checksum 0); null ids come first; repeated rows get a place each;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.workspace import Workspace, partitions

SHARDS = 40
ROUNDS = 8
SEED = 20_011
_INDEX = (1 << 33) - 1


def rectangle(n: int) -> tuple[int, int]:
    a = max(1, isqrt(n))
    return a, -(-n // a) if n else 1


def permuted(x: Column, a: int, b: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The Feistel network on [0, a*b): the two coordinates are shifted by a keyed hash of each other in turn."""

    def step(s: Column, k: Column) -> Column:
        even = k % 2 == 0
        by = F.xxhash64(F.lit(seed), k, F.when(even, s["r"]).otherwise(s["l"]))
        return F.struct(
            F.when(even, (s["l"] + F.pmod(by, F.lit(a))) % a).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise((s["r"] + F.pmod(by, F.lit(b))) % b).alias("r"),
        )

    start = F.struct((x % a).alias("l"), ((x - x % a) / F.lit(a)).cast("long").alias("r"))  # exact below 2^53
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["r"] * a + s["l"])


def walk_length(spark: SparkSession, n: int, seed: int) -> int:
    """Steps after which every row of [0, n) is back inside: the longest chain through the a*b - n < a outside points."""
    a, b = rectangle(n)
    out = spark.range(n, a * b).withColumn("z", F.col("id"))
    steps = 1
    while True:
        out = out.withColumn("z", permuted(F.col("z"), a, b, seed)).filter(F.col("z") >= n)
        if out.isEmpty():
            return steps + 1
        steps += 1


def place(row: Column, n: int, seed: int, steps: int) -> Column:
    """The permuted position of a row number in [0, n), by cycle walking."""
    a, b = rectangle(n)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        row.cast("long"),
        lambda p, i: F.when((i == 1) | (p >= n), permuted(p, a, b, seed)).otherwise(p),
    )


def numbered(df: DataFrame, keys: list[str], work: Workspace) -> tuple[DataFrame, int]:
    """Adds ``row``, the rank by ``keys`` from 0, and gives the row count. Repeated rows share no number."""
    spark = df.sparkSession
    base = work.table("slim", df.withColumn("_tie", F.monotonically_increasing_id()))
    order = [*keys, "_tie"]
    dealt = base.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    dealt = work.table("dealt", dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX))))
    counts = sorted(tuple(r) for r in dealt.groupBy("_part").count().collect())  # one row a partition
    first, total = [], 0
    for part, count in counts:
        first.append((part, total))
        total += count
    offsets = spark.createDataFrame(first, "_part int, _first long")
    out = dealt.join(F.broadcast(offsets), "_part").withColumn("row", F.col("_first") + F.col("_at"))
    return out.drop("_part", "_at", "_first", "_tie"), total


def shard(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row) for every row of ``df`` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = df.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"))
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size", "_hash"], Workspace(df.sparkSession, "shard"))
    if n:
        rows = rows.withColumn("_p", place(F.col("row"), n, seed, walk_length(df.sparkSession, n, seed)))
    else:
        rows = rows.withColumn("_p", F.col("row"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_p") % shards).cast("int").alias("shard"),
        F.expr(f"_p div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
