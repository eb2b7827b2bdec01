"""Readers with fixed schemas, and sinks whose files other tools read.

Text tables are tab-separated without quoting; an empty field is the empty string, never null.
"""

from __future__ import annotations

import csv
import json
import os

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def _strings(columns: tuple[str, ...] | list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def header_of(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return first[0][0].split("\t") if first else []


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """The required columns of a file with a header; raises ValueError if one is missing."""
    header = header_of(spark, path)
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    rows = spark.read.csv(path, sep="\t", header=True, quote="", escape="", schema=_strings(header), mode="FAILFAST")
    return rows.select([F.coalesce(F.col(c), F.lit("")).alias(c) for c in required])


def read_source(spark: SparkSession, folder: str, split: str, number: int) -> DataFrame:
    """One source of records, its broken encodings repaired."""
    rows = read_tsv(spark, f"{folder}/{split}_source{number}.tsv", RECORD_COLUMNS)
    return rows.select([repaired(F.col(c)).alias(c) for c in RECORD_COLUMNS])


@F.pandas_udf(T.StringType())
def _repair(texts: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        for encoding in ("cp1252", "latin-1"):
            try:
                return t.encode(encoding).decode("utf-8")
            except (UnicodeError, AttributeError):
                continue
        return t

    return texts.map(one)


def repaired(c: Column) -> Column:
    """Text that was UTF-8 read as a Western code page, read anew; only rows that show its marks are touched."""
    broken = c.rlike("â|Ã")
    return F.when(broken, _repair(F.when(broken, c))).otherwise(c)


def truth_pairs(rows: DataFrame) -> DataFrame:
    """(s1, rec) from (source1_entity_id, matched_entity_ids), ids joined with commas."""
    each = F.explode(F.split("matched_entity_ids", ","))
    return rows.select(F.col("source1_entity_id").alias("s1"), each.alias("rec")).filter("rec <> ''")


def labels(truth: DataFrame, s1: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rec, s1 or null) for all records and (s1, n_true) for all entities; ValueError if the truth names others."""
    unknown = truth.join(s1.select("s1"), "s1", "left_anti").select(F.col("s1").alias("id")).union(truth.join(records.select("rec"), "rec", "left_anti").select("rec"))
    if not unknown.isEmpty():
        raise ValueError("the truth names ids that are in neither table")
    true = records.select("rec").join(truth.select("rec", "s1"), "rec", "left")
    counts = s1.select("s1").join(truth.groupBy("s1").agg(F.count("*").alias("n_true")), "s1", "left").na.fill(0, ["n_true"])
    return true, counts


def id_lists(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, ids): every entity, its distinct record ids sorted as strings."""
    lists = pairs.groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set(F.col("rec").cast("string"))), ",").alias("ids"))
    return entities.select("s1").join(lists, "s1", "left").na.fill("", ["ids"])


def pair_lists(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, ids): every entity, its records in the order of ``ord``, repeats kept."""
    rows = F.array_sort(F.collect_list(F.struct("ord", F.col("rec").cast("string").alias("rec"))))
    lists = pairs.groupBy("s1").agg(F.array_join(F.transform(rows, lambda r: r["rec"]), ",").alias("ids"))
    return entities.select("s1").join(lists, "s1", "left").na.fill("", ["ids"])


def write_lists(lists: DataFrame, path: str, order: str, header: tuple[str, str] = TRUTH_COLUMNS) -> None:
    """One text file in the order of a column, header first."""
    rows = lists.orderBy(order).select(F.col("s1").cast("string").alias(header[0]), F.col("ids").alias(header[1]))
    rows.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", lineSep="\n")


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1, ids) of a list file; ValueError if it holds carriage returns."""
    if not spark.read.text(path, lineSep="\n").filter(F.col("value").contains("\r")).isEmpty():
        raise ValueError(f"{path} holds carriage returns")
    return read_tsv(spark, path, TRUTH_COLUMNS).toDF("s1", "ids")


def write_table(df: DataFrame, path: str, by: list[str] | None = None, rows_per_file: int = 5_000_000) -> None:
    """Parquet, partitioned by label where given; files end after a number of rows."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def cached(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The table at ``path``, built and written first if it is absent or incomplete, or if ``force`` is set."""
    if force or not exists(spark, path):
        write_table(build(), path)
    return spark.read.parquet(path)


def joined_features(pairs: DataFrame, tables: list[tuple[DataFrame, list[str]]], keys: tuple[str, ...] = ("rec", "s1")) -> DataFrame:
    """``pairs`` with chosen columns of several feature tables, joined by key."""
    for table, columns in tables:
        pairs = pairs.join(table.select(*keys, *columns), list(keys), "left")
    return pairs


def sampled_features(features: DataFrame, keys: DataFrame) -> DataFrame:
    """The feature rows of sampled pairs."""
    return features.join(keys.select("rec", "s1"), ["rec", "s1"], "left_semi")


def write_sidecar(path: str, values: dict) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(values, f, ensure_ascii=False, indent=1, sort_keys=True)


def log_run(path: str, row: dict) -> None:
    """Appends a row to a CSV log, with a header if the file is new."""
    new = not os.path.exists(path)
    with open(path, "a", encoding="utf-8", newline="") as f:
        writer = csv.DictWriter(f, fieldnames=sorted(row))
        if new:
            writer.writeheader()
        writer.writerow(row)
