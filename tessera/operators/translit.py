"""Spellings learned from matched pairs: tokens by position in names, components by co-occurrence in addresses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.functions import text
from tessera.functions.similarity import ratio


def token_map(pairs: DataFrame, least: int = 5, share: float = 0.5) -> DataFrame:
    """(token, target, n, total) from ``pairs`` (rec_name, s1_name): the usual counterpart of each token with marks.

    Only names with equally many tokens are aligned; ties between targets go to the one first in order.
    """
    both = pairs.select(text.tokens(F.col("rec_name")).alias("a"), text.tokens(F.col("s1_name")).alias("b")).filter("size(a) = size(b)")
    each = both.select(F.explode(F.arrays_zip("a", "b")).alias("z")).select(F.col("z.a").alias("token"), F.col("z.b").alias("target"))
    counts = each.filter(~text.is_ascii(F.col("token"))).groupBy("token", "target").agg(F.count("*").alias("n"))
    ranked = counts.withColumns({"total": F.sum("n").over(W.partitionBy("token")), "_r": F.row_number().over(W.partitionBy("token").orderBy(F.desc("n"), "target"))})
    return ranked.filter((F.col("_r") == 1) & (F.col("total") >= least) & (F.col("n") >= share * F.col("total"))).drop("_r")


@F.pandas_udf(DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype=float)


def component_map(pairs: DataFrame, least: int = 5, share: float = 0.6, near: float = 0.8) -> DataFrame:
    """(component, target) from ``pairs`` (rec_addr, s1_addr): among the most frequent companions, the most alike."""
    clean = lambda c: F.array_join(text.tokens(c), " ")
    rows = pairs.withColumn("_id", F.monotonically_increasing_id()).select("_id", F.split("rec_addr", ",").alias("a"), F.split("s1_addr", ",").alias("b"))
    left = rows.select("_id", F.explode("a").alias("part")).filter(~text.is_ascii(F.col("part"))).select("_id", clean(F.col("part")).alias("component"))
    right = rows.select("_id", F.explode(F.array_distinct(F.transform("b", clean))).alias("target")).filter("target <> ''")
    totals = left.groupBy("component").agg(F.count("*").alias("total")).filter(F.col("total") >= least)
    counts = left.join(right, "_id").groupBy("component", "target").agg(F.count("*").alias("n")).join(totals, "component")
    best = F.max("n").over(W.partitionBy("component"))
    close = counts.withColumn("_best", best).filter((F.col("_best") >= share * F.col("total")) & (F.col("n") >= near * F.col("_best")))
    alike = close.withColumn("_like", _likeness(F.lower(text.romanized(F.col("component"))), F.replace(F.col("target"), F.lit(" "), F.lit(""))))
    w = W.partitionBy("component").orderBy(F.desc("_like"), F.desc("n"), "target")
    return alike.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("component", "target")


def applied(rows: DataFrame, column: str, learned: DataFrame, most: int = 200_000) -> DataFrame:
    """``rows`` (id, column) with (id, spelled): tokens with marks replaced by what was learned, others romanized."""
    words = rows.select("id", F.posexplode(F.filter(F.split(column, r"\s+"), lambda t: t != "")).alias("pos", "word"))
    side = learned.select("token", "target")
    side = F.broadcast(side) if side.count() <= most else side
    out = words.join(side, F.lower("word") == F.col("token"), "left")
    spelled = F.when(text.is_ascii(F.col("word")), F.col("word")).otherwise(F.coalesce("target", text.romanized(F.col("word"))))
    lists = out.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", spelled.alias("w")))).alias("ws"))
    return rows.select("id").join(lists, "id", "left").select("id", F.coalesce(F.array_join(F.transform("ws", lambda x: x["w"]), " "), F.lit("")).alias("spelled"))


def applied_components(rows: DataFrame, column: str, learned: DataFrame, most: int = 200_000) -> DataFrame:
    """``rows`` (id, column) with (id, spelled): address components with marks replaced as a whole where one was learned."""
    parts = rows.select("id", F.posexplode(F.split(column, ",")).alias("pos", "part"))
    parts = parts.withColumn("_key", F.when(~text.is_ascii(F.col("part")), F.array_join(text.tokens(F.col("part")), " ")))
    side = learned.select(F.col("component").alias("_key"), "target")
    side = F.broadcast(side) if side.count() <= most else side
    out = parts.join(side, "_key", "left").withColumn("w", F.trim(F.coalesce("target", "part")))
    lists = out.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "w"))).alias("ws"))
    return rows.select("id").join(lists, "id", "left").select("id", F.coalesce(F.array_join(F.transform("ws", lambda x: x["w"]), ", "), F.lit("")).alias("spelled"))


def learned_maps(raw: DataFrame, truth: DataFrame, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(token map, component map) from the raw records of matched pairs (rec, s1)."""
    sides = raw.select("id", "name_raw", "addr_raw")
    pairs = truth.join(sides.toDF("s1", "s1_name", "s1_addr"), "s1").join(sides.toDF("rec", "rec_name", "rec_addr"), "rec")
    return token_map(pairs, least), component_map(pairs, least)


def spelled(raw: DataFrame, tokens: DataFrame, components: DataFrame) -> DataFrame:
    """``raw`` records in Latin letters, with ``non_latin`` for names that were not: whole components of addresses first,
    then word by word, what was learned before what the letters say. Records in plain letters pass as they are."""
    marked = raw.withColumn("non_latin", ~text.is_ascii(F.col("name_raw")))
    plain = text.is_ascii(F.concat("name_raw", "addr_raw"))
    others = marked.filter(~plain)
    names = applied(others.select("id", "name_raw"), "name_raw", tokens).withColumnRenamed("spelled", "_name")
    whole = applied_components(others.select("id", "addr_raw"), "addr_raw", components)
    addresses = applied(whole, "spelled", tokens).withColumnRenamed("spelled", "_addr")
    out = others.join(names, "id").join(addresses, "id").withColumns({"name_raw": F.col("_name"), "addr_raw": F.col("_addr")})
    return marked.filter(plain).unionByName(out.select(marked.columns))
