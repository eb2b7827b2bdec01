"""Statistics of candidate pairs within their record and within their entity.

Pairs have the keys ``rec`` and ``s1`` and an ``ord`` that breaks ties, so every ranking is a total order. Missing values
are null, never NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("rec", "s1")


def _whole(key: str):
    return W.partitionBy(key)


def _ranked(key: str, score: str):
    return W.partitionBy(key).orderBy(F.desc(score), "ord", *[k for k in KEYS if k != key])


def rank_of(key: str, score: str) -> Column:
    """0 for the best pair of the group; ties have different ranks."""
    return F.row_number().over(_ranked(key, score)) - 1


def runner_up(key: str, score: str) -> Column:
    """The second best score of the group, null for a group of one."""
    return F.nth_value(score, 2).over(_ranked(key, score).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))


def group_stats(pairs: DataFrame, key: str, score: str) -> DataFrame:
    """``pairs`` with rank, best, second and size of their group."""
    return pairs.withColumns({"rank": rank_of(key, score), "best": F.max(score).over(_whole(key)), "second": runner_up(key, score), "size": F.count("*").over(_whole(key))})


def capped_stats(pairs: DataFrame, key: str, score: str) -> DataFrame:
    """Small statistics for a first model: rank to 255, size to 65535, distance to the best."""
    full = group_stats(pairs, key, score)
    return full.select(*pairs.columns, F.least("rank", F.lit(255)).alias("rank"), F.least("size", F.lit(65535)).alias("size"), (F.col("best") - F.col(score)).alias("gap"))


def rank_gap_margin(key: str, score: str, tag: str) -> dict[str, Column]:
    rank = rank_of(key, score)
    return {
        f"{tag}_rank": rank,
        f"{tag}_gap": F.max(score).over(_whole(key)) - F.col(score),
        f"{tag}_margin": F.when(rank == 0, F.col(score) - F.coalesce(runner_up(key, score), F.lit(0.0))).otherwise(0.0),
    }


def competition(pairs: DataFrame, scores: tuple[str, ...], total: str) -> DataFrame:
    """Rank, gap and margin for both keys and every score, group sizes, and sums of ``total``."""
    for key in KEYS:  # one shuffle a key: all its windows share a partitioning
        columns = {f"{key}_n_cands": F.count("*").over(_whole(key)), f"{key}_sum_{total}": F.sum(total).over(_whole(key))}
        for score in scores:
            columns |= rank_gap_margin(key, score, f"{key}_{score}")
        pairs = pairs.withColumns(columns)
    return pairs


def pruned(pairs: DataFrame, score: str, top: int = 8, least: float = 0.001) -> DataFrame:
    """The ``top`` best pairs of each record with a score of ``least`` or more."""
    return pairs.withColumn("_rank", rank_of("rec", score)).filter((F.col("_rank") < top) & (F.col(score) >= least)).drop("_rank")


def context(pairs: DataFrame, score: str, strong: float = 0.5) -> DataFrame:
    """What else is linked to the pair's entity, by the scores of an earlier model."""
    for key in KEYS:
        pairs = pairs.withColumns(rank_gap_margin(key, score, f"{score}_{key}"))
    pairs = pairs.withColumn("_strong", ((F.col(f"{score}_rec_rank") == 0) & (F.col(score) >= strong)).cast("int"))
    out = pairs.withColumns({
        f"{score}_s1_n_linked": F.sum("_strong").over(_whole("s1")) - F.col("_strong"),
        f"{score}_s1_n_linked_same_src": F.sum("_strong").over(W.partitionBy("s1", "src")) - F.col("_strong"),
        f"{score}_s1_sum": F.sum(score).over(_whole("s1")),
    })
    return out.drop("_strong")


def relative_counts(pairs: DataFrame) -> DataFrame:
    """``pairs`` (with country) and the size of the entity's group relative to the country's mean."""
    groups = pairs.groupBy("country", "s1").count()
    means = groups.groupBy("country").agg((F.sum("count") / F.count("*")).alias("_mean"))
    rel = groups.join(F.broadcast(means), "country").select("country", "s1", (F.col("count") / F.col("_mean")).alias("s1_n_cands_rel"))
    return pairs.join(rel, ["country", "s1"])


def sibling_pairs(pairs: DataFrame, score: str, least: float = 0.8, most: int = 4) -> DataFrame:
    """(rec, s1, sib): other records confidently linked to the pair's entity, ``most`` + 1 an entity at most."""
    sure = pairs.withColumn("_rank", rank_of("rec", score)).filter((F.col("_rank") == 0) & (F.col(score) >= least))
    sure = sure.withColumn("_n", F.row_number().over(W.partitionBy("s1").orderBy(F.desc(score), "ord", "rec"))).filter(F.col("_n") <= most + 1)
    return pairs.select("rec", "s1").join(sure.select("s1", F.col("rec").alias("sib")), "s1").filter("rec <> sib").select("rec", "s1", "sib")


def name_frequency(s1: DataFrame, records: DataFrame) -> DataFrame:
    """(id, freq): how many entities of the country share the record's name_core; 0 if none does."""
    counts = s1.groupBy("country", "name_core").agg(F.count("*").alias("freq"))
    return records.join(counts, ["country", "name_core"], "left").select("id", F.coalesce("freq", F.lit(0)).alias("freq"))


def without_common_tokens(records: DataFrame, column: str, share: float = 0.01) -> DataFrame:
    """(id, kept): ``column`` without tokens in more than ``share`` of the country's records; digits always stay."""
    rows = records.select("id", "country", F.split(column, " ").alias("_t"))
    seen = rows.select("id", "country", F.explode(F.array_distinct("_t")).alias("token")).filter("token <> ''")
    sizes = records.groupBy("country").agg(F.count("*").alias("_n"))
    common = seen.groupBy("country", "token").count().join(F.broadcast(sizes), "country").filter(F.col("count") > share * F.col("_n")).filter(~F.col("token").rlike(r"\d"))
    lists = common.groupBy("country").agg(F.collect_set("token").alias("_common"))  # under 1 / share tokens times the mean length
    kept = F.filter("_t", lambda t: (t != "") & ~F.coalesce(F.array_contains("_common", t), F.lit(False)))
    return rows.join(F.broadcast(lists), "country", "left").select("id", F.array_join(kept, " ").alias("kept"))


def ambiguity(pairs: DataFrame, similarity: str, near: float = 90) -> DataFrame:
    """Rank and gap of a name similarity within the record, and its number of near-equal candidates."""
    return pairs.withColumns({
        "rec_rank_cname": rank_of("rec", similarity),
        "rec_gap_cname": F.max(similarity).over(_whole("rec")) - F.col(similarity),
        "rec_n_same_name": F.sum((F.col(similarity) >= near).cast("int")).over(_whole("rec")),
    })
