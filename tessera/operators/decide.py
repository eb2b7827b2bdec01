"""From scored pairs to matches: one entity a record, under a threshold and a margin.

Pairs have ``rec``, ``s1``, a probability and an ``ord`` for ties. Thresholds are compared in the probability's own width.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.evaluate import f05


def best_per_record(pairs: DataFrame, p: str = "p") -> DataFrame:
    """The best pair of each record with ``second``, the probability of the runner-up (0 if there is none)."""
    w = W.partitionBy("rec").orderBy(F.desc(p), "ord", "s1")
    ranked = pairs.withColumns({"_n": F.row_number().over(w), "second": F.lead(p, 1, 0.0).over(w)})
    return ranked.filter(F.col("_n") == 1).drop("_n")


def accepted(p: Column, second: Column, threshold: Column, margin: Column) -> Column:
    return (p >= threshold) & (p - second >= margin)


def select(pairs: DataFrame, threshold: float, margin: float, p: str = "p") -> DataFrame:
    best = best_per_record(pairs, p)
    return best.filter(accepted(F.col(p), F.col("second"), F.lit(threshold), F.lit(margin)))


def select_by_label(pairs: DataFrame, known: DataFrame, seen: tuple[float, float], unseen: tuple[float, float], p: str = "p") -> DataFrame:
    """Like ``select``, with other limits for pairs whose ``country`` is not among ``known`` (a small list of labels)."""
    flagged = best_per_record(pairs, p).join(F.broadcast(known.select("country").distinct().withColumn("_seen", F.lit(True))), "country", "left")
    old = F.coalesce("_seen", F.lit(False))
    limit = [F.when(old, a).otherwise(b) for a, b in zip(seen, unseen)]
    return flagged.filter(accepted(F.col(p), F.col("second"), *limit)).withColumn("unseen", ~old).drop("_seen")


def match_lists(matches: DataFrame) -> DataFrame:
    """(s1, matches): record ids of each entity that has any, sorted and joined with commas."""
    return matches.groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set(F.col("rec").cast("string"))), ",").alias("matches"))


def tune(pairs: DataFrame, truth: DataFrame, entities: DataFrame, thresholds: list[float], margins: list[float], p: str = "p") -> DataFrame:
    """(threshold, margin, matches, f05) over a grid, the mean being over all of ``entities`` (s1, n_true).

    The grid is a short list, so each best pair meets each of its points and is summed at once.
    """
    spark = pairs.sparkSession
    grid = F.broadcast(spark.createDataFrame([(t, m) for t in thresholds for m in margins], "threshold double, margin double"))
    best = best_per_record(pairs, p).join(truth.select("rec", F.col("s1").alias("_true")), "rec", "left")
    hit = (F.col("s1") == F.col("_true")).cast("int")
    each = best.select("s1", p, "second", F.coalesce(hit, F.lit(0)).alias("tp")).crossJoin(grid)
    each = each.filter(accepted(F.col(p), F.col("second"), F.col("threshold"), F.col("margin")))
    counts = each.groupBy("threshold", "margin", "s1").agg(F.sum("tp").alias("tp"), F.count("*").alias("n_pred"))
    scored = counts.join(entities, "s1", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)))
    sums = scored.groupBy("threshold", "margin").agg(F.sum("n_pred").alias("matches"), F.sum(f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))).alias("_sum"), F.sum((F.col("n_true") == 0).cast("int")).alias("_lost"))
    total = entities.agg(F.count("*").alias("_all"), F.sum((F.col("n_true") == 0).cast("int")).alias("_empty"))
    out = grid.join(sums, ["threshold", "margin"], "left").crossJoin(F.broadcast(total))
    # an entity without prediction scores 1 if it has no match, else 0
    score = (F.coalesce("_sum", F.lit(0.0)) + F.col("_empty") - F.coalesce("_lost", F.lit(0))) / F.col("_all")
    return out.select("threshold", "margin", F.coalesce("matches", F.lit(0)).alias("matches"), score.alias("f05"))


def mean_probability(runs: list[DataFrame]) -> DataFrame:
    """(rec, s1, p): the mean over runs that scored the same pairs."""
    named = [r.select("rec", "s1", F.col("p").alias(f"_p{k}")) for k, r in enumerate(runs)]
    joined = reduce(lambda a, b: a.join(b, ["rec", "s1"]), named)
    return joined.select("rec", "s1", (sum((F.col(f"_p{k}") for k in range(len(runs))), F.lit(0.0)) / len(runs)).alias("p"))


def blend(seen_runs: list[DataFrame], unseen_runs: list[DataFrame], pairs: DataFrame, known: DataFrame) -> DataFrame:
    """``pairs`` (rec, s1, country) with p from one group of runs for known labels and from another for the others."""
    a = mean_probability(seen_runs).withColumnRenamed("p", "_seen_p")
    b = mean_probability(unseen_runs).withColumnRenamed("p", "_unseen_p")
    flag = F.broadcast(known.select("country").distinct().withColumn("_seen", F.lit(True)))
    out = pairs.join(a, ["rec", "s1"]).join(b, ["rec", "s1"]).join(flag, "country", "left")
    return out.withColumn("p", F.when(F.coalesce("_seen", F.lit(False)), F.col("_seen_p")).otherwise(F.col("_unseen_p"))).drop("_seen", "_seen_p", "_unseen_p")


def differing(one: DataFrame, two: DataFrame) -> bool:
    """Whether two tables of the same columns hold different rows, repeats counted."""
    return not one.exceptAll(two).union(two.exceptAll(one)).isEmpty()


def overridden(base: DataFrame, other: DataFrame, labels: DataFrame, known: DataFrame, candidates: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(s1, matches): rows of ``base`` for entities with a known label, rows of ``other`` for the rest.

    Raises ValueError unless both cover the same entities and come from the same ``candidates`` (two tables of pairs).
    """
    if differing(base.select("s1"), other.select("s1")):
        raise ValueError("the two outputs cover different entities")
    if candidates and differing(*(c.select("rec", "s1") for c in candidates)):
        raise ValueError("the two outputs come from different candidates")
    flag = labels.select("s1", "country").join(F.broadcast(known.select("country").distinct().withColumn("_seen", F.lit(True))), "country", "left").select("s1", F.coalesce("_seen", F.lit(False)).alias("_seen"))
    both = base.select("s1", F.col("matches").alias("_a")).join(other.select("s1", F.col("matches").alias("_b")), "s1").join(flag, "s1")
    return both.select("s1", F.when(F.col("_seen"), F.col("_a")).otherwise(F.col("_b")).alias("matches"))


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """(rec, s1, change): KEEP, DROP or ADD for every pair of either side."""
    a = old.select("rec", "s1").distinct().withColumn("_a", F.lit(1))
    b = new.select("rec", "s1").distinct().withColumn("_b", F.lit(1))
    return a.join(b, ["rec", "s1"], "full_outer").select("rec", "s1", F.when(F.col("_b").isNull(), "DROP").when(F.col("_a").isNull(), "ADD").otherwise("KEEP").alias("change"))
