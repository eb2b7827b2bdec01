"""Scores of matches and candidates, checks of outputs, and profile tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one entity from counts; 1 if nothing is predicted and nothing is true."""
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when(tp == 0, 0.0).otherwise(1.25 * tp / (n_pred + 0.25 * n_true))


def entity_scores(matches: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, tp, n_pred, n_true, f05) for all of ``entities``; matches and truth are (rec, s1) pairs."""
    hits = matches.join(truth.withColumn("_hit", F.lit(1)), ["rec", "s1"], "left")
    found = hits.groupBy("s1").agg(F.count("*").alias("n_pred"), F.count("_hit").alias("tp"))
    real = truth.groupBy("s1").agg(F.count("*").alias("n_true"))
    out = entities.select("s1").join(found, "s1", "left").join(real, "s1", "left").na.fill(0, ["n_pred", "tp", "n_true"])
    return out.select("s1", "tp", "n_pred", "n_true", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")).alias("f05"))


def macro_f05(matches: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    return entity_scores(matches, truth, entities).agg(F.avg("f05").alias("f05"), F.count("*").alias("entities"))


def by_true_count(scores: DataFrame) -> DataFrame:
    """(bucket, entities, f05): mean score by the number of true matches."""
    n = F.col("n_true")
    bucket = F.when(n == 0, "0").when(n == 1, "1").when(n <= 3, "2-3").when(n <= 5, "4-5").otherwise("6+")
    return scores.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("entities"), F.avg("f05").alias("f05"))


def retrieval_report(pairs: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: pairs, recall, the F0.5 of a perfect decision on them, and candidates by entity, entities without any included."""
    hits = pairs.select("rec", "s1").join(truth.select("rec", "s1").withColumn("_hit", F.lit(1)), ["rec", "s1"], "left")
    found = hits.groupBy("s1").agg(F.count("*").alias("n"), F.count("_hit").alias("tp"))
    real = truth.groupBy("s1").agg(F.count("*").alias("n_true"))
    each = entities.select("s1").join(found, "s1", "left").join(real, "s1", "left").na.fill(0, ["n", "tp", "n_true"])
    return each.agg(
        F.sum("n").alias("pairs"), F.try_divide(F.sum("tp"), F.sum("n_true")).alias("recall"), F.avg(f05(F.col("tp"), F.col("tp"), F.col("n_true"))).alias("oracle_f05"),
        F.avg("n").alias("mean_candidates"), F.percentile("n", 0.99).alias("p99_candidates"), F.avg((F.col("n") == 0).cast("int")).alias("without"),
    )


def prune_grid(pairs: DataFrame, truth: DataFrame, entities: DataFrame, tops: list[int], floors: list[float], p: str) -> DataFrame:
    """(top_n, min_prob, pairs, recall, oracle_f05): what a rank and a floor would keep, from one ranked table.

    ``oracle_f05`` is the mean score over ``entities`` of a perfect decision on what is kept.
    """
    from tessera.operators.groups import rank_of

    spark = pairs.sparkSession
    ranked = pairs.withColumn("_rank", rank_of("rec", p)).join(truth.select("rec", "s1").withColumn("_hit", F.lit(1)), ["rec", "s1"], "left")
    grid = F.broadcast(spark.createDataFrame([(t, f) for t in tops for f in floors], "top_n int, min_prob double"))
    kept = ranked.select("s1", "_rank", "_hit", F.col(p).alias("_p")).crossJoin(grid).filter((F.col("_rank") < F.col("top_n")) & (F.col("_p") >= F.col("min_prob")))
    each = kept.groupBy("top_n", "min_prob", "s1").agg(F.count("*").alias("n"), F.count("_hit").alias("tp"))
    real = entities.select("s1").join(truth.groupBy("s1").agg(F.count("*").alias("n_true")), "s1", "left").na.fill(0, ["n_true"])
    scored = each.join(real, "s1", "left")
    known = F.col("n_true").isNotNull()
    gain = F.when(known & (F.col("n_true") > 0), f05(F.col("tp"), F.col("tp"), F.col("n_true")))
    sums = scored.groupBy("top_n", "min_prob").agg(F.sum("n").alias("pairs"), F.sum(F.when(known, F.col("tp"))).alias("_tp"), F.sum(gain).alias("_gain"))
    total = real.agg(F.sum("n_true").alias("_true"), F.count("*").alias("_all"), F.sum((F.col("n_true") == 0).cast("int")).alias("_empty"))
    out = grid.join(sums, ["top_n", "min_prob"], "left").crossJoin(F.broadcast(total))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("top_n", "min_prob", zero("pairs").alias("pairs"), F.try_divide(zero("_tp"), F.col("_true")).alias("recall"), F.try_divide(zero("_gain") + F.col("_empty"), F.col("_all")).alias("oracle_f05"))


def violations(matches: DataFrame, candidates: DataFrame, entities: DataFrame, records: DataFrame) -> DataFrame:
    """(rule, n): how often an output breaks each rule. Inputs: pairs (rec, s1); entities (s1); records (rec)."""
    rules = {
        "unknown entity": matches.select("s1").join(entities, "s1", "left_anti"),
        "unknown record": matches.select("rec").join(records, "rec", "left_anti"),
        "entity as record": matches.join(entities.select(F.col("s1").alias("rec")), "rec", "left_semi"),
        "repeated pair": matches.groupBy("rec", "s1").count().filter("count > 1"),
        "record twice": matches.groupBy("rec").agg(F.count_distinct("s1").alias("n")).filter("n > 1"),
        "not a candidate": matches.select("rec", "s1").distinct().join(candidates.select("rec", "s1"), ["rec", "s1"], "left_anti"),
    }
    out = None
    for rule, rows in rules.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = one if out is None else out.union(one)
    return out


def band_density(best: DataFrame, entities: DataFrame, p: str = "p", width: float = 0.1) -> DataFrame:
    """(country, band, n, per_1000): best pairs by probability band, a thousand entities of the country."""
    sizes = entities.groupBy("country").agg(F.count("*").alias("_all"))
    bands = best.groupBy("country", F.floor(F.round(F.col(p) / width, 9)).cast("int").alias("band")).agg(F.count("*").alias("n"))
    return bands.join(F.broadcast(sizes), "country").select("country", "band", "n", (F.col("n") * 1000.0 / F.col("_all")).alias("per_1000"))


def pattern_rates(rows: DataFrame, patterns: dict[str, Column], label: str) -> DataFrame:
    """(pattern, n, share): how many rows show each pattern and the share of them with the label; one scan."""
    sums = rows.agg(*[f.alias(f"{k}_{i}") for i, c in enumerate(patterns.values()) for k, f in (("n", F.sum(c.cast("int"))), ("y", F.sum(F.when(c, F.col(label).cast("int")))))])
    stack = ", ".join(f"'{name}', n_{i}, y_{i}" for i, name in enumerate(patterns))
    return sums.selectExpr(f"stack({len(patterns)}, {stack}) AS (pattern, n, y)").select("pattern", F.coalesce("n", F.lit(0)).alias("n"), F.try_divide("y", "n").alias("share"))


def rates(rows: DataFrame, keys: list[str], flags: dict[str, Column]) -> DataFrame:
    """Means of flags by group, with the group's size."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(c.cast("int")).alias(name) for name, c in flags.items()])


def distinctiveness(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """How often values of ``by`` recur within groups: share of single ones, median, p90 and p99 of their counts."""
    counts = rows.groupBy(*keys, by).count()
    return counts.groupBy(*keys).agg(F.avg((F.col("count") == 1).cast("int")).alias("single"), *[F.percentile("count", q).alias(f"p{int(100 * q)}") for q in (0.5, 0.9, 0.99)])


def binned_means(rows: DataFrame, bins: str, value: str, width: float, least: int = 200) -> DataFrame:
    """(bin, n, mean): means of ``value`` in bins of ``bins``, thin bins left out."""
    return rows.groupBy(F.floor(F.round(F.col(bins) / width, 9)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).filter(F.col("n") >= least)


def last_components(rows: DataFrame, address: str, most: int) -> DataFrame:
    """(country, part, n): the most frequent last address components."""
    part = F.trim(F.substring_index(F.col(address), ",", -1))
    return rows.groupBy("country", part.alias("part")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country", "part").limit(most)


def missed(truth: DataFrame, candidates: DataFrame, matches: DataFrame, threshold: float) -> DataFrame:
    """(rec, s1, reason): true pairs that were not matched: no candidate, low score, or lost to another entity."""
    lost = truth.join(matches.select("rec", "s1"), ["rec", "s1"], "left_anti").join(candidates.select("rec", "s1", "p"), ["rec", "s1"], "left")
    return lost.select("rec", "s1", F.when(F.col("p").isNull(), "not a candidate").when(F.col("p") < threshold, "low score").otherwise("lost").alias("reason"))


def entity_sample(entities: DataFrame, links: DataFrame, n: int) -> DataFrame:
    """(s1, rec): the first ``n`` entities in hash order with their linked records, null if they have none."""
    chosen = entities.select("s1").orderBy(F.crc32(F.col("s1").cast("string").cast("binary")), "s1").limit(n)
    return links.join(F.broadcast(chosen), "s1", "right").select("s1", "rec")


def sweep(best: DataFrame, flags: dict[str, Column], thresholds: list[float], p: str = "p") -> DataFrame:
    """(country, threshold, n, flags...): accepted pairs by country at each threshold, with counts of flags."""
    grid = F.broadcast(best.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold double"))
    return best.crossJoin(grid).filter(F.col(p) >= F.col("threshold")).groupBy("country", "threshold").agg(F.count("*").alias("n"), *[F.sum(c.cast("int")).alias(name) for name, c in flags.items()])
