"""Profiles of decisions: samples, what a rule or a post-filter changes, pattern densities, and word statistics of two splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.evaluate import f05, macro_f05


def draw_of(*keys: Column) -> Column:
    """A number in [0, 1) from the MD5 of some keys; the same wherever it is computed."""
    joined = F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def query_sample(records: DataFrame, share: float) -> DataFrame:
    """About ``share`` of the records (id, country) of every country; the feature is a sample, and it can be repeated."""
    return records.filter(draw_of(F.col("country"), F.col("id")) < share)


def change_of_rule(s1: DataFrame, precision: list[float], entities: int) -> DataFrame:
    """(country, q, pairs, entities, alone, change): what dropping all pairs of a pattern is expected to change.

    ``s1`` has country, pattern (pairs of the pattern) and others (other accepted pairs, taken as right) of each entity. A
    pair of the pattern is wrong with probability q, so the right ones among them are binomial; the change is that of the
    mean F0.5 over ``entities``, all matches of an entity being taken as found. ``alone`` counts entities without others.
    """
    grid = F.broadcast(s1.sparkSession.createDataFrame([(q,) for q in precision], "q double"))
    m, k, q = F.col("pattern").cast("double"), F.col("others").cast("double"), F.col("q")
    start = F.struct(F.pow(q, m).alias("w"), F.lit(0.0).alias("sum"))

    def step(state: Column, j: Column) -> Column:
        """Adds the change for j right pairs and moves the binomial weight on to j + 1."""
        right = j.cast("double")
        gain = f05(k, k, k + right) - f05(k + right, k + m, k + right)
        onward = state["w"] * (m - right) / (right + 1) * (1 - q) / q
        return F.struct(onward.alias("w"), (state["sum"] + state["w"] * gain).alias("sum"))

    rows = s1.filter("pattern > 0").crossJoin(grid)
    each = rows.withColumn("_gain", F.aggregate(F.sequence(F.lit(0), F.col("pattern").cast("int")), start, step, lambda s: s["sum"]))
    return each.groupBy("country", "q").agg(
        F.sum("pattern").alias("pairs"), F.count("*").alias("entities"), F.sum((F.col("others") == 0).cast("long")).alias("alone"),
        (F.sum("_gain") / F.lit(float(entities))).alias("change"),
    )


def filter_effect(matches: DataFrame, flagged: Column, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: accepted and flagged pairs, the share of flagged ones that are right, and macro F0.5 with and without them."""
    pairs = matches.select("rec", "s1", flagged.alias("_flag"))
    hits = pairs.join(truth.select("rec", "s1").withColumn("_hit", F.lit(1)), ["rec", "s1"], "left")
    counts = hits.agg(F.count("*").alias("accepted"), F.sum(F.col("_flag").cast("long")).alias("flagged"), F.sum(F.when(F.col("_flag"), F.coalesce("_hit", F.lit(0)))).alias("_right"))
    sides = [macro_f05(rows.select("rec", "s1"), truth, entities).select(F.col("f05").alias(name)) for rows, name in ((pairs, "before"), (pairs.filter(~F.col("_flag")), "after"))]
    out = counts.crossJoin(sides[0]).crossJoin(sides[1])  # one row each
    return out.select("accepted", "flagged", F.try_divide("_right", "flagged").alias("right_share"), "before", "after")


def pattern_density(pairs: DataFrame, entities: DataFrame, patterns: dict[str, Column], cuts: list[float], p: str = "p") -> DataFrame:
    """(split, country, cut, pairs_per_s1, ...): pairs an entity, and pairs of each pattern a hundred entities, at cut-offs.

    ``pairs`` and ``entities`` have split and country.
    """
    grid = F.broadcast(pairs.sparkSession.createDataFrame([(c,) for c in cuts], "cut double"))
    sizes = entities.groupBy("split", "country").agg(F.count("*").alias("_all"))
    sums = pairs.crossJoin(grid).filter(F.col(p) >= F.col("cut")).groupBy("split", "country", "cut")
    sums = sums.agg(F.count("*").alias("_n"), *[F.sum(c.cast("long")).alias(name) for name, c in patterns.items()])
    rates = [(F.col(name) * 100 / F.col("_all")).alias(name) for name in patterns]
    return sums.join(F.broadcast(sizes), ["split", "country"]).select("split", "country", "cut", (F.col("_n") / F.col("_all")).alias("pairs_per_s1"), *rates)


def ratio_quantiles(stats: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """(split, country, tokens, q10, q25, q50, q75, q90, weighted, over): where ordinary words' ratios lie.

    A word's ratio is the growth of its document frequency from entities to records against that of the sides; words of
    ``least`` entities or more count, ``weighted`` is their median by frequency, and ``over`` the share at 1.15 or more.
    """
    rows = with_ratio(stats, sizes).filter(F.col("df1") >= least)
    return rows.groupBy("split", "country").agg(
        F.count("*").alias("tokens"), *[F.percentile("ratio", x / 100).alias(f"q{x}") for x in (10, 25, 50, 75, 90)],
        F.percentile("ratio", 0.5, F.col("df1")).alias("weighted"), F.avg((F.col("ratio") >= 1.15).cast("int")).alias("over"),
    )


def with_ratio(stats: DataFrame, sizes: DataFrame) -> DataFrame:
    """``stats`` (split, country, token, df1, df23, ...) with ratio; ``sizes`` is (split, country, n1, n23)."""
    ratio = (F.col("df23") + 1.0) / (F.col("df1") + 1.0) / (F.col("n23") / F.col("n1"))
    return stats.join(F.broadcast(sizes), ["split", "country"]).withColumn("ratio", ratio)


def class_flips(stats: DataFrame, one: str, two: str) -> DataFrame:
    """(country, before, after, tokens, share): words of both splits by their class in each, the share being of the second
    split's occurrences in records. ``stats`` has split, country, token, class and df23."""
    a = stats.filter(F.col("split") == one).select("country", "token", F.col("class").alias("before"))
    b = stats.filter(F.col("split") == two).select("country", "token", F.col("class").alias("after"), "df23")
    counts = a.join(b, ["country", "token"]).groupBy("country", "before", "after").agg(F.count("*").alias("tokens"), F.sum("df23").alias("_n"))
    whole = F.sum("_n").over(W.partitionBy("country"))  # nine rows a country at most
    return counts.select("country", "before", "after", "tokens", F.try_divide("_n", whole).alias("share"))


def region_coverage(records: DataFrame, address: str, codes: list[str]) -> DataFrame:
    """(country, n, known): records with an address and the share whose last component names a known region."""
    last = F.lower(F.trim(F.substring_index(F.col(address), ",", -1)))
    rows = records.filter(F.col(address) != "")
    known = F.exists(F.split(last, " "), lambda t: t.isin(codes))
    return rows.groupBy("country").agg(F.count("*").alias("n"), F.avg(known.cast("int")).alias("known"))


def view_report(pairs: DataFrame, truth: DataFrame, bits: dict[str, int]) -> DataFrame:
    """(view, pairs, recall) of each view and of the union: ``pairs`` are (rec, s1, views), ``truth`` (rec, s1)."""
    hits = pairs.join(truth.select("rec", "s1").withColumn("_hit", F.lit(1)), ["rec", "s1"], "left")
    found = {"union": F.lit(True), **{name: F.col("views").bitwiseAND(F.lit(bit)) > 0 for name, bit in bits.items()}}
    sums = hits.agg(*[e.alias(f"{k}_{name}") for name, c in found.items() for k, e in (("n", F.sum(c.cast("long"))), ("t", F.sum(F.when(c, F.coalesce("_hit", F.lit(0))).cast("long"))))])
    total = truth.agg(F.count("*").alias("_all"))
    stack = ", ".join(f"'{name}', n_{name}, t_{name}" for name in found)
    rows = sums.crossJoin(total).selectExpr(f"stack({len(found)}, {stack}) AS (view, pairs, hits)", "_all")
    return rows.select("view", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.try_divide(F.coalesce("hits", F.lit(0)), "_all").alias("recall"))


def decision_changes(old: DataFrame, new: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(change, n, ...): pairs that a second decision keeps, drops or adds, and how many of each carry each flag.

    Both are (rec, s1) with the columns that the flags read; of kept pairs the first decision's are read.
    """
    a, b = old.withColumn("_old", F.lit(True)), new.withColumn("_new", F.lit(True))
    both = a.join(b.select("rec", "s1", "_new"), ["rec", "s1"], "left").withColumn("change", F.when(F.col("_new"), "KEEP").otherwise("DROP"))
    added = b.join(a.select("rec", "s1", "_old"), ["rec", "s1"], "left_anti").withColumn("change", F.lit("ADD"))
    rows = both.select("change", *[c.alias(n) for n, c in flags.items()]).union(added.select("change", *[c.alias(n) for n, c in flags.items()]))
    return rows.groupBy("change").agg(F.count("*").alias("n"), *[F.sum(F.coalesce(n, F.lit(False)).cast("long")).alias(n) for n in flags])


def label_report(scored: DataFrame, truth: DataFrame, entities: DataFrame, thresholds: list[float], margins: list[float]) -> DataFrame:
    """(country, threshold, margin, matches, f05): the best grid point of each country by itself.

    ``scored`` pairs (rec, s1, country, ord, p) of a country come from models that never saw it; ``entities`` is (s1,
    country, n_true). The countries are a short list.
    """
    from functools import reduce

    from tessera.operators import decide

    out = []
    for (country,) in sorted(entities.select("country").distinct().collect()):
        own = entities.filter(F.col("country") == country).select("s1", "n_true")
        grid = decide.tune(scored.filter(F.col("country") == country), truth, own, thresholds, margins)
        out.append(grid.orderBy(F.desc("f05"), "threshold", "margin").limit(1).select(F.lit(country).alias("country"), *grid.columns))
    return reduce(DataFrame.union, out)
