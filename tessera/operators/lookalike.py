"""Look-alike names: word statistics of both sides, and how a record's words differ from its entity's."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import fixed, text
from tessera.functions.similarity import jaro_winkler

COLUMNS = (
    "la_n_missing", "la_n_extra", "la_extra_vocab", "la_extra_filler", "la_extra_rare", "la_swap_vocab", "la_extra_lratio_min",
    "la_extra_lshare_max", "la_missing_lshare_min", "la_acronym", "la_swap_jw", "la_swap_same_initial", "la_extra_vocab_len_min",
)


def token_stats(s1: DataFrame, records: DataFrame) -> DataFrame:
    """(country, token, df1, df23, lratio, lshare, n1, vocab_min) of name words, for countries that have entities."""
    sizes = s1.groupBy("country").agg(F.count("*").alias("n1")).join(records.groupBy("country").agg(F.count("*").alias("n23")), "country", "left").na.fill(0)

    def words(rows: DataFrame, side: int) -> DataFrame:
        return rows.select("country", F.explode(text.name_words(F.col("name_n"))).alias("token"), F.lit(side).alias("side"))

    df = words(s1, 1).union(words(records, 0)).groupBy("country", "token").agg(F.sum("side").alias("df1"), F.sum(1 - F.col("side")).alias("df23"))
    out = df.filter((F.col("df1") >= 1) | (F.col("df23") >= fixed.FILLER_DOCS)).join(F.broadcast(sizes), "country")
    ratio = F.log((F.col("df23") + 1.0) / (F.col("df1") + 1.0)) - F.log(F.greatest("n23", F.lit(1)).cast("double") / F.greatest("n1", F.lit(1)))
    return out.select(
        "country", "token", "df1", "df23", F.least(F.greatest(ratio, F.lit(fixed.LRATIO_LEAST)), F.lit(fixed.LRATIO_MOST)).alias("lratio"),
        F.log((F.col("df1") + 0.5) / F.greatest("n1", F.lit(1)) * 1e6).alias("lshare"), "n1", F.greatest(F.lit(2), F.bround(F.col("n1") * fixed.VOCABULARY_SHARE).cast("int")).alias("vocab_min"),
    )


def word_class() -> Column:
    """filler, vocab or rare, of a row of ``token_stats``."""
    filler = (F.col("lratio") >= math.log(fixed.FILLER_RATIO)) & (F.col("df23") >= fixed.FILLER_DOCS)
    return F.when(filler, "filler").when(F.col("df1") >= F.col("vocab_min"), "vocab").otherwise("rare")


def filler_ratios(stats: DataFrame, sizes: DataFrame, least: int, most: int) -> DataFrame:
    """(country, token, df1, df23, ratio): words that records add most often."""
    rows = stats.filter(F.col("df23") >= least).join(F.broadcast(sizes), "country")
    ratio = F.col("df23") / F.greatest("df1", F.lit(1)) / (F.col("n23") / F.col("n1"))
    return rows.select("country", "token", "df1", "df23", F.round(ratio, 6).alias("ratio")).orderBy(F.desc("ratio"), "country", "token").limit(most)


def subsequence(short: str, long: str) -> bool:
    at = -1
    for c in short:
        at = long.find(c, at + 1)
        if at < 0:
            return False
    return True


def likeness(x: str, y: str) -> str | None:
    """How two spellings may be one word: "same", "cut" (one begins the other), "contracted", "typed" (close by
    Jaro-Winkler), or None."""
    less, more = min(len(x), len(y)), max(len(x), len(y))
    if x == y:
        return "same"
    if less >= 3 and x[:less] == y[:less]:
        return "cut"
    brief, most_letters = less <= 3 and more <= 7, less >= 0.6 * more
    if (brief or most_letters) and x[:1] == y[:1]:
        if subsequence(x, y) if len(x) < len(y) else subsequence(y, x):
            return "contracted"
    return "typed" if jaro_winkler(x, y) >= 0.85 else None


def counterparts(left: list[str], right: list[str]) -> tuple[list[bool], list[bool]]:
    """Whether each word of either side has a counterpart on the other: by the matrix of likenesses, or because four or
    more of its letters stand in the other side written as one word."""
    matrix = [[likeness(x, y) is not None for y in right] for x in left]
    sides = []
    for words, lines, others in ((left, matrix, right), (right, list(zip(*matrix)), left)):
        letters = "".join(others)
        sides.append([any(line) or (len(word) > 3 and word in letters) for word, line in zip(words, lines)])
    return sides[0], sides[1]


def difference(left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """(missing, extra): words of the left side without a counterpart, and of the right side."""
    found = counterparts(left, right)
    return tuple([word for word, has in zip(words, side) if not has] for words, side in zip((left, right), found))


def compared(a: list[str], b: list[str], stats: dict[str, tuple[float, float, str]], absent: float) -> dict[str, float | None]:
    """The look-alike columns; ``stats`` gives (lratio, lshare, class) of known words, ``absent`` the lshare of others."""
    out: dict[str, float | None] = dict.fromkeys(COLUMNS)
    if not a or not b:
        return out
    counts = ("la_n_missing", "la_n_extra", "la_extra_vocab", "la_extra_filler", "la_extra_rare", "la_swap_vocab", "la_acronym")
    out.update(dict.fromkeys(counts, 0.0))
    if len(a) > 1 and b == ["".join(t[0] for t in a)]:
        out["la_acronym"] = 1.0
        return out
    missing, extra = difference(a, b)
    kinds = {kind: [u for u in extra if stats.get(u, (0, 0, "rare"))[2] == kind] for kind in ("vocab", "filler", "rare")}
    vocab = kinds["vocab"]
    ratios = [stats[u][0] for u in vocab + kinds["filler"]]
    out.update(la_n_missing=float(len(missing)), la_n_extra=float(len(extra)), la_extra_lratio_min=min(ratios, default=None))
    out.update({f"la_extra_{kind}": float(len(words)) for kind, words in kinds.items()})
    share = [[stats[t][1] if t in stats else absent for t in words] for words in (extra, missing)]
    out.update(la_extra_lshare_max=max(share[0], default=None), la_missing_lshare_min=min(share[1], default=None))
    out["la_extra_vocab_len_min"] = float(min(map(len, vocab))) if vocab else None
    if missing and vocab:
        out.update(
            la_swap_vocab=1.0, la_swap_jw=max(jaro_winkler(t, u) for t in missing for u in vocab),
            la_swap_same_initial=float(bool({t[0] for t in missing} & {u[0] for u in vocab})),
        )
    return out


def pair_features(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """``pairs`` (country, s1_name, rec_name) with the look-alike columns, computed once a distinct triple.

    Statistics of the pair's own words travel with it, so nothing that grows with the data is broadcast.
    """
    key = ["country", "s1_name", "rec_name"]
    distinct = pairs.select(*key).distinct()
    distinct = distinct.withColumn("_a", text.name_words(F.col("s1_name"))).withColumn("_b", text.name_words(F.col("rec_name")))
    words = distinct.select(*key, F.explode(F.array_distinct(F.concat("_a", "_b"))).alias("token"))
    known = words.join(stats.select("country", "token", "lratio", "lshare", word_class().alias("class")), ["country", "token"])
    known = known.groupBy(*key).agg(F.collect_list(F.struct("token", "lratio", "lshare", "class")).alias("_stats"))
    sizes = stats.select("country", "n1").distinct()
    rows = distinct.join(known, key, "left").join(F.broadcast(sizes), "country", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, found, n1 in zip(batch["_a"], batch["_b"], batch["_stats"], batch["n1"]):
                n1 = 1 if pd.isna(n1) else n1
                own = {} if found is None else {x["token"]: (x["lratio"], x["lshare"], x["class"]) for x in found}
                out.append(compared(list(a), list(b), own, math.log(0.5 / max(n1, 1) * 1e6)))
            yield pd.concat([batch[key].reset_index(drop=True), pd.DataFrame(out, columns=list(COLUMNS), dtype=float)], axis=1)

    schema = "country string, s1_name string, rec_name string, " + ", ".join(f"{c} double" for c in COLUMNS)
    found = rows.mapInPandas(run, schema)
    found = found.select(*key, *[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) for c in COLUMNS])
    return pairs.join(found, key)


def is_vocab_swap() -> Column:
    return F.coalesce((F.col("la_swap_vocab") == 1) & (F.col("la_swap_same_initial") == 0) & (F.col("la_extra_vocab_len_min") >= 4), F.lit(False))


def post_filtered(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """``matches`` (country, s1_name, rec_name, ...) without pairs that swap a word of the name for another ordinary one."""
    return pair_features(matches, stats).filter(~is_vocab_swap()).drop(*COLUMNS)


def post_filter_counts(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """(country, pairs, dropped): what ``post_filtered`` takes from each country."""
    dropped = F.sum(is_vocab_swap().cast("long")).alias("dropped")
    return pair_features(matches, stats).groupBy("country").agg(F.count("*").alias("pairs"), dropped)


def changed_words(pairs: DataFrame, top: int = 25) -> DataFrame:
    """(country, kind, word, n, share): the words that pairs (country, s1_name, rec_name) most often lack or add.

    ``kind`` is missing or extra, by exact words; the share is that of all such words of the country and kind.
    """
    a, b = text.name_words(F.col("s1_name")), text.name_words(F.col("rec_name"))
    sides = F.array(F.struct(F.lit("missing").alias("kind"), F.array_except(a, b).alias("words")), F.struct(F.lit("extra").alias("kind"), F.array_except(b, a).alias("words")))
    words = pairs.select("country", F.explode(sides).alias("_s")).select("country", "_s.kind", F.explode("_s.words").alias("word"))
    counts = words.groupBy("country", "kind", "word").agg(F.count("*").alias("n"))
    whole = counts.groupBy("country", "kind").agg(F.sum("n").alias("_all"))  # a row or two a country
    place = F.row_number().over(W.partitionBy("country", "kind").orderBy(F.desc("n"), "word"))
    best = counts.withColumn("_k", place).filter(F.col("_k") <= top).join(F.broadcast(whole), ["country", "kind"])
    return best.select("country", "kind", "word", "n", (F.col("n") / F.col("_all")).alias("share"))


def swap_profile(pairs: DataFrame) -> DataFrame:
    """(country, pairs, swaps, fillers, entities, swapped_entities) of accepted pairs with their look-alike columns.

    ``swaps`` are pairs under ``is_vocab_swap``, ``fillers`` pairs whose record only adds filler; ``swapped_entities`` are
    the entities with a swap at least.
    """
    filler = F.coalesce((F.col("la_extra_filler") > 0) & (F.col("la_n_missing") == 0) & (F.col("la_extra_vocab") == 0), F.lit(False))
    by_entity = pairs.groupBy("country", "s1").agg(F.count("*").alias("_n"), F.sum(is_vocab_swap().cast("long")).alias("_s"), F.sum(filler.cast("long")).alias("_f"))
    return by_entity.groupBy("country").agg(
        F.sum("_n").alias("pairs"), F.sum("_s").alias("swaps"), F.sum("_f").alias("fillers"),
        F.count("*").alias("entities"), F.sum((F.col("_s") > 0).cast("long")).alias("swapped_entities"),
    )


def difference_kind(pairs: DataFrame) -> DataFrame:
    """``pairs`` with SAME, DEL, ADD or SUB: what the record's words lack or add."""
    a, b = text.name_words(F.col("s1_name")), text.name_words(F.col("rec_name"))
    lacks, adds = F.size(F.array_except(a, b)) > 0, F.size(F.array_except(b, a)) > 0
    return pairs.withColumn("kind", F.when(lacks & adds, "SUB").when(lacks, "DEL").when(adds, "ADD").otherwise("SAME"))
