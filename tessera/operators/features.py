"""Columns of candidate pairs for the learners: 83 of the pair itself, and the lists of what each model reads.

Pairs are (country, rec, s1, ord, views, cos_name, cos_addr, tcos_name, tcos_addr, p1). Strings are joined where they are
scored, once for each distinct pair of strings; what cannot be compared is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity, text
from tessera.functions.fixed import VIEW_BITS
from tessera.operators import groups, lookalike

SCORED = {
    "n": ("name_n", similarity.SCORES), "c": ("name_core", ("ratio", "token_set", "jaro_winkler")), "ns": ("name_ns", ("ratio", "partial")),
    "a": ("addr_n", similarity.SCORES[:4]), "num": ("addr_nums", ("token_set", "token_sort")),
}
#: Strings of either side that are looked for in the other: column, field of the entity, field of the record.
CROSSED = {"s1_first_in_rec": ("first", "name_core"), "rec_first_in_s1": ("name_core", "first"), "x_name_addr": ("addr_n", "name_n")}
EQUAL = ("house", "state", "postal", "legal", "first")
SIZES = ("name_len", "addr_len", "name_ntok", "addr_ntok")
FLAGS = ("is_domain", "name_non_latin", "addr_empty", "src")
COSINES = ("cos_name", "cos_addr", "tcos_name", "tcos_addr")
COMPETING = ("full", "tok", "p1")

NAME_COLUMNS = [f"{tag}_{s}" for tag in ("n", "c", "ns") for s in SCORED[tag][1]]
ADDRESS_COLUMNS = [f"{tag}_{s}" for tag in ("a", "num") for s in SCORED[tag][1]]
PAIR_COLUMNS = [
    *NAME_COLUMNS, *ADDRESS_COLUMNS, *[f"{c}_eq" for c in EQUAL], "s1_name_freq", "rec_name_s1_freq", *CROSSED,
    *[f"{k}_{c}" for c in SIZES for k in ("d", "r")], "s1_name_ntok", *[f"r_{c}" for c in FLAGS],
]
VIEW_COLUMNS = [f"view_{v}" for v in VIEW_BITS]
GROUP_COLUMNS = [
    "cos_full", "tcos_full", *[f"{k}_{s}_{x}" for k in groups.KEYS for s in COMPETING for x in ("rank", "gap", "margin")],
    *[f"{k}_n_cands" for k in groups.KEYS], *[f"{k}_sum_p1" for k in groups.KEYS],
]
SIBLING_COLUMNS = ["sib_name", "sib_ns", "sib_addr", "n_sib"]
AMBIGUITY_COLUMNS = ["rec_rank_cname", "rec_gap_cname", "rec_n_same_name"]
BASE = [*PAIR_COLUMNS, *COSINES, "p1", *VIEW_COLUMNS, *GROUP_COLUMNS, *SIBLING_COLUMNS, *AMBIGUITY_COLUMNS]
RARE_COLUMNS = ["ar_token_set", "ar_ratio", "nr_token_set", "nr_ratio"]
RELATIVE = ["s1_n_cands_rel"]
CONTEXT = [f"p2_{k}_{x}" for k in groups.KEYS for x in ("rank", "gap", "margin")] + ["p2", "p2_s1_n_linked", "p2_s1_n_linked_same_src", "p2_s1_sum", "p2sib_name", "p2sib_ns", "p2sib_addr", "n_p2sib"]
#: What each final model leaves out of all its columns.
DROPS = {"A": ("s1_n_cands",), "B": ("s1_n_cands", "la_extra_lratio_min", "la_extra_lshare_max", "la_missing_lshare_min")}
#: Columns of the first model.
STAGE1 = [
    *COSINES, "cos_full", "tcos_full", *VIEW_COLUMNS, "n_views", *[f"{k}_{s}_{x}" for k in groups.KEYS for s in ("full", "tok") for x in ("rank", "gap")],
    *[f"{k}_n_cands" for k in groups.KEYS], "r_addr_empty", "r_name_non_latin", "x_name_ratio", "x_addr_token_set", "x_num_token_set",
]


def chosen(columns: list[str], extra: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> list[str]:
    """A list of columns with others added and some left out, each once; ValueError if one to be left out is not there."""
    found = list(dict.fromkeys([*columns, *extra]))
    if unknown := set(drop) - set(found):
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return [c for c in found if c not in drop]


def model_columns(model: str, stage: int) -> list[str]:
    """Columns of the second or third stage of model A or B."""
    return chosen(BASE, (*lookalike.COLUMNS, *RELATIVE, *(CONTEXT if stage == 3 else ())), DROPS[model])


def _fields(records: DataFrame) -> DataFrame:
    """(id, ...): what the columns read of a record."""
    sizes = {"name_len": F.length("name_n"), "addr_len": F.length("addr_n"), "name_ntok": text.word_count(F.col("name_n")), "addr_ntok": text.address_word_count(F.col("addr_n"))}
    flags = {c: F.col(c).cast("int") for c in FLAGS}
    names = ["name_n", "name_core", "name_ns", "addr_n", "addr_nums", *EQUAL]
    return records.select("id", *names, *[c.alias(n) for n, c in (sizes | flags).items()])


def _sides(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` with the fields of the entity (a_) and of the record (b_)."""
    fields = _fields(records)
    for tag, key in (("a", "s1"), ("b", "rec")):
        pairs = pairs.join(fields.select(F.col("id").alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in fields.columns[1:]]), key)
    return pairs


def described(pairs: DataFrame, records: DataFrame, ones: DataFrame) -> DataFrame:
    """``pairs`` with ``PAIR_COLUMNS``; strings of neither side stay."""
    out = _sides(pairs, records)
    for tag, (field, which) in SCORED.items():
        out = similarity.with_scores(out, f"a_{field}", f"b_{field}", tag, which, guarded=tag == "num")
    for name, (ours, theirs) in CROSSED.items():
        out = similarity.with_scores(out, f"a_{ours}", f"b_{theirs}", name, ("partial",)).withColumnRenamed(f"{name}_partial", name)
    out = out.withColumns({f"{c}_eq": text.equal_or_null(F.col(f"a_{c}"), F.col(f"b_{c}")) for c in EQUAL})
    out = out.withColumns({f"d_{c}": F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in SIZES} | {f"r_{c}": F.col(f"b_{c}") for c in (*SIZES, *FLAGS)} | {"s1_name_ntok": F.col("a_name_ntok")})
    freq = groups.name_frequency(ones, records)
    out = out.join(freq.select(F.col("id").alias("s1"), F.col("freq").alias("s1_name_freq")), "s1")
    out = out.join(freq.select(F.col("id").alias("rec"), F.col("freq").alias("rec_name_s1_freq")), "rec")
    return out.select(*pairs.columns, *PAIR_COLUMNS)


def viewed(pairs: DataFrame) -> DataFrame:
    """``pairs`` with a flag for each view and their number."""
    flags = {f"view_{v}": (F.col("views").bitwiseAND(F.lit(bit)) > 0).cast("int") for v, bit in VIEW_BITS.items()}
    return pairs.withColumns(flags).withColumn("n_views", sum((F.col(c) for c in VIEW_COLUMNS), F.lit(0)))


def halves(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the mean cosines by trigrams and by words."""
    mean = lambda a, b: 0.5 * (F.col(a) + F.col(b))
    return pairs.withColumns({"cos_full": mean("cos_name", "cos_addr"), "tcos_full": mean("tcos_name", "tcos_addr")})


def competing(pairs: DataFrame, scores: tuple[str, ...] = COMPETING, total: str = "p1") -> DataFrame:
    """``pairs`` with their standing among the candidates of their record and of their entity."""
    out = groups.competition(halves(pairs).withColumns({"full": F.col("cos_full"), "tok": F.col("tcos_full")}), scores, total)
    return out.drop("full", "tok")


def siblings(pairs: DataFrame, records: DataFrame, p: str, least: float, prefix: str) -> DataFrame:
    """(rec, s1) with the best similarity to other records of the entity and their number."""
    near = groups.sibling_pairs(pairs, p, least)
    fields = records.select("id", "name_n", "name_ns", "addr_n")
    for tag, key in (("a", "rec"), ("b", "sib")):
        near = near.join(fields.select(F.col("id").alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in fields.columns[1:]]), key)
    for tag, field, which in (("name", "name_n", "token_set"), ("ns", "name_ns", "ratio"), ("addr", "addr_n", "token_set")):
        near = similarity.with_scores(near, f"a_{field}", f"b_{field}", tag, (which,)).withColumnRenamed(f"{tag}_{which}", f"{prefix}_{tag}")
    best = near.groupBy("rec", "s1").agg(*[F.max(f"{prefix}_{t}").alias(f"{prefix}_{t}") for t in ("name", "ns", "addr")], F.count("*").alias(f"n_{prefix}"))
    return pairs.select("rec", "s1").join(best, ["rec", "s1"], "left").na.fill(0, [f"n_{prefix}"])


def base(pairs: DataFrame, records: DataFrame, sibling_least: float = 0.8) -> DataFrame:
    """(country, rec, s1, ord) with the 83 columns of ``BASE``."""
    ones = records.filter("src = 1")
    out = groups.ambiguity(described(viewed(competing(pairs)), records, ones), "c_ratio")
    out = out.join(siblings(pairs, records, "p1", sibling_least, "sib"), ["rec", "s1"])
    return out.select("country", "rec", "s1", "ord", *BASE)


def rare(pairs: DataFrame, records: DataFrame, share: float = 0.01) -> DataFrame:
    """(rec, s1) with the scores of names and addresses without the country's common words, null where either is empty."""
    out = pairs.select("rec", "s1")
    for tag, field in (("ar", "addr_n"), ("nr", "name_core")):
        kept = groups.without_common_tokens(records, field, share)
        out = out.join(kept.select(F.col("id").alias("s1"), F.col("kept").alias("_a")), "s1").join(kept.select(F.col("id").alias("rec"), F.col("kept").alias("_b")), "rec")
        out = out.withColumnsRenamed({"_a": f"a_{tag}", "_b": f"b_{tag}"})
        out = similarity.with_scores(out, f"a_{tag}", f"b_{tag}", tag, ("token_set", "ratio"), guarded=True).drop(f"a_{tag}", f"b_{tag}")
    return out.select("rec", "s1", *RARE_COLUMNS)


def first_stage(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` without p1, with the columns of ``STAGE1``."""
    ranked = halves(pairs).withColumns({"full": F.col("cos_full"), "tok": F.col("tcos_full")})
    out = viewed(groups.competition(ranked, ("full", "tok"), "tok").drop("full", "tok"))
    fields = records.select("id", "name_core", "addr_n", "addr_nums", F.col("addr_empty").cast("int").alias("addr_empty"), F.col("name_non_latin").cast("int").alias("name_non_latin"))
    for tag, key in (("a", "s1"), ("b", "rec")):
        out = out.join(fields.select(F.col("id").alias(key), *[F.col(c).alias(f"_{tag}_{c}") for c in fields.columns[1:]]), key)
    for tag, field, which in (("x_name", "name_core", "ratio"), ("x_addr", "addr_n", "token_set"), ("x_num", "addr_nums", "token_set")):
        out = similarity.with_scores(out, f"_a_{field}", f"_b_{field}", tag, (which,), guarded=tag == "x_num")
    out = out.withColumns({"r_addr_empty": F.col("_b_addr_empty"), "r_name_non_latin": F.col("_b_name_non_latin")})
    return out.select(*pairs.columns, *[c for c in STAGE1 if c not in pairs.columns])


def context(pairs: DataFrame, records: DataFrame, least: float = 0.9) -> DataFrame:
    """(rec, s1) with the columns of ``CONTEXT`` from the scores ``p2`` of the second stage; ``pairs`` have src."""
    around = groups.context(pairs, "p2").select("rec", "s1", *[c for c in CONTEXT if "sib" not in c])
    return around.join(siblings(pairs, records, "p2", least, "p2sib"), ["rec", "s1"])


def looks(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(rec, s1) with the look-alike columns and the relative size of the entity's group."""
    ones, others = records.filter("src = 1"), records.filter("src > 1")
    names = pairs.select("country", "rec", "s1").join(ones.select(F.col("id").alias("s1"), F.col("name_n").alias("s1_name")), "s1").join(others.select(F.col("id").alias("rec"), F.col("name_n").alias("rec_name")), "rec")
    out = groups.relative_counts(lookalike.pair_features(names, lookalike.token_stats(ones, others)))
    return out.select("rec", "s1", *lookalike.COLUMNS, *RELATIVE)
