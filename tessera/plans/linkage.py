"""A whole linkage run: normalise, retrieve, prune, describe, score, decide, list and check.

Every stage writes Parquet to its folder below ``out`` and the next one reads it; a finished stage is not run again unless
``force`` is set, so an interrupted run goes on where it stopped.

    python -m tessera.plans.linkage --sources FOLDER --split train --out FOLDER
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import blocking, decide, evaluate, features, groups, learn, lookalike, sparse, translit
from tessera.sources import tables
from tessera.sources.shared import written


@dataclass(frozen=True)
class Settings:
    """Limits and thresholds of a run."""

    key_entities: int = 20
    house_entities: int = 50
    token_entities: int = 2000
    gram_k: int = 30
    full_k: int = 10
    field_k: int = 5
    stage1_share: float = 0.05
    least_score: float = 0.02
    prune_top: int = 8
    prune_least: float = 0.001
    folds: int = 3
    rounds: int = 20
    sibling_least: float = 0.8
    context_least: float = 0.9
    model: str = "A"
    least_spellings: int = 5
    thresholds: tuple[float, ...] = (0.4, 0.5, 0.6, 0.7)
    margins: tuple[float, ...] = (0.0, 0.2, 0.5)


def normalised(rows: DataFrame) -> DataFrame:
    """``rows`` (id, country, src, name_raw, addr_raw) with all normalised fields; ``non_latin`` tells of names respelled before."""
    rows = rows.withColumns({"_n": text.name_fields(F.col("name_raw")), "_t": text.address_tokens(F.col("addr_raw"))})
    before = [F.col("non_latin").alias("_respelled")] if "non_latin" in rows.columns else []
    rows = rows.withColumn("_a", text.address_fields(F.col("_t"))).select("id", "country", "src", *before, "_n.*", "_a.*")
    if before:
        rows = rows.withColumn("name_non_latin", F.col("name_non_latin") | F.col("_respelled")).drop("_respelled")
    return rows.withColumns({"legal": text.legal_of(F.col("name_n")), "first": text.first_of(F.col("name_core")), "state": text.state_set(F.col("addr_n"))})


def candidates(records: DataFrame, s: Settings) -> DataFrame:
    """(country, rec, s1, ord, views, cos_name, cos_addr, tcos_name, tcos_addr): the union of all views with exact cosines."""
    ones, recs = records.filter("src = 1"), records.filter("src > 1")
    sizes = blocking.country_sizes(records)
    fields = {"name": "name_n", "addr": "addr_n"}
    by_word = [blocking.weights(blocking.postings(records, F.filter(F.split(f, " "), lambda t: t != "")), sizes) for f in fields.values()]
    words = written(sparse.packed_words(by_word), "words")
    grams = written(sparse.packed_grams(records, list(fields.values())), "grams")
    indexed = sparse.packed_words([blocking.held(w, s.token_entities) for w in by_word])
    least = s.least_score
    found = sparse.top_views(indexed, {"tname": sparse.View((0,), s.field_k, least), "taddr": sparse.View((1,), s.field_k, least), "tfull": sparse.View((0, 1), s.full_k, least)})
    found = written(found, "word_views")
    views = {
        "full": sparse.top_views(grams, {"full": sparse.View((0, 1), s.gram_k, factor=0.5)}, width=3), **{v: found.filter(F.col("view") == v) for v in ("tname", "taddr", "tfull")},
        "key": blocking.key_pairs(ones, recs, ["name_core"], s.key_entities), "hkey": blocking.house_pairs(ones, recs, s.house_entities),
    }
    pairs = blocking.union_views(views).join(ones.select(F.col("id").alias("s1"), "country"), "s1")
    for prefix, rows, width in (("cos", grams, 3), ("tcos", words, None)):
        pairs = sparse.pair_cosines(pairs, rows, [f"{prefix}_{tag}" for tag in fields], width)
    return pairs.select("country", "rec", "s1", F.col("s1").alias("ord"), "views", *features.COSINES)


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    return pairs.join(truth.select("rec", "s1").withColumn("_hit", F.lit(1.0)), ["rec", "s1"], "left").withColumn("label", F.coalesce("_hit", F.lit(0.0))).drop("_hit")


#: What joins the 83 columns of a pair in its second and third stage.
MORE = [*lookalike.COLUMNS, *features.RELATIVE]


class Run:
    """The stages of one split below ``out``; models and the decision come from the training split."""

    def __init__(self, raw: DataFrame, out: str, settings: Settings, force: bool, maps: tuple[DataFrame, DataFrame], truth: DataFrame | None = None, trained: Run | None = None) -> None:
        self.spark, self.out, self.s, self.force, self.truth = raw.sparkSession, out, settings, force, truth
        self.models = trained.models if trained else f"{out}/models"
        self.learned = trained is not None
        self.records = self.stage("records", lambda: normalised(translit.spelled(raw, *maps)))
        self.ones = self.records.filter("src = 1").select(F.col("id").alias("s1"), "country")
        self.candidates = self.stage("candidates", lambda: candidates(self.records, self.s))
        self.described = self.stage("described", lambda: features.first_stage(self.candidates, self.records))
        first = self.scored("stage1", self.described, features.STAGE1, "p1", self.s.stage1_share)
        self.pruned = self.stage("pruned", lambda: groups.pruned(first, "p1", self.s.prune_top, self.s.prune_least).select(*self.candidates.columns, F.col("p1").cast("double").alias("p1")))
        columns = [*features.BASE, *MORE]
        self.features = self.stage("features", lambda: features.base(self.pruned, self.records, self.s.sibling_least).join(features.looks(self.pruned, self.records), ["rec", "s1"]))
        second = self.scored("stage2", self.features, columns, "p2")
        around = self.stage("context", lambda: self._context(second))
        more = features.chosen(columns, tuple(features.CONTEXT), features.DROPS[self.s.model])
        self.pairs = self.scored("stage3", self.features.join(around, ["rec", "s1"]), more, "p").select("rec", "s1", "country", "ord", F.col("p").cast("double").alias("p"))

    def stage(self, name: str, build) -> DataFrame:
        return tables.cached(self.spark, f"{self.out}/{name}", build, self.force)

    def _context(self, second: DataFrame) -> DataFrame:
        rows = second.select("rec", "s1", "ord", F.col("r_src").alias("src"), F.col("p2").cast("double").alias("p2"))
        return features.context(rows, self.records, self.s.context_least)

    def scored(self, name: str, rows: DataFrame, columns: list[str], p: str, share: float = 0.8) -> DataFrame:
        """``rows`` with ``p``: out of fold where there is truth; else by the training split's models, the first stage by one of
        all folds and the others by the mean of the folds'."""
        s, path = self.s, f"{self.models}/{name}"

        def build() -> DataFrame:
            if self.learned:
                models = learn.load_models(f"{path}/whole", 1) if name == "stage1" else learn.load_models(f"{path}/folds", s.folds)
                return learn.fold_mean(models, rows, columns).withColumnRenamed("p", p)
            data = labelled(rows, self.truth)
            out, models = learn.out_of_fold(data, columns, s.folds, train=share, valid=share / 4, rounds=s.rounds)
            learn.save_models(models, f"{path}/folds")
            if name == "stage1":
                learn.save_models([learn.whole_model(data, columns, s.folds, train=share, valid=share / 4, rounds=s.rounds)], f"{path}/whole")
            return out.drop("label").withColumnRenamed("p", p)

        return self.stage(name, build)

    def decided(self, threshold: float, margin: float, force: bool = False) -> dict[str, DataFrame]:
        """Matches and lists from the saved probabilities; ``force`` decides again where there was a decision."""
        found = tables.cached(self.spark, f"{self.out}/matches", lambda: decide.select(self.pairs, threshold, margin).select("rec", "s1", "country", "p"), self.force or force)
        lists = tables.cached(self.spark, f"{self.out}/lists", lambda: tables.id_lists(found, self.ones), self.force or force)
        broken = evaluate.violations(found, self.candidates, self.ones, self.records.filter("src > 1").select(F.col("id").alias("rec"))).filter("n > 0")
        if not broken.isEmpty():
            raise ValueError(f"the matches break rules: {[tuple(r) for r in broken.collect()]}")
        return {"matches": found, "lists": lists}

    def tables(self) -> dict[str, DataFrame]:
        return {"records": self.records, "candidates": self.candidates, "pruned": self.pruned, "features": self.features, "stage3": self.pairs}


def run(raw: DataFrame, truth: DataFrame, out: str, settings: Settings | None = None, force: bool = False, test: DataFrame | None = None, threshold: float | None = None, margin: float | None = None) -> dict[str, DataFrame]:
    """All stages over ``raw`` records and ``truth`` (rec, s1), and over the records of a ``test`` split; the tables by stage.

    A ``threshold`` or ``margin`` takes the place of the tuned one: matches are decided anew from the saved probabilities.
    """
    s = settings or Settings()
    maps = tuple(tables.cached(raw.sparkSession, f"{out}/{name}", lambda m=m: m, force) for name, m in zip(("token_map", "component_map"), translit.learned_maps(raw, truth, s.least_spellings)))
    train = Run(raw, out, s, force, maps, truth)
    counts = train.ones.join(truth.groupBy("s1").agg(F.count("*").alias("n_true")), "s1", "left").select("s1", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    grid = train.stage("decision_grid", lambda: decide.tune(train.pairs, truth, counts, list(s.thresholds), list(s.margins)))
    best = grid.orderBy(F.desc("f05"), "threshold", "margin").first()
    limits = (best["threshold"] if threshold is None else threshold, best["margin"] if margin is None else margin)
    again = threshold is not None or margin is not None
    found = train.tables() | train.decided(*limits, again) | {"decision_grid": grid}
    found["report"] = tables.cached(raw.sparkSession, f"{out}/report", lambda: evaluate.macro_f05(found["matches"].select("rec", "s1"), truth, train.ones), force or again)
    if test is not None:
        other = Run(test, f"{out}/test", s, force, maps, trained=train)
        found |= {f"test_{k}": v for k, v in (other.tables() | other.decided(*limits, again)).items()}
    return found


def read_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """The three sources of a split as raw records."""
    out = None
    for number in (1, 2, 3):
        rows = tables.read_source(spark, folder, split, number).select(F.col("entity_id").alias("id"), "country", F.lit(number).alias("src"), F.col("business_name").alias("name_raw"), F.col("business_address").alias("addr_raw"))
        out = rows if out is None else out.union(rows)
    return out


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--sources", required=True)
    args.add_argument("--split", default="train")
    args.add_argument("--test", help="a split to be predicted with the models of the first")
    args.add_argument("--out", required=True)
    args.add_argument("--threshold", type=float, help="instead of the tuned one; saved probabilities are decided anew")
    args.add_argument("--margin", type=float, help="instead of the tuned one")
    args.add_argument("--log", help="a CSV file on the driver to which the run's score is appended")
    args.add_argument("--force", action="store_true")
    given = args.parse_args()
    spark = SparkSession.builder.appName("linkage").getOrCreate()
    truth = tables.truth_pairs(tables.read_tsv(spark, f"{given.sources}/{given.split}_ground_truth.tsv", tables.TRUTH_COLUMNS))
    test = read_split(spark, given.sources, given.test) if given.test else None
    found = run(read_split(spark, given.sources, given.split), truth, given.out, force=given.force, test=test, threshold=given.threshold, margin=given.margin)
    tables.write_lists(found["lists"], f"{given.out}/matching_results", "s1")
    if test is not None:
        tables.write_lists(found["test_lists"], f"{given.out}/test/matching_results", "s1")
    found["report"].show()
    if given.log:
        tables.log_run(given.log, {"out": given.out, "matches": found["matches"].count(), **found["report"].first().asDict()})


if __name__ == "__main__":
    main()
