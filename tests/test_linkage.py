"""A run from raw records to lists, linkage of a stream, and the projection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import blocking, evaluate, features, translit
from tessera.plans import linkage
from tessera.streaming import incremental

FIRST = ["acme", "blue", "cedar", "delta", "ember", "forge", "granite", "harbor", "indigo", "jade", "kite", "lunar"]
SECOND = ["foods", "motors", "books", "clinic", "textiles"]


def raw_rows():
    rows, truth = [], []
    for k, a in enumerate(FIRST):
        for j, b in enumerate(SECOND):
            n = k * len(SECOND) + j
            country = "US" if n % 2 else "FR"
            rows.append((n, country, 1, f"{a} {b} ltd", f"{n + 1} {a} street"))
            if n % 4:
                rows.append((1000 + n, country, 2, f"{a} {b}", f"{n + 1} {a} st"))
                truth.append((1000 + n, n))
            if n % 3 == 0:
                rows.append((2000 + n, country, 3, f"{a.title()} {b} Limited", ""))
                truth.append((2000 + n, n))
    return rows, truth


def test_whole_run(spark, tmp_path):
    rows, pairs = raw_rows()
    schema = "id long, country string, src int, name_raw string, addr_raw string"
    raw, truth = spark.createDataFrame(rows, schema), spark.createDataFrame(pairs, "rec long, s1 long")
    limits = linkage.Settings(folds=2, rounds=2, stage1_share=0.8, thresholds=(0.3, 0.5), margins=(0.0,))
    out = str(tmp_path / "run")
    found = linkage.run(raw, truth, out, limits, test=raw.withColumn("id", F.col("id") + 10_000))
    assert found["report"].first()["f05"] > 0.8
    assert found["features"].columns[:4] == ["rec", "s1", "country", "ord"] and set(features.BASE) <= set(found["features"].columns)
    for split in ("", "test_"):
        assert found[f"{split}lists"].count() == len(FIRST) * len(SECOND)
        assert found[f"{split}matches"].count() == found[f"{split}matches"].select("rec").distinct().count() > 0
    shifted = truth.select(F.col("rec") + 10_000, F.col("s1") + 10_000).toDF("rec", "s1")
    ones = found["test_records"].filter("src = 1").select(F.col("id").alias("s1"))
    assert evaluate.macro_f05(found["test_matches"].select("rec", "s1"), shifted, ones).first()["f05"] > 0.8
    again = linkage.run(raw, truth, out, limits)
    assert again["matches"].count() == found["matches"].count()
    strict = linkage.run(raw, truth, out, limits, threshold=1.1)
    assert strict["matches"].count() == 0 and strict["stage3"].count() == found["stage3"].count()


def test_learned_spellings(spark):
    raw = [(k, "IN", 1, f"delhi traders {k}", f"{k} road, mumbai") for k in range(6)] + [(100 + k, "IN", 2, f"दिल्ली traders {k}", f"{k} road, मुंबई") for k in range(6)]
    rows = spark.createDataFrame([*raw, (200, "IN", 3, "दिल्ली", "मुंबई, 4 lane"), (201, "IN", 3, None, ""), (202, "IN", 3, "", None)], "id long, country string, src int, name_raw string, addr_raw string").na.fill("")
    truth = spark.createDataFrame([(100 + k, k) for k in range(6)], "rec long, s1 long")
    maps = translit.learned_maps(rows, truth)
    assert {tuple(r) for r in maps[0].select("token", "target").collect()} == {("दिल्ली", "delhi")}
    got = {r["id"]: r for r in translit.spelled(rows, *maps).collect()}
    assert (got[200]["name_raw"], got[200]["addr_raw"], got[200]["non_latin"]) == ("delhi", "mumbai, 4 lane", True)
    assert got[3]["non_latin"] is False and len(got) == 15
    fields = {r["id"]: r for r in linkage.normalised(translit.spelled(rows, *maps)).collect()}
    assert fields[200]["name_n"] == "delhi" and fields[200]["name_non_latin"] and not fields[3]["name_non_latin"]


def test_lists_of_columns():
    assert len(features.BASE) == 83 and len(features.model_columns("A", 3)) == 110 and len(features.model_columns("B", 3)) == 107
    with pytest.raises(ValueError):
        features.chosen(["a"], ("b",), ("c",))


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([r for r in raw_rows()[0]], "id long, country string, src int, name_raw string, addr_raw string")
    rows = rows.select("id", "country", "src", text.tokens(F.col("name_raw")).alias("words"))
    ones = rows.filter("src = 1")
    counts, sizes = blocking.postings(ones, F.col("words")), blocking.country_sizes(ones)
    index, idf = blocking.index_of(blocking.weights(counts, sizes), 1000), blocking.idf(counts, sizes)
    rows.filter("src = 2").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = incremental.link_stream(stream, index, idf, str(tmp_path / "out"), str(tmp_path / "check"), 0.3, 0.0)
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 0 and got.filter("rec - 1000 <> s1").count() == 0


def test_projection(spark):
    rows = spark.createDataFrame([(i, "c", f"word{i % 5} other{i % 3} {'abcdefgh'[i % 8:]}") for i in range(60)], "id long, country string, t string")
    w = blocking.weights(blocking.gram_counts(rows, F.col("t")), blocking.country_sizes(rows))
    known, parts = blocking.svd_components(w, 40)
    got = {r["id"]: np.array(r["vector"]) for r in blocking.projected(w, known, parts).collect()}
    exact = {}
    for i, _, t, x in w.select("id", "country", "token", "w").collect():
        exact.setdefault(i, {})[t] = x
    for i in range(0, 60, 7):
        for j in range(0, 60, 11):
            assert abs(got[i] @ got[j] - sum(x * exact[j].get(t, 0) for t, x in exact[i].items())) < 0.05
