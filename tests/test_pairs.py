"""Sources, decisions, evaluation and learning on small tables."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking, decide, evaluate, groups, learn, translit
from tessera.sources import tables


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_tsv_round_trip(spark, tmp_path):
    path = str(tmp_path / "train_source1.tsv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('country\tentity_id\tbusiness_name\tbusiness_address\textra\nUS\tS1-1\tNA "x\\\t\tz\n')
    got = tables.read_source(spark, str(tmp_path), "train", 1).collect()
    assert [tuple(r) for r in got] == [("S1-1", 'NA "x\\', "", "US")]
    with pytest.raises(ValueError):
        tables.read_tsv(spark, path, ("nothing",))


def test_lists_round_trip(spark, tmp_path):
    pairs = frame(spark, [("a", "r2", 1), ("a", "r1", 2), ("a", "r1", 2)], "s1 string, rec string, ord int")
    entities = frame(spark, [("b",), ("a",)], "s1 string")
    assert sorted(map(tuple, tables.id_lists(pairs, entities).collect())) == [("a", "r1,r2"), ("b", "")]
    lists = tables.pair_lists(pairs, entities)
    assert sorted(map(tuple, lists.collect())) == [("a", "r2,r1,r1"), ("b", "")]
    path = str(tmp_path / "out")
    tables.write_lists(lists, path, "s1")
    back = tables.read_lists(spark, path)
    assert sorted(map(tuple, back.collect())) == [("a", "r2,r1,r1"), ("b", "")]
    assert tables.truth_pairs(back.toDF(*tables.TRUTH_COLUMNS)).count() == 3
    with open(tmp_path / "cr.tsv", "w", newline="") as f:
        f.write("source1_entity_id\tmatched_entity_ids\r\na\tb\r\n")
    with pytest.raises(ValueError):
        tables.read_lists(spark, str(tmp_path / "cr.tsv"))


def test_labels_reject_unknown_ids(spark):
    s1, rec = frame(spark, [("a",)], "s1 string"), frame(spark, [("r",), ("q",)], "rec string")
    true, counts = tables.labels(frame(spark, [("a", "r")], "s1 string, rec string"), s1, rec)
    assert sorted(map(tuple, true.collect())) == [("q", None), ("r", "a")] and counts.first()[1] == 1
    with pytest.raises(ValueError):
        tables.labels(frame(spark, [("a", "zz")], "s1 string, rec string"), s1, rec)


def test_cached_table_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.cached(spark, str(tmp_path / "t"), build).count() == 3
    assert len(calls) == 1
    tables.write_sidecar(str(tmp_path / "m.json"), {"a": 1})
    tables.log_run(str(tmp_path / "log.csv"), {"a": 1, "b": 2})
    tables.log_run(str(tmp_path / "log.csv"), {"a": 3, "b": 4})
    assert (tmp_path / "log.csv").read_text().split() == ["a,b", "1,2", "3,4"]


def test_f05_examples(spark):
    truth = frame(spark, [("S2-00047", 1), ("S3-00812", 1), ("x", 3), ("y", 4), ("z", 6)], "rec string, s1 int")
    found = frame(spark, [("S2-00047", 1), ("S3-00812", 1), ("S2-00193", 1), ("q", 2), ("w", 4), ("z", 6)], "rec string, s1 int")
    entities = frame(spark, [(k,) for k in (1, 2, 3, 4, 5, 6)], "s1 int")
    got = {r["s1"]: r["f05"] for r in evaluate.entity_scores(found, truth, entities).collect()}
    assert got[1] == pytest.approx(0.7143, abs=1e-3)
    assert (got[2], got[3], got[4], got[5], got[6]) == (0, 0, 0, 1, 1)


def test_every_record_at_most_once(spark):
    pairs = frame(spark, [(r, s, (r * 7 + s * 3) % 10 / 10, s) for r in range(30) for s in range(4)], "rec int, s1 int, p double, ord int")
    best = decide.select(pairs, 0.3, 0.1)
    assert best.count() == best.select("rec").distinct().count()
    assert best.join(pairs, ["rec", "s1"], "left_anti").count() == 0
    assert groups.pruned(pairs, "p", 2, 0.2).groupBy("rec").count().filter("count > 2").isEmpty()


def test_override_checks_entities(spark):
    a, b = frame(spark, [("x", "1"), ("y", "2")], "s1 string, matches string"), frame(spark, [("x", "3"), ("y", "4")], "s1 string, matches string")
    labels = frame(spark, [("x", "US"), ("y", "FR")], "s1 string, country string")
    known = frame(spark, [("US",)], "country string")
    assert sorted(map(tuple, decide.overridden(a, b, labels, known).collect())) == [("x", "1"), ("y", "4")]
    with pytest.raises(ValueError):
        decide.overridden(a, b.limit(1), labels, known)


def test_index_equals_cross_join(spark):
    rows = frame(spark, [(i, "c", 1 if i % 3 == 0 else 2, f"w{i % 4} w{i % 5} w{i % 7}") for i in range(40)], "id long, country string, src int, t string")
    w = blocking.weights(blocking.postings(rows, F.split("t", " ")), blocking.country_sizes(rows))
    one = w.filter("id % 3 = 0")
    scored = {(r["rec"], r["s1"]): r["score"] for r in blocking.token_scores(w.filter("id % 3 <> 0"), blocking.index_of(one, 1000)).collect()}
    by = {}
    for i, _, token, x in w.select("id", "country", "token", "w").collect():
        by.setdefault(i, {})[token] = x
    for i in by:
        for j in by:
            if i % 3 and not j % 3:
                want = round(sum(x * by[j].get(t, 0) for t, x in by[i].items()), 6)
                assert scored.get((i, j), 0.0) == pytest.approx(want, abs=2e-6)


def test_learned_spellings(spark):
    pairs = frame(spark, [("प्राइवेट acme", "private acme")] * 5 + [("प्राइवेट x", "pvt x")], "rec_name string, s1_name string")
    learned = translit.token_map(pairs)
    assert [tuple(r) for r in learned.collect()] == [("प्राइवेट", "private", 5, 6)]
    rows = frame(spark, [(1, "Acme प्राइवेट"), (2, "")], "id long, name string")
    assert sorted(map(tuple, translit.applied(rows, "name", learned).collect())) == [(1, "Acme private"), (2, "")]
    places = frame(spark, [("गुजरात, x", "gujarat, surat")] * 6, "rec_addr string, s1_addr string")
    assert translit.component_map(places).first()["target"] in {"gujarat", "surat"}


def test_out_of_fold_covers_all(spark):
    rows = frame(spark, [(r, s, float(r % 2), None if r % 5 == 0 else r / 7, "a" if s % 2 else "b") for r in range(60) for s in range(6)], "rec int, s1 int, label double, x double, country string")
    rows = rows.withColumn("y", F.col("label") + 0.0)
    out, models = learn.out_of_fold(rows, ["x", "y"], folds=2, rounds=2)
    assert out.count() == rows.count() and out.filter("(p >= 0.5) <> (label = 1)").count() == 0
    assert learn.fold_mean(models, rows, ["x", "y"]).count() == rows.count()
    assert learn.importances(models, ["x", "y"])[0][0] == "y"
    assert learn.leave_one_out(rows, ["x", "y"], "country", kind="logistic", rounds=3).count() == rows.count()
    import zlib

    assert {(r["s1"], r["f"]) for r in rows.select("s1", learn.fold_of(F.col("s1"), 3).alias("f")).distinct().collect()} == {(s, zlib.crc32(str(s).encode()) % 3) for s in range(6)}
