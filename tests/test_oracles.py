"""Every query with SQL gives what DuckDB gives for it, rows in any order."""

import math

import pandas as pd
import pytest
from conftest import SF

from tessera import queries
from tessera.functions import fixed, similarity
from tessera.operators import features, lookalike


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    found, wanted = ordered(queries.QUERIES[name](spark, SF).toPandas()), ordered(duck.sql(queries.SQL[name]).df())
    pd.testing.assert_frame_equal(found, wanted, check_dtype=False)


def rows_of(spark, name):
    assert name not in queries.SQL
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def names(spark):
    """(s1_name, rec_name, country) by pair, and the words' statistics by country."""
    from tessera.plans import bindings as B
    from tessera.plans import record_queries as R

    pairs = {(r["rec"], r["s1"]): r for r in R._name_pairs(spark, SF).collect()}
    stats = {(r["country"], r["token"]): r for r in lookalike.token_stats(*B.sides(B.records(spark, SF))).withColumn("class", lookalike.word_class()).collect()}
    sizes = {r["country"]: r["n1"] for r in stats.values()}
    return pairs, stats, sizes


def words_of(name):
    skip = set(fixed.LEGAL_FORMS) | set(fixed.NAME_FILLER)
    return list(dict.fromkeys(w for w in name.split(" ") if len(w) > 1 and w not in skip))


def looked(pair, stats, sizes):
    a, b, c = words_of(pair["s1_name"]), words_of(pair["rec_name"]), pair["country"]
    own = {w: (stats[c, w]["lratio"], stats[c, w]["lshare"], stats[c, w]["class"]) for w in {*a, *b} if (c, w) in stats}
    return lookalike.compared(a, b, own, math.log(0.5 / max(sizes.get(c, 1), 1) * 1e6))


def swaps(look):
    return look["la_swap_vocab"] == 1 and look["la_swap_same_initial"] == 0 and (look["la_extra_vocab_len_min"] or 0) >= 4


def test_look_alikes_one_by_one(spark, names):
    pairs, stats, sizes = names
    got = {(r["rec"], r["s1"]): r for r in rows_of(spark, "q_lookalike")}
    assert got.keys() == pairs.keys()
    for key, pair in pairs.items():
        for column, want in looked(pair, stats, sizes).items():
            assert got[key][column] == (want if want is None else pytest.approx(want, abs=1e-6))
    kept = {(r["rec"], r["s1"]) for r in rows_of(spark, "q_postfilter")}
    dropped = {k: p for k, p in pairs.items() if swaps(looked(p, stats, sizes))}
    assert kept == pairs.keys() - dropped.keys()
    for r in rows_of(spark, "q_postfilter_counts"):
        assert r["pairs"] == sum(p["country"] == r["country"] for p in pairs.values()) and r["dropped"] == sum(p["country"] == r["country"] for p in dropped.values())
    for r in rows_of(spark, "q_swap_profile"):
        own = {k for k, p in dropped.items() if p["country"] == r["country"]}
        assert (r["swaps"], r["swapped_entities"]) == (len(own), len({s1 for _, s1 in own}))


def test_scores_one_by_one(spark, names):
    functions = (similarity.ratio, similarity.partial, similarity.token_sort, similarity.token_set, similarity.jaro_winkler)
    for r in rows_of(spark, "q_pair_scores"):
        pair = names[0][r["rec"], r["s1"]]
        for name, f in zip(similarity.SCORES, functions):
            assert r[f"n_{name}"] == pytest.approx(f(pair["s1_name"], pair["rec_name"]), abs=1e-6)


def test_columns_of_pairs(spark, duck):
    """The 83 columns against scores, windows and fields made one by one."""
    from tessera.plans import bindings as B

    records = {r["id"]: r for r in B.records(spark, SF).collect()}
    got = rows_of(spark, "q_pair_features")
    assert got and set(features.BASE) <= got[0].keys()
    by = {}
    for r in got:
        by.setdefault(("rec", r["rec"]), []).append(r)
        by.setdefault(("s1", r["s1"]), []).append(r)
    for r in got:
        a, b = records[r["s1"]], records[r["rec"]]
        assert r["n_ratio"] == pytest.approx(similarity.ratio(a["name_n"], b["name_n"]), abs=1e-6)
        assert r["a_token_sort"] == pytest.approx(similarity.token_sort(a["addr_n"], b["addr_n"]), abs=1e-6)
        assert r["x_name_addr"] == pytest.approx(similarity.partial(a["addr_n"], b["name_n"]), abs=1e-6)
        assert r["s1_first_in_rec"] == pytest.approx(similarity.partial(a["first"], b["name_core"]), abs=1e-6)
        assert r["num_token_set"] == (pytest.approx(similarity.token_set(a["addr_nums"], b["addr_nums"]), abs=1e-6) if a["addr_nums"] and b["addr_nums"] else None)
        assert (r["d_name_len"], r["r_addr_ntok"]) == (abs(len(a["name_n"]) - len(b["name_n"])), len(b["addr_n"].split()))
        assert r["house_eq"] == (float(a["house"] == b["house"]) if a["house"] and b["house"] else None)
        for key in ("rec", "s1"):
            group = by[key, r[key]]
            assert r[f"{key}_n_cands"] == len(group) and r[f"{key}_sum_p1"] == pytest.approx(sum(x["p1"] for x in group), abs=1e-5)
            assert r[f"{key}_p1_gap"] == pytest.approx(max(x["p1"] for x in group) - r["p1"], abs=1e-5)
            assert sorted(x[f"{key}_full_rank"] for x in group) == list(range(len(group)))
        assert r["cos_full"] == pytest.approx((r["cos_name"] + r["cos_addr"]) / 2, abs=1e-6)
    first = {(r["rec"], r["s1"]): r for r in rows_of(spark, "q_stage1_features")}
    for r in got:
        other = first[r["rec"], r["s1"]]
        assert other["x_name_ratio"] == r["c_ratio"] and other["n_views"] == sum(r[c] for c in features.VIEW_COLUMNS)
    assert {(r["rec"], r["s1"]) for r in rows_of(spark, "q_rare_scores")} == first.keys()


def test_left_out_report(spark):
    report = rows_of(spark, "q_leave_one_out_report")
    assert sorted(r["country"] for r in report) == ["c0", "c1", "c2"] and all(0 <= r["f05"] <= 1 for r in report)


def test_models_of_folds(spark):
    """Rows scored, labels kept, probabilities in range; importances sum to one; a shift changes decisions only, not rows."""
    scored = {name: rows_of(spark, name) for name in ("q_out_of_fold", "q_second_family", "q_fold_mean")}
    sizes = {len(v) for v in scored.values()}
    assert len(sizes) == 1 and all(0 <= r["p"] <= 1 for v in scored.values() for r in v)
    for name in ("q_out_of_fold", "q_second_family"):
        hit = [r["p"] for r in scored[name] if r["label"] == 1]
        rest = [r["p"] for r in scored[name] if r["label"] == 0]
        assert sum(hit) / len(hit) >= sum(rest) / len(rest) - 0.05
    assert sum(r["importance"] for r in rows_of(spark, "q_importance")) == pytest.approx(1, abs=1e-6)
    assert sum(r["n"] for r in rows_of(spark, "q_shift")) == sizes.pop()


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["rec", "s1", "p", "second"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
