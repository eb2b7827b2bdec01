import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import similarity as s
from tessera.operators import lookalike

words = st.text("abc d", max_size=12)


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b):
            row[k + 1], before = (before + 1 if x == y else max(row[k + 1], row[k])), row[k + 1]
    return row[-1]


@given(words, words)
@settings(max_examples=300, deadline=None)
def test_properties(a, b):
    assert s.common(a, b) == slow_common(a, b)
    assert s.ratio(a, b) == s.ratio(b, a)
    assert s.ratio(a, a) == 100
    assert s.partial(a, b) >= s.ratio(a, b) - 1e-9 or len(a) != len(b)
    assert s.token_sort(a, b) == s.token_sort(" ".join(reversed(a.split())), b)
    for score in (s.ratio, s.partial, s.token_sort, s.token_set):
        assert 0 <= score(a, b) <= 100
    assert 0 <= s.jaro_winkler(a, b) <= 1


@pytest.mark.parametrize(("a", "b", "want"), [("kitten", "sitting", 61.538), ("", "", 100), ("", "a", 0), ("abcd", "abxd", 75)])
def test_ratio(a, b, want):
    assert s.ratio(a, b) == pytest.approx(want, abs=1e-3)


def test_sets_and_parts():
    assert s.token_set("acme foods", "foods acme ltd") == 100
    assert s.token_set("", "a") == 0
    assert s.partial("acme", "the acme co") == 100
    assert s.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)


def test_scores_in_spark(spark):
    rows = spark.createDataFrame([("acme", "acme co"), (None, "x"), ("", "")], "a string, b string")
    got = s.with_scores(rows, "a", "b", "n", ("ratio", "partial")).orderBy("b").collect()
    by = {r["b"]: r["n_partial"] for r in got}
    assert by == {"acme co": 100.0, "x": None, "": 100.0}


@pytest.mark.parametrize(("a", "b", "want"), [("bar", "boulangerie", False), ("gaming", "gg", True), ("homes", "hs", True), ("pediatric", "pediatr", True), ("amis", "collectif", False)])
def test_close(a, b, want):
    assert (lookalike.likeness(a, b) is not None) is want


def test_compared():
    acronym = lookalike.compared(["tata", "consultancy", "services"], ["tcs"], {}, 0.0)
    assert acronym["la_acronym"] == 1 and acronym["la_n_missing"] == 0 and acronym["la_swap_jw"] is None
    stats = {"collectif": (0.0, 1.0, "vocab"), "amis": (0.0, 2.0, "vocab"), "services": (1.0, 3.0, "filler")}
    swap = lookalike.compared(["mauges", "amis"], ["mauges", "collectif"], stats, -1.0)
    assert (swap["la_swap_vocab"], swap["la_swap_same_initial"], swap["la_extra_vocab_len_min"], swap["la_missing_lshare_min"]) == (1, 0, 9, 2)
    filler = lookalike.compared(["pediatric", "clinic"], ["pediatric", "services"], stats, -1.0)
    assert (filler["la_extra_filler"], filler["la_swap_vocab"]) == (1, 0)
    assert set(lookalike.compared([], ["a"], {}, 0.0).values()) == {None}
    assert lookalike.difference(["blue", "skies"], ["blueskies"]) == ([], [])
    assert lookalike.difference(["blue", "sky"], ["bluesky"]) == (["sky"], [])  # only words of four letters count as glued
