"""Block products against brute force, and that no table has a row for each pair that shares a token."""

import math
import random

from tessera.operators import blocking, sparse
from tessera.plans import linkage


def _rows(spark, text_ids):
    rng = random.Random(3)
    words = ["ab", "abc", "bcd", "cde", "x", "zz9", "den"]
    name = lambda: " ".join(rng.choices(words, k=rng.randint(0, 4)))
    rows = [(f"r{k:03d}" if text_ids else k, "c" if k % 7 else "d", 1 + k % 3, name(), name()) for k in range(120)]
    rows += [(f"s{k}" if text_ids else 900 + k, "alone", 1, "ab", "x") for k in range(3)] + [("t" if text_ids else 990, None, 2, "ab", "x")]
    return rows, spark.createDataFrame(rows, f"id {'string' if text_ids else 'long'}, country string, src int, name string, addr string")


def _grams(text):
    return [f" {w} "[k : k + 3] for w in text.split() for k in range(len(w))]


def _scores(rows, field):
    """{(rec, s1): rounded cosine} by brute force."""
    out = {}
    for country in ("c", "d", "alone"):
        own = [r for r in rows if r[1] == country]
        lists = {r[0]: _grams(r[field]) for r in own}
        df = {}
        for g in lists.values():
            for t in set(g):
                df[t] = df.get(t, 0) + 1
        w = {}
        for i, g in lists.items():
            raw = {t: (1 + math.log(g.count(t))) * (1 + math.log((1 + len(own)) / (1 + df[t]))) for t in set(g)}
            length = math.sqrt(sum(x * x for x in raw.values()))
            w[i] = {t: x / length for t, x in raw.items()}
        for a in own:
            for b in own:
                shared = w[a[0]].keys() & w[b[0]].keys()
                if a[2] > 1 and b[2] == 1 and shared:
                    out[a[0], b[0]] = math.floor(sum(w[a[0]][t] * w[b[0]][t] for t in shared) * 1e6 + 0.5) / 1e6
    return out


def test_block_products(spark):
    for text_ids in (False, True):
        rows, df = _rows(spark, text_ids)
        name, addr = _scores(rows, 3), _scores(rows, 4)
        packed = sparse.packed_grams(df, ["name", "addr"])
        out = sparse.top_views(packed, {"n": sparse.View((0,), 3, 0.3), "both": sparse.View((0, 1), 4, factor=0.5)}, 3, records=16, entities=9)
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroupsInArrow")[0]
        got = {(r["view"], r["rec"], r["rank"]): (r["s1"], r["score"]) for r in out.collect()}
        both = {p: math.floor((name.get(p, 0) + addr.get(p, 0)) * 0.5 * 1e6 + 0.5) / 1e6 for p in name.keys() | addr.keys()}
        wanted = {}
        for view, scores, k, least in (("n", name, 3, 0.3), ("both", both, 4, 0.0)):
            for rec in {p[0] for p in scores}:
                best = sorted((-s, p[1]) for p, s in scores.items() if p[0] == rec and s >= least)[:k]
                wanted |= {(view, rec, n + 1): (s1, -s) for n, (s, s1) in enumerate(best)}
        assert got == wanted
        pairs = spark.createDataFrame([(r[1], r[0], e[0], 5) for r in rows for e in rows if r[2] > 1 and e[2] == 1 and r[1] == e[1] == "c"][::7], f"country string, rec {df.dtypes[0][1]}, s1 {df.dtypes[0][1]}, more int")
        cosines = sparse.pair_cosines(pairs, packed, ["x", "y"], 3, records=16, entities=9).collect()
        assert len(cosines) == pairs.count()
        assert all((r["x"], r["y"], r["more"]) == (name.get((r["rec"], r["s1"]), 0.0), addr.get((r["rec"], r["s1"]), 0.0), 5) for r in cosines)
    assert sparse.top_views(packed.limit(0), {"n": sparse.View((0,), 3)}, 3).count() == 0


def test_no_row_for_each_shared_token(spark):
    """Equal names: pairs are the square of the rows, no operator's output may be."""
    rows = [(k, "c", 1 + k % 2, f"alpha beta{'' if k % 2 else ' gamma'}", "one two") for k in range(400)]
    df = spark.createDataFrame(rows, "id long, country string, src int, name_n string, addr_n string")
    words = [blocking.weights(blocking.postings(df, blocking.F.split(f, " ")), blocking.country_sizes(df)) for f in ("name_n", "addr_n")]
    out = sparse.top_views(sparse.packed_words(words), {"v": sparse.View((0, 1), 5, 0.02)})
    assert out.count() == 200 * 5 and out.filter("rec % 2 = 1 AND s1 = 2 * (rank - 1)").count() == 200 * 5
    names = linkage.candidates.__code__.co_names
    assert "index_scores" not in names and "pair_token_cosines" not in names


def test_words_of_any_number_of_entities(spark, tmp_path):
    """A word that more than 2,000 entities hold finds partners in q_token_topk_full; other queries keep to their SQL."""
    import duckdb

    from tessera.plans import record_queries as R

    letters = lambda k: "q" + "".join(chr(97 + int(x)) for x in str(k))
    many = R.MOST_ENTITIES + 1
    rows = [(k, f"shared {letters(k)}" if k else "shared only", "src1") for k in range(many)]
    # by the common word of its name alone; by the same and a word of one entity; by nothing
    rows += [(many, "shared", "src9"), (many + 1, f"shared {letters(5)}", "src15"), (many + 2, "other words", "src9")]
    db = duckdb.connect()
    db.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, 'en', ?, 1)", rows)
    db.sql(f"COPY documents TO '{tmp_path}/documents.parquet'")
    found = {name: sorted(map(tuple, R.QUERIES[name](spark, str(tmp_path)).collect())) for name in ("q_token_topk_full", "q_jaro_winkler", "q_pair_agreement")}
    for name in found:
        assert found[name] == sorted(db.sql(R.SQL[name]).fetchall())
    idf = {n: math.log((1 + len(rows)) / (1 + n)) + 1 for n in (1, 2, many + 2)}
    # words of one entity weigh alike: ties go to the smaller id, but that of the second record has a lighter word
    common, rare, twice = idf[many + 2], idf[1], idf[2]
    score = {k: common / math.hypot(common, twice if k == 5 else rare) for k in range(many)}
    best = sorted(score, key=lambda k: (-score[k], k))[:10]
    assert [r for r in found["q_token_topk_full"] if r[0] == many] == sorted((many, k, round(score[k], 6), n + 1) for n, k in enumerate(best))
    assert {r[1] for r in found["q_token_topk_full"] if r[0] == many + 1} >= {5}
    assert {r[0] for r in found["q_jaro_winkler"]} == {r[0] for r in found["q_pair_agreement"]} == {many + 1}
