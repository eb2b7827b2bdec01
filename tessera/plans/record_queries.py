"""Queries over records: normalisation, keys, retrieval, and statistics of words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fixed, similarity, text
from tessera.operators import analysis, blocking, decide, evaluate, features, groups, lookalike, sparse, translit
from tessera.plans import bindings as B
from tessera.plans import linkage
from tessera.sources import tables
from tessera.sources.shared import Once

#: Most entities that hold a word of the index: of names and addresses (q_token_topk_full has no such limit), of whole texts.
MOST_ENTITIES, MOST_TEXTS = 2000, 50
THRESHOLD, MARGIN = 0.6, 0.1


_once = Once()


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(("records", sf_dir), lambda: B.records(spark, sf_dir))


def _r(c, n: int = 6):
    return F.round(c, n)


# ---- normalisation


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.array_join(text.tokens(F.coalesce("text", F.lit(""))), " ").alias("tokens"), F.size(text.tokens(F.coalesce("text", F.lit("")))).cast("long").alias("n"))


def q_norm_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("id", "name_n", "name_core", "name_ns", "is_domain", "name_non_latin", "legal", "first")


def q_norm_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("id", "addr_n", "addr_nums", "house", "postal", "addr_empty", "state")


def q_website_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = text.name_fields(F.regexp_extract("url", "^https?://([^/?#]*)", 1))
    return B.table(spark, sf_dir, "pages").select("page_id", fields.alias("f")).select("page_id", "f.name_n", "f.name_ns", "f.is_domain")


def q_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        "id", F.length("name_n").alias("name_len"), F.length("addr_n").alias("addr_len"), text.word_count(F.col("name_n")).alias("name_ntok"), text.address_word_count(F.col("addr_n")).alias("addr_ntok")
    )


def q_accent_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "documents").select("doc_id", text.folded(F.coalesce("text", F.lit(""))).alias("folded"))


def q_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose commas were read in a wrong encoding, as three characters of which one is the mark of such errors.

    Texts with letters of other encodings beside them cannot have been read so, and stay as they are.
    """
    broken = F.replace("text", F.lit(","), F.lit("\u00e2\u20ac\u201c"))
    return B.table(spark, sf_dir, "benchmark").select("item_id", tables.repaired(broken).alias("text"))


def q_address_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.col("p_size").cast("string"), F.lit(" st "), F.lower("p_name"))
    return B.table(spark, sf_dir, "part").select("p_partkey", text.address_key(line).alias("key"))


def q_token_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.raw_records(spark, sf_dir)
    names = rows.filter("src = 1").select(F.col("id").alias("s1"), F.col("name_raw").alias("s1_name"))
    pairs = B.truth(spark, sf_dir).join(names, "s1").join(rows.select(F.col("id").alias("rec"), F.col("name_raw").alias("rec_name")), "rec")
    return translit.token_map(pairs, least=1)


# ---- keys


def q_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, rows = B.parts(spark, sf_dir)
    return blocking.key_pairs(s1, rows, ["name_core"], 20)


def q_house_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, rows = B.parts(spark, sf_dir)
    return blocking.house_pairs(s1, rows, 50)


def q_address_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, s1) with the same house number and beginning of the street in one country."""
    line = F.concat(F.col("house"), F.lit(" "), F.col("name_core"))
    s1, rows = (t.withColumn("key", text.address_key(line)).filter("key IS NOT NULL") for t in B.parts(spark, sf_dir))
    return blocking.key_pairs(s1, rows, ["key"], 50)


# ---- words and trigrams


def _weights(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    """Weights of a field's distinct tokens, records and entities."""
    rows = _records(spark, sf_dir).select("id", "country", "src", F.filter(F.split(field, " "), lambda t: t != "").alias("_w"))
    return _once(("weights", sf_dir, field), lambda: blocking.weights(blocking.postings(rows, F.col("_w")), blocking.country_sizes(rows)))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, country, src, _w): the words of whole texts."""
    words = text.tokens(F.coalesce("text", F.lit("")))
    return B.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("country"), B.source_number().alias("src"), words.alias("_w"))


def q_token_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir)
    return blocking.idf(blocking.postings(rows, F.col("_w")), blocking.country_sizes(rows)).select("country", "token", "df", _r("idf").alias("idf"))


#: Views by words: of names, of addresses, of both.
_WORD_VIEWS = {"tname": sparse.View((0,), 5, 0.02), "taddr": sparse.View((1,), 5, 0.02), "tfull": sparse.View((0, 1), 10, 0.02)}


def _word_views(spark: SparkSession, sf_dir: str, *names: str, most: int | None = MOST_ENTITIES) -> DataFrame:
    """(view, country, rec, s1, score, rank) of the named views by words; both fields are packed in any case.

    The index leaves out words of more than ``most`` entities, none if that is None.
    """
    rows = sparse.packed_words([blocking.held(_weights(spark, sf_dir, f), most) for f in ("name_n", "addr_n")])
    return _once(("word_views", sf_dir, names, most), lambda: sparse.top_views(rows, {n: _WORD_VIEWS[n] for n in names}))


def _word_view(spark: SparkSession, sf_dir: str, name: str, most: int | None = MOST_ENTITIES) -> DataFrame:
    return _word_views(spark, sf_dir, name, most=most).select("rec", "s1", "score", "rank")


def q_token_topk_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_view(spark, sf_dir, "tname")


def q_token_topk_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_view(spark, sf_dir, "taddr")


def q_token_topk_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name plus address score of every pair that shares a word in either, however common."""
    return _word_view(spark, sf_dir, "tfull", None)


def q_token_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _weights(spark, sf_dir, "name_n")
    pairs = _word_views(spark, sf_dir, "taddr").select("country", "rec", "s1")
    return blocking.pair_token_cosines(pairs, w.filter("src > 1"), w.filter("src = 1")).select("rec", "s1", "cos")


def _gram_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("id", "country", "src", "name_ns", "name_core")


def q_gram_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gram_rows(spark, sf_dir)
    return blocking.idf(blocking.gram_counts(rows, F.col("name_core")), blocking.country_sizes(rows)).select("country", "token", "df", _r("idf").alias("idf"))


def q_gram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sparse.packed_grams(_gram_rows(spark, sf_dir), ["name_core"])
    return sparse.top_views(rows, {"core": sparse.View((0,), 3, 0.3)}, width=3).select("rec", "s1", "score", "rank")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word TF-IDF of whole texts within the country, the best entity of each record under a threshold and a margin."""
    rows = _texts(spark, sf_dir)
    w = _once(("text_weights", sf_dir), lambda: blocking.weights(blocking.postings(rows, F.col("_w")), blocking.country_sizes(B.raw_records(spark, sf_dir))))
    pairs = blocking.index_scores(w, MOST_TEXTS).withColumnsRenamed({"score": "p"}).withColumn("ord", F.col("s1"))
    return decide.select(pairs, THRESHOLD, MARGIN).select("rec", "s1", "p", "second")


# ---- vectors


def q_dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, queries = B.vectors(spark, sf_dir)
    return blocking.dense_top_k(queries, index, 5)


def _dense_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    index, queries = B.field_vectors(spark, sf_dir)
    return blocking.dense_views(queries, index, {view: 5})[view]


def q_dense_topk_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense_view(spark, sf_dir, "full")


def q_dense_topk_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense_view(spark, sf_dir, "name")


def q_dense_topk_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense_view(spark, sf_dir, "addr")


def q_pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pairs = rows.select(F.col("vec_id").alias("rec"), F.col("embedding").alias("_a")).withColumn("s1", F.col("rec") - F.col("rec") % 10)
    return pairs.join(rows.select(F.col("vec_id").alias("s1"), F.col("embedding").alias("_b")), "s1").select("rec", "s1", _r(blocking.dot(F.col("_a"), F.col("_b"))).alias("cos"))


# ---- union and report


VIEWS = ("full", "tname", "taddr", "tfull", "key", "hkey")
FULL_K = 30


def _gram_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of half the name's and half the address's trigram cosine, over all pairs that share a trigram."""
    rows = sparse.packed_grams(_records(spark, sf_dir), ["name_n", "addr_n"])
    return sparse.top_views(rows, {"full": sparse.View((0, 1), FULL_K, factor=0.5)}, width=3)


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    words = _word_views(spark, sf_dir, *_WORD_VIEWS)
    return _once(("union", sf_dir), lambda: blocking.union_views({
        "full": _gram_full(spark, sf_dir), **{v: words.filter(F.col("view") == v) for v in _WORD_VIEWS},
        "key": blocking.key_pairs(s1, recs, ["name_core"], 20), "hkey": blocking.house_pairs(s1, recs),
    }))


def q_view_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(spark, sf_dir)


def q_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _union(spark, sf_dir)
    sums = rows.agg(*[F.sum(blocking.has_view(v).cast("int")).alias(v) for v in VIEWS])
    return sums.selectExpr(f"stack({len(VIEWS)}, {', '.join(f"'{v}', {v}" for v in VIEWS)}) AS (view, pairs)")


def q_view_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analysis.view_report(_union(spark, sf_dir), B.truth(spark, sf_dir), {v: fixed.VIEW_BITS[v] for v in VIEWS})
    return out.withColumn("recall", _r("recall"))


def q_query_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature is a sample: a fifth of the records of every country, by hash."""
    return analysis.query_sample(B.raw_records(spark, sf_dir).filter("src > 1"), 0.2).select("id", "country")


def q_block_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ones = B.raw_records(spark, sf_dir).filter("src = 1").select(F.col("id").alias("s1"))
    out = evaluate.retrieval_report(_union(spark, sf_dir), B.truth(spark, sf_dir), ones)
    return out.select("pairs", *[_r(c).alias(c) for c in out.columns[1:]])


# ---- words


def q_name_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    return groups.name_frequency(s1, recs)


def q_common_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.without_common_tokens(_records(spark, sf_dir), "name_n", 0.01)


def q_name_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("id", F.array_join(text.name_words(F.col("name_n")), " ").alias("words"))


def q_token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    out = lookalike.token_stats(s1, recs)
    return out.select("country", "token", "df1", "df23", _r("lratio").alias("lratio"), _r("lshare").alias("lshare"), "vocab_min", lookalike.word_class().alias("class"))


def q_filler_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    sizes = s1.groupBy("country").agg(F.count("*").alias("n1")).join(recs.groupBy("country").agg(F.count("*").alias("n23")), "country")
    return lookalike.filler_ratios(lookalike.token_stats(s1, recs).drop("n1"), sizes, 3, 25)


def q_token_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    stats = lookalike.token_stats(s1, recs).select("country", "token", lookalike.word_class().alias("class"))
    words = recs.select("country", "src", F.explode(text.name_words(F.col("name_n"))).alias("token")).join(stats, ["country", "token"], "left")
    kind = F.coalesce("class", F.lit("rare"))
    return words.groupBy("country", "src").agg(F.count("*").alias("words"), *[F.sum((kind == k).cast("int")).alias(k) for k in ("filler", "vocab", "rare")])


def q_noise_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    flags = {"domain": F.col("is_domain"), "non_latin": F.col("name_non_latin"), "no_house": F.col("house") == "", "no_address": F.col("addr_empty")}
    out = evaluate.rates(rows, ["country", "src"], flags)
    return out.select("country", "src", "n", *[_r(c).alias(c) for c in flags])


def q_distinctiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.distinctiveness(_records(spark, sf_dir), ["country"], "first")
    return out.select("country", *[_r(c).alias(c) for c in out.columns[1:]])


def q_last_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.last_components(B.raw_records(spark, sf_dir), "addr_raw", 25)


def q_source_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.raw_records(spark, sf_dir).groupBy("country", "src").agg(F.count("*").alias("n"))


# ---- pairs of names


def _name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    pairs = _word_view(spark, sf_dir, "tfull").filter("rank <= 2").select("rec", "s1")
    a = rows.select(F.col("id").alias("s1"), "country", F.col("name_n").alias("s1_name"), F.col("addr_n").alias("s1_addr"))
    b = rows.select(F.col("id").alias("rec"), F.col("name_n").alias("rec_name"), F.col("addr_n").alias("rec_addr"))
    return _once(("name_pairs", sf_dir), lambda: pairs.join(a, "s1").join(b, "rec"))


def q_jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity.with_scores(_name_pairs(spark, sf_dir), "s1_name", "rec_name", "n", ("jaro_winkler",))
    return out.select("rec", "s1", _r("n_jaro_winkler").alias("jw"))


def q_pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity.with_scores(_name_pairs(spark, sf_dir), "s1_name", "rec_name", "n", similarity.SCORES)
    return out.select("rec", "s1", *[_r(f"n_{s}").alias(f"n_{s}") for s in similarity.SCORES])


def q_pair_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir).select("id", "house", "state", "postal", "legal", "first", "name_n", "addr_n", "is_domain", "name_non_latin", "addr_empty", "src")
    pairs = _word_view(spark, sf_dir, "tfull").filter("rank <= 2").select("rec", "s1")
    a = rows.select(F.col("id").alias("s1"), *[F.col(c).alias(f"a_{c}") for c in rows.columns[1:]])
    both = pairs.join(a, "s1").join(rows.withColumnRenamed("id", "rec"), "rec")
    equal = [text.equal_or_null(F.col(f"a_{c}"), F.col(c)).alias(f"{c}_eq") for c in ("house", "state", "postal", "legal", "first")]
    inside = lambda word, whole: F.when((word != "") & (whole != ""), F.contains(whole, word).cast("double"))
    sizes = [(F.length(f"a_{c}") - F.length(c)).alias(f"d_{c}_len") for c in ("name_n", "addr_n")]
    return both.select("rec", "s1", *equal, inside(F.col("a_first"), F.col("name_n")).alias("s1_first_in_rec"), inside(F.col("first"), F.col("a_name_n")).alias("rec_first_in_s1"), *sizes, "is_domain", "name_non_latin", "addr_empty", "src")


def q_same_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, n, share): pairs whose normalised addresses are equal."""
    rows = _name_pairs(spark, sf_dir)
    return rows.groupBy("country").agg(F.count("*").alias("n"), _r(F.avg((F.col("s1_addr") == F.col("rec_addr")).cast("int"))).alias("share"))


def q_lookalike(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    out = lookalike.pair_features(_name_pairs(spark, sf_dir), lookalike.token_stats(s1, recs))
    return out.select("rec", "s1", *[_r(c).alias(c) for c in lookalike.COLUMNS])


def q_postfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    return lookalike.post_filtered(_name_pairs(spark, sf_dir), lookalike.token_stats(s1, recs)).select("rec", "s1")


def q_difference_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.difference_kind(_name_pairs(spark, sf_dir)).groupBy("country", "kind").agg(F.count("*").alias("n"))


def q_changed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.changed_words(_name_pairs(spark, sf_dir), 10).withColumn("share", _r("share"))


def _looked(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    return lookalike.pair_features(_name_pairs(spark, sf_dir), lookalike.token_stats(s1, recs))


def q_swap_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.swap_profile(_looked(spark, sf_dir))


def q_postfilter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, recs = B.sides(_records(spark, sf_dir))
    return lookalike.post_filter_counts(_name_pairs(spark, sf_dir), lookalike.token_stats(s1, recs))


def q_same_address_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, n, share): pairs that swap words, and how many of them have equal addresses."""
    rows = lookalike.difference_kind(_name_pairs(spark, sf_dir)).filter("kind = 'SUB'")
    return rows.groupBy("country").agg(F.count("*").alias("n"), _r(F.avg((F.col("s1_addr") == F.col("rec_addr")).cast("int"))).alias("share"))


def q_region_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known regions are stood in for by the codes of states, whose letters some words of the tables share."""
    return analysis.region_coverage(B.raw_records(spark, sf_dir), "addr_raw", list(fixed.STATE_CODES)).withColumn("known", _r("known"))


# ---- columns of pairs


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all views with their cosines."""
    return _once(("candidates", sf_dir), lambda: linkage.candidates(_records(spark, sf_dir), linkage.Settings()))


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best candidates of each record; the mean word cosine stands in for the first model's score."""
    scored = _candidates(spark, sf_dir).withColumn("p1", _r((F.col("tcos_name") + F.col("tcos_addr")) / 2))
    return _once(("described", sf_dir), lambda: groups.pruned(scored, "p1", 2, 0.0))


def _six(rows: DataFrame) -> DataFrame:
    return rows.select(*[_r(c).alias(c) if t == "double" else c for c, t in rows.dtypes])


def q_stage1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.first_stage(_described(spark, sf_dir).drop("p1"), _records(spark, sf_dir))
    return _six(out.select("rec", "s1", *features.STAGE1))


def q_pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(features.base(_described(spark, sf_dir), _records(spark, sf_dir), 0.3).drop("country", "ord"))


def q_rare_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(features.rare(_described(spark, sf_dir), _records(spark, sf_dir)))


# ---- words of two splits


def _split(rows: DataFrame) -> DataFrame:
    return rows.withColumn("split", F.when(F.col("id") % 2 == 0, "train").otherwise("test"))


def _split_stats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(word statistics with their class, sizes of the sides) of records with even and with odd ids."""
    rows = _split(_records(spark, sf_dir))
    stats, sizes = [], []
    for split in ("train", "test"):
        s1, recs = B.sides(rows.filter(F.col("split") == split))
        stats.append(lookalike.token_stats(s1, recs).select(F.lit(split).alias("split"), "country", "token", "df1", "df23", lookalike.word_class().alias("class")))
        sizes.append(s1.groupBy("country").agg(F.count("*").alias("n1")).join(recs.groupBy("country").agg(F.count("*").alias("n23")), "country").select(F.lit(split).alias("split"), "country", "n1", "n23"))
    return _once(("split_stats", sf_dir), lambda: stats[0].union(stats[1])), sizes[0].union(sizes[1])


def q_ratio_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analysis.ratio_quantiles(*_split_stats(spark, sf_dir), 3)
    return out.select("split", "country", "tokens", *[_r(c).alias(c) for c in out.columns[3:]])


def q_class_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.class_flips(_split_stats(spark, sf_dir)[0], "train", "test").withColumn("share", _r("share"))


# ---- SQL

_R = f"WITH {B.RECORDS_SQL}"


def _sql_weights(field: str, tag: str, source: str = "records", words: str = "", most: int | None = MOST_ENTITIES) -> str:
    words = words or f"string_split({field}, ' ')"
    index = f"SELECT * FROM w_{tag} WHERE src = 1"
    if most is not None:
        index = f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY country, token) AS c FROM w_{tag} WHERE src = 1) WHERE c <= {most}"
    return f"""
size_{tag} AS (SELECT country, count(*) AS n FROM {source} GROUP BY country),
post_{tag} AS (SELECT DISTINCT id, country, src, token FROM (SELECT id, country, src, unnest({words}) AS token FROM {source}) WHERE token <> ''),
idf_{tag} AS (SELECT country, token, count(*) AS df, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM post_{tag} JOIN size_{tag} USING (country) GROUP BY country, token),
w_{tag} AS (SELECT id, country, src, token, idf / sqrt(sum(idf * idf) OVER (PARTITION BY country, id)) AS w FROM post_{tag} JOIN idf_{tag} USING (country, token)),
index_{tag} AS ({index}),
score_{tag} AS (SELECT a.country, a.id AS rec, b.id AS s1, round(sum(a.w * b.w), 6) AS score FROM w_{tag} a JOIN index_{tag} b USING (country, token) WHERE a.src > 1 GROUP BY ALL)"""


def _sql_top(table: str, k: int, least: float) -> str:
    return f"SELECT * FROM (SELECT country, rec, s1, score, CAST(row_number() OVER (PARTITION BY rec ORDER BY score DESC, s1) AS INTEGER) AS rank FROM {table} WHERE score >= {least}) WHERE rank <= {k}"


_TEXTS = f"{B.RAW_SQL}, texts AS (SELECT r.id, r.country, r.src, {B.sql_tokens("coalesce(text, '')")} AS words FROM raw_records r JOIN documents d ON d.doc_id = r.id)"
_T = _sql_weights("", "t", "texts", "words", MOST_TEXTS)
_N, _A = _sql_weights("name_n", "n"), _sql_weights("addr_n", "a")
_FULL = "score_f AS (SELECT country, rec, s1, round(sum(score), 6) AS score FROM (SELECT * FROM score_n UNION ALL SELECT * FROM score_a) GROUP BY ALL)"
_PAIRS = f"{B.RECORDS_SQL}, {_N}, {_A}, {_FULL}, top_f AS ({_sql_top('score_f', 10, 0.02)}), two AS (SELECT rec, s1 FROM top_f WHERE rank <= 2), name_pairs AS (SELECT t.rec, t.s1, a.country, a.name_n AS s1_name, b.name_n AS rec_name, a.addr_n AS s1_addr, b.addr_n AS rec_addr FROM two t JOIN records a ON a.id = t.s1 JOIN records b ON b.id = t.rec)"
_SKIP = B.sql_list(fixed.LEGAL_FORMS + fixed.NAME_FILLER)


def _sql_words(x: str) -> str:
    """Distinct words in order, without legal forms, filler and single characters."""
    kept = f"list_filter(string_split({x}, ' '), lambda t: length(t) > 1 AND t NOT IN {_SKIP})"
    return f"list_filter({kept}, lambda t, i: list_position({kept}, t) = i)"


_STATS = f"""
side_sizes AS (SELECT country, count(*) FILTER (src = 1) AS n1, count(*) FILTER (src > 1) AS n23 FROM records GROUP BY country HAVING count(*) FILTER (src = 1) > 0),
side_words AS (SELECT country, src, unnest({_sql_words("name_n")}) AS token FROM records),
stats AS (
    SELECT country, token, df1, df23, least(greatest(ln((df23 + 1.0) / (df1 + 1.0)) - ln(CAST(greatest(n23, 1) AS DOUBLE) / greatest(n1, 1)), {fixed.LRATIO_LEAST}), {fixed.LRATIO_MOST}) AS lratio,
           ln((df1 + 0.5) / greatest(n1, 1) * 1e6) AS lshare, CAST(greatest(2, round_even(n1 * {fixed.VOCABULARY_SHARE}, 0)) AS INTEGER) AS vocab_min, n1, n23
    FROM (SELECT country, token, count(*) FILTER (src = 1) AS df1, count(*) FILTER (src > 1) AS df23 FROM side_words GROUP BY ALL) JOIN side_sizes USING (country)
    WHERE df1 >= 1 OR df23 >= {fixed.FILLER_DOCS}
), classes AS (
    SELECT *, CASE WHEN lratio >= ln({fixed.FILLER_RATIO}) AND df23 >= {fixed.FILLER_DOCS} THEN 'filler' WHEN df1 >= vocab_min THEN 'vocab' ELSE 'rare' END AS class FROM stats
)"""

_KINDS = f"""kinds AS (SELECT *, len(list_filter(a, lambda t: NOT list_contains(b, t))) > 0 AS lacks, len(list_filter(b, lambda t: NOT list_contains(a, t))) > 0 AS adds
    FROM (SELECT *, {_sql_words("s1_name")} AS a, {_sql_words("rec_name")} AS b FROM name_pairs))"""
_SPLIT_STATS = f"""
split_words AS (SELECT id % 2 AS odd, country, src, unnest({_sql_words("name_n")}) AS token FROM records),
split_sizes AS (SELECT id % 2 AS odd, country, count(*) FILTER (src = 1) AS n1, count(*) FILTER (src > 1) AS n23 FROM records GROUP BY ALL HAVING count(*) FILTER (src = 1) > 0),
split_stats AS (
    SELECT CASE WHEN odd = 0 THEN 'train' ELSE 'test' END AS split, country, token, df1, df23, n1, n23, (df23 + 1.0) / (df1 + 1.0) / (CAST(n23 AS DOUBLE) / n1) AS ratio,
           CASE WHEN least(greatest(ln((df23 + 1.0) / (df1 + 1.0)) - ln(CAST(greatest(n23, 1) AS DOUBLE) / greatest(n1, 1)), {fixed.LRATIO_LEAST}), {fixed.LRATIO_MOST}) >= ln({fixed.FILLER_RATIO}) AND df23 >= {fixed.FILLER_DOCS} THEN 'filler'
                WHEN df1 >= CAST(greatest(2, round_even(n1 * {fixed.VOCABULARY_SHARE}, 0)) AS INTEGER) THEN 'vocab' ELSE 'rare' END AS class
    FROM (SELECT odd, country, token, count(*) FILTER (src = 1) AS df1, count(*) FILTER (src > 1) AS df23 FROM split_words GROUP BY ALL) JOIN split_sizes USING (odd, country)
    WHERE df1 >= 1 OR df23 >= {fixed.FILLER_DOCS}
)"""


def _sql_grams(field: str, tag: str) -> str:
    """gram_score_{tag}: trigram cosines of a field over all pairs that share a trigram."""
    return f"""
gram_words_{tag} AS (SELECT id, country, src, ' ' || unnest(list_filter(string_split(lower({field}), ' '), lambda t: t <> '')) || ' ' AS w FROM records),
gram_each_{tag} AS (SELECT id, country, src, unnest(list_transform(range(1, length(w) - 1), lambda k: substr(w, k, 3))) AS token FROM gram_words_{tag}),
gram_tf_{tag} AS (SELECT id, country, src, token, count(*) AS tf FROM gram_each_{tag} WHERE regexp_matches(token, '^[a-z0-9 ]{{3}}$') GROUP BY ALL),
gram_size_{tag} AS (SELECT country, count(*) AS n FROM records GROUP BY country),
gram_idf_{tag} AS (SELECT country, token, count(*) AS df, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM gram_tf_{tag} JOIN gram_size_{tag} USING (country) GROUP BY country, token),
gram_raw_{tag} AS (SELECT id, country, src, token, (ln(CAST(tf AS DOUBLE)) + 1.0) * idf AS w0 FROM gram_tf_{tag} JOIN gram_idf_{tag} USING (country, token)),
gram_w_{tag} AS (SELECT id, country, src, token, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY country, id)) AS w FROM gram_raw_{tag}),
gram_score_{tag} AS (SELECT a.country, a.id AS rec, b.id AS s1, round(sum(a.w * b.w), 6) AS score FROM gram_w_{tag} a JOIN gram_w_{tag} b USING (country, token) WHERE a.src > 1 AND b.src = 1 GROUP BY ALL)"""


_GRAM_FULL = f"{_sql_grams('name_n', 'n')}, {_sql_grams('addr_n', 'a')}, gram_full AS (SELECT country, rec, s1, round(sum(score) * 0.5, 6) AS score FROM (SELECT * FROM gram_score_n UNION ALL SELECT * FROM gram_score_a) GROUP BY ALL)"
_UNION = f"""{_PAIRS}, {_GRAM_FULL}, key_counts AS (SELECT *, count(*) OVER (PARTITION BY country, name_core) AS c FROM records WHERE src = 1),
house_counts AS (SELECT *, count(*) OVER (PARTITION BY country, house, first) AS c FROM records WHERE src = 1 AND house <> '' AND first <> ''),
found AS (
    SELECT rec, s1, 32 AS bit FROM ({_sql_top("score_n", 5, 0.02)}) UNION ALL SELECT rec, s1, 64 FROM ({_sql_top("score_a", 5, 0.02)}) UNION ALL SELECT rec, s1, 16 FROM top_f
    UNION ALL SELECT rec, s1, 1 FROM ({_sql_top("gram_full", FULL_K, 0.0)})
    UNION ALL SELECT r.id, k.id, 8 FROM records r JOIN key_counts k USING (country, name_core) WHERE r.src > 1 AND k.c <= 20
    UNION ALL SELECT r.id, k.id, 128 FROM records r JOIN house_counts k USING (country, house, first) WHERE r.src > 1 AND k.c <= 50
), view_union AS (SELECT rec, s1, CAST(bit_or(bit) AS INTEGER) AS views FROM found GROUP BY rec, s1)"""

_GRAMS = f"{B.RECORDS_SQL}, {_sql_grams('name_core', 'c')}"

_BITS = ", ".join(f"('{v}', {fixed.VIEW_BITS[v]})" for v in VIEWS)
_F05 = "CASE WHEN {p} = 0 AND {t} = 0 THEN 1.0 WHEN {h} = 0 THEN 0.0 ELSE 1.25 * {h} / ({p} + 0.25 * {t}) END"

SQL = {
    "q_tokens": f"SELECT doc_id, array_to_string({B.sql_tokens("coalesce(text, '')")}, ' ') AS tokens, len({B.sql_tokens("coalesce(text, '')")}) AS n FROM documents",
    "q_norm_name": f"{_R} SELECT id, name_n, name_core, name_ns, is_domain, name_non_latin, legal, first FROM records",
    "q_norm_addr": f"{_R} SELECT id, addr_n, addr_nums, house, postal, addr_empty, state FROM records",
    "q_website_names": f"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS low FROM pages),
        b AS (SELECT *, regexp_replace(low, '{fixed.DOMAIN}', '\\1', 'g') AS bare FROM h),
        w AS (SELECT *, list_transform({B.sql_tokens("bare")}, lambda t: {B.sql_case("t", fixed.LEGAL)}) AS ws FROM b)
        SELECT page_id, array_to_string(ws, ' ') AS name_n,
               array_to_string(CASE WHEN len(list_filter(ws, lambda t: t NOT IN {_SKIP})) = 0 THEN ws ELSE list_filter(ws, lambda t: t NOT IN {_SKIP}) END, '') AS name_ns, bare <> low AS is_domain FROM w""",
    "q_lengths": f"""{_R} SELECT id, CAST(length(name_n) AS INTEGER) AS name_len, CAST(length(addr_n) AS INTEGER) AS addr_len, CAST(length(name_n) - length(replace(name_n, ' ', '')) + 1 AS INTEGER) AS name_ntok,
        CAST(CASE WHEN addr_n = '' THEN 0 ELSE length(addr_n) - length(replace(addr_n, ' ', '')) + 1 END AS INTEGER) AS addr_ntok FROM records""",
    "q_accent_fold": f"SELECT doc_id, {B.sql_folded("coalesce(text, '')")} AS folded FROM documents",
    "q_mojibake": "SELECT item_id, replace(text, ',', CASE WHEN strlen(text) = length(text) THEN '\u2013' ELSE '\u00e2\u20ac\u201c' END) AS text FROM benchmark",
    "q_address_key": "SELECT p_partkey, CAST(p_size AS VARCHAR) || ' ' || substr(lower(p_name), 1, least(4, strpos(lower(p_name) || ' ', ' ') - 1)) AS key FROM part",
    "q_token_map": f"""WITH {B.RAW_SQL}, {B.TRUTH_SQL}, two_names AS (SELECT {B.sql_tokens("r.name_raw")} AS a, {B.sql_tokens("e.name_raw")} AS b FROM truth t JOIN raw_records r ON r.id = t.rec JOIN raw_records e ON e.id = t.s1),
        each AS (SELECT unnest(a) AS token, unnest(b) AS target FROM two_names WHERE len(a) = len(b)),
        n AS (SELECT token, target, count(*) AS n FROM each WHERE strlen(token) <> length(token) GROUP BY ALL),
        r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY token) AS BIGINT) AS total, row_number() OVER (PARTITION BY token ORDER BY n DESC, target) AS k FROM n)
        SELECT token, target, n, total FROM r WHERE k = 1 AND n >= 0.5 * total""",
    "q_key_join": f"WITH {B.PARTS_SQL}, e AS (SELECT *, count(*) OVER (PARTITION BY country, name_core) AS c FROM parts WHERE id % 5 = 0) SELECT r.id AS rec, e.id AS s1 FROM parts r JOIN e USING (country, name_core) WHERE r.id % 5 <> 0 AND e.c <= 20",
    "q_house_join": f"WITH {B.PARTS_SQL}, e AS (SELECT *, count(*) OVER (PARTITION BY country, house, first) AS c FROM parts WHERE id % 5 = 0) SELECT r.id AS rec, e.id AS s1 FROM parts r JOIN e USING (country, house, first) WHERE r.id % 5 <> 0 AND e.c <= 50",
    "q_address_join": f"""WITH {B.PARTS_SQL}, k AS (SELECT *, house || ' ' || substr(first, 1, 4) AS key FROM parts), e AS (SELECT *, count(*) OVER (PARTITION BY country, key) AS c FROM k WHERE id % 5 = 0)
        SELECT r.id AS rec, e.id AS s1 FROM k r JOIN e USING (country, key) WHERE r.id % 5 <> 0 AND e.c <= 50""",
    "q_same_address": f"WITH {_PAIRS} SELECT a.country, count(*) AS n, round(avg(CAST(a.addr_n = b.addr_n AS INT)), 6) AS share FROM two t JOIN records a ON a.id = t.s1 JOIN records b ON b.id = t.rec GROUP BY a.country",
    "q_token_idf": f"WITH {_TEXTS}, {_T} SELECT country, token, df, round(idf, 6) AS idf FROM idf_t",
    "q_token_topk_name": f"{_R}, {_N} SELECT rec, s1, score, rank FROM ({_sql_top('score_n', 5, 0.02)})",
    "q_token_topk_addr": f"{_R}, {_A} SELECT rec, s1, score, rank FROM ({_sql_top('score_a', 5, 0.02)})",
    "q_token_topk_full": f"{_R}, {_sql_weights('name_n', 'n', most=None)}, {_sql_weights('addr_n', 'a', most=None)}, {_FULL} SELECT rec, s1, score, rank FROM ({_sql_top('score_f', 10, 0.02)})",
    "q_token_cosine": f"""{_R}, {_N}, {_A}, c AS ({_sql_top("score_a", 5, 0.02)}), s AS (SELECT c.rec, c.s1, round(sum(a.w * b.w), 6) AS cos FROM c JOIN w_n a ON a.id = c.rec JOIN w_n b ON b.id = c.s1 AND b.token = a.token GROUP BY ALL)
        SELECT c.rec, c.s1, coalesce(cos, 0.0) AS cos FROM c LEFT JOIN s USING (rec, s1)""",
    "q_gram_idf": f"WITH {_GRAMS} SELECT country, token, df, round(idf, 6) AS idf FROM gram_idf_c",
    "q_gram_topk": f"WITH {_GRAMS} SELECT rec, s1, score, rank FROM ({_sql_top('gram_score_c', 3, 0.3)})",
    "q_flagship": f"""WITH {_TEXTS}, {_T}, r AS (SELECT rec, s1, score AS p, lead(score, 1, 0.0) OVER w AS second, row_number() OVER w AS k FROM score_t WINDOW w AS (PARTITION BY rec ORDER BY score DESC, s1))
        SELECT rec, s1, p, second FROM r WHERE k = 1 AND p >= {THRESHOLD} AND p - second >= {MARGIN}""",
    "q_dense_topk": """WITH s AS (SELECT q.vec_id AS rec, i.vec_id AS s1, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS score FROM embeddings q JOIN embeddings i ON q.label = i.label AND q.vec_id % 2 = 1 AND i.vec_id % 2 = 0)
        SELECT * FROM (SELECT rec, s1, score, CAST(row_number() OVER (PARTITION BY rec ORDER BY score DESC, s1) AS INTEGER) AS rank FROM s) WHERE rank <= 5""",
    **{f"q_dense_topk_{view}": f"""WITH {B.FIELD_VECTORS_SQL}, s AS (SELECT q.id AS rec, i.id AS s1, round({score}, 6) AS score FROM field_vectors q JOIN field_vectors i USING (country) WHERE q.id % 2 = 1 AND i.id % 2 = 0 AND {asked})
        SELECT * FROM (SELECT rec, s1, score, CAST(row_number() OVER (PARTITION BY rec ORDER BY score DESC, s1) AS INTEGER) AS rank FROM s) WHERE rank <= 5"""
       for view, score, asked in (("full", "0.5 * list_dot_product(q.n, i.n) + 0.5 * list_dot_product(q.a, i.a)", "true"), ("name", "list_dot_product(q.n, i.n)", "q.has_name"), ("addr", "list_dot_product(q.a, i.a)", "q.has_addr"))},
    "q_pair_cosine": "SELECT a.vec_id AS rec, b.vec_id AS s1, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cos FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id - a.vec_id % 10",
    "q_view_union": f"WITH {_UNION} SELECT * FROM view_union",
    "q_view_counts": f"WITH {_UNION} SELECT view, CAST(sum(CASE WHEN views & bit > 0 THEN 1 ELSE 0 END) AS BIGINT) AS pairs FROM view_union CROSS JOIN (VALUES {_BITS}) v(view, bit) GROUP BY view",
    "q_view_report": f"""WITH {_UNION}, {B.TRUTH_SQL}, h AS (SELECT v.views, t.rec IS NOT NULL AS hit FROM view_union v LEFT JOIN truth t USING (rec, s1))
        SELECT view, CAST(sum(CASE WHEN bit = 0 OR views & bit > 0 THEN 1 ELSE 0 END) AS BIGINT) AS pairs, round(sum(CASE WHEN hit AND (bit = 0 OR views & bit > 0) THEN 1 ELSE 0 END) / (SELECT count(*) FROM truth), 6) AS recall
        FROM h CROSS JOIN (VALUES {_BITS}, ('union', 0)) b(view, bit) GROUP BY view""",
    "q_query_sample": f"WITH {B.RAW_SQL} SELECT id, country FROM raw_records WHERE src > 1 AND CAST('0x' || substr(md5(country || '|' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.2",
    "q_block_report": f"""WITH {_UNION}, {B.TRUTH_SQL}, f AS (SELECT s1, count(*) AS n, count(t.rec) AS tp FROM view_union v LEFT JOIN truth t USING (rec, s1) GROUP BY s1), g AS (SELECT s1, count(*) AS n_true FROM truth GROUP BY s1),
        e AS (SELECT coalesce(n, 0) AS n, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true FROM raw_records r LEFT JOIN f ON f.s1 = r.id LEFT JOIN g ON g.s1 = r.id WHERE src = 1)
        SELECT CAST(sum(n) AS BIGINT) AS pairs, round(sum(tp) / sum(n_true), 6) AS recall, round(avg({_F05.format(p="tp", t="n_true", h="tp")}), 6) AS oracle_f05, round(avg(n), 6) AS mean_candidates,
               round(quantile_cont(n, 0.99), 6) AS p99_candidates, round(avg(CASE WHEN n = 0 THEN 1 ELSE 0 END), 6) AS without FROM e""",
    "q_name_freq": f"{_R} SELECT r.id, coalesce(c.n, 0) AS freq FROM records r LEFT JOIN (SELECT country, name_core, count(*) AS n FROM records WHERE src = 1 GROUP BY ALL) c USING (country, name_core) WHERE src > 1",
    "q_common_tokens": f"""{_R}, t AS (SELECT id, country, unnest(string_split(name_n, ' ')) AS token, generate_subscripts(string_split(name_n, ' '), 1) AS pos FROM records),
        d AS (SELECT country, token, count(DISTINCT id) AS df FROM t WHERE token <> '' GROUP BY ALL), s AS (SELECT country, count(*) AS n FROM records GROUP BY country),
        c AS (SELECT country, token FROM d JOIN s USING (country) WHERE df > 0.01 * n AND NOT regexp_matches(token, '[0-9]')),
        k AS (SELECT id, string_agg(token, ' ' ORDER BY pos) AS kept FROM t ANTI JOIN c USING (country, token) WHERE token <> '' GROUP BY id)
        SELECT r.id, coalesce(kept, '') AS kept FROM records r LEFT JOIN k USING (id)""",
    "q_name_words": f"{_R} SELECT id, array_to_string({_sql_words('name_n')}, ' ') AS words FROM records",
    "q_token_stats": f"{_R}, {_STATS} SELECT country, token, df1, df23, round(lratio, 6) AS lratio, round(lshare, 6) AS lshare, vocab_min, class FROM classes",
    "q_filler_words": f"{_R}, {_STATS} SELECT country, token, df1, df23, round(CAST(df23 AS DOUBLE) / greatest(df1, 1) / (CAST(n23 AS DOUBLE) / n1), 6) AS ratio FROM stats WHERE df23 >= 3 ORDER BY ratio DESC, country, token LIMIT 25",
    "q_token_mix": f"""{_R}, {_STATS} SELECT w.country, w.src, count(*) AS words, count(*) FILTER (coalesce(class, 'rare') = 'filler') AS filler, count(*) FILTER (coalesce(class, 'rare') = 'vocab') AS vocab, count(*) FILTER (coalesce(class, 'rare') = 'rare') AS rare
        FROM side_words w LEFT JOIN classes c USING (country, token) WHERE src > 1 GROUP BY ALL""",
    "q_noise_rates": f"""{_R} SELECT country, src, count(*) AS n, round(avg(CAST(is_domain AS INT)), 6) AS domain, round(avg(CAST(name_non_latin AS INT)), 6) AS non_latin, round(avg(CAST(house = '' AS INT)), 6) AS no_house,
        round(avg(CAST(addr_empty AS INT)), 6) AS no_address FROM records GROUP BY ALL""",
    "q_distinctiveness": f"""{_R}, c AS (SELECT country, first, count(*) AS n FROM records GROUP BY ALL) SELECT country, round(avg(CAST(n = 1 AS INT)), 6) AS single, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90,
        round(quantile_cont(n, 0.99), 6) AS p99 FROM c GROUP BY country""",
    "q_last_component": f"WITH {B.RAW_SQL} SELECT country, trim(string_split(addr_raw, ',')[-1]) AS part, count(*) AS n FROM raw_records GROUP BY ALL ORDER BY n DESC, country, part LIMIT 25",
    "q_source_sizes": f"WITH {B.RAW_SQL} SELECT country, src, count(*) AS n FROM raw_records GROUP BY ALL",
    "q_jaro_winkler": f"WITH {_PAIRS} SELECT rec, s1, round(jaro_winkler_similarity(s1_name, rec_name), 6) AS jw FROM name_pairs",
    "q_pair_agreement": f"""WITH {_PAIRS} SELECT t.rec, t.s1, {", ".join(f"CASE WHEN a.{c} <> '' AND b.{c} <> '' THEN CAST(a.{c} = b.{c} AS DOUBLE) END AS {c}_eq" for c in ("house", "state", "postal", "legal", "first"))},
        CASE WHEN a.first <> '' AND b.name_n <> '' THEN CAST(contains(b.name_n, a.first) AS DOUBLE) END AS s1_first_in_rec, CASE WHEN b.first <> '' AND a.name_n <> '' THEN CAST(contains(a.name_n, b.first) AS DOUBLE) END AS rec_first_in_s1,
        CAST(length(a.name_n) - length(b.name_n) AS INTEGER) AS d_name_n_len, CAST(length(a.addr_n) - length(b.addr_n) AS INTEGER) AS d_addr_n_len, b.is_domain, b.name_non_latin, b.addr_empty, b.src
        FROM two t JOIN records a ON a.id = t.s1 JOIN records b ON b.id = t.rec""",
    "q_changed_words": f"""WITH {_PAIRS}, {_KINDS}, w AS (SELECT country, 'missing' AS kind, unnest(list_filter(a, lambda t: NOT list_contains(b, t))) AS word FROM kinds UNION ALL SELECT country, 'extra', unnest(list_filter(b, lambda t: NOT list_contains(a, t))) FROM kinds),
        c AS (SELECT country, kind, word, count(*) AS n FROM w GROUP BY ALL)
        SELECT country, kind, word, n, round(n / whole, 6) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY country, kind) AS whole, row_number() OVER (PARTITION BY country, kind ORDER BY n DESC, word) AS k FROM c) WHERE k <= 10""",
    "q_same_address_flagged": f"WITH {_PAIRS}, {_KINDS} SELECT country, count(*) AS n, round(avg(CAST(s1_addr = rec_addr AS INT)), 6) AS share FROM kinds WHERE lacks AND adds GROUP BY country",
    "q_region_coverage": f"WITH {B.RAW_SQL} SELECT country, count(*) AS n, round(avg(CAST(len(list_filter(string_split(lower(trim(string_split(addr_raw, ',')[-1])), ' '), lambda t: t IN {B.sql_list(fixed.STATE_CODES)})) > 0 AS INT)), 6) AS known FROM raw_records WHERE addr_raw <> '' GROUP BY country",
    "q_ratio_quantiles": f"""{_R}, {_SPLIT_STATS}, o AS (SELECT * FROM split_stats WHERE df1 >= 3 AND n23 > 0), e AS (SELECT split, country, quantile_cont(ratio, 0.5) AS weighted FROM (SELECT split, country, ratio, unnest(range(df1)) FROM o) GROUP BY ALL)
        SELECT split, country, tokens, q10, q25, q50, q75, q90, round(weighted, 6) AS weighted, over FROM (SELECT split, country, count(*) AS tokens, {", ".join(f"round(quantile_cont(ratio, {x / 100}), 6) AS q{x}" for x in (10, 25, 50, 75, 90))}, round(avg(CAST(ratio >= 1.15 AS INT)), 6) AS over FROM o GROUP BY ALL) JOIN e USING (split, country)""",
    "q_class_flips": f"""{_R}, {_SPLIT_STATS}, f AS (SELECT a.country, a.class AS before, b.class AS after, count(*) AS tokens, sum(b.df23) AS n FROM split_stats a JOIN split_stats b ON a.country = b.country AND a.token = b.token AND a.split = 'train' AND b.split = 'test' GROUP BY ALL)
        SELECT country, before, after, tokens, round(n / sum(n) OVER (PARTITION BY country), 6) AS share FROM f""",
    "q_difference_kinds": f"""WITH {_PAIRS}, w AS (SELECT country, {_sql_words("s1_name")} AS a, {_sql_words("rec_name")} AS b FROM name_pairs), k AS (SELECT country, len(list_filter(a, lambda t: NOT list_contains(b, t))) > 0 AS lacks, len(list_filter(b, lambda t: NOT list_contains(a, t))) > 0 AS adds FROM w)
        SELECT country, CASE WHEN lacks AND adds THEN 'SUB' WHEN lacks THEN 'DEL' WHEN adds THEN 'ADD' ELSE 'SAME' END AS kind, count(*) AS n FROM k GROUP BY ALL""",
}

QUERIES = {name: _once.query(f) for name, f in [*globals().items(), ("q_flagship", flagship)] if name.startswith("q_")}
