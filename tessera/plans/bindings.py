"""The synthetic tables in the roles of records, labels, vectors and scored pairs, in Spark and in SQL.

Every table here has an SQL twin of the same name: a list of common table expressions that DuckDB can run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fixed, text

FOLD_SQL = [(a, b) for a, b in text.LIGATURES.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_number() -> Column:
    """1 for entities, 2 and 3 for the sources of records, from the name of a document's source."""
    n = F.substring("source", 4, 9).cast("int")
    return F.when(n < 8, 1).when(n < 14, 2).otherwise(3)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, country, src, name_raw, addr_raw), a business record for each document.

    The tables hold no business records. What stands in for a record's fields are words 1-4 of a document (its name) and
    words 5-10 (its address); the rest of the text belongs to no field. Queries over whole texts read the documents
    themselves (``q_tokens``, ``q_accent_fold``, ``q_token_idf``, ``q_flagship``).
    """
    words = F.split(F.coalesce("text", F.lit("")), "[ \t\n\r]+")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("country"), source_number().alias("src"),
        F.array_join(F.slice(words, 1, 4), " ").alias("name_raw"), F.array_join(F.slice(words, 5, 6), " ").alias("addr_raw"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_records`` with all normalised fields."""
    rows = raw_records(spark, sf_dir).withColumns({"_n": text.name_fields(F.col("name_raw")), "_t": text.address_tokens(F.col("addr_raw"))})
    rows = rows.withColumn("_a", text.address_fields(F.col("_t"))).select("id", "country", "src", "name_raw", "addr_raw", "_n.*", "_a.*")
    return rows.withColumns({"legal": text.legal_of(F.col("name_n")), "first": text.first_of(F.col("name_core")), "state": text.state_set(F.col("addr_n"))})


def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities (source 1) and records (sources 2 and 3)."""
    return rows.filter("src = 1"), rows.filter("src > 1")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, s1): records whose text equals that of an entity of their country, the least such entity."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    n = F.substring("source", 4, 9).cast("int")
    key = ["country", "copy"]
    rows = docs.select("doc_id", F.col("lang").alias("country"), F.sha2(F.col("text").cast("binary"), 256).alias("copy"), (n < 8).alias("one"))
    least = rows.filter("one").groupBy(*key).agg(F.min("doc_id").alias("s1"))
    return rows.filter("NOT one").join(least, key).select(F.col("doc_id").alias("rec"), "s1")


#: A total order of lines: line numbers repeat within an order.
_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag")


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, s1, ord, src, p, tok, full, country): order lines by order and supplier."""
    first = lambda c: F.min_by(c, F.struct(*_LINE_ORDER))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("rec"), F.col("l_suppkey").alias("s1"))
    return rows.agg(
        F.min("l_linenumber").alias("ord"), first("l_linestatus").alias("src"), F.round(first("l_discount") * 10, 2).alias("p"),
        F.round(first("l_tax") * 10, 2).alias("tok"), F.round(first("l_quantity") / 50, 2).alias("full"),
    ).withColumn("country", F.concat(F.lit("c"), F.col("s1") % 3))


def pair_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, s1): the supplier of an order's first line, unless that line was returned; other orders match nothing."""
    order = F.struct(*_LINE_ORDER)
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("rec")).agg(F.min_by("l_suppkey", order).alias("s1"), F.min_by("l_returnflag", order).alias("_flag"))
    return first.filter("_flag <> 'R'").select("rec", "s1")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("s1"), F.concat(F.lit("c"), F.col("s_suppkey") % 3).alias("country"))


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Entities and records of the parts table, for exact keys."""
    words = F.split(F.lower("p_name"), " ")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("country"), F.lower("p_name").alias("name_core"), words[0].alias("first"), F.col("p_size").cast("string").alias("house"),
    )
    return rows.filter("id % 5 = 0"), rows.filter("id % 5 <> 0")


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Index (even ids) and queries (odd ids)."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("country"), F.col("embedding").alias("vector"))
    return rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")


def field_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Index and queries with a vector for each field: the halves of an embedding; some fields are empty, hence zero."""
    n = F.col("vec_id")
    empty = F.transform(F.sequence(F.lit(1), F.lit(32)), lambda _: F.lit(0.0))
    half = lambda at, gone: F.when(gone, empty).otherwise(F.transform(F.slice("embedding", at, 32), lambda x: x.cast("double")))
    rows = table(spark, sf_dir, "embeddings").select(n.alias("id"), F.col("label").cast("string").alias("country"), half(1, n % 11 == 5).alias("name_vector"), half(33, n % 13 == 7).alias("addr_vector"))
    return rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")


# ---- the same in SQL


def sql_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_case(x: str, mapping: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items()) + f" ELSE {x} END"


def sql_folded(x: str) -> str:
    out = x
    for a, b in FOLD_SQL:
        out = f"replace({out}, '{a}', '{b}')"
    return f"strip_accents({out})"


def sql_tokens(x: str) -> str:
    flat = f"translate(replace(lower({x}), '&', ' and '), '.''`', '')"
    return f"list_filter(string_split(regexp_replace({flat}, '{text.SEPARATORS}', ' ', 'g'), ' '), lambda t: t <> '')"


def sql_states(x: str) -> str:
    out = x
    for name in sorted(fixed.STATES, key=lambda s: (-len(s), s)):
        out = f"regexp_replace({out}, '\\b{name}\\b', '{fixed.STATES[name]}', 'g')"
    return out


def sql_number(x: str) -> str:
    inner = f"regexp_replace({x}, '{fixed.NUMBER_PREFIX}', '\\1')"
    return f"CASE WHEN regexp_matches({x}, '[0-9]') THEN regexp_replace({inner}, '{fixed.LEADING_ZEROS}', '\\1') ELSE {x} END"


RAW_SQL = """
raw_words AS (
    SELECT doc_id AS id, lang AS country, CAST(substr(source, 4) AS INTEGER) AS n,
           string_split_regex(coalesce(text, ''), '[ \t\n\r]+') AS ws FROM documents
), raw_records AS (
    SELECT id, country, CASE WHEN n < 8 THEN 1 WHEN n < 14 THEN 2 ELSE 3 END AS src,
           array_to_string(ws[1:4], ' ') AS name_raw, array_to_string(ws[5:10], ' ') AS addr_raw FROM raw_words
)"""

RECORDS_SQL = f"""{RAW_SQL}, low_records AS (
    SELECT *, lower({sql_folded("name_raw")}) AS low,
           list_filter(list_transform(list_filter(string_split({sql_states(f"regexp_replace(array_to_string({sql_tokens(sql_folded(f"regexp_replace(addr_raw, '{fixed.NUMERO}', 'no ', 'g')"))}, ' '), '{fixed.ORDINAL}', '\\1', 'g')")}, ' '),
               lambda t: t <> '' AND t NOT IN {sql_list(fixed.ADDRESS_DROP)}), lambda t: {sql_number(f"({sql_case('t', fixed.ADDRESS)})")}),
               lambda t: t <> '' AND t NOT IN {sql_list(fixed.ADDRESS_DROP)}) AS ats
    FROM raw_records
), bare_records AS (
    SELECT *, CASE WHEN contains(low, '.') THEN regexp_replace(low, '{fixed.DOMAIN}', '\\1', 'g') ELSE low END AS bare FROM low_records
), word_records AS (
    SELECT *, list_transform({sql_tokens("bare")}, lambda t: {sql_case("t", fixed.LEGAL)}) AS ws0 FROM bare_records
), glue_records AS (
    SELECT *, coalesce(len(ws0) = 1 AND length(ws0[1]) >= 8 AND suffix(ws0[1], 'com'), false) AS glued FROM word_records
), ws_records AS (
    SELECT *, CASE WHEN glued THEN [substr(ws0[1], 1, length(ws0[1]) - 3)] ELSE ws0 END AS ws FROM glue_records
), core_records AS (
    SELECT *, list_filter(ws, lambda t: t NOT IN {sql_list(fixed.LEGAL_FORMS + fixed.NAME_FILLER)}) AS core0 FROM ws_records
), core2_records AS (
    SELECT *, CASE WHEN len(core0) = 0 THEN ws ELSE core0 END AS core,
           list_filter(ats, lambda t: regexp_matches(t, '[0-9]')) AS numbers, list_filter(ats, lambda t: regexp_matches(t, '^[0-9]')) AS houses,
           list_filter(ats, lambda t: regexp_matches(t, '^([0-9]{{5}}|[0-9]{{6}})$')) AS postals, list_filter(ats, lambda t: regexp_matches(t, '^[a-z]+$')) AS alphas
    FROM core_records
), records AS (
    SELECT id, country, src, name_raw, addr_raw, array_to_string(ws, ' ') AS name_n, array_to_string(core, ' ') AS name_core, array_to_string(core, '') AS name_ns,
           (bare <> low OR glued) AS is_domain, strlen(name_raw) <> length(name_raw) AS name_non_latin, array_to_string(ats, ' ') AS addr_n,
           array_to_string(list_sort(list_distinct(numbers)), ' ') AS addr_nums, coalesce(regexp_extract(houses[1], '^([0-9]+)', 1), '') AS house,
           array_to_string(list_sort(list_distinct(postals)), ' ') AS postal, len(ats) = 0 AS addr_empty,
           array_to_string(list_sort(list_distinct(list_filter(ws, lambda t: t IN {sql_list(fixed.LEGAL_FORMS)}))), ' ') AS legal,
           coalesce(core[1], '') AS first,
           array_to_string(list_sort(list_distinct(list_filter([alphas[1], alphas[-1]], lambda t: t IN {sql_list(fixed.STATE_CODES)}))), ' ') AS state
    FROM core2_records
)"""

TRUTH_SQL = """
copies AS (
    SELECT doc_id, lang AS country, text, CAST(substr(source, 4) AS INTEGER) < 8 AS one FROM documents WHERE text IS NOT NULL
), truth AS (
    SELECT r.doc_id AS rec, e.s1 FROM copies r JOIN (SELECT country, text, min(doc_id) AS s1 FROM copies WHERE one GROUP BY ALL) e USING (country, text) WHERE NOT r.one
)"""

_ORDER_SQL = "{" + ", ".join(f"'{c}': {c}" for c in _LINE_ORDER) + "}"
PAIRS_SQL = f"""
pairs AS (
    SELECT l_orderkey AS rec, l_suppkey AS s1, min(l_linenumber) AS ord, arg_min(l_linestatus, {_ORDER_SQL}) AS src, round(arg_min(l_discount, {_ORDER_SQL}) * 10, 2) AS p,
           round(arg_min(l_tax, {_ORDER_SQL}) * 10, 2) AS tok, round(arg_min(l_quantity, {_ORDER_SQL}) / 50, 2) AS "full", 'c' || (l_suppkey % 3) AS country
    FROM lineitem GROUP BY l_orderkey, l_suppkey
), pair_truth AS (
    SELECT l_orderkey AS rec, arg_min(l_suppkey, {_ORDER_SQL}) AS s1 FROM lineitem GROUP BY l_orderkey HAVING arg_min(l_returnflag, {_ORDER_SQL}) <> 'R'
), entities AS (SELECT s_suppkey AS s1, 'c' || (s_suppkey % 3) AS country FROM supplier)"""

_HALF_SQL = "CASE WHEN {gone} THEN list_transform(range(32), lambda x: CAST(0 AS DOUBLE)) ELSE CAST(embedding[{a}:{b}] AS DOUBLE[]) END"
FIELD_VECTORS_SQL = f"""
field_vectors AS (
    SELECT vec_id AS id, label AS country, {_HALF_SQL.format(gone="vec_id % 11 = 5", a=1, b=32)} AS n, {_HALF_SQL.format(gone="vec_id % 13 = 7", a=33, b=64)} AS a,
           vec_id % 11 <> 5 AS has_name, vec_id % 13 <> 7 AS has_addr FROM embeddings
)"""

PARTS_SQL = """
parts AS (
    SELECT p_partkey AS id, p_type AS country, lower(p_name) AS name_core, string_split(lower(p_name), ' ')[1] AS first, CAST(p_size AS VARCHAR) AS house FROM part
)"""
