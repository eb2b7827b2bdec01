"""Candidate retrieval: keys, word and character TF-IDF through inverted indexes, dense vectors, and their union.

Rows are (id, country, ...). Pairs never cross countries, so country is part of every key; a country that lacks either
side drops out of the inner joins by itself. Sums are rounded to six digits before they are ranked, and ties go to the
smaller id, so results do not depend on the order of evaluation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.fixed import VIEW_BITS

DIGITS = 6


def key_pairs(s1: DataFrame, records: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(rec, s1) with equal keys; keys shared by more than ``most`` entities are skipped."""
    k = ["country", *keys]
    few = s1.groupBy(*k).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).drop("_n")
    rare = s1.select(F.col("id").alias("s1"), *k).join(few, k, "left_semi")
    return records.select(F.col("id").alias("rec"), *k).join(rare, k).select("rec", "s1")


def house_pairs(s1: DataFrame, records: DataFrame, most: int = 50) -> DataFrame:
    """Equal house number and first name word, both non-empty; the cap counts after that filter."""
    full = "house <> '' AND first <> ''"
    return key_pairs(s1.filter(full), records.filter(full), ["house", "first"], most)


def _named(rows: DataFrame) -> list[str]:
    """The columns that postings carry on: ``src`` where it is known."""
    return ["id", "country", *(["src"] if "src" in rows.columns else [])]


def postings(rows: DataFrame, words: Column) -> DataFrame:
    """(id, country, token), with src if ``rows`` has it: the distinct tokens of each row."""
    return rows.select(*_named(rows), F.explode(F.array_distinct(words)).alias("token"))


def grams(text: Column) -> Column:
    """Character trigrams of a-z, 0-9 and space, each word padded with one space on both sides."""
    padded = F.transform(F.filter(F.split(F.lower(text), " "), lambda t: t != ""), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))
    each = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda k: F.substring(w, k, 3)))
    return F.filter(F.flatten(each), lambda g: g.rlike("^[a-z0-9 ]{3}$"))


def gram_counts(rows: DataFrame, text: Column) -> DataFrame:
    """(id, country, token, tf), with src if ``rows`` has it."""
    names = _named(rows)
    return rows.select(*names, F.explode(grams(text)).alias("token")).groupBy(*names, "token").agg(F.count("*").alias("tf"))


def idf(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(country, token, df, idf): smoothed inverse document frequency; ``sizes`` is (country, n) over all rows.

    Where postings know their src, df1 counts the entities among them.
    """
    more = [F.sum((F.col("src") == 1).cast("long")).alias("df1")] if "src" in counts.columns else []
    df = counts.groupBy("country", "token").agg(F.count("*").alias("df"), *more)
    ratio = (F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))
    return df.join(F.broadcast(sizes), "country").select("country", "token", "df", *df.columns[3:], (F.log(ratio) + 1.0).alias("idf"))


def weights(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id, country, token, w): TF-IDF rows of length one; a count ``tf`` weighs 1 + ln tf, without it every token weighs 1.

    Where postings know their src, so do the weights, and df1 tells how many entities hold the token: what an index leaves
    out is then known on both sides before anything is joined.
    """
    tf = F.log(F.col("tf").cast("double")) + 1.0 if "tf" in counts.columns else F.lit(1.0)
    known = idf(counts, sizes).drop("df")
    names = [*_named(counts), "token", *(["df1"] if "src" in counts.columns else [])]
    raw = counts.join(known, ["country", "token"]).select(*names, (tf * F.col("idf")).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy("country", "id")))
    return raw.select(*names, (F.col("_w") / length).alias("w"))


def country_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("country").agg(F.count("*").alias("n"))


def index_of(s1_weights: DataFrame, most: int) -> DataFrame:
    """An inverted index without tokens of more than ``most`` entities; weights keep their scale."""
    if "df1" in s1_weights.columns:
        return s1_weights.filter(F.col("df1") <= most)
    few = s1_weights.groupBy("country", "token").agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).drop("_n")
    return s1_weights.join(few, ["country", "token"], "left_semi")


def held(w: DataFrame, most: int | None) -> DataFrame:
    """Weights that know df1 without tokens that no entity holds, or more than ``most``."""
    return w.filter(F.col("df1") > 0 if most is None else F.col("df1").between(1, most))


def index_scores(w: DataFrame, most: int | None) -> DataFrame:
    """``token_scores`` of records against entities, from weights that know src and df1.

    Tokens that no entity holds, or more than ``most``, leave both sides before the join.
    """
    kept = held(w, most)
    return token_scores(kept.filter("src > 1"), kept.filter("src = 1"))


def token_scores(record_weights: DataFrame, index: DataFrame) -> DataFrame:
    """(country, rec, s1, score): products of weights summed over shared tokens."""
    left = record_weights.select("country", "token", F.col("id").alias("rec"), F.col("w").alias("_a"))
    right = index.select("country", "token", F.col("id").alias("s1"), F.col("w").alias("_b"))
    return left.join(right, ["country", "token"]).groupBy("country", "rec", "s1").agg(F.round(F.sum(F.col("_a") * F.col("_b")), DIGITS).alias("score"))


def top_k(scored: DataFrame, k: int, least: float = 0.0) -> DataFrame:
    """The k best entities of each record with ``least`` or more, and their rank from 1."""
    w = W.partitionBy("rec").orderBy(F.desc("score"), "s1")
    return scored.filter(F.col("score") >= least).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def pair_token_cosines(pairs: DataFrame, record_weights: DataFrame, s1_weights: DataFrame) -> DataFrame:
    """``pairs`` (country, rec, s1) with the exact cosine over all tokens, common ones included; 0 without a shared one."""
    left = pairs.select("country", "rec", "s1").join(record_weights.select("country", F.col("id").alias("rec"), "token", F.col("w").alias("_a")), ["country", "rec"])
    both = left.join(s1_weights.select("country", F.col("id").alias("s1"), "token", F.col("w").alias("_b")), ["country", "s1", "token"])
    sums = both.groupBy("country", "rec", "s1").agg(F.round(F.sum(F.col("_a") * F.col("_b")), DIGITS).alias("cos"))
    return pairs.join(sums, ["country", "rec", "s1"], "left").withColumn("cos", F.coalesce("cos", F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def dense_top_k(records: DataFrame, s1: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """(rec, s1, score, rank): exact top-k by inner product of ``vector`` within the country.

    Both sides are cut into blocks of about ``block`` rows a country, and every pair of blocks is multiplied as matrices by
    a task of its own; only a record's k best of a block leave the task. A country that lacks either side gives nothing.
    """
    import numpy as np
    import pyarrow as pa

    def blocked(rows: DataFrame, mine: str, other: DataFrame, theirs: str) -> DataFrame:
        """Every row under its own block and each block of the other side."""
        own, far = (country_sizes(x).select(F.col("country").cast("string").alias("country"), (F.floor((F.col("n") - 1) / block) + 1).alias(c)) for x, c in ((rows, "_own"), (other, "_far")))
        # an id under its own name: both sides may come from one table
        rows = rows.select(F.col("id").alias("id"), F.col("country").cast("string").alias("country"), F.col("vector").cast("array<double>").alias("vector"))
        dealt = rows.join(F.broadcast(own.join(far, "country")), "country")  # a row a country
        place = F.pmod(F.xxhash64("id"), F.col("_own")).alias(mine)
        return dealt.select("id", "country", "vector", place, F.explode(F.sequence(F.lit(0), F.col("_far") - 1)).alias(theirs))

    def multiplied(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if left.num_rows and right.num_rows:
            a, b = (np.stack([v.as_py() for v in t.column("vector")]).astype(float) for t in (left, right))
            ids = right.column("id").to_numpy()
            scores = np.round(a @ b.T, DIGITS)
            order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
            found = [np.repeat(left.column("id").to_numpy(), order.shape[1]), ids[order].ravel(), np.take_along_axis(scores, order, 1).ravel()]
        return pa.table(found, names=["rec", "s1", "score"])

    key = ["country", "_a", "_b"]
    sides = blocked(records, "_a", s1, "_b").groupBy(*key), blocked(s1, "_b", records, "_a").groupBy(*key)
    return top_k(sides[0].cogroup(sides[1]).applyInArrow(multiplied, "rec long, s1 long, score double"), k, float("-inf"))


def dense_views(records: DataFrame, s1: DataFrame, ks: dict[str, int], block: int = 4096) -> dict[str, DataFrame]:
    """Views full, name and addr over rows (id, country, name_vector, addr_vector), each with its k; a k of 0 leaves it out.

    ``full`` scores half the sum of both products, as one product of the joined vectors, and skips no record; ``name`` and
    ``addr`` skip records whose field is empty, that is whose vector is zero.
    """

    def joined(rows: DataFrame, scale: float) -> DataFrame:
        both = F.transform(F.concat("name_vector", "addr_vector"), lambda x: x.cast("double") * scale)
        return rows.select("id", "country", both.alias("vector"))

    out = {}
    for view, k in ks.items():
        if k and view == "full":
            out[view] = dense_top_k(joined(records, 0.5), joined(s1, 1.0), k, block)
        elif k:
            column = f"{view}_vector"
            asked = records.filter(F.exists(column, lambda x: x != 0))
            out[view] = dense_top_k(*(rows.select("id", "country", F.col(column).alias("vector")) for rows in (asked, s1)), k, block)
    return out


def union_views(views: dict[str, DataFrame]) -> DataFrame:
    """(rec, s1, views): every pair once, with the bits of the views that found it."""
    tagged = [df.select("rec", "s1", F.lit(VIEW_BITS[name]).alias("_bit")) for name, df in views.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("rec", "s1").agg(F.bit_or("_bit").cast("int").alias("views"))


def has_view(name: str) -> Column:
    return F.col("views").bitwiseAND(F.lit(VIEW_BITS[name])) > 0


def svd_components(record_weights: DataFrame, dims: int, sample: int = 1000, tokens: int = 20_000):
    """(tokens, components): right singular vectors of a bounded hash sample of TF-IDF rows, over its commonest tokens.

    An approximation by design; ``token_scores`` gives the exact cosines.
    """
    import numpy as np

    ids = record_weights.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = record_weights.join(F.broadcast(ids), "id").select("id", "token", "w")
    top = rows.groupBy("token").count().orderBy(F.desc("count"), "token").limit(tokens)
    known = sorted(r[0] for r in top.collect())
    place = {t: k for k, t in enumerate(known)}
    index: dict = {}
    matrix = np.zeros((sample, len(known)), np.float32)
    for i, t, w in rows.collect():
        if t in place:
            matrix[index.setdefault(i, len(index)), place[t]] = w
    values, vectors = np.linalg.eigh((matrix @ matrix.T).astype(float))
    order = np.argsort(-values)[:dims]
    order = order[values[order] > 1e-9]
    return known, (matrix.T @ vectors[:, order] / np.sqrt(values[order])).astype(np.float32)


def projected(record_weights: DataFrame, known: list[str], components) -> DataFrame:
    """(id, country, vector): unit rows in the space of the components; zero rows where nothing is known."""
    import numpy as np
    import pandas as pd

    shared = record_weights.sparkSession.sparkContext.broadcast(({t: k for k, t in enumerate(known)}, components))
    grouped = record_weights.groupBy("id", "country").agg(F.collect_list("token").alias("t"), F.collect_list("w").alias("w"))

    def run(batches):
        place, parts = shared.value
        for batch in batches:
            out = []
            for tokens, weights_ in zip(batch["t"], batch["w"]):
                use = [(place[t], w) for t, w in zip(tokens, weights_) if t in place]
                v = np.array([w for _, w in use], np.float32) @ parts[[k for k, _ in use]] if use else np.zeros(parts.shape[1], np.float32)
                out.append((v / (np.linalg.norm(v) or 1)).astype(float).tolist())
            yield pd.DataFrame({"id": batch["id"], "country": batch["country"], "vector": out})

    return grouped.mapInPandas(run, "id long, country string, vector array<double>")
