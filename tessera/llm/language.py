"""Language of web pages: Bayesian fusion of text, declared language, address suffix and host.

Four kinds of evidence about a page's language are combined by Bayes' rule:

* the text: hashed words and character trigrams under a model of each language, counted over all documents with a known
  language. Words of a text depend on each other, so the log likelihood is divided by ``BURST``;
* the language that the markup declares (``lang`` of the html tag, wherever in the page) and the suffix of the address (its
  last label): the rates of each given the language, from grouped aggregation over the pages with the posteriors by text
  as weights and ``PULL`` pseudo-pages whose declaration or suffix is the language's own code;
* the host: a prior smoothed in a hierarchy. The page's host is drawn towards its domain (last two labels), that towards its
  suffix, that towards all pages, each with ``PULL`` pseudo-pages.

Posteriors by text are summed by group; a page's own is taken out of every sum again, so that no page is evidence about
itself. All languages of the documents take part. Their models are made in executors and go through broadcasts of
``BLOCK`` languages; a task holds one block. The visible text is the markup without script, style, comments and tags.
Sums by group are pre-aggregated, and what is joined back, a row a page with its posterior and never text, is spread over
salted keys, so a host, domain or suffix may hold any share of the pages.

Defined cases: a null page has no text and declares nothing; a null or odd address has host ''; with nothing to go on the
posterior is the prior of all pages; ties go to the language first in the alphabet; repeated pages keep a row each;
an empty table gives an empty result; without documents of known language there are no languages to choose
from and the language is null; further columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytescan
from tessera.llm.workspace import Workspace, bounded_batches, each, spread_join

BUCKETS = 1 << 15
BURST = 8.0
PULL = 5.0
SMOOTHING = 0.5
#: Numbers that a broadcast side may hold: rows by languages by arrays.
SIDE_NUMBERS = 2_000_000
#: Languages whose models are held in memory at once.
BLOCK = 64
_WORD = bytescan.table_of([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
_HIDDEN = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"""<html((?:[\s/](?:"[^"]*"|'[^']*'|[^>"'])*)?)>""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TAG_NAME = re.compile(r"\s*([A-Za-z]+)")


def shown(page: str | None) -> str:
    """The page without script, style and comments."""
    return _HIDDEN.sub(" ", page) if page else ""


def visible(page: str | None) -> str:
    """The text that a reader sees."""
    return markup.unescape(_TAG.sub(" ", shown(page)))


def declared(page: str | None) -> str:
    """The primary language tag of the html element, in lower case, or ''."""
    found = _HTML.search(shown(page))
    for name, *values in _ATTRIBUTE.findall(found.group(1)) if found else ():
        if name.lower() == "lang":
            tag = _TAG_NAME.match("".join(values))
            return tag.group(1).lower() if tag else ""
    return ""


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def features(column: pa.Array, hasher: bytescan.SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and byte trigrams of each text, and the first of each text."""
    buf, bounds = bytescan.text_buffer(column)
    buf = bytescan.LOWER[buf]
    word = _WORD[buf]
    buf = np.where(word, buf, 0x20).astype(np.uint8)
    starts, ends = bytescan.runs(word)
    words = hasher(buf, starts, ends) % np.uint64(BUCKETS)
    wide = buf.astype(np.uint64)
    grams = bytescan.mix((wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]) % np.uint64(BUCKETS) if len(buf) > 2 else np.zeros(0, np.uint64)
    at = np.flatnonzero(word[1 : 1 + len(grams)])  # trigrams around a letter
    text_of = lambda x: np.searchsorted(bounds, x, side="right") - 1
    owner = np.concatenate((text_of(starts), text_of(at + 1)))
    bucket = np.concatenate((words, grams[at] + np.uint64(BUCKETS))).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(bounds)))


def language_models(docs: DataFrame, work: Workspace) -> DataFrame:
    """(lang, logs): for every language of ``docs`` (text, lang) its log probabilities by bucket, as packed 32-bit floats."""
    rows = docs.filter(F.col("lang").isNotNull() & (F.col("lang") != "")).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in sums.items():
                some = np.flatnonzero(own)
                # a language whose documents hold no word still has a model
                some = some if len(some) else np.zeros(1, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some), pa.array(own[some])], names=["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                bucket, first = features(part.column("text"), hasher)
                names = part.column("lang").to_pylist()
                index = {x: k for k, x in enumerate(dict.fromkeys(names))}
                owner = np.repeat([index[x] for x in names], np.diff(first))
                for lang, k in index.items():
                    if lang not in sums and len(sums) >= BLOCK:
                        yield from flush()
                    own = np.bincount(bucket[owner == k], minlength=2 * BUCKETS)
                    sums[lang] = sums[lang] + own if lang in sums else own
        yield from flush()

    def model(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(2 * BUCKETS)
        counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
        counts = counts.reshape(2, BUCKETS) + SMOOTHING
        logs = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
        return pd.DataFrame({"lang": [key[0]], "logs": [logs.tobytes()]})

    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return work.table("models", counts.groupBy("lang").applyInPandas(model, "lang string, logs binary"))


def model_blocks(models: DataFrame) -> Iterator[np.ndarray]:
    """Log probabilities of ``BLOCK`` languages at a time, in the order of their names."""
    held = []
    for row in models.orderBy("lang").select("logs").toLocalIterator():
        held.append(np.frombuffer(bytes(row[0]), np.float32))
        if len(held) == BLOCK:
            yield np.stack(held)
            held = []
    if held:
        yield np.stack(held)


def by_text(pages: DataFrame, shared: list) -> DataFrame:
    """(page_id, url, declared, likelihood): scaled likelihoods of the languages by the text alone, the best being 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        for batch in batches:
            for part in bytescan.slices(batch, "html"):
                source = part.column("html").to_pylist()
                bucket, first = features(pa.array([visible(x) for x in source], pa.string()), hasher)
                out = []
                for block in each(shared):
                    for row in block:
                        sums = np.concatenate(([0.0], np.cumsum(row[bucket], dtype=np.float64)))
                        out.append((sums[first[1:]] - sums[first[:-1]]) / BURST)
                out = np.stack(out, axis=1)
                out = np.exp(np.maximum(out - out.max(axis=1, keepdims=True), -50))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), pa.array([declared(x) for x in source]), pa.array(list(out), pa.list_(pa.float64()))],
                    names=["page_id", "url", "declared", "likelihood"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, declared string, likelihood array<double>")


def _normal(a: Column) -> Column:
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.transform(a, lambda x: x / total)


def _times(*arrays: Column) -> Column:
    out = arrays[0]
    for a in arrays[1:]:
        out = F.zip_with(out, a, lambda x, y: x * y)
    return out


def _sums(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Arrays summed by group, element by element, in one pre-aggregated shuffle."""
    sums = rows.select(*keys, F.posexplode(value).alias("_k", "_v")).groupBy(*keys, "_k").agg(F.sum("_v").alias("_v"))
    return sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_v"))), lambda x: x["_v"]).alias(name))  # a number a language


def languages_of(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, host, declared, language, probability) of every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    bounded_batches(spark)
    work = Workspace(spark, "language")
    models = language_models(docs, work)
    languages = [r[0] for r in models.select("lang").orderBy("lang").collect()]
    n = len(languages)
    host = host_of(F.col("url"))
    if not n:
        none = F.lit(None)
        return pages.select(F.col("page_id").cast("long"), host.alias("host"), none.cast("string").alias("declared"), none.cast("string").alias("language"), none.cast("double").alias("probability"))
    rows = by_text(pages, [spark.sparkContext.broadcast(block) for block in model_blocks(models)])
    labels = F.split("host", r"\.")
    rows = (
        rows.withColumn("host", host)
        .withColumn("domain", F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")))
        .withColumn("suffix", F.element_at(labels, -1))
        .withColumn("own", _normal(F.col("likelihood")))
        .drop("url")
    )
    rows = work.table("text", rows)
    names = F.array(*[F.lit(x) for x in languages])
    groups = work.table("groups", _sums(rows, ["host", "domain", "suffix"], "own", "by_host"))
    by_domain = work.table("domains", _sums(groups, ["domain", "suffix"], "by_host", "by_domain"))
    by_suffix = work.table("suffixes", _sums(by_domain, ["suffix"], "by_domain", "by_suffix"))
    by_declared = work.table("declared", _sums(rows, ["declared"], "own", "by_declared"))
    every = by_suffix.agg(*[F.sum(F.col("by_suffix")[k]) for k in range(n)]).first()
    every = [float(x or 0) for x in every]
    total = sum(every)
    flat = F.array(*[F.lit((x + 1) / (total + n)) for x in every])
    sums = F.array(*[F.lit(x) for x in every])

    def rest(group: str | Column) -> Column:
        """A group's sums without the page itself."""
        return F.zip_with(group, "own", lambda x, y: F.greatest(x - y, F.lit(0.0)))

    def rate(column: str, values: int) -> Column:
        """P(value | language) for the page's value, smoothed."""
        named = F.transform(names, lambda x: F.when(F.col(column) == x, F.lit(PULL)).otherwise(F.lit(0.0)))
        seen = F.zip_with(rest(f"by_{column}"), named, lambda x, y: x + y + SMOOTHING)
        weights = F.transform(rest(sums), lambda x: x + SMOOTHING * values + PULL)
        return F.zip_with(seen, weights, lambda x, y: x / y)

    def drawn(group: str, prior: Column) -> Column:
        """The group's rates without the page itself, drawn towards a prior."""
        others = rest(group)
        size = F.aggregate(others, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(others, prior, lambda x, p: (x + PULL * p) / (size + PULL))

    def joined(out: DataFrame, side: DataFrame, key: str, member: str) -> DataFrame:
        return out.join(F.broadcast(side), key) if side.count() * n * 3 <= SIDE_NUMBERS else spread_join(out, side, key, member)

    sides = joined(joined(groups, by_domain.drop("suffix"), "domain", "host"), by_suffix, "suffix", "host")
    sides = work.table("sides", sides.drop("domain"))
    out = joined(rows.drop("domain", "suffix"), sides, "host", "page_id")
    out = joined(out, by_declared, "declared", "page_id")
    prior = drawn("by_host", drawn("by_domain", drawn("by_suffix", flat)))
    told = F.when(F.col("declared") == "", F.array(*[F.lit(1.0)] * n)).otherwise(rate("declared", by_declared.count() + 1))
    out = out.withColumn("p", _normal(_times(F.col("likelihood"), told, rate("suffix", by_suffix.count() + 1), prior)))
    best = F.array_max("p")
    return out.select("page_id", "host", "declared", F.element_at(names, F.array_position("p", best).cast("int")).alias("language"), best.alias("probability"))


def op6_evidence_fusion_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
