"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Texts are cut into tokens (runs of letters and digits, runs of punctuation). Token unigrams, token bigrams and bigrams of
token shapes (kind, case, digits, length, equal to the token before) are hashed into ``BUCKETS`` each. The raw model
counts every n-gram of every document. The target model counts those of labelled documents of quality 1. A document's
log importance weight is the sum, over its n-grams, of the log ratio of the two smoothed models.

Sampling without replacement in proportion to the weights is a top-k of weight plus Gumbel noise; the noise is a hash of
the id, so the sample is reproducible. k is the number of documents whose weight reaches a cutoff, which is calibrated on
labelled documents that the target model has not seen: the best separation that keeps ``RECALL`` of the good ones. The
k-th key is found by counting key prefixes, never by sorting or collecting the keys.

Only the labels used to fit are bounded: a hash sample of ``FIT_ROWS`` labelled rows. Counts cover all documents.

Defined cases: a null or empty text has no n-grams and weight 0; a null id draws the noise of id 0; rows with the same
key are kept or left together; without labelled rows of both kinds the cutoff keeps every document; an empty table gives
an empty result; labels without a document and repeated labels do no harm (any label 0 counts as 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytescan
from tessera.llm.workspace import Workspace, mapped, shielded

BUCKETS = 10_000
KINDS = 3
FIT_ROWS = 20_000
RECALL = 0.995
#: Separation (kept share of the good plus rejected share of the bad) given up for a lower cutoff.
SLACK = 0.005
SMOOTHING = 1.0
#: Target n-grams that the raw model stands in for.
PRIOR = 10_000.0
SEED = 7
_WORD = bytescan.table_of([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_KIND = np.where(_WORD, 1, np.where(bytescan.table_of([(0x00, 0x20), (0x7F, 0x7F)]), 0, 2)).astype(np.uint8)
_CASES = [bytescan.table_of(r) for r in ([(0x41, 0x5A)], [(0x61, 0x7A)], [(0x30, 0x39)])]


def ngrams(column: pa.Array, hasher: bytescan.SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, text by text, and the first n-gram of each text."""
    buf, bounds = bytescan.text_buffer(column)
    kind = _KIND[buf]
    edge = np.concatenate(([True], kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, bool)
    at = np.flatnonzero(edge)
    to = np.append(at[1:], len(kind))
    token = kind[at] > 0
    starts, ends = at[token], to[token]
    h = hasher(buf, starts, ends)
    first = bytescan.per_text(starts, bounds)
    inner = np.ones(len(h), bool)  # has a token before it in its text
    inner[first[:-1][np.diff(first) > 0]] = False
    shape = kind[starts].astype(np.uint64) + (np.minimum(ends - starts, 7).astype(np.uint64) << np.uint64(2))
    for k, table in enumerate(_CASES):
        sums = np.concatenate(([0], np.cumsum(table[buf])))
        shape |= (sums[ends] > sums[starts]).astype(np.uint64) << np.uint64(5 + k)
    prior = np.concatenate((h[:1], h[:-1]))
    shape |= (inner & (h == prior)).astype(np.uint64) << np.uint64(8)
    n = np.uint64(BUCKETS)
    out = np.empty((len(h), KINDS), np.int64)
    out[:, 0] = h % n
    out[:, 1] = BUCKETS + bytescan.mix(np.where(inner, prior, 0) * np.uint64(3) + h) % n
    before = np.where(inner, np.concatenate((shape[:1], shape[:-1])), 0).astype(np.uint64)
    out[:, 2] = 2 * BUCKETS + bytescan.mix((before << np.uint64(9)) + shape) % n
    return out.ravel(), first * KINDS


def noise(ids: np.ndarray, seed: int) -> np.ndarray:
    """Gumbel noise as a function of the id."""
    h = bytescan.mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    u = ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def sortable(x: np.ndarray) -> np.ndarray:
    """Doubles as signed integers in the same order."""
    bits = np.ascontiguousarray(x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def labelled(labels: DataFrame, limit: int) -> dict[int, int]:
    """doc_id -> quality of a hash sample of about ``limit`` labelled rows."""
    rows = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    n = rows.count()
    if n > limit:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * (limit / n)))
    found = rows.groupBy("doc_id").agg(F.min("quality").alias("quality")).collect()
    return {i: int(q >= 1) for i, q in found}


def in_fit(ids: np.ndarray) -> np.ndarray:
    """Four fifths of the good labelled documents fit the target model; the others calibrate."""
    return bytescan.mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(5) > 0


@dataclass
class Model:
    ratio: np.ndarray
    cutoff: float

    def weights(self, column: pa.Array, hasher: bytescan.SpanHasher) -> np.ndarray:
        grams, first = ngrams(column, hasher)
        sums = np.concatenate(([0.0], np.cumsum(self.ratio[grams])))
        return sums[first[1:]] - sums[first[:-1]]


def _ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> Model:
    """Counts over all of ``docs`` (doc_id, text); the cutoff from the labelled documents held out."""
    quality = labelled(labels, limit)
    known = np.array(sorted(quality), np.int64)
    good = np.array([quality[i] == 1 for i in known.tolist()], bool)
    shared = docs.sparkSession.sparkContext.broadcast((known, known[good & in_fit(known)], known[~(good & in_fit(known))]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target_ids, hasher = shared.value[1], bytescan.SpanHasher()
        raw = np.zeros(KINDS * BUCKETS, np.int64)
        target = np.zeros_like(raw)
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                grams, first = ngrams(part.column("text"), hasher)
                raw += np.bincount(grams, minlength=len(raw))
                mine = np.isin(_ids(part), target_ids) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                target += np.bincount(grams[np.repeat(mine, np.diff(first))], minlength=len(raw))
        some = np.flatnonzero(raw)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    sums = mapped(docs.select("doc_id", "text"), count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()
    counts = np.zeros((2, KINDS, BUCKETS))
    for bucket, raw, target in sums:
        counts[:, bucket // BUCKETS, bucket % BUCKETS] = raw, target
    if not counts[1].any():
        counts[1] = counts[0]
    raw, target = ((c + SMOOTHING) / (c.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS) for c in counts)
    seen = counts[1].sum(axis=1, keepdims=True)
    target = (counts[1] + PRIOR * raw) / (seen + PRIOR)  # few target n-grams leave the ratio near one
    model = Model(np.log(target / raw).ravel(), -np.inf)
    held = mapped(docs.select("doc_id", "text"), _scores(docs.sparkSession.sparkContext.broadcast((model, shared.value[2]))), "doc_id long, log_weight double")
    scores = [(w, quality[i]) for i, w in held.collect()]  # at most the labelled sample
    model.cutoff = cutoff_of([w for w, q in scores if q], [w for w, q in scores if not q])
    return model


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, wanted), hasher = shared.value, bytescan.SpanHasher()
        for batch in batches:
            mask = np.isin(_ids(batch), wanted) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for part in bytescan.slices(batch.filter(pa.array(mask)), "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(model.weights(part.column("text"), hasher))], names=["doc_id", "log_weight"])

    return run


def cutoff_of(good: list[float], bad: list[float], recall: float = RECALL) -> float:
    """The lowest cutoff that parts good from bad within ``SLACK`` of the best among those that keep ``recall`` of the good."""
    if not good or not bad:
        return -np.inf
    good_, bad_ = np.sort(good), np.sort(bad)
    edges = np.unique(np.concatenate((good_, bad_)))
    cuts = np.concatenate(([edges[0] - 1], (edges[1:] + edges[:-1]) / 2))
    kept = 1 - np.searchsorted(good_, cuts) / len(good_)
    gain = np.where(kept >= recall, kept + np.searchsorted(bad_, cuts) / len(bad_), -1)
    return float(cuts[np.flatnonzero(gain >= gain.max() - SLACK)[0]])


def kth_key(keys: DataFrame, k: int) -> int:
    """The k-th largest of the signed 64-bit ``key`` column, by counting prefixes of 16 bits."""
    prefix, rank = None, k
    for shift in (48, 32, 16, 0):
        level = F.shiftright("key", shift)
        rows = keys if prefix is None else keys.filter(F.shiftright("key", shift + 16) == prefix)
        counts = sorted((tuple(r) for r in rows.groupBy(level.alias("p")).count().collect()), reverse=True)  # 65,536 at most
        for prefix, n in counts:
            if rank <= n:
                break
            rank -= n
    return prefix


def keyed(docs: DataFrame, model: Model, seed: int, keep: list[str], least: int | None = None) -> DataFrame:
    """``keep`` with log_weight, gumbel_key and key; rows below the key ``least`` are left out."""
    from pyspark.sql import types as T

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("_weight", T.DoubleType()), T.StructField("_gumbel", T.DoubleType()), T.StructField("_key", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, hasher = to_arrow_schema(schema), bytescan.SpanHasher()
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                weight = shared.value.weights(part.column("text"), hasher)
                gumbel = weight + noise(_ids(part), seed)
                key = sortable(gumbel)
                columns = [*(part.column(c).cast(arrow.field(c).type) for c in keep), pa.array(weight), pa.array(gumbel), pa.array(key)]
                out = pa.RecordBatch.from_arrays(columns, schema=arrow)
                yield out if least is None else out.filter(pa.array(key >= least))

    return mapped(docs.select(list(dict.fromkeys([*keep, "doc_id", "text"]))), run, schema)


def resample(docs: DataFrame, labels: DataFrame, seed: int = SEED, limit: int = FIT_ROWS) -> tuple[DataFrame, Model, int | None]:
    """(doc_id, log_weight, gumbel_key, key) of all documents, the model, and the least key in the sample."""
    work = Workspace(docs.sparkSession, "resample")
    model = fit(docs, labels, limit)
    rows = work.table("keys", keyed(docs, model, seed, ["doc_id"]).withColumnsRenamed({"_weight": "log_weight", "_gumbel": "gumbel_key", "_key": "key"}))
    k = rows.filter(F.col("log_weight") >= model.cutoff).count()
    return rows, model, kth_key(rows, k) if k else None


def sampled(docs: DataFrame, labels: DataFrame, seed: int = SEED, limit: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` in the sample, all columns as they are."""
    _, model, least = resample(docs, labels, seed, limit)
    if least is None:
        return docs.limit(0)
    inner, restored = shielded(docs, ["doc_id", "text"])
    return restored(keyed(inner, model, seed, inner.columns, least))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents: doc_id, log_weight, gumbel_key."""
    rows, _, least = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = rows.filter(F.col("key") >= least) if least is not None else rows.limit(0)
    return kept.select("doc_id", "log_weight", "gumbel_key")
