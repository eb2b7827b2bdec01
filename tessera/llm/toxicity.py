"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text, compared window by window.

Texts are lower-cased (A-Z) and read as running words with single spaces. A window is a stretch of ``SCALES`` words: each
word by itself, and each stretch of four. It is compressed under both dictionaries, led in and followed by padding that
both hold, so that zstandard neither falls back to a raw block nor stops looking for matches before the window ends. The
ordinary length less the toxic one, in bytes, is the window's distance. How many windows reach each of the ``STEPS``, the
greatest distances, their mean and the number of windows go into a logistic score, whose weights are the thresholds'
calibration.

Training. The ordinary dictionary holds the words of ordinary training documents by their document frequency, the most
frequent last (nearest, so cheapest to refer to). The toxic one holds the same and then, in the same order, the words of
toxic documents that no two ordinary ones use; the ordinary one has as many bytes of its next words in their place, so that
offsets cost the same. Weights are calibrated on ``PARTS`` parts, each measured with dictionaries of the others; the final
dictionaries use all. Copies among the training rows count once. At most ``TOXIC_ROWS`` and ``ORDINARY_ROWS``
labelled rows are used, chosen by hash, never one that is held out; scoring covers whole texts of all rows.

Distances of single words are remembered by a worker for all its tasks, under the words themselves.

Defined cases: a null or empty text has no windows and gets the score of no distance; a null id counts as held out; rows
without a toxic label are not trained on, repeated labels take the larger; if the training rows lack either kind, every
score is 0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytescan, tokens
from tessera.llm.workspace import bounded_batches

TOXIC_ROWS, ORDINARY_ROWS = 1_500, 3_500
#: Bytes of what both dictionaries hold, and of what is the toxic one's own.
SHARED_BYTES, OWN_BYTES = 6_144, 4_096
#: Least documents of a dictionary's word: of the toxic one's own, of the shared.
LEAST_TOXIC, LEAST_ORDINARY = 3, 2
#: Words of a window, and distances in bytes that are counted.
SCALES, STEPS = (1, 4), (2, 3, 4, 5, 6, 7, 8)
FOLDS = 5
#: Parts of the training rows; each is measured with dictionaries of the others.
PARTS = 5
_LEAD, _TRAIL = bytes(range(200, 240)), bytes(range(180, 196))  # no text holds these byte sequences: they are not UTF-8
_WORD = bytescan.table_of([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


class Words:
    """The words of a column, one space between them: bytes, starts and ends, and the first word of each text."""

    def __init__(self, column: pa.Array) -> None:
        buf, bounds = bytescan.text_buffer(column)
        buf = bytescan.LOWER[buf]
        word = _WORD[buf]
        keep = word.copy()
        keep[1:] |= word[:-1] & ~word[1:]
        self.buf = np.where(word, buf, 0x20).astype(np.uint8)[keep]
        self.start, self.end = bytescan.runs(word[keep])
        self.first = bytescan.per_text(self.start, np.concatenate(([0], np.cumsum(keep)))[bounds])

    def windows(self, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first window of each text) of the windows of ``scale`` words."""
        words = np.diff(self.first)
        count = -(-words // scale)
        at = bytescan.ranges(np.zeros(len(count), np.int64), count) * scale
        last = np.minimum(at + scale, np.repeat(words, count)) - 1
        origin = np.repeat(self.first[:-1], count)
        return self.start[origin + at], self.end[origin + last], np.concatenate(([0], np.cumsum(count)))


@dataclass
class Dictionaries:
    """Two dictionaries and the distance of a window under them."""

    toxic: bytes
    ordinary: bytes
    _ready: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary, "_ready": []}

    def compressors(self) -> list:
        if not self._ready:
            how = zstandard.ZstdCompressionParameters(
                window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, target_length=16, strategy=zstandard.STRATEGY_GREEDY,
                write_checksum=False, write_content_size=False, write_dict_id=False,
            )
            for content in (self.toxic, self.ordinary):
                own = zstandard.ZstdCompressionDict(content + b" " + _TRAIL + _LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(compression_params=how)
                self._ready.append(zstandard.ZstdCompressor(dict_data=own, compression_params=how).compress)
        return self._ready

    def distance(self, window: bytes) -> int:
        toxic, ordinary = self.compressors()
        padded = b"".join((_LEAD, b" ", window, b" ", _TRAIL))
        return len(ordinary(padded)) - len(toxic(padded))

    def key(self) -> bytes:
        return hashlib.sha256(self.toxic + b"\x00" + self.ordinary).digest()


def dictionaries(docs: Iterable[tuple[set[bytes], int]]) -> Dictionaries:
    """Dictionaries of training documents, each given as its distinct words and its label."""
    counts = Counter(), Counter()
    for words, label in docs:
        counts[label].update(words)

    def chosen(label: int, size: int, least: int, known: set[bytes]) -> list[bytes]:
        out, left = [], size
        for word, n in sorted(counts[label].items(), key=lambda x: (-x[1], x[0])):
            if n < least or left < len(word) + 1:
                break
            if word not in known:
                out.append(word)
                left -= len(word) + 1
        return out

    def joined(words: list[bytes]) -> bytes:
        return b"".join(b" " + w for w in reversed(words))

    shared = chosen(0, SHARED_BYTES, LEAST_ORDINARY, set())
    own = joined(chosen(1, OWN_BYTES, LEAST_TOXIC, {w for w, n in counts[0].items() if n >= LEAST_ORDINARY}))
    following = joined(chosen(0, len(own) + 64, 1, set(shared))).rjust(len(own))
    return Dictionaries(joined(shared) + own, joined(shared) + following[len(following) - len(own) :])


class Distances:
    """Distances of all windows of a column; single words are remembered in two generations."""

    _last: Distances | None = None
    ENTRIES = 500_000

    def __init__(self, known: Dictionaries) -> None:
        self.known, self.key = known, known.key()
        self.words = tokens.Memo(known.distance, self.ENTRIES)

    @classmethod
    def of(cls, known: Dictionaries) -> Distances:
        """One table a Python worker, so that what it remembers outlives a task."""
        if cls._last is None or cls._last.key != known.key():
            cls._last = cls(known)
        return cls._last

    def __call__(self, words: Words, hasher: bytescan.SpanHasher) -> list[tuple[np.ndarray, np.ndarray]]:
        """By scale (distances, first window of each text)."""
        out, data = [], words.buf.tobytes()
        for scale in SCALES:
            a, b, first = words.windows(scale)
            if scale == 1:
                at, back = bytescan.distinct(words.buf, a, b, hasher(words.buf, a, b)) if len(a) else (a, a)
                memo = self.words
                d = np.array([memo[data[i:j]] for i, j in zip(a[at].tolist(), b[at].tolist())], np.int64)[back]
            else:
                distance = self.known.distance
                d = np.array([distance(data[i:j]) for i, j in zip(a.tolist(), b.tolist())], np.int64)
            out.append((d, first))
        return out


def features(distances: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of numbers for each text."""
    out = []
    for d, first in distances:
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((-d, owner))
        place = np.arange(len(d)) - np.repeat(first[:-1], n)

        def total(x: np.ndarray, owner: np.ndarray = owner, n: np.ndarray = n) -> np.ndarray:
            return np.bincount(owner, x, len(n))

        size = np.maximum(n, 1)
        counts = [total(d >= t) for t in STEPS]
        out += [total(d[order] * (place < k)) for k in (1, 3)]
        out += [np.log1p(c) for c in counts] + [c / size for c in counts[1:5]]
        out += [total(d) / size, np.log(size)]
    return np.stack(out, axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and weights (bias first) of a ridge logistic regression, by Newton steps."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / sd]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * np.r_[0, w[1:]])
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return mean, sd, w


@dataclass
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), (x - self.mean) / self.sd] @ self.weights, -700, 700)))


def fit(docs: list[tuple[int, bytes, int]]) -> Model | None:
    """A model of training documents (id, words with a space between, label); None if a kind is missing."""
    labels = np.array([label for *_, label in docs])
    if len(set(labels.tolist())) < 2:
        return None
    fold = bytescan.mix(np.array([i for i, *_ in docs], np.int64).view(np.uint64)) % np.uint64(PARTS)
    distinct = [(set(text.split(b" ")), label) for _, text, label in docs]
    hasher, x = bytescan.SpanHasher(), np.zeros((len(docs), 0))
    for side in range(PARTS):
        mine = np.flatnonzero(fold == side)
        other = Distances(dictionaries(distinct[k] for k in np.flatnonzero(fold != side)))
        for k in mine.tolist():
            row = features(other(Words(pa.array([docs[k][1]], pa.binary())), hasher))
            x = x if x.shape[1] else np.zeros((len(docs), row.shape[1]))
            x[k] = row
    return Model(dictionaries(distinct), *logistic(x, labels))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int, ordinary_rows: int) -> list[tuple[int, bytes, int]]:
    """(id, words, label) of a bounded hash sample of labelled rows that are not held out, copies once."""
    bounded_batches(docs.sparkSession)
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    chosen: dict[int, int] = {}
    for label, limit in ((1, toxic_rows), (0, ordinary_rows)):
        own = rows.filter(F.col("toxic") == label)
        n = own.count()
        if n > limit:
            own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * (limit / n)))
        chosen |= {i: label for i, _ in own.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(np.array(sorted(chosen), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            wanted = np.isin(ids, shared.value) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for part in bytescan.slices(batch.filter(pa.array(wanted)), "text"):
                w = Words(part.column("text"))
                data, h = w.buf.tobytes(), hasher(w.buf, w.start, w.end)
                texts, marks = [], []
                for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
                    texts.append(data[w.start[a] : w.end[b - 1]] if b > a else b"")
                    grams = h[a:b]
                    for k in range(1, min(4, b - a)):
                        grams = bytescan.mix(grams[:-1] * np.uint64(3) + h[a + k : b])
                    marks.append([int((bytescan.mix(grams ^ np.uint64(s + 1)) >> np.uint64(1)).min(initial=(1 << 63) - 1)) for s in range(4)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(texts, pa.binary()), pa.array(marks, pa.list_(pa.int64()))], names=["doc_id", "words", "marks"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, words binary, marks array<long>")
    seen: set[tuple[int, int]] = set()
    out = []
    for i, words, marks in found.orderBy("doc_id").toLocalIterator():  # as many rows as were chosen
        own = set(enumerate(marks))
        if words and len(own & seen) < 3:
            out.append((i, bytes(words), chosen[i]))
        seen |= own
    return out


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    if model is None:
        return docs.select(F.col("doc_id").cast("long"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, bytescan.SpanHasher()
        distances = Distances.of(model.dictionaries)
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                x = features(distances(Words(part.column("text")), hasher))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(model.scores(x))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    model = fit(training_rows(docs, labels, toxic_rows, ordinary_rows))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
