"""Benchmark decontamination by an FM-index of each training shard.

Texts are lower-cased (A-Z) and cut into words of digits, a-z and everything from U+0080 on. The windows of a benchmark
item are its runs of ten words (the whole item if it has fewer, but not none). A shard is the rows of one task up to
``SHARD_BYTES`` of text. Its distinct words are its alphabet, and the sequence of all its words, with a separator after
each text, is indexed once. Windows are found by backward search through the ranks of the wavelet tree, their places by
sampled suffix positions, and the places merge into removal spans. Documents stay whole rows throughout, so there is no
shuffle.

The windows are broadcast in blocks of ``BLOCK_WINDOWS`` at most, made one after the other from a stream of items. A task
searches all blocks in the same index and holds one block at a time, the driver none.

Words are told apart by their bytes; hashes only find them.

Defined cases: a null or empty text has no words and is not contaminated; items without words or without an id have no
windows; items with the same id count once; repeated documents keep a row each; an empty table gives an empty result;
further columns are ignored by ``report`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.fmindex import FMIndex
from tessera.llm.workspace import bounded_batches, each, mapped, shielded

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_WINDOWS = 200_000
_WORD = bytescan.table_of([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
_FOUND = [T.StructField("_words", T.LongType()), T.StructField("_spans", T.ArrayType(T.IntegerType())), T.StructField("_cuts", T.ArrayType(T.IntegerType())), T.StructField("_items", T.ArrayType(T.LongType()))]


_HASHER = bytescan.SpanHasher()


class Words:
    """The words of some columns: bytes, byte ranges within their text, and the first word of each text."""

    def __init__(self, columns: list[pa.Array]) -> None:
        parts, shift = [], 0
        for column in columns:  # hashed one by one: a hash does not depend on the place in the buffer
            buf, bounds = bytescan.text_buffer(column)
            buf = bytescan.LOWER[buf]
            at, to = bytescan.runs(_WORD[buf])
            first = bytescan.per_text(at, bounds)
            base = np.repeat(bounds[:-1], np.diff(first))
            parts.append((buf, _HASHER(buf, at, to), at + shift, to + shift, np.diff(first), at - base, to - base))
            shift += len(buf)
        self.buf, self.hash, self.at, self.to, self.count, self.start, self.end = (np.concatenate(x) for x in zip(*parts))
        self.first = np.concatenate(([0], np.cumsum(self.count)))


class Alphabet:
    """The distinct words of a shard, numbered from 1 in the order of their hashes."""

    def __init__(self, words: Words) -> None:
        rows, number = bytescan.distinct(words.buf, words.at, words.to, words.hash)
        order = np.argsort(words.hash[rows], kind="stable")
        rows = rows[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        self.symbols = place[number]
        self.hash, self.at, self.size, self.buf = words.hash[rows], words.at[rows], (words.to - words.at)[rows], words.buf
        same = np.concatenate(([0], np.flatnonzero(np.diff(self.hash)) + 1, [len(self.hash)]))
        self.most = int(np.diff(same).max(initial=1))  # words of one hash

    def find(self, hashes: np.ndarray, buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The symbols of other words, 0 for those that the shard lacks."""
        out = np.zeros(len(hashes), np.int64)
        if not len(self.hash):
            return out
        low = np.searchsorted(self.hash, hashes)
        for k in range(self.most):
            place = np.minimum(low + k, len(self.hash) - 1)
            hit = np.flatnonzero((self.hash[place] == hashes) & (self.size[place] == size) & (out == 0))
            hit = hit[bytescan.same(buf, at[hit], self.buf, self.at[place[hit]], size[hit])]
            out[hit] = place[hit] + 1
        return out


class Block:
    """Windows of some items: the distinct words with their bytes, and right-aligned patterns of word numbers from 1."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[int]]) -> None:
        known = {w: k for k, w in enumerate(dict.fromkeys(w for window in windows for w in window), 1)}
        self.size = np.array([len(w) for w in known], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.buf = np.frombuffer(b"".join(known), np.uint8)
        self.hash = _HASHER(self.buf, self.at, self.at + self.size)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.patterns = np.zeros((len(windows), int(self.lengths.max(initial=1))), np.int64)
        for i, window in enumerate(windows):
            self.patterns[i, -len(window) :] = [known[w] for w in window]
        self.item_first = np.concatenate(([0], np.cumsum([len(x) for x in windows.values()]))).astype(np.int64)
        self.items = np.array([i for x in windows.values() for i in sorted(x)], np.int64)

    def within(self, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
        """(windows of words that the shard holds, their patterns in its symbols)."""
        symbol = np.concatenate(([0], alphabet.find(self.hash, self.buf, self.at, self.size)))
        patterns = symbol[self.patterns]
        some = np.flatnonzero((patterns > 0).sum(axis=1) == self.lengths)
        return some, patterns[some]


def blocks(benchmark: DataFrame, window: int, limit: int) -> Iterator[Block]:
    """The benchmark's windows in blocks; items stream through the driver one partition at a time."""
    found: dict[tuple[bytes, ...], set[int]] = {}
    for item, text in benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        words = Words([pa.array([text])])
        w = [words.buf[a:b].tobytes() for a, b in zip(words.at.tolist(), words.to.tolist())]
        for k in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[k : k + window]), set()).add(item)
            if len(found) >= limit:
                yield Block(found)
                found = {}
    if found:
        yield Block(found)


def search_shard(columns: list[pa.Array], blocks: Iterable[Block]) -> tuple[np.ndarray, ...]:
    """Over all texts of the columns: words by text, (span_first, spans in words), cuts in bytes, (item_first, items)."""
    words = Words(columns)
    alphabet = Alphabet(words)
    texts, owner = len(words.count), np.repeat(np.arange(len(words.count)), words.count)
    # a separator follows each text, so that neither occurrences nor spans go on into the next one
    sym = np.zeros(len(owner) + texts, np.int64)
    sym[np.arange(len(owner)) + owner] = alphabet.symbols
    bounds = words.first + np.arange(texts + 1)
    index = FMIndex(sym, len(alphabet.hash) + 1) if texts else None
    depth, pairs = np.zeros(len(sym) + 1, np.int64), np.zeros((0, 2), np.int64)
    for block in blocks:
        which, patterns = block.within(alphabet)
        if not len(which):
            continue
        lo, hi = index.search(patterns, block.lengths[which])
        which = np.repeat(which, hi - lo)
        at = index.locate(bytescan.ranges(lo, hi - lo))
        depth += np.bincount(at, minlength=len(depth)) - np.bincount(at + block.lengths[which], minlength=len(depth))
        times = block.item_first[which + 1] - block.item_first[which]
        new = np.stack((np.repeat(np.searchsorted(bounds, at, side="right") - 1, times), block.items[bytescan.ranges(block.item_first[which], times)]), axis=1)
        pairs = np.unique(np.concatenate((pairs, new)), axis=0)
    a, b = bytescan.runs(np.cumsum(depth[:-1]) > 0)
    own = np.searchsorted(bounds, a, side="right") - 1
    spans = np.stack((a - bounds[own], b - bounds[own]), axis=1)
    cuts = np.stack((words.start[a - own], words.end[b - own - 1]), axis=1)
    return words.count, np.searchsorted(own, np.arange(texts + 1)), spans, cuts, np.searchsorted(pairs[:, 0], np.arange(texts + 1)), pairs[:, 1]


def cut_out(text: str, cuts: list[int]) -> str:
    """A text without some byte ranges of its UTF-8 form."""
    raw, at, out = text.encode(), 0, []
    for a, b in zip(cuts[::2], cuts[1::2]):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


def findings(df: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, limit: int = BLOCK_WINDOWS, cutting: bool = False) -> DataFrame:
    """``keep`` with _words, _spans (hit words), _cuts (hit bytes) and _items of every row of ``df``; ``cutting`` edits the texts."""
    spark = df.sparkSession
    bounded_batches(spark)
    schema = T.StructType([df.schema[c] for c in keep] + _FOUND)
    shared = [spark.sparkContext.broadcast(block) for block in blocks(benchmark, window, limit)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def shard(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, span_first, spans, cuts, item_first, items = search_shard([p.column("text") for p in parts], each(shared))
            at = 0
            for part in parts:
                to = at + part.num_rows
                row_spans = [spans[a:b].ravel().tolist() for a, b in zip(span_first[at:to], span_first[at + 1 :])]
                row_cuts = [cuts[a:b].ravel().tolist() for a, b in zip(span_first[at:to], span_first[at + 1 :])]
                row_items = [items[a:b].tolist() for a, b in zip(item_first[at:to], item_first[at + 1 :])]
                new = [pa.array(words[at:to], pa.int64()), pa.array(row_spans, pa.list_(pa.int32())), pa.array(row_cuts, pa.list_(pa.int32())), pa.array(row_items, pa.list_(pa.int64()))]
                if cutting and any(row_cuts):
                    texts = [cut_out(t, c) if c else t for t, c in zip(part.column("text").to_pylist(), row_cuts)]
                    part = part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays([*(part.column(c).cast(arrow.field(c).type) for c in keep), *new], schema=arrow)
                at = to

        parts, size = [], 0
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                parts.append(part)
                size += part.column("text").nbytes
                if size >= SHARD_BYTES:
                    yield from shard(parts)
                    parts, size = [], 0
        if parts:
            yield from shard(parts)

    return mapped(df.select(list(dict.fromkeys([*keep, "text"]))), run, schema)


def report(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``df`` (doc_id, text)."""
    found = findings(df, benchmark, ["doc_id"], window, limit)
    hit = F.aggregate("_spans", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("sign")), lambda s, x: F.struct((s["sum"] + s["sign"] * x).alias("sum"), (-s["sign"]).alias("sign")), lambda s: s["sum"])
    items: Column = F.array_join(F.array_sort(F.transform("_items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
    )


def clean(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """``df`` with the removal spans cut out of ``text``; all other rows and columns stay as they are."""
    inner, restored = shielded(df, ["text"])
    return restored(findings(inner, benchmark, inner.columns, window, limit, cutting=True))


def op5_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP5_SQL = f"""
WITH docs AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
item_at AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS n, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS k FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM item_at),
doc_at AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM docs CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n),
hits AS (SELECT d.doc_id, d.k, d.n, w.item_id FROM (SELECT doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM doc_at) d JOIN windows w USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
