"""Token ids in files of fixed-width bit packing, with block offsets for random access.

A file holds the ids of consecutive documents in ascending doc_id order: a header (magic, bits an id, ids a block, ids,
documents), the byte offset of each block, the first id of each document, and the blocks. Every id takes the fewest bits
that the vocabulary needs; a block starts at a byte boundary, so any range of ids is read from its blocks alone and
unpacked in numpy without a loop over ids.

Files are rows (bucket, part, start, content) of a Parquet table: Spark's committer then makes a retried or speculative
task harmless, and any file system that Spark reaches will do. ``start`` counts the ids of all files before.

Documents are dealt into files by ranges of doc_id. Fine ranges of about equal counts come from the distribution of the
ids, and neighbours among them are joined to ranges of about equal bytes of text; so texts are encoded only once, and
what is shuffled is packed already. A file ends after ``FILE_IDS`` ids, within a range; so no file grows without bound,
whatever a document's length or a repeated id. A file knows its first id within its range; the driver sees one sum a range.

Reading takes each document by its offset from the blocks that hold it; a block is unpacked once while documents follow
each other.

Defined cases: a null or empty text has only the end id; null ids come first; rows with equal ids follow each other in
the order of their contents; an empty table gives no files and an empty result; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytescan, tokens
from tessera.llm.workspace import Workspace, partitions

END_ID = 2
BLOCK_IDS = 4096
FILE_IDS = 1 << 20
#: Ids that are spread into bits at a time; whole bytes at any width.
_PACK_IDS = 1 << 16
#: Fine ranges of doc_id for each range of files.
FINE = 8
MAGIC = b"TKB1"
_HEADER = struct.Struct("<4sIIQQ")


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive ``width``-bit little-endian numbers, padded to a whole byte."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for k in range(0, len(ids), _PACK_IDS):
        bits = np.unpackbits(ids[k : k + _PACK_IDS].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes | memoryview, count: int, width: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes: each is cut from the 64-bit window that starts at its first byte."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    raw = np.zeros(len(data) + 8, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    first = np.arange(count, dtype=np.int64) * width
    window = np.lib.stride_tricks.sliding_window_view(raw, 8)[first >> 3].copy().view("<u8").ravel()
    return ((window >> (first & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def write_file(ids: np.ndarray, firsts: np.ndarray, width: int, block: int = BLOCK_IDS) -> bytes:
    packed = [pack(ids[k : k + block], width) for k in range(0, len(ids), block)]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in packed]))).astype("<u8")
    return b"".join([_HEADER.pack(MAGIC, width, block, len(ids), len(firsts)), offsets.tobytes(), firsts.astype("<u8").tobytes(), *packed])


class PackedFile:
    """Random access to a file's ids and documents."""

    def __init__(self, content: bytes) -> None:
        magic, self.width, self.block, self.n, self.docs = _HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        blocks = -(-self.n // self.block)
        self.offsets = np.frombuffer(content, "<u8", blocks + 1, _HEADER.size)
        self.firsts = np.frombuffer(content, "<u8", self.docs, _HEADER.size + 8 * (blocks + 1)).astype(np.int64)
        self.data = memoryview(content)[_HEADER.size + 8 * (blocks + 1 + self.docs) :]
        self._last: tuple[int, np.ndarray] = -1, np.zeros(0, np.uint32)

    def _block(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            data = self.data[int(self.offsets[k]) : int(self.offsets[k + 1])]
            self._last = k, unpack(data, min(self.block, self.n - k * self.block), self.width)
        return self._last[1]

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids in [start, end), from the blocks that hold them."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-end // self.block)
        parts = self._block(a) if b - a == 1 else np.concatenate([self._block(k) for k in range(a, b)])
        return parts[start - a * self.block : end - a * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.firsts[k + 1]) if k + 1 < self.docs else self.n)


@lru_cache(maxsize=1)
def library_ids(path: str) -> tokens.PieceTable:
    """The library's ids of pieces; one table a Python worker, so that it outlives a task."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    mark = next(t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special)
    mark_id = tokenizer.token_to_id(mark)

    def encode(pieces: list[str]) -> list[np.ndarray]:
        """Many pieces in one call, a special token between them; those that may hold one themselves go alone."""
        plain = [p for p in pieces if "<" not in p]
        found = {}
        for k in range(0, len(plain), 4096):
            own = plain[k : k + 4096]
            ids = np.array(tokenizer.encode_batch_fast([mark.join(own)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.concatenate(([-1], np.flatnonzero(ids == mark_id), [len(ids)])).tolist()
            found |= {p: ids[a + 1 : b] for p, a, b in zip(own, cuts, cuts[1:])}
        return [found[p] if p in found else np.array(tokenizer.encode(p, add_special_tokens=False).ids, "<u4") for p in pieces]

    return tokens.PieceTable(encode)


def encoded(df: DataFrame, path: str, width: int, end_id: int) -> DataFrame:
    """(doc_id, bucket, n, packed) with the end id appended, packed by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = library_ids(path), np.array([end_id], "<u4")
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                flat, first = table(part.column("text"))
                ids = [np.concatenate((flat[a:b], end)) for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("bucket").cast(pa.int32()), pa.array([len(x) for x in ids], pa.int64()), pa.array([pack(x, width) for x in ids], pa.binary())],
                    names=["doc_id", "bucket", "n", "packed"],
                )

    return df.select("doc_id", "bucket", "text").mapInArrow(run, "doc_id long, bucket int, n long, packed binary")


def bucketed(df: DataFrame, count: int) -> DataFrame:
    """Adds ``bucket``, ascending with doc_id: ``count`` ranges at most with about as many bytes of text each."""

    def placed(cuts: list[int]):
        above = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
        return F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(above, lambda c: c < F.col("doc_id")))).cast("int")

    if count < 2:
        return df.withColumn("bucket", F.lit(0))
    fine = FINE * count
    cuts = sorted(set(df.select(F.percentile_approx("doc_id", [k / fine for k in range(1, fine)], 4 * fine)).first()[0] or []))
    sizes = dict(df.select(placed(cuts).alias("k"), (F.octet_length("text") + 16).alias("n")).groupBy("k").agg(F.sum(F.coalesce("n", F.lit(16)))).collect())  # ``fine`` rows at most
    share, seen, kept = sum(sizes.values()) / count, 0, []
    for k, cut in enumerate(cuts):  # fine range k ends at cuts[k]
        seen += sizes.get(k, 0)
        if seen >= share * (len(kept) + 1) and len(kept) < count - 1:
            kept.append(cut)
    return df.withColumn("bucket", placed(kept))


def write_files(df: DataFrame, work: Workspace, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files of ``df`` (doc_id, text); (bucket, part, start, content, docs), one row a file, docs being its ids in order."""
    spark = df.sparkSession
    width = width_of(tokens.vocabulary_size(path))
    n = partitions(spark)
    rows = encoded(bucketed(df.select("doc_id", "text"), n), path, width, end_id)
    dealt = rows.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "n", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        bucket, number, before, total = None, 0, 0, 0  # files and ids of the bucket so far, ids of this file

        def flush() -> pa.RecordBatch:
            firsts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))[:-1]
            content = write_file(np.concatenate(ids), firsts, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([total], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([content], pa.binary())],
                names=["bucket", "part", "before", "n", "docs", "content"],
            )

        for batch in batches:
            for doc, b, k, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if docs and (b != bucket or total >= file_ids):
                    yield flush()
                    number, before = (number + 1, before + total) if b == bucket else (0, 0)
                    docs, ids, total = [], [], 0
                bucket = b
                docs.append(doc)
                ids.append(unpack(packed, k, width))
                total += k
        if docs:
            yield flush()

    written = work.table("files", dealt.mapInArrow(run, "bucket int, part int, before long, n long, docs array<long>, content binary"))
    sums = sorted(tuple(r) for r in written.groupBy("bucket").agg(F.sum("n")).collect())  # a row a range, as many as partitions
    first = [(bucket, sum(size for _, size in sums[:k])) for k, (bucket, _) in enumerate(sums)]
    starts = spark.createDataFrame(first, "bucket int, first long")
    return written.join(F.broadcast(starts), "bucket").select("bucket", "part", (F.col("first") + F.col("before")).alias("start"), "content", "docs")


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, unpacked from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, content in zip(*(batch.column(k) for k in ("start", "docs", "content"))):
                file, docs, start = PackedFile(content.as_py()), docs.as_py(), start.as_py()
                ends = np.append(file.firsts[1:], file.n)
                crc = [zlib.crc32(np.ascontiguousarray(file.document(k), "<u4")) for k in range(file.docs)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(file.firsts + start), pa.array(ends - file.firsts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("start", "docs", "content").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "bitpack"), tokens.default_path())
    return read_files(files)
