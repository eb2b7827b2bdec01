"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact verification, components.

Fingerprints: texts are lower-cased (A-Z), split at ASCII white space and cut into shingles of four words (the whole
sequence if it has fewer); bit i is set if it is set in over half the shingles' XXH64 (seed 42). A text without words
has fingerprint zero and links like any other.

Linking at ``radius`` differing bits: a fingerprint maps to the bit counts of its 32 two-bit segments, written as one
64-bit word in which a count is as many ones (``embedding``). The Manhattan distance of two such vectors, the number of
bits in which the words differ, is a lower bound of the Hamming distance. Linked fingerprints therefore differ in at most
``radius`` groups when the segments are dealt into ``radius + AGREE`` groups: in at least ``AGREE`` of them all counts are
equal. The grid is the range join's first step: each fingerprint goes to one cell, the counts of ``AGREE`` groups, in each
of the C(radius + AGREE, AGREE) projections. Within a cell pairs in Manhattan range are found first, and these are
verified on the exact bits. Only a spanning forest of a cell's links leaves it. Cells with more than ``CELL`` members are
split into blocks, every pair of blocks being compared in a task of its own, so no cell is ever gathered whole.

Exact copies share one fingerprint and are one node from the start. Components come from alternating large-star and
small-star steps over written tables. Joins on a fingerprint, node or root deal their rows by a salt as well, so copies or a
component of any number are spread over many keys (``workspace.spread_join``); minima are pre-aggregated.

Defined cases: a null text has no words; a null id takes part but is never a component's id unless all its ids are null;
repeated rows keep a result row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytescan
from tessera.llm.workspace import Workspace, mapped, partitions, shielded, spread_join

WORDS, SEED, RADIUS = 4, 42, 4
#: Groups of segments whose counts make a cell; one more divides the pairs within cells by about eight here.
AGREE = 3
#: Low bits of the two-bit segments.
_LOW = 0x5555555555555555
#: Shingles whose bits are counted at a time.
_BITS = 1 << 16
#: Members of a grid cell that one task compares at once.
CELL = 2048
#: Hot cells whose list may be broadcast; beyond it they are joined by a shuffle.
HOT_CELLS = 50_000
#: Rows to be removed whose ids may be broadcast; beyond it they are joined by a shuffle.
GONE_BROADCAST = 250_000
_SPACE = bytescan.table_of([(0x20, 0x20), (0x09, 0x0D)])


def fingerprints_of(column: pa.Array, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Fingerprints (uint64) of all texts of a column."""
    buf, bounds = bytescan.text_buffer(column)
    buf = bytescan.LOWER[buf]
    texts = len(bounds) - 1
    out = np.zeros(texts, np.uint64)
    space = _SPACE[buf]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]  # the first white space after each word stays, as one space
    flat = buf[keep]
    gap = space[keep]
    flat[gap] = 0x20
    starts, ends = bytescan.runs(~gap)
    place = np.concatenate(([0], np.cumsum(keep)))[bounds]
    first = bytescan.per_text(starts, place)
    counts = np.diff(first)
    size = np.minimum(counts, words)
    shingles = np.where(counts > 0, counts - size + 1, 0)
    total = int(shingles.sum())
    if not total:
        return out
    begin = np.concatenate(([0], np.cumsum(shingles)[:-1]))
    at = np.arange(total) + np.repeat(first[:-1] - begin, shingles)
    some = np.flatnonzero(shingles)
    ones, origin = np.zeros((len(some), 64), np.int32), begin[some]
    view, digest = memoryview(flat.tobytes()), xxhash.xxh64_intdigest
    last = at + np.repeat(size, shingles) - 1
    for k in range(0, total, _BITS):
        spans = zip(starts[at[k : k + _BITS]].tolist(), ends[last[k : k + _BITS]].tolist())
        hashes = np.fromiter((digest(view[a:b], seed) for a, b in spans), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low, high = np.searchsorted(origin, k, side="right") - 1, np.searchsorted(origin, k + len(hashes))
        ones[low:high] += np.add.reduceat(bits, np.maximum(origin[low:high] - k, 0), axis=0, dtype=np.int32)
    over = (2 * ones > shingles[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def fingerprints(df: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, copy, fp) for every row of ``df`` (doc_id, text): a hash of the text, and the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                fp = fingerprints_of(part.column("text"), words, seed)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("copy"), pa.array(fp.view(np.int64))], names=["doc_id", "copy", "fp"])

    return mapped(df.select("doc_id", F.xxhash64("text").alias("copy"), "text"), run, "doc_id long, copy long, fp long")


def embedding(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments in unary: 00, 01 or 11 at each segment's place."""
    low, beside = np.uint64(_LOW), fp >> np.uint64(1)
    return ((fp | beside) & low) | (fp & beside & low) << np.uint64(1)


def projections(radius: int) -> list[int]:
    """Masks of the segments of every ``AGREE`` groups out of ``radius + AGREE``."""
    groups = [sum(3 << 2 * int(k) for k in g) for g in np.array_split(np.arange(32), radius + AGREE)]
    return [sum(chosen) for chosen in combinations(groups, AGREE)]


def cells(nodes: DataFrame, radius: int) -> DataFrame:
    """(cell, fp): every fingerprint under its cell of each projection. Cells are hashed; a collision only joins two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = projections(radius)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                fp = batch.column("fp").slice(at, 8192).to_numpy(zero_copy_only=False)
                counts = embedding(fp.view(np.uint64))
                for k, mask in enumerate(views):
                    cell = bytescan.mix((counts & np.uint64(mask)) + bytescan.mix(np.array([k], np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp)], names=["cell", "fp"])

    return mapped(nodes.select("fp"), run, "cell long, fp long")


def in_range(a: np.ndarray, b: np.ndarray, fa: np.ndarray, fb: np.ndarray, radius: int) -> np.ndarray:
    """Whether embeddings a, b lie within the radius and, of those that do, the fingerprints fa, fb as well."""
    out = np.bitwise_count(a ^ b) <= radius
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count((fa[at] if len(fa) == len(out) else fa) ^ fb[at]) <= radius
    return out


def forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph "at most ``radius`` bits differ" over distinct fingerprints."""
    left, right = [], []
    rest, counts = fp, embedding(fp)
    while len(rest):
        front, rest, counts = rest[:1], rest[1:], counts[1:]
        while len(front) and len(rest):
            near = in_range(counts, embedding(front[:1]), front[:1], rest, radius)
            found = rest[near]
            if len(found):
                left.append(np.full(len(found), front[0]))
                right.append(found)
                rest, counts = rest[~near], counts[~near]
            front = np.concatenate((front[1:], found))
    if not left:
        return fp[:0], fp[:0]
    return np.concatenate(left), np.concatenate(right)


def cell_links(cell: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the cells of a run of rows sorted by cell."""
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(cell)])))
    small = 12
    left, right = [fp[:0]], [fp[:0]]
    at = np.repeat((sizes > 1) & (sizes <= small), sizes).nonzero()[0]
    c, f = cell[at], fp[at]
    e = embedding(f)
    for lag in range(1, small):
        near = np.flatnonzero((c[lag:] == c[:-lag]) & in_range(e[lag:], e[:-lag], f[:-lag], f[lag:], radius))
        left.append(f[near])
        right.append(f[near + lag])
    for s, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        own = fp[s : s + n]
        if n <= CELL // 2:  # most cells hold no link at all: one dense comparison tells
            e = embedding(own)
            a, b = np.nonzero(np.triu(np.bitwise_count(e[:, None] ^ e[None, :]) <= radius, 1))
            near = np.bitwise_count(own[a] ^ own[b]) <= radius
            own = own[np.unique(np.concatenate((a[near], b[near])))]
        a, b = forest(own, radius)
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, work: Workspace, radius: int = RADIUS) -> DataFrame:
    """(a, b): links whose connected components are those of all links between the distinct ``fp`` of ``nodes``."""
    spark = nodes.sparkSession
    dealt = cells(nodes, radius)
    hot = work.table("hot", dealt.groupBy("cell").count().filter(F.col("count") > CELL).select("cell", F.expr(f"cast(count div {CELL // 2} as int) + 1").alias("blocks")))
    n_hot = hot.count()
    dealt = dealt.withColumn("block", F.lit(0).cast("long"))
    if n_hot:
        side = F.broadcast(hot) if n_hot <= HOT_CELLS else hot
        dealt = dealt.drop("block").join(side, "cell", "left")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(own, j).cast("long") * F.col("blocks") + F.greatest(own, j))
        dealt = dealt.select("cell", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(every))).alias("block"))
    n = partitions(spark)
    dealt = dealt.repartition(n, "cell", "block").sortWithinPartitions("cell", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]

        def out(cell, block, fp):
            if not len(cell):
                return None
            a, b = cell_links(cell * np.int64(1_000_003) + block, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]) if len(a) else None

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            new[2] = new[2].view(np.uint64)
            kept = [np.concatenate(x) for x in zip(kept, new)]
            whole = np.flatnonzero((kept[0] != kept[0][-1]) | (kept[1] != kept[1][-1])) if len(kept[0]) else []
            cut = int(whole[-1]) + 1 if len(whole) else 0
            if found := out(*(x[:cut] for x in kept)):
                yield found
            kept = [x[cut:] for x in kept]
        if found := out(*kept):
            yield found

    found = mapped(dealt.select("cell", "block", "fp"), run, "a long, b long")
    return work.table("links", found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def with_least(rows: DataFrame, key: str, value: str, member: str) -> DataFrame:
    """``rows`` with ``m``, the least ``value`` of their key; rows of one key are spread by a hash of ``member``."""
    return spread_join(rows, rows.groupBy(key).agg(F.min(value).alias("m")), key, member)


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the least node of its component."""

    def tally(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = edges.filter("a <> b")
    state, step = tally(edges), 0
    while state[0]:
        way = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        large = with_least(way, "u", "v", "v").filter("v > u")  # large-star
        large = work.table(f"large{step}", large.select(F.least("m", "u").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct())
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))  # small-star: all edges point to smaller nodes
        small = with_least(down, "u", "v", "v").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        small = work.table(f"small{step}", small.filter("a <> b").distinct())
        work.drop(f"large{step}")
        new, step = tally(small), step + 1
        if new == state:
            return small.select(F.col("b").alias("node"), F.col("a").alias("root"))
        edges, state = small, new
        if step > 1:
            work.drop(f"small{step - 2}")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def component_ids(nodes: DataFrame, node: str, roots: DataFrame, work: Workspace) -> DataFrame:
    """(node, component_id): the least ``least`` among the nodes of a component, for every row of ``nodes`` (node, least)."""
    members = roots.union(roots.select("root", "root").distinct()).toDF(node, "root")
    members = work.table("members", members.join(nodes.select(node, "least"), node))
    moved = work.table("moved", with_least(members, "root", "least", node).select(node, F.col("m").alias("component_id")))
    return nodes.select(node, "least").join(moved, node, "left").select(node, F.coalesce("component_id", "least").alias("component_id"))


def linked(df: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, copy, fp, component_id) for every row of ``df`` (doc_id, text)."""
    work = Workspace(df.sparkSession, "simhash")
    prints = work.table("prints", fingerprints(df, words))
    nodes = work.table("nodes", prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    ids = component_ids(nodes, "fp", components(links(nodes, work, radius), work), work)
    return spread_join(prints, ids, "fp", "doc_id").select("doc_id", "copy", "fp", "component_id")


def near_duplicates(df: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``df`` (doc_id, text)."""
    return linked(df, words, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(df: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` that stay: of each component the row with the least id; rows of one id and text once."""
    return remaining(df, linked(df, words, radius))


def remaining(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``df`` that stay, given the component of each as ``rows`` (doc_id, copy, component_id).

    Rows without an id stay. What goes is told by ids and text hashes; while these are few they are broadcast and no text
    is shuffled.
    """
    work = Workspace(df.sparkSession, "deduplicated")
    rows = work.table("linked", rows)
    gone = work.table("gone", rows.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct())
    repeated = work.table("repeated", rows.filter("doc_id = component_id").groupBy("doc_id", "copy").count().filter("count > 1").select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")))
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_copy"))

    def small(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if side.count() <= GONE_BROADCAST else side

    inner, restored = shielded(df, ["doc_id", "text"])
    kept = inner.join(small(gone), same, "left_anti")
    if not repeated.isEmpty():
        once = inner.join(small(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(small(repeated), same, "left_anti").unionByName(once)
    return restored(kept)


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
