"""Near copies by shingle similarity of at least 4/5: fingerprints, prefix keys, segment counts, verification, components.

Texts are lower-cased (A-Z), split at ASCII white space and cut into shingles of five words (the whole sequence if it has
fewer); a text is the set of its shingles' 64-bit hashes. Texts link if their sets have a Jaccard similarity of 4/5.

Fingerprints come first, by operator 7's method (``simhash``): a bit is set if it is set in over half the set's hashes, and
fingerprints within its radius are found in cells of their two-bit segment counts. That finds the closest copies only: at a
similarity of 4/5 two fingerprints differ in 9.7 of 64 bits on average. So the sets' own keys find the rest, and what either
finds are candidates for the same verification.

No pair is missed: linked sets of n and m shingles share at least ceil(4/5 max(n, m)), so in any order of all shingles
their first common one is among the first n - ceil(4n/5) + 1 of each. The order is by the number of sets that hold a shingle:
those of one set only come first and can be left out, and what is left of the first ones are a set's keys; most sets have
none. Sets that share a key are compared by size and by the counts of 32 segments of their hashes, whose Manhattan distance
is a lower bound of the symmetric difference, which is at most (n + m) / 9. A spanning forest of what passes leaves a key;
its components are candidates only. In each, the sets themselves are compared, and the links found give the components.
Large groups are split into blocks, every pair of blocks being compared in a task of its own.

Equal sets are one node from the start. Defined cases: those of ``simhash``; texts without words link with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import bytescan, simhash
from tessera.llm.workspace import Workspace, mapped, partitions, spread_join

WORDS, SEGMENTS = 5, 32
#: Shingles whose bits are counted at a time, and those that one task sorts, about.
BITS, SORTED = 1 << 16, 1_000_000
#: Members that one task compares at once: by segment counts, and by their sets.
CELL, BLOCK = 2048, 512
#: Hot groups or texts whose list may be broadcast; beyond it they are joined by a shuffle.
BROADCAST = 50_000
#: Very common shingles: of a sample of one text in so many, those in this many of its texts and in this share of them; the
#: most that are listed; the tasks that the rows of each are spread over.
SAMPLE_EVERY, LEAST_COMMON, COMMON_SHARE, MOST_COMMON, SPLIT = 64, 4, 2_000, 100_000, 64
#: Sets that a task remembers to send copies once.
REMEMBERED = 200_000
#: Bits of a shingle's hash that a key does without: what is equal in the others only may link, so this costs comparisons.
SHORTER = np.uint64(16)
_SPACE = bytescan.table_of([(0x20, 0x20), (0x09, 0x0D)])


def shingles_of(column: pa.Array, hasher: bytescan.SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes, sorted within each text; first of each text) of a column."""
    buf, bounds = bytescan.text_buffer(column)
    buf = bytescan.LOWER[buf]
    space = _SPACE[buf]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    flat, gap = buf[keep], space[keep]
    flat[gap] = 0x20
    starts, ends = bytescan.runs(~gap)
    first = bytescan.per_text(starts, np.concatenate(([0], np.cumsum(keep)))[bounds])
    counts = np.diff(first)
    size = np.minimum(counts, WORDS)
    shingles = np.where(counts > 0, counts - size + 1, 0)
    at = bytescan.ranges(first[:-1], shingles)
    h = hasher(flat, starts[at], ends[at + np.repeat(size, shingles) - 1]).view(np.int64)
    owner = np.repeat(np.arange(len(counts)), shingles)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))[: len(h)]
    return h[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def nodes_of(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(bytescan.mix(h.view(np.uint64)))))
    return bytescan.mix((sums[first[1:]] - sums[first[:-1]]) ^ bytescan.mix(np.diff(first).astype(np.uint64))).view(np.int64)


def fingerprints_of(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The fingerprint of each set, zero of an empty one."""
    n = np.diff(first)
    some = np.flatnonzero(n)
    ones, origin = np.zeros((len(some), 64), np.int32), first[:-1][some]
    for k in range(0, len(h), BITS):
        bits = np.unpackbits(h[k : k + BITS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low, high = np.searchsorted(origin, k, side="right") - 1, np.searchsorted(origin, k + len(bits))
        ones[low:high] += np.add.reduceat(bits, np.maximum(origin[low:high] - k, 0), axis=0, dtype=np.int32)
    out = np.zeros(len(n), np.int64)
    out[some] = np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little").view(np.int64).reshape(-1)
    return out


def prints(df: DataFrame) -> DataFrame:
    """(doc_id, copy, node, fp, n, counts) of every row: hashes of text and set, fingerprint, size and segment counts of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                h, first = shingles_of(part.column("text"), hasher)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(n)), n)
                segment = (h.view(np.uint64) % np.uint64(SEGMENTS)).astype(np.int64)
                counts = np.bincount(owner * SEGMENTS + segment, minlength=len(n) * SEGMENTS)
                counts = np.minimum(counts, 255).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("copy"), pa.array(nodes_of(h, first)), pa.array(fingerprints_of(h, first)), pa.array(n.astype(np.int32)), pa.array([counts[k : k + SEGMENTS] for k in range(0, len(counts), SEGMENTS)], pa.binary())],
                    names=["doc_id", "copy", "node", "fp", "n", "counts"],
                )

    return mapped(df.select("doc_id", F.xxhash64("text").alias("copy"), "text"), run, "doc_id long, copy long, node long, fp long, n int, counts binary")


def cells_of(h: np.ndarray) -> np.ndarray:
    """The leading bits of hashes, as positive numbers; in a sorted set equal ones are neighbours."""
    return (h.view(np.uint64) >> SHORTER).view(np.int64)


def common_cells(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, ranks) of what a hash sample of the texts shows to be very common, sorted by shingle.

    Only where rows are sent and in what order shingles come depend on it, never which sets link; so it may be bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(cells_of(shingles_of(part.column("text"), hasher)[0]))], names=["cell"])

    sample = df.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_EVERY)) == 0)
    least = max(LEAST_COMMON, sample.count() // COMMON_SHARE)
    counts = mapped(sample, run, "cell long").groupBy("cell").count().filter(F.col("count") >= least)
    found = sorted(tuple(r) for r in counts.orderBy(F.desc("count"), "cell").limit(MOST_COMMON).collect())
    return np.array([c for c, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def keys_of(df: DataFrame, shingles: int = 0) -> DataFrame:
    """(cell, node): the keys of every set, a row each; ``shingles`` tells how many there are, and so the tasks that sort them.

    The order of shingles is that of the number of sets that hold them; very common ones come last, in the order of their
    sample, so they need no count and their rows are spread over ``SPLIT`` tasks each.
    """
    shared = df.sparkSession.sparkContext.broadcast(common_cells(df))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (common, _) = bytescan.SpanHasher(), shared.value
        seen: set[int] = set()
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                h, first = shingles_of(part.column("text"), hasher)
                node, n = nodes_of(h, first), np.diff(first)
                cell, place = cells_of(h), np.repeat(np.arange(len(n)), n)
                twice = (cell[1:] == cell[:-1]) & (place[1:] == place[:-1])
                # linked sets share at least so many keys: shingles with one key between them count once
                least = (4 * n + 4) // 5 - np.bincount(place[1:][twice], minlength=len(n))
                fresh = np.zeros(len(node), bool)  # copies within a task go once
                for k, x in enumerate(node.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[k] = True
                if len(seen) > REMEMBERED:
                    seen.clear()
                use = np.repeat(fresh, n)
                cell, owner, size = cell[use], np.repeat(node, n)[use], np.repeat(least, n)[use].astype(np.int32)
                if len(common):
                    place = np.minimum(np.searchsorted(common, cell), len(common) - 1)
                    salt = (owner.view(np.uint64) % np.uint64(SPLIT)).astype(np.int64)
                    cell = np.where(common[place] == cell, -1 - (place * SPLIT + salt), cell)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(owner), pa.array(size)], names=["cell", "node", "least"])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, ranks = shared.value
        for t in groups(batches, "cell"):
            c, node, least = (t.column(x).to_numpy() for x in ("cell", "node", "least"))
            new = np.concatenate(([True], (c[1:] != c[:-1]) | (node[1:] != node[:-1])))
            c, node, least = c[new], node[new], least[new]
            starts = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(c)])))
            sets = np.repeat(sizes, sizes).astype(np.int64)
            if len(common):  # a negative cell tells the place of a common shingle, and its salt
                place = np.where(c < 0, (-1 - c) // SPLIT, 0)
                sets = np.where(c < 0, (1 << 40) + ranks[place], sets)
                c = np.where(c < 0, common[place], c)
            some = sets > 1
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (c, node, least, sets)], names=["cell", "node", "least", "sets"])

    every = mapped(df.select("text"), spread, "cell long, node long, least int")
    every = every.repartition(max(partitions(df.sparkSession), shingles // SORTED), "cell").sortWithinPartitions("cell", "node")
    rows = mapped(every, held, "cell long, node long, least int, sets long")
    own = W.partitionBy("node")
    rows = rows.select("*", F.row_number().over(own.orderBy("sets", "cell")).alias("place"), F.count("*").over(own).alias("shared"))
    return rows.filter("place <= shared - least + 1").select("cell", "node")


def forest(size: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a graph over 0..size-1; ``near`` tells which of some members link to one."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rest = np.arange(size)
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            hit = near(int(front[0]), rest)
            found = rest[hit]
            left.append(np.full(len(found), front[0]))
            right.append(found)
            rest = rest[~hit]
            front = np.concatenate((front[1:], found))
    return np.concatenate(left), np.concatenate(right)


def may_link(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes n, m and segment counts a, b can have a similarity of 4/5."""
    out = 5 * np.minimum(n, m) >= 4 * np.maximum(n, m)
    at = np.flatnonzero(out)
    a, b = (a[at] if len(a) == len(out) else a), b[at]
    apart = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
    out[at] = 9 * apart <= (n[at] if len(n) == len(out) else n) + m[at]
    return out


def cell_links(group: np.ndarray, node: np.ndarray, n: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that may hold, as a forest within each group, of rows sorted by group."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    small = 8
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.repeat((sizes > 1) & (sizes <= small), sizes).nonzero()[0]
    for lag in range(1, small):
        a, b = at[:-lag], at[lag:]
        same = group[a] == group[b]
        a, b = a[same], b[same]
        near = may_link(n[a], n[b], counts[a], counts[b])
        left.append(node[a[near]])
        right.append(node[b[near]])
    for s, k in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        own, size, segments = node[s : s + k], n[s : s + k], counts[s : s + k]
        a, b = forest(k, lambda i, rest: may_link(size[i : i + 1], size[rest], segments[i : i + 1], segments[rest]))
        left.append(own[a])
        right.append(own[b])
    return np.concatenate(left), np.concatenate(right)


def set_links(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links that hold among some sets of distinct hashes."""
    n = np.array([len(s) for s in sets])
    first = np.concatenate(([0], np.cumsum(n)))
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        held = np.zeros(len(values), np.int64)
        held[ids[first[i] : first[i + 1]]] = 1
        size = n[rest]
        sums = np.concatenate(([0], np.cumsum(held[ids[bytescan.ranges(first[rest], size)]])))
        ends = np.cumsum(size)
        return 9 * (sums[ends] - sums[ends - size]) >= 4 * (n[i] + size)

    return forest(len(sets), near)


def dealt(rows: DataFrame, key: str, limit: int, work: Workspace, node: str = "node") -> DataFrame:
    """``rows`` with a block, dealt and sorted by key and block; groups beyond ``limit`` go to all pairs of their blocks."""
    hot = work.table(f"hot_{key}", rows.groupBy(key).count().filter(F.col("count") > limit).select(key, F.expr(f"cast(count div {limit // 2} as int) + 1").alias("blocks")))
    n_hot = hot.count()
    if n_hot:
        out = rows.join(F.broadcast(hot) if n_hot <= BROADCAST else hot, key, "left")
        own = F.pmod(F.xxhash64(node), F.col("blocks")).cast("int")
        every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(own, j).cast("long") * F.col("blocks") + F.greatest(own, j))
        out = out.withColumn("block", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(every)))).drop("blocks")
    else:
        out = rows.withColumn("block", F.lit(0).cast("long"))
    return out.repartition(partitions(rows.sparkSession), key, "block").sortWithinPartitions(key, "block")


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Batches sorted by some columns, cut where a group ends."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(x).to_numpy() for x in keys]
        if kept and [x[0] for x in columns] != last:  # noqa: F821
            yield pa.Table.from_batches(kept)
            kept = []
        new = np.flatnonzero(np.any([x != x[-1] for x in columns], axis=0))
        cut = int(new[-1]) + 1 if len(new) else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        kept.append(batch.slice(cut))
        last = [x[-1] for x in columns]
    if kept:
        yield pa.Table.from_batches(kept)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def by_fingerprint(nodes: DataFrame, work: Workspace) -> DataFrame:
    """(a, b): sets with fingerprints within operator 7's radius; of equal fingerprints the least set stands for the others."""
    owner = work.table("owners", nodes.groupBy("fp").agg(F.min("node").alias("owner")))
    near = simhash.links(owner.select("fp"), Workspace(nodes.sparkSession, "fingerprints"))
    far = owner.select(F.col("fp").alias("b"), F.col("owner").alias("_b"))
    near = near.join(owner.select(F.col("fp").alias("a"), F.col("owner").alias("_a")), "a").join(far, "b").select("_a", "_b")
    equal = nodes.select("fp", "node").join(owner, "fp").filter("node <> owner").select("owner", "node")
    return near.union(equal).select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))


def candidates(df: DataFrame, nodes: DataFrame, work: Workspace) -> DataFrame:
    """(a, b): a graph of which every component of linked sets lies in one component."""
    close = work.table("close", by_fingerprint(nodes, work))
    keys = work.table("keys", keys_of(df, int(nodes.agg(F.sum("n")).first()[0] or 0)))
    rows = dealt(keys.join(nodes.select("node", "n", "counts"), "node"), "cell", CELL, work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, "cell", "block"):
            c, b, node, n = (t.column(x).to_numpy() for x in ("cell", "block", "node", "n"))
            counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8).reshape(-1, SEGMENTS)
            left, right = cell_links(c * np.int64(1_000_003) + b, node, n.astype(np.int64), counts)
            if len(left):
                yield _edges(left, right)

    return work.table("candidates", mapped(rows, run, "a long, b long").union(close).distinct())


def links(df: DataFrame, nodes: DataFrame, work: Workspace) -> DataFrame:
    """(a, b): links that hold, with the components of all of them."""
    roots = simhash.components(candidates(df, nodes, work), Workspace(df.sparkSession, "nearcopies"))
    roots = roots.union(roots.select("root", "root").distinct()).toDF("node", "root")
    wanted = work.table("wanted", nodes.join(roots, "node").select("copy", "node", "root"))
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    texts = df.select(F.xxhash64("text").alias("copy"), "text").join(side, "copy").groupBy("copy", "node", "root").agg(F.min("text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = bytescan.SpanHasher()
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                h, first = shingles_of(part.column("text"), hasher)
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("root"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h))], names=["node", "root", "hashes"])

    rows = dealt(work.table("sets", mapped(texts.select("node", "root", "text"), read, "node long, root long, hashes array<long>")), "root", BLOCK, work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, "root", "block"):
            c, b, node = (t.column(x).to_numpy() for x in ("root", "block", "node"))
            hashes = t.column("hashes").combine_chunks()
            first, values = hashes.offsets.to_numpy(), hashes.values.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (b[1:] != b[:-1]))))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(c)]):
                if e - s > 1:
                    x, y = set_links([values[first[k] : first[k + 1]] for k in range(s, e)])
                    left.append(node[s + x])
                    right.append(node[s + y])
            if sum(map(len, left)):
                yield _edges(np.concatenate(left), np.concatenate(right))

    return work.table("links", mapped(rows, run, "a long, b long").distinct())


def linked(df: DataFrame) -> DataFrame:
    """(doc_id, copy, component_id) for every row of ``df`` (doc_id, text)."""
    work = Workspace(df.sparkSession, "nearcopies")
    every = work.table("prints", prints(df))
    nodes = work.table("nodes", every.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("copy").alias("copy"), *[F.first(c).alias(c) for c in ("fp", "n", "counts")]))
    ids = simhash.component_ids(nodes, "node", simhash.components(links(df, nodes, work), work), work)
    return spread_join(every.select("doc_id", "copy", "node"), ids, "node", "doc_id").select("doc_id", "copy", "component_id")


def deduplicated(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that stay: of each component the row with the least id; rows of one id and text once."""
    return simhash.remaining(df, linked(df))
