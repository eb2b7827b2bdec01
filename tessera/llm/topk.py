"""Exact top-k inner products by a three-phase uniform threshold.

The score of a pair is the sum of its local scores, one for each of ``SEGMENTS`` runs of dimensions.

1. Gather. Each task keeps, for every dimension, a local list of its candidates in order of that component, which serves
   all queries: a query reads it from the top or from the bottom by the sign of its own component. The first k entries at
   both ends of all lists are scored exactly. The k-th best of these scores over all tasks is a safe cutoff for a query:
   nothing below it can be in the answer.
2. Broadcast and collect. A score that reaches the cutoff c has a local score of c / segments at least (the uniform
   threshold) in some segment. Local scores are bounded by products of norms, so candidates in order of norm are read only
   down to the threshold; what no segment's list holds is never multiplied at all.
3. Resolve. For the pairs left the segments are added one after the other. A pair is dropped once its sum and the norm
   bounds of the other segments stay below the cutoff, which each task raises as it finds better scores. What survives
   has its exact score, and each task keeps its k best; a window over these gives the result.

Two jobs over the candidates serve all queries. Queries are broadcast in blocks of ``BLOCK_QUERIES``; a task scores its
candidates, ``CHUNK`` at a time, against one block after the other and holds one block. For a query it keeps k entries.

Integers are held as doubles, which is exact while (dimensions * largest component squared) stays below 2^53, as for any
embedding of ordinary size. Vectors beyond that are multiplied as Python integers; scores saturate at 64 bits.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows without an id, take no part;
only vectors of the same length are paired; every query row has an answer of its own, also where rows share an id, and
leaves out one row, its own (that of the same id and vector); ties go to the smaller id, and repeated candidates keep an
entry each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.workspace import Workspace, each

K, SEGMENTS, SCALE = 10, 4, 1024
QUERY_EVERY = 100
BLOCK_QUERIES = 1024
#: Candidates that a task holds, and those that it compares with a block at once.
CHUNK, PART = 65_536, 4096
#: Above this share of pairs left a segment is multiplied for all of them.
DENSE = 0.3
EXACT = 2.0**53
_NONE = -np.inf
_ROWS = "query long, query_id long, vec_id long, score long, own boolean"


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer components) of the rows that take part, by length of the vector."""
    ids, column = batch.column("vec_id"), batch.column("embedding")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    sizes = np.where(pc.is_valid(ids).to_numpy(zero_copy_only=False), sizes, 0)
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten()
        x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # null components become NaN
        good = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            yield ids.take(pa.array(rows[good])).to_numpy(zero_copy_only=False).astype(np.int64), np.floor(x[good] * SCALE)


def large(x: np.ndarray) -> np.ndarray:
    """Rows whose products need more than a double holds."""
    with np.errstate(over="ignore"):
        return x.shape[1] * np.abs(x).max(axis=1, initial=0) ** 2 >= EXACT


def parts(d: int, segments: int) -> list[slice]:
    cuts = np.linspace(0, d, min(segments, d) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


@dataclass
class Queries:
    """Queries with vectors of one length, each with its number among all queries and a cutoff."""

    number: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    cutoff: np.ndarray | None = None

    def take(self, rows: np.ndarray) -> Queries:
        return Queries(self.number[rows], self.ids[rows], self.x[rows], None if self.cutoff is None else self.cutoff[rows])


class Lists:
    """The best entries of each query so far: score descending, id ascending."""

    def __init__(self, q: Queries, keep: int) -> None:
        self.q, self.keep = q, keep
        self.score = np.full((len(q.ids), keep), _NONE)
        self.ids = np.zeros((len(q.ids), keep), np.int64)
        self.own = np.zeros((len(q.ids), keep), bool)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """Entries of some queries, given by the query's row."""
        if not len(row):
            return
        r = np.concatenate((np.repeat(np.arange(len(self.score)), self.keep), row))
        s, i, o = (np.concatenate((x.ravel(), y)) for x, y in ((self.score, score), (self.ids, ids), (self.own, own)))
        order = np.lexsort((i, -s, r))
        first = np.searchsorted(r[order], np.arange(len(self.score)))
        best = order[first[:, None] + np.arange(self.keep)]
        self.score, self.ids, self.own = s[best], i[best], o[best]

    def batch(self) -> pa.RecordBatch:
        a, b = np.nonzero(self.score > _NONE)
        score = np.clip(self.score[a, b], -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
        return found(self.q, a, self.ids[a, b], score, self.own[a, b])


def found(q: Queries, row: np.ndarray, ids: np.ndarray, score: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q.number[row]), pa.array(q.ids[row]), pa.array(ids), pa.array(score, pa.int64()), pa.array(own)], names=["query", "query_id", "vec_id", "score", "own"])


def own_rows(q: Queries, row: np.ndarray, ids: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether candidates ``at`` have the id and the vector of their queries."""
    out = q.ids[row] == ids[at]
    some = np.flatnonzero(out)
    out[some] = (q.x[row[some]] == x[at[some]]).all(axis=1)
    return out


def ends(x: np.ndarray, k: int) -> np.ndarray:
    """Rows among the first k at either end of the list of some dimension."""
    if len(x) <= 2 * k:
        return np.arange(len(x))
    order = np.argpartition(x, (k, len(x) - k), axis=0)
    return np.unique(np.concatenate((order[:k].ravel(), order[len(x) - k :].ravel())))


def gathered(q: Queries, ids: np.ndarray, x: np.ndarray, keep: int) -> Lists:
    """Phase 1: exact scores of what was gathered."""
    lists = Lists(q, keep)
    for at in range(0, len(ids), PART):
        i, v = ids[at : at + PART], x[at : at + PART]
        scores = q.x @ v.T
        n = min(keep, len(i))
        top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        row = np.repeat(np.arange(len(q.ids)), n)
        lists.add(row, scores[row, top.ravel()], i[top.ravel()], own_rows(q, row, i, v, top.ravel()))
    return lists


def resolved(q: Queries, ids: np.ndarray, x: np.ndarray, keep: int, segments: int) -> tuple[Lists, int]:
    """Phases 2 and 3 on some candidates: the best entries at or above the cutoffs, and the products that were computed."""
    lists, products = Lists(q, keep), 0
    pieces = parts(x.shape[1], segments)
    norms = lambda v: np.stack([np.linalg.norm(v[:, s], axis=1) for s in pieces], axis=1)
    tails = lambda n: np.sqrt(np.cumsum(n[:, ::-1] ** 2, axis=1)[:, ::-1])
    q_norm = norms(q.x)
    q_tail = tails(q_norm)
    cutoff = q.cutoff.copy()
    for at in range(0, len(ids), PART):
        i, v = ids[at : at + PART], x[at : at + PART]
        v_norm = norms(v)
        v_tail = tails(v_norm)
        slack = 0.5 + 1e-9 * np.abs(np.where(np.isfinite(cutoff), cutoff, 0))
        least = cutoff - slack
        alive = np.zeros((len(q.ids), len(i)), bool)
        for s in range(len(pieces)):  # the uniform threshold on the lists by norm
            alive |= q_norm[:, s, None] * v_norm[None, :, s] >= least[:, None] / len(pieces)
        total, row, col = np.zeros(alive.shape), None, None
        for s, piece in enumerate(pieces):
            if row is None and alive.mean() > DENSE:
                total += q.x[:, piece] @ v[:, piece].T
                products += alive.size * (piece.stop - piece.start)
                if s + 1 < len(pieces):
                    alive &= total + q_tail[:, s + 1, None] * v_tail[None, :, s + 1] >= least[:, None]
                continue
            if row is None:
                row, col = np.nonzero(alive)
                total = total[row, col]
            total = total + np.concatenate([np.einsum("ij,ij->i", q.x[row[k : k + PART], piece], v[col[k : k + PART], piece]) for k in range(0, max(1, len(row)), PART)])
            products += len(row) * (piece.stop - piece.start)
            bound = total + (q_tail[row, s + 1] * v_tail[col, s + 1] if s + 1 < len(pieces) else 0)
            left = bound >= least[row]
            row, col, total = row[left], col[left], total[left]
        if row is None:
            row, col = np.nonzero(alive & (total >= cutoff[:, None]))
            total = total[row, col]
        enough = total >= cutoff[row]
        row, col, total = row[enough], col[enough], total[enough]
        lists.add(row, total, i[col], own_rows(q, row, i, v, col))
        cutoff = np.maximum(cutoff, lists.score[:, -1])
    return lists, products


def exactly(q: Queries, ids: np.ndarray, x: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    """The best entries of pairs whose products leave a double, in Python's integers."""
    if not len(q.ids) or not len(ids):
        return
    whole = lambda v: np.array([[int(c) for c in r] for r in v.tolist()], object).reshape(v.shape)
    right = whole(x).T
    for k, vector in enumerate(whole(q.x)):
        scores = vector @ right
        best = np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:keep])
        row = np.full(len(best), k)
        clipped = np.array([min(max(scores[j], -(1 << 63)), (1 << 63) - 1) for j in best], np.int64)
        yield found(q, row, ids[best], clipped, own_rows(q, row, ids, x, best))


def chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of up to ``limit`` candidates of one length."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            for ids, x in vectors(batch.slice(at, limit)):
                own = held.setdefault(x.shape[1], [])
                own.append((ids, x))
                if sum(len(i) for i, _ in own) >= limit:
                    yield tuple(np.concatenate(v) for v in zip(*held.pop(x.shape[1])))
    for own in held.values():
        yield tuple(np.concatenate(v) for v in zip(*own))


def gather(df: DataFrame, shared: list, keep: int) -> DataFrame:
    """Phase 1 by task; what needs long integers is left to the other phases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for ids, x in chunks(batches, CHUNK):
            small = ~large(x)
            ids, x = ids[small], x[small]
            if x.shape[1] in pools:
                ids, x = (np.concatenate(v) for v in zip(pools[x.shape[1]], (ids, x)))
            rows = ends(x, keep)
            pools[x.shape[1]] = ids[rows], x[rows]
        for block in each(shared):
            for q in block:
                ids, x = pools.get(q.x.shape[1], ((), ()))
                if len(ids):
                    yield gathered(q.take(np.flatnonzero(~large(q.x))), ids, x, keep).batch()

    return df.mapInArrow(run, _ROWS)


def resolve(df: DataFrame, shared: list, keep: int, segments: int) -> DataFrame:
    """Phases 2 and 3 by chunk of candidates and block of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches, CHUNK):
            wide = large(x)
            for block in each(shared):
                for q in block:
                    if q.x.shape[1] != x.shape[1]:
                        continue
                    own = large(q.x)
                    plain = q.take(np.flatnonzero(~own))
                    if len(plain.ids) and not wide.all():
                        yield resolved(plain, ids[~wide], x[~wide], keep, segments)[0].batch()
                    yield from exactly(plain, ids[wide], x[wide], keep)
                    yield from exactly(q.take(np.flatnonzero(own)), ids, x, keep)

    return df.mapInArrow(run, _ROWS)


def query_blocks(queries: DataFrame, limit: int) -> Iterator[list[Queries]]:
    """All queries in blocks of about ``limit``, numbered; they reach the driver as packed vectors, a partition at a time."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches, limit):
            for k in range(0, len(ids), limit):
                i, v = ids[k : k + limit], x[k : k + limit]
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([i.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], names=["d", "ids", "x"])

    number, held, size = 0, [], 0
    for d, ids, x in queries.mapInArrow(pack, "d int, ids binary, x binary").toLocalIterator():
        ids = np.frombuffer(bytes(ids), np.int64)
        held.append(Queries(np.arange(number, number + len(ids)), ids, np.frombuffer(bytes(x)).reshape(-1, d)))
        number, size = number + len(ids), size + len(ids)
        if size >= limit:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[Queries]) -> list[Queries]:
    """Queries of the same length in one."""
    out = []
    for d in sorted({q.x.shape[1] for q in held}):
        own = [q for q in held if q.x.shape[1] == d]
        out.append(Queries(*(np.concatenate([getattr(q, f) for q in own]) for f in ("number", "ids", "x"))))
    return out


def with_cutoffs(blocks: Iterator[list[Queries]], rows: Iterator) -> Iterator[list[Queries]]:
    """Blocks with the cutoffs of (query, cutoff) rows in order of the queries, both read side by side."""
    rows, ahead = iter(rows), None
    for block in blocks:
        last, known = max(int(q.number.max()) for q in block), {}
        while True:
            ahead = ahead or next(rows, None)
            if ahead is None or ahead[0] > last:
                break
            known[ahead[0]], ahead = float(ahead[1]), None
        yield [Queries(q.number, q.ids, q.x, np.array([known.get(n, _NONE) for n in q.number.tolist()])) for q in block]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS, limit: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query, all having vec_id and embedding."""
    spark = candidates.sparkSession
    work = Workspace(spark, "topk")
    keep = k + 1  # a query's own row is among its candidates until the end
    candidates = candidates.select("vec_id", "embedding")
    queries = work.table("queries", queries.select("vec_id", "embedding"))
    send = spark.sparkContext.broadcast
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    first = gather(candidates, [send(b) for b in query_blocks(queries, limit)], keep)
    cutoffs = work.table("cutoffs", first.withColumn("_n", place).filter(F.col("_n") == keep).select("query", "score"))
    blocks = with_cutoffs(query_blocks(queries, limit), cutoffs.orderBy("query").toLocalIterator())
    best = work.table("best", resolve(candidates, [send(b) for b in blocks], keep, segments).withColumn("_n", place).filter(F.col("_n") <= keep))
    # one row of the query's own id and vector leaves the list, and those after it move up
    mine = F.min(F.when(F.col("own"), F.col("_n"))).over(W.partitionBy("query"))
    rank = (F.col("_n") - F.when(F.col("_n") > F.col("_own"), 1).otherwise(0)).cast("int")
    rows = best.withColumn("_own", mine).filter("_own IS NULL OR _n <> _own")
    return rows.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def op10_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.filter(F.col("vec_id") % QUERY_EVERY == 0))


OP10_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
