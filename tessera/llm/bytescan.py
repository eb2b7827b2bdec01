"""Vectorised scanning of text columns as UTF-8 bytes.

An Arrow string column is one byte buffer with offsets, so words can be found, lower-cased and hashed for thousands of
texts at once in numpy. Slices are bounded in bytes; only a single text longer than that makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: Bytes that ``same`` compares at a time, about: each takes some 40 bytes of indices.
COMPARED = 1 << 18
#: (prime, base) of the two polynomials of a span's hash.
_MODULI = (((1 << 31) - 1, 1_226_214_263), ((1 << 31) - 19, 845_027_381))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table_of(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A 256-entry membership table of inclusive byte ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch with at most ``limit`` bytes of text, one row at least."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_buffer(column: pa.Array, mark: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte buffer, ``mark`` after each; text i lies in [bounds[i], bounds[i+1] - 1). Null is empty."""
    joined = pc.binary_join_element_wise(pc.fill_null(pc.cast(column, pa.binary()), b""), b"", mark)
    _, offsets, data = joined.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[joined.offset : joined.offset + len(joined) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None and len(joined) else np.zeros(0, np.uint8)
    return buf, bounds - bounds[0]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edges = np.concatenate(([0], edges))
    if mask[-1]:
        edges = np.concatenate((edges, [len(mask)]))
    return edges[0::2], edges[1::2]


class SpanHasher:
    """64-bit hashes of byte spans from prefix sums of two polynomials, each modulo a prime of 31 bits.

    Equal bytes have equal hashes. Unequal ones nearly never do, but callers whose results must be exact compare the
    bytes as well (``distinct``, ``same``).
    """

    def __init__(self) -> None:
        self.power = [np.ones(1, np.uint64) for _ in _MODULI]
        self.inverse = [np.ones(1, np.uint64) for _ in _MODULI]

    def _reach(self, n: int) -> None:
        if len(self.power[0]) < n:
            size = max(n, 1 << 16)
            for k, (p, base) in enumerate(_MODULI):
                self.power[k], self.inverse[k] = powers(base, p, size), powers(pow(base, -1, p), p, size)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(buf)
        self._reach(n + 1)
        coefficient = buf.astype(np.uint64) + np.uint64(1)
        halves = []
        for (p, _), power, inverse in zip(_MODULI, self.power, self.inverse):
            terms = coefficient * power[:n]
            if n >= 1 << 24:  # sums of smaller products would leave 64 bits
                terms %= np.uint64(p)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            halves.append((sums[ends] - sums[starts]) % np.uint64(p) * inverse[starts] % np.uint64(p))
        return mix(halves[0] << np.uint64(32) | halves[1])


def powers(base: int, p: int, n: int) -> np.ndarray:
    """base^0, base^1, ... (n of them) modulo a prime below 2^32."""
    out, done = np.ones(n, np.uint64), 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, p)) % np.uint64(p)
        done += more
    return out


def same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes of a from each of a_starts on equal those of b from b_starts on, ``sizes`` bytes each."""
    ends = np.cumsum(sizes)
    if len(sizes) > 1 and ends[-1] > COMPARED:
        cuts = np.unique(np.concatenate(([0], np.searchsorted(ends, np.arange(COMPARED, ends[-1], COMPARED), side="right"), [len(sizes)])))
        return np.concatenate([_same(a, a_starts[i:j], b, b_starts[i:j], sizes[i:j]) for i, j in zip(cuts, cuts[1:])])
    return _same(a, a_starts, b, b_starts, sizes)


def _same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    unequal = a[ranges(a_starts, sizes)] != b[ranges(b_starts, sizes)]
    if not unequal.any():
        return np.ones(len(sizes), bool)
    ends = np.cumsum(sizes)
    sums = np.concatenate(([0], np.cumsum(unequal)))
    return sums[ends] == sums[ends - sizes]


def distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a span of each distinct content, the content of each span): told apart by hash, then by the bytes themselves."""
    _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    first, sizes = at[back], ends - starts
    check = np.flatnonzero(first != np.arange(len(first)))
    unequal = sizes[check] != sizes[first[check]]
    check_bytes = check[~unequal]
    unequal[~unequal] = ~same(buf, starts[check_bytes], buf, starts[first[check_bytes]], sizes[check_bytes])
    if not unequal.any():
        return at, back
    other: dict[bytes, int] = {}
    more: list[int] = []
    for i in check[unequal].tolist():  # unequal spans of equal hashes
        content = buf[starts[i] : ends[i]].tobytes()
        if content not in other:
            other[content] = len(at) + len(more)
            more.append(i)
        back[i] = other[content]
    return np.concatenate((at, more)), back


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that the low bits depend on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index ranges: span i with marks[i] in text t lies in [out[t], out[t+1])."""
    return np.searchsorted(marks, bounds)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (sizes[0] of them), then the same of starts[1], and so on."""
    skipped = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - skipped, sizes)
