"""Words of a tokenizer file, and encoding of texts by their pieces, each distinct piece once.

The tokenizer of ``word_bpe_49k.json`` drops white space and never lets a word span it, and neither normalisation nor
lower-casing looks across it. So the ids of a text are those of its white-space pieces in order. It also parts letters
from the punctuation that follows them and lower-cases: a piece of letters and trailing punctuation is cut in two, and
A-Z are lower-cased before pieces are compared. Pieces with "<", which may hold a special token, stay as they are.

Pieces are found, hashed and looked up in numpy, and each hit is compared byte by byte: pieces of equal hashes never stand
in for each other. Only pieces that a worker does not remember reach the encoder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tessera.llm import bytescan

#: White space of the tokenizer's patterns, inside a character class.
WHITE = r"\p{White_Space}"
#: Pieces in a generation of the table, pieces added before they are merged into it, and the longest piece in bytes kept.
ENTRIES, RECENT, KEY_BYTES = 300_000, 50_000, 200
_WHITE = bytescan.table_of([(0x09, 0x0D), (0x20, 0x20)])
#: ASCII punctuation that may end a piece: no apostrophe, no bracket.
_TAIL = np.isin(np.arange(256), list(b'.,;:!?#$%&*|)"'))
_LETTER = bytescan.table_of([(0x41, 0x5A), (0x61, 0x7A)])
#: Second bytes of U+00C0..U+00FF that are letters.
_LATIN = bytescan.table_of([(0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF)])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def vocabulary_size(path: str) -> int:
    """One more than the largest id of the file, added tokens included."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


class Memo(dict):
    """Remembers what ``make`` gives, in two generations: when the young one is full, it becomes the old one."""

    def __init__(self, make: Callable, entries: int = 300_000) -> None:
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= KEY_BYTES:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def pieces(column: pa.Array, hasher: bytescan.SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, hashes, first piece of each text) of a column of texts."""
    raw, bounds = bytescan.text_buffer(column)
    starts, ends = bytescan.runs(~_WHITE[raw])
    buf = bytescan.LOWER[raw]
    whole = np.zeros(len(starts), bool)
    if len(at := np.flatnonzero(raw == 0x3C)):
        whole[np.searchsorted(starts, at, side="right") - 1] = True
        for a, b in zip(starts[whole].tolist(), ends[whole].tolist()):
            buf[a:b] = raw[a:b]
    body = np.maximum.accumulate(np.where(_TAIL[raw], -1, np.arange(len(raw))))  # the last byte that is no tail, so far
    core = body[ends - 1] + 1
    last, before = raw[core - 1], raw[np.maximum(core - 2, 0)]
    cut = (core > starts) & (core < ends) & ~whole & (_LETTER[last] | ((before == 0xC3) & _LATIN[last] & (core - 1 > starts)))
    more = np.concatenate(([0], np.cumsum(cut)))
    at = np.arange(len(starts)) + more[:-1]
    a, b = np.empty(len(starts) + int(more[-1]), np.int64), np.empty(len(starts) + int(more[-1]), np.int64)
    a[at], b[at] = starts, np.where(cut, core, ends)
    a[at[cut] + 1], b[at[cut] + 1] = core[cut], ends[cut]
    first = bytescan.per_text(starts, bounds)
    return buf, a, b, hasher(buf, a, b), first + more[first]


class _Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, sizes: np.ndarray, flat: np.ndarray) -> None:
        self.sizes, self.first, self.flat = sizes, np.cumsum(sizes) - sizes, flat

    def take(self, rows: np.ndarray) -> _Ragged:
        return _Ragged(self.sizes[rows], self.flat[bytescan.ranges(self.first[rows], self.sizes[rows])])

    def plus(self, other: _Ragged) -> _Ragged:
        return _Ragged(np.concatenate((self.sizes, other.sizes)), np.concatenate((self.flat, other.flat)))


def _none(kind: type) -> _Ragged:
    return _Ragged(np.zeros(0, np.int64), np.zeros(0, kind))


def _spans(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> _Ragged:
    return _Ragged(sizes[rows], buf[bytescan.ranges(starts[rows], sizes[rows])])


class _Level:
    """Pieces by hash, ascending, with their bytes and their ids. Of pieces with equal hashes one is held."""

    def __init__(self) -> None:
        self.hash, self.text, self.ids = np.zeros(0, np.uint64), _none(np.uint8), _none(np.uint32)

    def find(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of each piece, or -1; a hit has the same bytes."""
        if not len(self.hash) or not len(hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        hit = np.flatnonzero((self.hash[at] == hashes) & (self.text.sizes[at] == sizes))
        hit = hit[bytescan.same(buf, starts[hit], self.text.flat, self.text.first[at[hit]], sizes[hit])]
        out = np.full(len(hashes), -1)
        out[hit] = at[hit]
        return out

    def add(self, hashes: np.ndarray, text: _Ragged, ids: _Ragged) -> None:
        """Adds pieces; of equal hashes the one that came first stays."""
        key = np.concatenate((self.hash, hashes))
        order = np.argsort(key, kind="stable")
        order = order[np.concatenate(([True], key[order[1:]] != key[order[:-1]]))] if len(order) else order
        self.hash, self.text, self.ids = key[order], self.text.plus(text).take(order), self.ids.plus(ids).take(order)


class PieceTable:
    """Ids of texts by way of their distinct pieces, remembered in bounded tables that outlive a task."""

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], entries: int = ENTRIES) -> None:
        self.encode, self.entries = encode, entries
        self.levels = [_Level(), _Level(), _Level()]  # recent, main, old
        self.hasher = bytescan.SpanHasher()

    def _remember(self, hashes: np.ndarray, text: _Ragged, ids: _Ragged) -> None:
        recent, main, _ = self.levels
        recent.add(hashes, text, ids)
        if len(recent.hash) > RECENT:
            if len(main.hash) + len(recent.hash) > self.entries:
                self.levels[1:] = [_Level(), main]
            self.levels[1].add(recent.hash, recent.text, recent.ids)
            self.levels[0] = _Level()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the first id of each)."""
        buf, starts, ends, hashes, first = pieces(column, self.hasher)
        at, back = bytescan.distinct(buf, starts, ends, hashes)
        hashes, starts, lengths = hashes[at], starts[at], (ends - starts)[at]
        sizes, begin = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        left, flat, total = np.arange(len(at)), [], 0
        again = left[:0]
        for k, level in enumerate(self.levels):
            places = level.find(hashes[left], buf, starts[left], lengths[left])
            hit, ids = left[places >= 0], level.ids.take(places[places >= 0])
            sizes[hit], begin[hit] = ids.sizes, ids.first + total
            if k == 2:
                again, again_ids = hit, ids
            flat.append(ids.flat)
            total += len(ids.flat)
            left = left[places < 0]
        if len(left):
            data = buf.tobytes()
            new = self.encode([data[i : i + n].decode() for i, n in zip(starts[left].tolist(), lengths[left].tolist())])
            ids = _Ragged(np.array([len(x) for x in new], np.int64), np.concatenate(new))
            sizes[left], begin[left] = ids.sizes, ids.first + total
            flat.append(ids.flat)
            keep = np.flatnonzero(lengths[left] <= KEY_BYTES)
            self._remember(hashes[left[keep]], _spans(buf, starts, lengths, left[keep]), ids.take(keep))
        if len(again):
            self._remember(hashes[again], _spans(buf, starts, lengths, again), again_ids)
        used = sizes[back]
        out = np.concatenate(flat)[bytescan.ranges(begin[back], used)]
        return out, np.concatenate(([0], np.cumsum(used)))[first]


def segments(raw: memoryview | bytes, limit: int = bytescan.SLICE_BYTES) -> Iterator[tuple[bytes, bool]]:
    """A text's bytes in stretches of at most ``limit``, cut after ASCII white space where there is any.

    The flag tells that the stretch ends a piece; where it is False, the piece goes on in the next stretch.
    """
    at, n = 0, len(raw)
    while at < n:
        part = bytes(raw[at : at + limit])
        white = np.flatnonzero(_WHITE[np.frombuffer(part, np.uint8)]) if at + limit < n else [len(part) - 1]
        if len(white):
            part = part[: int(white[-1]) + 1]
        yield part, bool(len(white))
        at += len(part)


def first_piece(part: bytes) -> tuple[bytes, bytes]:
    """A stretch cut before its first white space."""
    white = np.flatnonzero(_WHITE[np.frombuffer(part, np.uint8)])
    at = int(white[0]) if len(white) else len(part)
    return part[:at], part[at:]
