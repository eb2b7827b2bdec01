"""BPE as a streaming transducer with bounded lookahead, and decoding by an incremental byte-to-text machine.

Sufficient lookahead. A merge list fixes how far to the right the fate of a token can depend. A token z that ends where
more text may follow changes only if z, or a token on the right spine of z (its right part, that part's right part, ...),
is taken by a merge with the next token before the merge that uses it in z. That next token may be changed in the same
way by what follows it, but only through merges of lower rank still. Ranks fall strictly along such a chain, so a single
pass over the list in rank order gives the longest chain in symbols. A token is stable, and is emitted, once that many
symbols after its end are known; the rest of the input is encoded as if it began there, since no merge ever crossed the
token's edge. Memory is a constant number of symbols, however long a word is.

The last symbol of a word has its own form (the end-of-word suffix), so one symbol more is held back.

Defined cases: a null or empty text has no ids and decodes to the empty string; special tokens written out in a text
become their ids, as the library does by default; repeated rows keep a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bytescan, tokens
from tessera.llm.workspace import bounded_batches, mapped

#: Characters of a piece, and symbols of a word beyond the lookahead, that are taken in before what is stable is emitted.
CHUNK = 256
_NO_RANK = 1 << 62
#: Ids whose bytes are laid out at a time, and bytes that the decoding machine is fed at a time.
DECODE_IDS, DECODE_BYTES = 1 << 14, 1 << 16


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """The merge list of a tokenizer file with its sufficient lookahead."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.merged.setdefault((vocabulary[a], vocabulary[b]), (rank, vocabulary[a + b]))
        self.pairs = {a << 32 | b: x for (a, b), x in self.merged.items()}
        symbols = byte_symbols()
        self.inner = [vocabulary[c] for c in symbols]
        self.last = [vocabulary[c + self.suffix] for c in symbols]
        self.ahead = self._lookaheads({*self.inner, *self.last})
        #: Symbols after a token that can change it at most, whatever the token.
        self.lookahead = max(self.ahead.values(), default=0)

    def _lookaheads(self, single: set[int]) -> dict[int, int]:
        """For each token the symbols after its end that can still change it."""
        length = dict.fromkeys(single, 1)
        formed: dict[int, tuple[int, int]] = {}  # token -> (rank that forms it, right part)
        ranks: dict[int, list[int]] = {}  # token -> ranks of the merges that it begins, ascending
        reach: dict[int, list[int]] = {}  # token -> the longest chain among those merges up to each

        def chain(token: int, limit: int) -> int:
            """The longest chain among merges of rank below ``limit`` that begin with the token or on its right spine."""
            longest = 0
            while True:
                if k := bisect_left(ranks.get(token, []), limit):
                    longest = max(longest, reach[token][k - 1])
                if token not in formed:
                    return longest
                below, token = formed[token]
                limit = min(limit, below)

        for (a, b), (rank, new) in self.merged.items():
            if new not in formed:
                formed[new] = rank, b
                length[new] = length[a] + length[b]
            own = length[b] + chain(b, rank)
            ranks.setdefault(a, []).append(rank)
            best = reach.setdefault(a, [])
            best.append(max(own, best[-1]) if best else own)
        return {token: chain(token, _NO_RANK) for token in length}

    def apply(self, ids: list[int]) -> list[int]:
        """Merges until no pair of the list is left, least rank first, left to right."""
        merged, none = self.pairs.get, (_NO_RANK, 0)
        found = [merged(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            k = found.index(best)
            ids[k : k + 2] = [best[1]]
            del found[k]
            if k:
                found[k - 1] = merged(ids[k - 1] << 32 | best[1], none)
            if k < len(found):
                found[k] = merged(best[1] << 32 | ids[k + 1], none)
        return ids

    def word(self, raw: bytes) -> list[int]:
        """The ids of a whole word."""
        return self.apply([self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]) if raw else []


class WordStream:
    """Ids of one word whose bytes arrive bit by bit."""

    def __init__(self, merges: Merges) -> None:
        self.merges, self.held = merges, b""

    def feed(self, raw: bytes) -> Iterator[int]:
        self.held += raw
        most, ahead, inner = self.merges.lookahead + CHUNK, self.merges.ahead, self.merges.inner
        while len(self.held) > most:
            known = self.held[:most]  # one more is held: the last symbol's form is not known yet
            at, emitted = 0, 0
            for token in self.merges.apply([inner[b] for b in known]):
                at += len(self.merges.token[token])  # a symbol is one character, and no token here has the suffix
                if at + ahead[token] > len(known):
                    break
                yield token
                emitted = at
            self.held = self.held[emitted:]

    def close(self) -> list[int]:
        """What is held is bounded, and its end is known now."""
        held, self.held = self.held, b""
        return self.merges.word(held)


class Encoder:
    """Ids of texts: special tokens, normalisation, words, merges."""

    _RUNS = {"L": regex.compile(r"\p{L}+"), "O": regex.compile(rf"[^{tokens.WHITE}\p{{L}}\p{{N}}]+")}
    _WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{tokens.WHITE}\p{{L}}\p{{N}}]+")

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.words = tokens.Memo(self._word, 20_000)
        self.table = tokens.PieceTable(lambda pieces: [np.array(list(self.piece(p)), "<u4") for p in pieces])
        names = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.special_chars = max(map(len, names), default=0)

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then each character's lower case by itself (no rule for a final sigma)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _word(self, word: str) -> tuple[int, ...]:
        stream = WordStream(self.merges)
        return (*stream.feed(word.encode()), *stream.close())

    def piece(self, piece: str) -> Iterator[int]:
        """Ids of a text without white space."""
        stream = PieceStream(self)
        for k in range(0, len(piece), CHUNK):
            yield from stream.feed(piece[k : k + CHUNK])
        yield from stream.close()

    def stretches(self, raw: memoryview) -> Iterator[np.ndarray]:
        """Ids of one text of any length, stretch by stretch."""
        open_piece: PieceStream | None = None
        for part, ends in tokens.segments(raw):
            if open_piece is None and ends:
                yield self.table(pa.array([part], pa.binary()))[0]
                continue
            if open_piece is None:
                open_piece, characters = PieceStream(self), codecs.getincrementaldecoder("utf-8")()
            piece, rest = (part, b"") if not ends else tokens.first_piece(part)
            text = characters.decode(piece, ends)
            for k in range(0, len(text), CHUNK):
                yield np.fromiter(open_piece.feed(text[k : k + CHUNK]), "<u4")
            if ends:
                yield np.fromiter(open_piece.close(), "<u4")
                open_piece = None
                if rest:
                    yield self.table(pa.array([rest], pa.binary()))[0]

    def texts(self, column: pa.Array) -> Iterator[Iterator[np.ndarray]]:
        """Of each text its ids, in one array or more."""
        if len(column) == 1 and column.is_valid()[0].as_py() and column.nbytes > bytescan.SLICE_BYTES:
            yield self.stretches(memoryview(column.cast(pa.binary())[0].as_buffer()))
            return
        ids, first = self.table(column)
        for a, b in zip(first, first[1:]):
            yield iter((ids[a:b],))


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One encoder a Python worker, so that what it remembers outlives a task."""
    return Encoder(path)


class PieceStream:
    """Ids of a piece without white space whose characters arrive bit by bit, in constant memory.

    The piece is cut only where normalisation, special tokens and contractions cannot reach across; a run of letters or
    of other characters stays open across cuts and feeds a ``WordStream``.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.encoder, self.raw = encoder, ""
        self.kind, self.open = "", WordStream(encoder.merges)

    def _safe(self, k: int) -> bool:
        """May the text be cut before raw[k]?"""
        c = self.raw[k]
        if unicodedata.category(c)[0] == "M" or "ᄀ" <= c <= "ᇿ":
            return False
        for j in (k - 1, k - 2):  # a contraction may begin with an apostrophe that begins a run
            if j >= 0 and self.raw[j] == "'" and not (j and self.raw[j - 1] == "'"):
                return False
        return True

    def feed(self, text: str) -> Iterator[int]:
        self.raw += text
        k = len(self.raw) - self.encoder.special_chars
        if k < CHUNK:
            return
        inside: set[int] = set()
        for m in self.encoder.special.finditer(self.raw) if self.encoder.special else ():
            inside.update(range(m.start() + 1, m.end()))
        while k > 0 and (k in inside or not self._safe(k)):
            k -= 1
        if k > 0:
            head, self.raw = self.raw[:k], self.raw[k:]
            yield from self._take(head, False)

    def close(self) -> Iterator[int]:
        head, self.raw = self.raw, ""
        yield from self._take(head, True)

    def _take(self, text: str, final: bool) -> Iterator[int]:
        at = 0
        for m in self.encoder.special.finditer(text) if self.encoder.special else ():
            yield from self._plain(text[at : m.start()], True)
            yield self.encoder.merges.special[m.group()]
            at = m.end()
        yield from self._plain(text[at:], final)

    def _plain(self, text: str, final: bool) -> Iterator[int]:
        text, at = self.encoder.normal(text), 0
        if self.kind:
            m = self.encoder._RUNS[self.kind].match(text)
            if m:
                yield from self.open.feed(m.group().encode())
                at = m.end()
            if at < len(text) or final:
                yield from self.open.close()
                self.kind = ""
        while at < len(text):
            m = self.encoder._WORD.search(text, at)
            if not m:
                return
            at, word = m.end(), m.group()
            whole = self.encoder._RUNS["L"].fullmatch(word) or self.encoder._RUNS["O"].fullmatch(word)
            if at < len(text) or final or not whole:
                yield from self.encoder.words[word]
            else:
                self.kind = "L" if self.encoder._RUNS["L"].fullmatch(word) else "O"
                yield from self.open.feed(word.encode())


class TextMachine:
    """Text from ids, bit by bit: bytes of tokens go through a UTF-8 machine that holds an unfinished character.

    ``library`` gives what the library gives for a file without a decoder: token strings with single spaces between.
    Otherwise the symbols turn back into the bytes they stand for and word ends into spaces.
    """

    def __init__(self, merges: Merges, library: bool = True) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.skip = self.between = int(library)  # bytes before the first token that are not part of the text
        if library:
            table = {i: b" " + t.encode() for i, t in merges.token.items()}
        else:
            byte = {c: b for b, c in enumerate(byte_symbols())}
            table = {}
            for i, t in merges.token.items():
                end = bool(merges.suffix) and t.endswith(merges.suffix)
                body = t[: -len(merges.suffix)] if end else t
                raw = t.encode() if t in merges.special else bytes(byte[c] for c in body)
                table[i] = raw + b" " * end
        parts = [table.get(i, b"") for i in range(max(table) + 1)]
        self.size = np.array([len(x) for x in parts], np.int64)
        self.first, self.flat = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(parts), np.uint8)

    def feed(self, ids: Iterable[int] | np.ndarray) -> Iterator[str]:
        """Text that is complete after some more ids, bit by bit."""
        ids = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), np.int64)
        for k in range(0, len(ids), DECODE_IDS):
            own = ids[k : k + DECODE_IDS]
            raw = self.flat[bytescan.ranges(self.first[own], self.size[own])].tobytes()
            if self.skip and raw:
                raw, self.skip = raw[self.skip :], 0
            for at in range(0, len(raw), DECODE_BYTES):
                yield self.machine.decode(raw[at : at + DECODE_BYTES])

    def close(self) -> str:
        out = self.machine.decode(b"", True)
        self.machine.reset()
        self.skip = self.between
        return out


def encode_texts(df: DataFrame, path: str, keep: list[str], with_ids: bool = False) -> DataFrame:
    """``keep`` with n_tokens, ids_sha256 and decoded_sha256 (and the ids) of every row of ``df``."""
    from pyspark.sql import types as T

    bounded_batches(df.sparkSession)
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    new += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    keep = [c for c in keep if c not in {f.name for f in new}]  # what is computed here replaces columns of its name
    schema = T.StructType([df.schema[c] for c in keep] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encoder = to_arrow_schema(schema), shared_encoder(path)
        machine = TextMachine(encoder.merges)
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                counts, digests, decoded, every = [], [], [], []
                for stretches in encoder.texts(part.column("text")):
                    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                    for ids in stretches:
                        n += len(ids)
                        of_ids.update(np.ascontiguousarray(ids, "<u4"))
                        for text in machine.feed(ids):
                            of_text.update(text.encode())
                        if with_ids:
                            every.append(ids.astype(np.int32))
                    of_text.update(machine.close().encode())
                    counts.append(n)
                    digests.append(of_ids.hexdigest())
                    decoded.append(of_text.hexdigest())
                out = [pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)]
                if with_ids:
                    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(every))))
                yield pa.RecordBatch.from_arrays([*(part.column(c).cast(arrow.field(c).type) for c in keep), *(x.cast(arrow.field(len(keep) + k).type) for k, x in enumerate(out))], schema=arrow)

    return mapped(df.select(list(dict.fromkeys([*keep, "text"]))), run, schema)


def op3_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokens.default_path(), ["doc_id"])
