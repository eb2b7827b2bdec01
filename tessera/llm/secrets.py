"""Secret scan: fixed patterns, and a character convolutional network over every other candidate and its context.

Patterns, leftmost and non-overlapping for each kind: ``assign`` (a key word, = or :, a value of 12 or more characters),
``access`` (AKIA and capitals or digits, 18 or more characters), ``hex`` (16 or more of 0-9a-f). What they find stays.

Candidates are all runs of 12 or more characters of values, but for those that lie wholly within a finding; a run that
goes beyond a finding is read as a whole. A network in numpy reads each with its context: characters are embedded,
convolved with width five, pooled over the context before, the candidate (maximum and mean) and the context after, and
combined. Longer candidates are read in overlapping windows, the highest score counts.

Training: labelled findings are those of the patterns in all documents and generated ones of well-known forms, look-alikes
are generated as well. Findings lose their key word or gain another, so that neither context nor form alone decides. All
other candidates of all documents are unlabelled: a first network takes them for look-alikes of half the weight, and those
that it ranks with the findings are left out when the second is trained, so a secret of a form that no pattern knows does
not count against itself. The distinct candidates are written once, in parts of ``PART_ROWS`` by hash. Each part trains a copy of
the network and the copies are averaged, in rounds; every candidate is read in every pass. Numerous shapes and labels weigh
like ``STRATUM`` rows. A fifth of all, by hash of the value, is held out: on all of it the scores are calibrated, and each shape
of candidate (digits, hex, mixed, letters) gets the highest threshold that keeps ``RECALL`` of its findings (of all shapes'
findings if it has none), an exact order statistic by counting prefixes. What it keeps of the held-out findings and what
passes of the held-out look-alikes and unlabelled candidates is in ``recalls`` and ``false_rates``. Only networks, counts and
the sums of at most ``2 * BUCKETS * SPREAD`` score ranges reach the driver.

Offsets are code points, ends exclusive. Work is done on UTF-8 bytes for many texts at once.

Defined cases: a null or empty text has no findings; repeated rows keep a row each; an empty table gives an empty result;
without any labelled finding the network adds nothing; further columns are ignored by ``findings`` and
kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import reduce
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.nearcopies import groups
from tessera.llm.workspace import Workspace, bounded_batches, mapped, shielded

KINDS = ("assign", "access", "hex", "network")
RECALL = 0.98
LEFT, BODY, RIGHT, STRIDE = 24, 64, 8, 48
CHARS, EMBED, WIDTH, FILTERS = 98, 8, 5, 24
LEAST = 12
#: Labels of training rows.
OTHER, FINDING, UNLABELLED = 0, 1, -1
SHAPES = ("digits", "hex", "mixed", "letters")
#: Rows that a shape and label weighs like at most, and generated ones.
STRATUM, GENERATED = 3_000, 5_000
HELD = 5
#: Bytes of a longer candidate that make one training row, a number of whole strides: rows have the windows of the whole.
PIECE = 21 * STRIDE + BODY - STRIDE
#: Rows of a part, about; passes over few rows and over many; rows read in all passes in between; averagings; passes over the
#: generated rows before the first averaging.
PART_ROWS, PASSES, READ_ROWS, ROUNDS, WARM = 16_000, (2, 14), 14 * 16_000, 4, 4
#: Ranges of raw scores that are summed to calibrate: so many a unit, up to this size on either side.
SPREAD, BUCKETS = 64, 64
_KEYS = [b"password=", b"token = \"", b"secret: ", b"api_key="]
_ROW = "around binary, a int, b int, shape int, held boolean, label int"
# The fixed patterns of the contract, on bytes; the key words are matched in lower-cased text.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = bytescan.table_of([(0x30, 0x39), (0x61, 0x66)])
_DIGIT = bytescan.table_of([(0x30, 0x39)])
_LETTER = bytescan.table_of([(0x41, 0x5A), (0x61, 0x7A)])
_VALUE = bytescan.table_of([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)]) | np.isin(np.arange(256), list(b"+/_.=-"))
_CODE = np.full(256, 1, np.uint8)
_CODE[32:127] = np.arange(3, 98)
_CODE[128:] = 2


class Scan:
    """Findings and candidates of a column: (kind, start byte, end byte) arrays over all its texts."""

    def __init__(self, column: pa.Array) -> None:
        self.buf, self.bounds = bytescan.text_buffer(column, b"\n")
        data, low = self.buf.tobytes(), bytescan.LOWER[self.buf].tobytes()
        assigned = [m.span() + m.span(1) for m in _ASSIGN.finditer(low) if m.end(1) - m.start(1) >= 12]
        found = [(0, a, b) for a, b, _, _ in assigned]
        found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 18]
        a, b = bytescan.runs(_HEX[self.buf])
        long = b - a >= 16
        hexes = np.stack((np.full(int(long.sum()), 2), a[long], b[long]), axis=1)
        self.base = np.concatenate((np.array(found, np.int64).reshape(-1, 3), hexes))
        #: (start, end) of what is secret in each finding: an assignment's value, else all of it.
        self.values = np.concatenate((np.array([v[2:] for v in assigned], np.int64).reshape(-1, 2), self.base[len(assigned) :, 1:]))
        a, b = bytescan.runs(_VALUE[self.buf])
        a, b = a[b - a >= LEAST], b[b - a >= LEAST]
        cover = np.zeros(len(self.buf) + 1, np.int64)
        np.add.at(cover, self.base[:, 1], 1)
        np.add.at(cover, self.base[:, 2], -1)
        covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
        covered = covered[b] - covered[a]
        free = covered < b - a
        self.start, self.end, self.touched = a[free], b[free], covered[free] > 0

    def points(self) -> np.ndarray:
        """Code points before each byte."""
        return np.concatenate(([0], np.cumsum((self.buf & 0xC0) != 0x80)))


def windows(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, candidate of each row): every candidate's windows with their context, as character codes; 0 is nothing.

    ``lows`` and ``highs`` bound the text of each candidate; nothing beyond is seen.
    """
    count = np.maximum(1, -(-(ends - starts - (BODY - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(len(starts)), count)
    first = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    stop = np.minimum(ends[owner], first + BODY)
    padded = np.concatenate((np.zeros(LEFT, np.uint8), _CODE[buf], np.zeros(BODY + RIGHT, np.uint8)))

    def seen(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return np.where((at >= low[:, None]) & (at < high[:, None]), padded[at + LEFT], 0)

    left = seen(first[:, None] + np.arange(-LEFT, 0), lows[owner], highs[owner])
    body = seen(first[:, None] + np.arange(BODY), starts[owner], ends[owner])
    right = seen(stop[:, None] + np.arange(RIGHT), lows[owner], highs[owner])
    return np.concatenate((left, body, right), axis=1), owner


def shape_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The place in ``SHAPES``: no letters, only 0-9a-f, letters and digits, no digits."""

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[buf])))
        return sums[ends] - sums[starts]

    letters, digits = share(_LETTER), share(_DIGIT)
    return np.select([letters == 0, share(_HEX) == ends - starts, digits > 0], [0, 1, 2], 3)


class Network:
    """Embedding, one convolution, four pools, one output; plain numpy, trained by Adam on the driver."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.p = {
            "e": rng.normal(0, 0.5, (CHARS, EMBED)), "w": rng.normal(0, (EMBED * WIDTH) ** -0.5, (EMBED * WIDTH, FILTERS)),
            "b": np.zeros(FILTERS), "v": rng.normal(0, 0.1, 4 * FILTERS), "c": np.zeros(1),
        }
        self.p["e"][0] = 0  # nothing
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def forward(self, codes: np.ndarray, body: int = BODY, places: bool = True) -> tuple[np.ndarray, tuple]:
        """(scores, what ``gradients`` needs unless ``places`` is false) of rows with so many codes of the candidate."""
        n, length = codes.shape
        e = np.zeros((n, length + WIDTH - 1, EMBED), self.p["e"].dtype)
        e[:, WIDTH // 2 : WIDTH // 2 + length] = self.p["e"][codes]
        unfolded = np.concatenate([e[:, k : k + length] for k in range(WIDTH)], axis=2).reshape(n * length, -1)
        h = np.maximum(unfolded @ self.p["w"] + self.p["b"], 0).reshape(n, length, FILTERS)
        cuts = ((0, LEFT), (LEFT, LEFT + body), (LEFT + body, length))
        best = [h[:, a:b].argmax(axis=1) + a for a, b in cuts] if places else []
        inside = (codes[:, LEFT : LEFT + body] > 0).astype(h.dtype)
        inside /= np.maximum(inside.sum(axis=1, keepdims=True), 1)
        mean = np.einsum("nlf,nl->nf", h[:, LEFT : LEFT + body], inside)
        most = [np.take_along_axis(h, k[:, None], 1)[:, 0] for k in best] if places else [h[:, a:b].max(axis=1) for a, b in cuts]
        pooled = np.concatenate([*most, mean], axis=1)
        return pooled @ self.p["v"] + self.p["c"], (unfolded, h, best, inside, pooled)

    def gradients(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        z, (unfolded, h, best, inside, pooled) = self.forward(codes)
        n, length = codes.shape
        dz = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight / n).astype(z.dtype)
        dpool = dz[:, None] * self.p["v"]
        dh = np.zeros_like(h)
        for k, at in enumerate(best):
            np.put_along_axis(dh, at[:, None], np.take_along_axis(dh, at[:, None], 1) + dpool[:, None, k * FILTERS : (k + 1) * FILTERS], 1)
        dh[:, LEFT : LEFT + BODY] += inside[:, :, None] * dpool[:, None, 3 * FILTERS :]
        flat = (dh * (h > 0)).reshape(n * length, FILTERS)
        du = (flat @ self.p["w"].T).reshape(n, length, WIDTH, EMBED)
        dwide = np.zeros((n, length + WIDTH - 1, EMBED), z.dtype)
        for k in range(WIDTH):
            dwide[:, k : k + length] += du[:, :, k]
        own = dwide[:, WIDTH // 2 : WIDTH // 2 + length].reshape(-1, EMBED)
        de = np.stack([np.bincount(codes.ravel(), own[:, k], CHARS) for k in range(EMBED)], axis=1)
        de[0] = 0
        return {"e": de, "w": unfolded.T @ flat, "b": flat.sum(axis=0), "v": dz @ pooled, "c": np.array([dz.sum()])}

    def train(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 14, batch: int = 128, rate: float = 0.01, seed: int = 2, of: tuple[float, float] = (0.0, 1.0)) -> None:
        """Both labels get the same total weight; the rate falls to a tenth; ``of`` tells from where to where this is in the whole."""
        rng = np.random.default_rng(seed)
        for label in (0, 1):
            weight = np.where(y == label, weight * 0.5 * len(y) / max(weight[y == label].sum(), 1e-9), weight)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, epochs * -(-len(codes) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for k in range(0, len(order), batch):
                rows = order[k : k + batch]
                step += 1
                now = rate * (1 - 0.9 * (of[0] + (of[1] - of[0]) * step / steps))
                for name, g in self.gradients(codes[rows], y[rows], weight[rows]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    move = now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.p[name] = (self.p[name] - move).astype(np.float32)

    def copy(self) -> Network:
        out = object.__new__(Network)
        out.p = {k: x.copy() for k, x in self.p.items()}
        return out

    def raw(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """The highest score of each candidate's windows."""
        best = np.full(len(starts), -np.inf)
        for k in range(0, len(starts), 8192):
            codes, owner = windows(buf, *(x[k : k + 8192] for x in (starts, ends, lows, highs)))
            np.maximum.at(best, owner + k, self.scores(codes))
        return best

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Scores of rows, those of like length together without most of the nothing that fills them up; it has no effect."""
        out = np.zeros(len(codes))
        size = (codes[:, LEFT : LEFT + BODY] > 0).sum(axis=1)
        order = np.argsort(size, kind="stable")
        for k in range(0, len(order), 512):
            rows = order[k : k + 512]
            body = min(BODY, int(size[rows[-1]]) + WIDTH)  # one place at least sees nothing, as among more of them
            some = codes[rows]
            out[rows] = self.forward(np.concatenate((some[:, : LEFT + body], some[:, LEFT + BODY :]), axis=1), body, places=False)[0]
        return out


@dataclass
class Model:
    network: Network
    scale: tuple[float, float]
    thresholds: np.ndarray
    #: Held-out findings, and held-out others, of each shape that reach its threshold; nan without any.
    recalls: np.ndarray
    false_rates: np.ndarray

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * raw + self.scale[1], -40, 40)))

    def probabilities(self, *candidates: np.ndarray) -> np.ndarray:
        return self.calibrated(self.network.raw(*candidates))

    def accepts(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        return self.probabilities(buf, starts, ends, lows, highs) >= self.thresholds[shape_of(buf, starts, ends)]


def laid_out(rows: list[tuple[bytes, int, int, int]]) -> tuple[np.ndarray, ...]:
    """(bytes, starts, ends, lows, highs) of candidates given with their surroundings."""
    highs = np.cumsum([len(r[0]) for r in rows])
    lows = highs - [len(r[0]) for r in rows]
    return np.frombuffer(b"".join(r[0] for r in rows), np.uint8), lows + [r[1] for r in rows], lows + [r[2] for r in rows], lows, highs


def generated(seed: int = 3, count: int = GENERATED) -> list[tuple[bytes, int, int, int]]:
    """(text, start, end, label): well-known forms of secrets and of look-alikes in neutral or telling contexts."""
    rng = np.random.default_rng(seed)

    def of(alphabet: str, n: int) -> str:
        return "".join(rng.choice(list(alphabet), n))

    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    every = lower + upper + digit

    def pick(options: list):
        return options[int(rng.integers(len(options)))]

    def number(a: int, b: int) -> int:
        return int(rng.integers(a, b))

    def word(a: int = 3, b: int = 9) -> str:
        return of(lower, 1) + "".join(pick(["an", "er", "in", "on", "th", "st", "re", "ti", "al", "en", "de", "ou", "le", "ra", "mo"]) for _ in range(number(a, b) // 2))

    def spoken(a: int, b: int) -> str:
        """A word that could be said, of some syllables."""
        onset, vowel, coda = ["b", "ch", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "sch", "sh", "st", "t", "th", "tr", "v", "w", "wh", "z"], ["a", "e", "i", "o", "u", "au", "ei", "ea", "ie", "io", "ou"], ["", "", "ch", "l", "n", "nd", "ng", "r", "s", "st", "t"]
        return "".join(pick(onset) + pick(vowel) + pick(coda) for _ in range(number(a, b)))

    def identity() -> str:
        letters = digit + pick(["abcdef", "ABCDEF"])
        return "-".join(of(letters, n) for n in (8, 4, 4, 4, 12))

    secret = [
        lambda: of(every, number(24, 48)), lambda: of(every + "+/", 40), lambda: pick(["ghp_", "gho_", "ghs_"]) + of(every, 36), lambda: pick(["sk_live_", "rk_live_", "pk_live_"]) + of(every, 24),
        lambda: of(digit + "abcdef", number(20, 64)), lambda: of(digit + "ABCDEF", number(20, 64)), lambda: "eyJ" + of(every, 20) + "." + of(every, 40) + "." + of(every + "_-", 30),
        lambda: of(every, number(14, 24)), lambda: pick(["xoxb-", "xoxp-"]) + of(digit, number(10, 13)) + "-" + of(digit, number(10, 13)) + "-" + of(every, 24), lambda: "AIza" + of(every + "_-", 35),
        lambda: of(lower + upper, number(20, 44)), lambda: of(upper, number(20, 40)), lambda: of(lower, number(24, 44)), lambda: "glpat-" + of(every + "_-", 20), lambda: "SG." + of(every + "_-", 22) + "." + of(every + "_-", 43),
        lambda: of(every + "+/", number(40, 84)) + pick(["", "=", "=="]),
    ]
    other = [
        lambda: ".".join(str(number(1, 255)) for _ in range(4)), lambda: word() + "." + of(digit, 2), lambda: f"{word()}{number(1, 9)}.example.com", lambda: f"{word()}.{word()}.{pick(['com', 'org', 'net'])}",
        lambda: f"20{number(10, 30)}-{number(10, 13)}-{number(10, 28)}", lambda: f"{number(100, 999)}-{number(100, 999)}-{number(1000, 9999)}", lambda: word(9, 16) + str(number(1, 9999)),
        lambda: "v" + ".".join(str(number(0, 40)) for _ in range(6)), lambda: word() + "/" + word() + "/" + str(number(1, 9999)), lambda: str(number(1, 9)) + "-" + word(8, 14) + "-" + word(5, 7),
        identity, identity, lambda: spoken(4, 9), lambda: spoken(4, 9).upper(), lambda: spoken(4, 8).capitalize(), lambda: spoken(2, 5).upper() + "." + spoken(2, 4).upper(), lambda: word(12, 30), lambda: "_".join(word() for _ in range(number(2, 5))), lambda: word() + "".join(word().capitalize() for _ in range(number(2, 5))), lambda: "-".join(word() for _ in range(number(2, 6))),
        lambda: pick(list("-=._")) * number(12, 60), lambda: word(12, 24).upper(), lambda: word(12, 24).capitalize() + ".", lambda: "-".join(of(digit, n) for n in (3, 1, 2, 6, 1)), lambda: "+" + of(digit, number(11, 14)),
        lambda: of(upper, 3) + "-" + of(digit, number(8, 12)), lambda: f"20{number(10, 30)}{number(10, 13)}{number(10, 28)}T{of(digit, 6)}", lambda: "/".join(word() for _ in range(number(3, 6))),
    ]
    words = [of(lower, number(2, 8)) for _ in range(200)] + [word(2, 9) for _ in range(200)]
    before = ["{w} ", "{w}, {w} ", '{w} = "', "{w}: ", "key=", "Bearer ", "auth {w} ", "credential: ", "the {w} {w} "]
    out = []
    for k in range(count):
        label = k % 2
        body = pick(secret if label else other)()
        if len(body) < LEAST:
            continue
        lead = re.sub(r"\{w\}", lambda m: pick(words), pick(before if label and rng.random() < 0.5 else before[:4] + before[-1:] * 3))
        text = f"{pick(words)} {lead}"
        start = len(text)
        out.append((f"{text}{body} {pick(words)} {pick(words)}".encode(), start, start + len(body), label))
    return out


def held_out(digest: bytes) -> bool:
    """Whether a value of this SHA-256 is held out."""
    return int.from_bytes(digest[:4], "big") % HELD == 0


def labelled(docs: DataFrame, limit: int = PIECE) -> DataFrame:
    """(around, a, b, shape, held, label): the distinct pattern findings and other candidates of all documents.

    Findings come with another context as well. Candidates of more than ``limit`` bytes come in pieces.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                s = Scan(part.column("text"))
                plain = ~s.touched
                spans = np.concatenate((np.stack((s.start[plain], s.end[plain]), axis=1), s.values))
                label = np.repeat([UNLABELLED, FINDING], [int(plain.sum()), len(s.values)])
                owner = np.searchsorted(s.bounds, spans[:, 0], side="right") - 1
                shape, data = shape_of(s.buf, spans[:, 0], spans[:, 1]), s.buf.tobytes()
                rows = []
                for (start, end), y, low, high, f in zip(spans.tolist(), label.tolist(), s.bounds[owner].tolist(), (s.bounds[owner + 1] - 1).tolist(), shape.tolist()):
                    held = held_out(hashlib.sha256(data[start:end]).digest())
                    for a in range(start, max(start + 1, end - (BODY - STRIDE)), limit - (BODY - STRIDE)):
                        b = min(a + limit, end)
                        first = max(a - LEFT, low)
                        around = data[first : min(b + RIGHT, high)]
                        rows.append((around, a - first, b - first, f, held, y))
                        if y == FINDING:
                            pick = zlib.crc32(around) % (2 * len(_KEYS))
                            lead = b"id " + (_KEYS[pick] if pick < len(_KEYS) else b" ")
                            rows.append((lead + around[a - first :], len(lead), len(lead) + b - a, f, held, y))
                if rows:
                    types = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["around", "a", "b", "shape", "held", "label"])

    found = mapped(docs.filter(F.col("text").isNotNull()).select("text"), run, _ROW)
    return found.groupBy("around", "a", "b", "shape", "held").agg(F.max("label").alias("label"))


def described(spark: SparkSession, rows: list[tuple[bytes, int, int, int]]) -> DataFrame:
    """Rows given as (text, start, end, label) in the form of ``labelled``."""
    shapes = shape_of(*laid_out(rows)[:3]).tolist() if rows else []
    return spark.createDataFrame([(bytearray(t), int(a), int(b), k, held_out(hashlib.sha256(t[a:b]).digest()), int(y)) for (t, a, b, y), k in zip(rows, shapes)], _ROW)


def candidates_of(t: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """``laid_out`` of rows with around, a and b."""
    return laid_out(list(zip(*(t.column(c).to_pylist() for c in ("around", "a", "b")))))


def trained(rows: DataFrame, more: list[tuple[bytes, int, int, int]], passes: int, parts: int, seed: int) -> Network:
    """A network trained on all ``rows`` (part, around, a, b, label, weight), sorted by part, and on ``more`` in every part."""
    network = Network(seed)
    codes, owner = windows(*laid_out(more))
    y = np.array([r[3] == FINDING for r in more], np.float32)[owner]
    if parts > 1:
        network.train(codes, y, np.ones(len(y)), WARM, of=(0.0, 0.0))
    rounds = min(passes, ROUNDS) if parts > 1 else 1
    for k in range(rounds):
        epochs = passes * (k + 1) // rounds - passes * k // rounds
        shared = rows.sparkSession.sparkContext.broadcast((network, codes, y))

        def run(batches: Iterator[pa.RecordBatch], k: int = k, epochs: int = epochs, shared=shared) -> Iterator[pa.RecordBatch]:
            start, codes, y = shared.value
            for t in groups(batches, "part"):
                part = t.column("part").to_numpy()
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])).tolist()
                for i, j in zip(cuts, cuts[1:]):
                    own = t.slice(i, j - i)
                    mine, owner = windows(*candidates_of(own))
                    labels, weight = own.column("label").to_numpy()[owner] == FINDING, own.column("weight").to_numpy()[owner]
                    copy = start.copy()
                    copy.train(np.concatenate((mine, codes)), np.concatenate((labels.astype(np.float32), y)), np.concatenate((weight, np.full(len(y), 1 / parts))), epochs, of=(k / rounds, (k + 1) / rounds))
                    flat = np.concatenate([copy.p[c].ravel() for c in sorted(copy.p)]).astype(np.float32).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([int(part[i])], pa.int32()), pa.array([j - i], pa.int64()), pa.array([flat], pa.binary())], names=["part", "n", "flat"])

        found = sorted((r[0], r[1], bytes(r[2])) for r in mapped(rows.select("part", "around", "a", "b", "label", "weight"), run, "part int, n long, flat binary").collect())
        if found:
            flat = np.average([np.frombuffer(f, np.float32) for _, _, f in found], axis=0, weights=[n for _, n, _ in found])
            at = 0
            for c in sorted(network.p):
                x = network.p[c]
                network.p[c] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
                at += x.size
        else:  # no document has a candidate
            network.train(codes, y, np.ones(len(y)), epochs, of=(k / rounds, (k + 1) / rounds))
        shared.unpersist()
    return network


def scored(rows: DataFrame, network: Network, name: str) -> DataFrame:
    """``rows`` with the network's raw scores, and a key of 32 bits in their order."""
    schema = T.StructType([*rows.schema, T.StructField(name, T.FloatType()), T.StructField(f"{name}_key", T.IntegerType())])
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = shared.value.raw(*candidates_of(batch)).astype(np.float32) + np.float32(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw), pa.array(keys_of(raw))], names=[*batch.schema.names, name, f"{name}_key"])

    return mapped(rows, run, schema)


def keys_of(raw: np.ndarray) -> np.ndarray:
    """Floats as integers in the same order; the same function gives the bits of the float back."""
    bits = np.ascontiguousarray(raw).view(np.int32)
    return np.where(bits < 0, bits ^ np.int32(0x7FFFFFFF), bits)


def nth_keys(rows: DataFrame, wanted: dict[int, int]) -> dict[int, int]:
    """For each shape the wanted-th smallest ``key``, from 0, by counting prefixes; 2,048 a shape at most reach the driver."""
    rank, prefix = dict(wanted), {}
    for shift in (22, 11, 0):
        own = [(F.col("shape") == g) & (F.shiftright("key", shift + 11) == prefix[g] if prefix else F.lit(True)) for g in wanted]
        counts = sorted(tuple(r) for r in rows.filter(reduce(lambda x, y: x | y, own)).groupBy("shape", F.shiftright("key", shift).alias("p")).count().collect())
        prefix = {}
        for g, p, n in counts:
            if g not in prefix:
                if rank[g] < n:
                    prefix[g] = p
                else:
                    rank[g] -= n
    return prefix


def _rank(n: int) -> int:
    """The place, from 0, of the least of n findings that a threshold must keep."""
    return int((1 - RECALL) * n + 1e-9)


def fit(docs: DataFrame, limit: int = PIECE) -> Model | None:
    spark, work = docs.sparkSession, Workspace(docs.sparkSession, "secrets")
    found = labelled(docs, limit)
    if not isinstance(found, DataFrame):
        found = described(spark, found)
    made = generated()
    found = work.table("found", found.withColumn("made", F.lit(False)).union(described(spark, made).withColumn("made", F.lit(True))))
    sizes = found.groupBy("label", "shape", "held", "made").agg(F.count("*").alias("n")).collect()  # 48 rows at most
    findings = {held: sum(r["n"] for r in sizes if r["label"] == FINDING and r["held"] == held) for held in (False, True)}
    if not all(findings.values()):
        return None
    rows = sum(r["n"] for r in sizes if not r["made"])
    parts = max(1, round(rows / PART_ROWS))
    passes = min(max(-(-READ_ROWS // max(rows, 1)), PASSES[0]), PASSES[1])
    weight = F.lit(1.0)
    for label, base, most in ((OTHER, 1.0, STRATUM), (FINDING, 1.0, 2 * STRATUM), (UNLABELLED, 0.5, STRATUM)):
        for shape in range(len(SHAPES)):
            n = sum(r["n"] for r in sizes if not r["made"] and (r["label"], r["shape"]) == (label, shape))
            weight = F.when(~F.col("made") & (F.col("label") == label) & (F.col("shape") == shape), base * min(1.0, most / max(n, 1))).otherwise(weight)
    dealt = found.withColumn("weight", weight).withColumn("part", F.pmod(F.xxhash64("around", "a", "b"), F.lit(parts)).cast("int"))
    table = work.table("parts", dealt.repartition(parts, "part").sortWithinPartitions("part", "around", "a", "b"))
    more = [r for r in made if not held_out(hashlib.sha256(r[0][r[1] : r[2]]).digest())]

    # unlabelled candidates among the findings of the first round may be findings
    first = trained(table.filter("NOT held AND NOT made"), more, -(-passes // 2), parts, 1)
    table = work.table("first", scored(table, first, "raw"))
    least = nth_keys(table.filter(f"label = {FINDING} AND NOT held").select(F.lit(0).alias("shape"), F.col("raw_key").alias("key")), {0: _rank(findings[False])})[0]
    table = table.withColumn("doubtful", F.expr(f"label = {UNLABELLED} AND raw_key >= {least}")).drop("raw", "raw_key")
    network = trained(table.filter("NOT held AND NOT made AND NOT doubtful"), more, passes, parts, 2)
    table = work.table("second", scored(table.filter("held"), network, "raw"))

    ranges = F.round(F.least(F.greatest("raw", F.lit(-BUCKETS)), F.lit(BUCKETS)) * SPREAD)
    sums = table.filter("NOT doubtful").groupBy(ranges.alias("range"), (F.col("label") == FINDING).alias("y")).agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("raw")).alias("z")).orderBy("range", "y").collect()
    w = np.array([r["w"] for r in sums])
    model = Model(network, calibrated(np.array([r["z"] for r in sums]) / w, np.array([r["y"] for r in sums]), w), *(np.full(len(SHAPES), np.nan) for _ in range(3)))
    good = {k: sum(r["n"] for r in sizes if r["held"] and r["label"] == FINDING and r["shape"] == k) for k in range(len(SHAPES))}
    keyed = table.filter(f"label = {FINDING}").select("shape", F.col("raw_key").alias("key"))
    least = nth_keys(keyed, {k: _rank(n) for k, n in good.items() if n})
    if len(least) < len(SHAPES):  # a shape without a held-out finding keeps the recall of all shapes
        least = dict.fromkeys(range(len(SHAPES)), nth_keys(keyed.withColumn("shape", F.lit(0)), {0: _rank(findings[True])})[0]) | least
    cut = reduce(lambda x, k: F.when(F.col("shape") == k, least[k]).otherwise(x), range(len(SHAPES)), F.lit(0))
    for shape, y, n, kept in table.groupBy("shape", F.col("label") == FINDING).agg(F.count("*"), F.sum((F.col("raw_key") >= cut).cast("long"))).collect():
        (model.recalls if y else model.false_rates)[shape] = kept / n
    raw = keys_of(np.array([least[k] for k in range(len(SHAPES))], np.int32)).view(np.float32)
    model.thresholds = model.calibrated(raw.astype(float))
    return model


def recall_threshold(good: np.ndarray) -> float:
    """The highest threshold that at least ``RECALL`` of the findings reach."""
    return float(np.sort(good)[int((1 - RECALL) * len(good) + 1e-9)])


def calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and offset of a logistic fit of the labels on weighted raw scores."""
    x = np.c_[z, np.ones(len(z))]
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (weight * (p - y)) + 0.01 * (w - [1, 0]))
        w = w - step
    return float(max(w[0], 1e-3)), float(w[1])


def spans_of(scan: Scan, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, kind, start, end) rows in code points of the text, by text, start, kind; first row of each text; bytes."""
    found = scan.base
    if model is not None:
        a, b = scan.start, scan.end
        if len(a):
            text = np.searchsorted(scan.bounds, a, side="right") - 1
            yes = model.accepts(scan.buf, a, b, scan.bounds[text], scan.bounds[text + 1] - 1)
            found = np.concatenate((found, np.stack((np.full(int(yes.sum()), 3), a[yes], b[yes]), axis=1)))
    text = np.searchsorted(scan.bounds, found[:, 1], side="right") - 1
    order = np.lexsort((found[:, 0], found[:, 1], text))
    found, text = found[order], text[order]
    points = scan.points()
    origin = points[scan.bounds[text]]
    out = np.stack((text, found[:, 0], points[found[:, 1]] - origin, points[found[:, 2]] - origin), axis=1)
    return out, np.searchsorted(text, np.arange(len(scan.bounds)))


def findings(docs: DataFrame, model: Model | None, keep: list[str], mark: str | None = None) -> DataFrame:
    """``keep`` with n_assign, n_access, n_hex, n_network, base_sha256, spans and cuts of every row of ``docs``.

    With a ``mark``, findings in a kept ``text`` are replaced by it.
    """
    bounded_batches(docs.sparkSession)
    new = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("cuts", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([docs.schema[c] for c in keep] + new)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in bytescan.slices(batch, "text"):
                rows, first = spans_of(Scan(part.column("text")), shared.value)
                counts, digests, texts, cuts = [], [], [], []
                for a, b in zip(first, first[1:]):
                    own = rows[a:b].tolist()
                    counts.append(np.bincount(rows[a:b, 1], minlength=4))
                    names = [f"{KINDS[k]}:{s}:{e}" for _, k, s, e in own]
                    digests.append(hashlib.sha256(",".join(n for n, r in zip(names, own) if r[1] < 3).encode()).hexdigest())
                    texts.append(",".join(names))
                    cuts.append([x for _, _, s, e in own for x in (s, e)])
                if mark is not None and any(cuts):
                    edited = [replaced(t, c, mark) if c else t for t, c in zip(part.column("text").to_pylist(), cuts)]
                    part = part.set_column(part.schema.get_field_index("text"), "text", pa.array(edited, pa.string()))
                n = np.array(counts, np.int64).reshape(-1, 4)
                columns = [*(pa.array(n[:, k]) for k in range(4)), pa.array(digests), pa.array(texts), pa.array(cuts, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c).cast(arrow.field(c).type) for c in keep), *(x.cast(arrow.field(len(keep) + k).type) for k, x in enumerate(columns))], schema=arrow)

    return mapped(docs.select(list(dict.fromkeys([*keep, "text"]))), run, schema)


def replaced(text: str, cuts: list[int], mark: str) -> str:
    """A text with ranges of code points, in order of their starts, replaced by a mark; overlapping ranges get one."""
    out, at = [], 0
    for a, b in zip(cuts[::2], cuts[1::2]):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model | None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; all other rows and columns stay as they are."""
    inner, restored = shielded(docs, ["text"])
    return restored(findings(inner, model, inner.columns, mark))


def op2_character_network_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return findings(docs, fit(docs), ["doc_id"]).drop("cuts")
