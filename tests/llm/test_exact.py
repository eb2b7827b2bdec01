"""Operators with exact contracts against brute force, edge cases included."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import bitpack, bpe, bytescan, decontaminate, fmindex, sharding, simhash, tokens, topk

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " \t\n", "a", "The CAT sat on the mat", "the cat sat on the mat", "x " * 500, "é ñ ß İ Σ 中文 한 🎉", "a" * 5000, "tok<|endoftext|>en don't ''s", "\x1c\x1d mid\x85dle space"]


SEGMENTS = tokens.segments


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def docs(spark):
    """Real documents with edge cases, repeated rows, a null id, and columns whose names operators use inside."""
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(TEXTS)] + [(10_005, TEXTS[5]), (None, "no id here")], "doc_id long, text string")
    return real.union(extra).withColumns({"copy": F.lit(1), "_key": F.lit("k"), "cuts": F.lit("c"), "ids": F.lit("i"), "_id": F.lit(2)})


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_shards(spark, docs, rows):
    got = sharding.shard(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    again = {(r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in got}
    assert sharding.shard(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1021])
def test_permutation(spark, n):
    steps = sharding.walk_length(spark, n, 5)
    got = [r[0] for r in spark.range(n).select(sharding.place(F.col("id"), n, 5, steps)).collect()]
    assert sorted(got) == list(range(n))


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    root = np.arange(len(rows))
    while True:
        new = np.array([root[near[k]].min() for k in range(len(rows))])
        if (new == root).all():
            break
        root = new
    least = {r: min((rows[k][0] for k in np.flatnonzero(root == r) if rows[k][0] is not None), default=None) for r in set(root.tolist())}
    wanted = sorted((str(i), f"{p:016x}", str(least[r])) for (i, _), p, r in zip(rows, prints.tolist(), root.tolist()))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == wanted
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r[0]) for r in kept.select("doc_id").collect())
    assert ids == sorted({str(least[r]) for r in set(root.tolist()) if least[r] is not None} | {str(i) for i, _ in rows if i is None})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_hot_cells_are_split(spark, monkeypatch):
    """A dense group larger than a cell still gives one component, and no link is lost."""
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = np.random.default_rng(0)
    centre = int(rng.integers(1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (300, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 200)})
    nodes = spark.createDataFrame([(x, k) for k, x in enumerate(fps)], "fp long, least long")
    from tessera.llm.workspace import Workspace

    work = Workspace(spark, "test")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, work), work).collect()}
    f = np.array(fps, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    root = np.arange(len(f))
    while True:
        new = np.array([root[near[k]].min() for k in range(len(f))])
        if (new == root).all():
            break
        root = new
    assert [roots.get(x, x) for x in fps] == [fps[k] for k in root]


@given(st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=4), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_fm_index(stretches, patterns):
    sym = np.array([x for s in stretches for x in [*s, 0]])
    index = fmindex.FMIndex(sym, 4)
    width = max(map(len, patterns))
    matrix = np.zeros((len(patterns), width), np.int64)
    for k, p in enumerate(patterns):
        matrix[k, width - len(p) :] = p
    lo, hi = index.search(matrix, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        wanted = [i for i in range(len(sym) - len(p) + 1) if sym[i : i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == wanted


def test_decontamination(spark, docs, rows):
    base = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = base.union(spark.createDataFrame([(900, "the cat"), (901, ""), (902, None), (None, "the"), (903, "x " * 12), (903, "a")], base.schema))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items.collect():
        w = word.findall(low(t)) if i is not None else []
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    wanted = []
    for i, t in rows:
        w, hit, found = word.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        wanted.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    for limit in (200_000, 90):  # one block of windows, and several
        got = decontaminate.report(docs, items, limit=limit).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(wanted)
    cleaned = decontaminate.clean(docs, items)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert cleaned.join(docs, ["doc_id", "text"], "left_semi").count() >= sum(not w[5] for w in wanted) - 3
    assert decontaminate.report(docs, items.limit(0)).filter("contaminated").isEmpty()
    assert decontaminate.report(docs.limit(0), items).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(tokens.default_path())


def test_tokens_equal_the_library(spark, docs, rows, library):
    got = bpe.encode_texts(docs, tokens.default_path(), docs.columns, with_ids=True)
    assert got.columns[-1] == "ids" and got.columns.count("ids") == 1
    found = {(r["doc_id"], r["text"]): r for r in got.collect()}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        r = found[i, t]
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_texts(docs.limit(0), tokens.default_path(), ["doc_id"]).count() == 0


PARTS = st.sampled_from(["a'll", "''s", "'", "é", "Σ", "中文", "가", "<|endoftext|>", "<|end", "12", "!!", "the", "ing", "lo", "l", "aaaa", "🎉", "İ", "́", "'re", "ß"])


@given(st.lists(PARTS, min_size=1, max_size=900))
@settings(max_examples=60, deadline=None)
def test_long_pieces_stream(encoder, library, parts):
    text = "".join(parts)
    stream = bpe.PieceStream(encoder)
    got = [x for k in range(0, len(text), 97) for x in stream.feed(text[k : k + 97])] + list(stream.close())
    assert got == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("word", ["a" * 9999, "therein" * 900, "中" * 3000, "!?" * 3000])
def test_long_words_keep_bounded_memory(encoder, library, word):
    stream, got, most = bpe.WordStream(encoder.merges), [], 0
    for k in range(0, len(word), 50):
        got += stream.feed(word[k : k + 50].encode())
        most = max(most, len(stream.held))
    assert got + stream.close() == library.encode(word, add_special_tokens=False).ids
    assert most <= encoder.merges.lookahead + bpe.CHUNK + 200


def test_lookahead_suffices(encoder):
    """Text after the lookahead never changes a token before it."""
    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"theraino", np.uint8)
    ahead = encoder.merges.lookahead
    for _ in range(60):
        head, a, b = (rng.choice(letters, n).tobytes() for n in (ahead + 60, 40, 40))
        one, two = (encoder.merges.apply([encoder.merges.inner[x] for x in head + t]) for t in (a, b))
        at = 0
        for x, y in zip(one, two):
            at += len(encoder.merges.token[x])
            if at + ahead > len(head):
                break
            assert x == y


def test_each_token_waits_for_its_own_lookahead(encoder):
    """A token is emitted as soon as its own lookahead is known, and is then final."""
    merges, rng = encoder.merges, np.random.default_rng(4)
    letters = np.frombuffer(b"theraino", np.uint8)
    early = 0
    for _ in range(60):
        head, a, b = (rng.choice(letters, n).tobytes() for n in (90, 300, 300))
        one, two = (merges.apply([merges.inner[x] for x in head + t]) for t in (a, b))
        at = 0
        for x, y in zip(one, two):
            at += len(merges.token[x])
            if at + merges.ahead[x] > len(head):
                break
            early += at + merges.lookahead > len(head)
            assert x == y
    assert early > 0 and merges.lookahead == max(merges.ahead.values())


def test_decoder_machine(encoder):
    (ids,) = next(encoder.texts(pa.array(["Ünïcode 🎉 text"])))
    machine = bpe.TextMachine(encoder.merges, library=False)
    bits = [machine.feed([x]) for x in ids.tolist()]
    assert "".join(t for b in bits for t in b) + machine.close() == "ünïcode 🎉 text "


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_decoder_machine_at_any_cut(encoder, library, monkeypatch, size):
    """Characters of several bytes are held over cuts of the byte stream."""
    monkeypatch.setattr(bpe, "DECODE_BYTES", size)
    ids = library.encode("中文 é 🎉 any text", add_special_tokens=False).ids
    machine = bpe.TextMachine(encoder.merges)
    assert "".join(machine.feed(ids)) + machine.close() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 3000 + " b", "the cat. " * 700, "x" * 10 + "中" * 900 + " y" * 40, " " * 2000 + "end", "tok<|endoftext|>en " * 200, "é" * 1111])
def test_one_long_text_streams(encoder, library, monkeypatch, text):
    """A text is read in stretches that end anywhere."""
    for limit in (64, 1000):
        monkeypatch.setattr(tokens, "segments", lambda raw, cut=limit: SEGMENTS(raw, cut))
        got = np.concatenate(list(encoder.stretches(memoryview(text.encode())))).tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def thue_morse(n):
    w = "a"
    while len(w) < n:
        w += w.translate(str.maketrans("ab", "ba"))
    return w


TWINS = [t for n in (1024, 4096) for t in (thue_morse(n), thue_morse(n).translate(str.maketrans("ab", "ba")))]


@pytest.fixture(params=["own", "weak"])
def hashing(request, monkeypatch):
    """The hash as it is, and one under which all spans collide that have the same last byte."""
    if request.param == "weak":
        monkeypatch.setattr(bytescan.SpanHasher, "__call__", lambda self, buf, starts, ends: buf[ends - 1].astype(np.uint64) % np.uint64(3))
    return request.param


def test_equal_hashes_do_not_mix_tokens(hashing, library):
    texts = [*TWINS, "the cat sat on a mat", "cats and dogs and cats", *TEXTS[:8]]
    for encode in (lambda c: [np.concatenate([*x, np.zeros(0, np.uint32)]) for x in bpe.Encoder(tokens.default_path()).texts(c)], both_levels):
        got = [x.tolist() for x in encode(pa.array(texts))]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def both_levels(column):
    bitpack.library_ids.cache_clear()
    table = bitpack.library_ids(tokens.default_path())
    for _ in range(2):  # the second time from memory
        ids, first = table(column)
    bitpack.library_ids.cache_clear()
    return [ids[a:b] for a, b in zip(first, first[1:])]


def test_equal_hashes_do_not_mix_items(hashing):
    texts = [f"{w} x" for w in TWINS] + ["one two three", "no item"]
    windows = {(w.encode(),): {k} for k, w in enumerate(TWINS[:1] + TWINS[2:3])} | {(b"two", b"three"): {7}, (b"tree",): {8}}
    _, _, spans, _, first, items = decontaminate.search_shard([pa.array(texts)], [decontaminate.Block(windows)])
    assert [items[a:b].tolist() for a, b in zip(first, first[1:])] == [[0], [], [1], [], [7], []]
    assert spans.tolist() == [[0, 1], [0, 1], [1, 3]]


@given(st.integers(1, 25), st.integers(0, 300), st.integers(0, 2**32))
@settings(max_examples=80, deadline=None)
def test_bit_packing(width, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << width, n).astype(np.uint32)
    assert (bitpack.unpack(bitpack.pack(ids, width), n, width) == ids).all()
    firsts = np.array([0, n // 3, n // 3, n])
    file = bitpack.PackedFile(bitpack.write_file(ids, firsts, width, 7))
    assert (file.ids(n // 4, n // 2) == ids[n // 4 : n // 2]).all()
    assert [len(file.document(k)) for k in range(4)] == [n // 3, 0, n - n // 3, 0]


def test_token_files(spark, docs, rows, library):
    from tessera.llm.workspace import Workspace

    for file_ids in (bitpack.FILE_IDS, 500):
        files = bitpack.write_files(docs, Workspace(spark, "test"), tokens.default_path(), file_ids=file_ids)
        got = sorted((tuple(r) for r in bitpack.read_files(files).collect()), key=lambda r: r[1])
        assert [r[0] is not None for r in got] == sorted(r[0] is not None for r in got)
        assert [r[0] for r in got if r[0] is not None] == sorted(i for i, _ in rows if i is not None)
        assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
        wanted = sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4"))) for i, t in rows for x in [library.encode(t or "", add_special_tokens=False).ids + [2]])
        assert sorted((str(r[0]), r[2], r[3]) for r in got) == wanted
    assert bitpack.read_files(bitpack.write_files(docs.limit(0), Workspace(spark, "test"), tokens.default_path())).count() == 0


def best_of(queries, good, k=10):
    wanted = []
    for n, (q, a) in enumerate(queries):
        rest = list(good)
        rest.remove((q, a))  # its own row only
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in rest if len(a) == len(b))[:k]
        wanted += [(q, r + 1, c, max(min(-s, 2**63 - 1), -(2**63))) for r, (s, c) in enumerate(scores)]
    return sorted(wanted)


def test_top_k(spark):
    rng = np.random.default_rng(2)
    data = [(k, rng.normal(0, 0.3, 6).tolist()) for k in range(230)] + [(300 + k, [0.5] * 6) for k in range(40)]
    data += [(1000, [float("nan")] * 6), (1100, None), (1200, []), (1300, [None] * 6), (None, [0.1] * 6), (1400, [0.1, 0.2]), (1402, [0.3, 0.4]), (200, data[200][1]), (7, data[7][1]), (100, data[3][1])]
    data += [(1500, [1e9, -2e9, 3e5, 0.0, 1.0, 2.0]), (1501, [1e6] * 6)]  # products beyond a double
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    wanted = best_of([(q, a) for q, a in good if q % 100 == 0], good)
    for limit in (1024, 2):
        got = topk.top_k(rows, rows.filter("vec_id % 100 = 0"), limit=limit)
        assert sorted(tuple(r) for r in got.collect()) == wanted
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_top_k_skips_products(spread):
    """The cutoff spares products, and what it spares is never in the answer."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 64))
    x = centres[rng.integers(0, 40, 6000)] + spread * rng.normal(size=(6000, 64))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1, keepdims=True))
    ids = np.arange(6000)
    q = topk.Queries(np.arange(60), ids[::100], x[::100])
    pool = topk.ends(x, 11)
    assert len(pool) <= 2 * 11 * 64 < len(x)
    q.cutoff = topk.gathered(q, ids[pool], x[pool], 11).score[:, -1]
    exact = np.sort(q.x @ x.T, axis=1)[:, ::-1][:, :11]
    assert (q.cutoff <= exact[:, -1]).all()
    lists, products = topk.resolved(q, ids, x, 11, 4)
    assert (lists.score == exact).all()
    assert products <= 0.6 * q.x.size * len(x)


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 50, 1, 0, 7)] + [None])], names=["text"])
    assert [p.num_rows for p in bytescan.slices(batch, "text", 8)] == [2, 1, 4]


def test_byte_comparison_takes_little_memory(spark):
    """A shard's words are compared a part at a time, and readers decode few whole texts at once."""
    import tracemalloc

    from tessera.llm import workspace

    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 12, 500_000)
    sizes[1000] = 600_000  # a word longer than a part
    buf = rng.integers(97, 99, int(sizes.sum()), dtype=np.uint8)
    at = np.cumsum(sizes) - sizes
    other = buf.copy()
    other[at[[5, 1000, -1]]] ^= 64
    tracemalloc.start()
    got = bytescan.same(buf, at, other, at, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.flatnonzero(~got).tolist() == [5, 1000, len(sizes) - 1]
    assert peak < 48 << 20
    assert bytescan.same(buf, at[:0], buf, at[:0], sizes[:0]).tolist() == []
    workspace.Workspace(spark, "settings")
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
