"""The pipeline's near copies against brute force over shingle sets."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import nearcopies

SF = "/root/testdata/sf0.001"
EDGES = [None, "", " \t\n", "a", "A", "the cat sat on the mat", "The CAT  sat on the mat", "x " * 500, "x " * 300, "é ñ ß 中文 한 🎉"]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def stays(rows):
    """Ids that stay, comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    near = np.array([[a == b or 5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets])
    root = np.arange(len(rows))
    while True:
        new = np.array([root[near[k]].min() for k in range(len(rows))])
        if (new == root).all():
            break
        root = new
    least = {min((rows[k][0] for k in np.flatnonzero(root == r) if rows[k][0] is not None), default=None) for r in set(root.tolist())}
    return sorted([i for i in least if i is not None]) + [None] * sum(i is None for i, _ in rows)


def edited(rng, text, edits):
    w = text.split()
    for k in rng.integers(0, len(w), edits):
        w[k] = f"new{rng.integers(1 << 30)}"
    return " ".join(w)


@pytest.mark.parametrize("small", [False, True])
def test_near_copies(spark, monkeypatch, small):
    """Real texts, copies with few and many edits, one large group, one line in most texts; also with tiny blocks."""
    if small:
        for name, value in (("CELL", 8), ("BLOCK", 6), ("BROADCAST", 0), ("SAMPLE_EVERY", 2), ("LEAST_COMMON", 3), ("SPLIT", 3), ("REMEMBERED", 5), ("SHORTER", np.uint64(54))):
            monkeypatch.setattr(nearcopies, name, value)
    rng = np.random.default_rng(4)
    real = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    line = " always the same few words of a notice here"
    texts = EDGES + [t + line for t in real] + [edited(rng, real[k % 60], int(rng.integers(1, 9))) for k in range(150)]
    base = " ".join(f"w{k}" for k in range(150))
    texts += [edited(rng, base, int(rng.integers(1, 5))) for _ in range(60)] + [base]
    rows = [(i, t) for i, t in enumerate(texts)] + [(70, texts[70]), (None, texts[80]), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "copy": F.lit("c"), "n": F.lit(2)})
    kept = corpus_pipeline.near_duplicates(spark, df, SF)
    assert kept.columns == df.columns
    wanted = stays(rows)
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=lambda i: (i is None, i)) == wanted
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), SF).count() == 0


def test_bounds_never_reject_a_link():
    rng = np.random.default_rng(1)
    for _ in range(300):
        k, x, y = rng.integers(0, 400), rng.integers(0, 60), rng.integers(0, 60)
        a, b, c = (rng.integers(-(2**63), 2**63 - 1, m) for m in (k, x, y))
        n, m = k + x, k + y
        if n and m and 5 * k >= 4 * (k + x + y):
            counts = [np.bincount(s % nearcopies.SEGMENTS, minlength=nearcopies.SEGMENTS)[None].astype(np.uint8) for s in (np.concatenate((a, b)), np.concatenate((a, c)))]
            assert nearcopies.may_link(np.array([n]), np.array([m]), *counts).all()


def test_fingerprints_come_first(spark):
    """The sets' fingerprints are majorities of their hashes, and near ones are candidates even if the sets' keys are left out."""
    import numpy as np
    import pyarrow as pa

    from tessera.llm import bytescan
    from tessera.llm.workspace import Workspace

    words = [f"w{k}" for k in range(4000)]
    texts = ["", "one", " ".join(words), " ".join([*words[:-1], "x"]), " ".join(words[::-1]), None]
    h, first = nearcopies.shingles_of(pa.array(texts, pa.string()), bytescan.SpanHasher())
    got = nearcopies.fingerprints_of(h, first).view(np.uint64)
    for k in range(len(texts)):
        own = h.view(np.uint64)[first[k] : first[k + 1]].tolist()
        assert int(got[k]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = nearcopies.prints(df)
    node = {r["doc_id"]: r["node"] for r in every.collect()}
    nodes = every.groupBy("node").agg(*[nearcopies.F.first(c).alias(c) for c in ("fp", "n")])
    edges = {(r["a"], r["b"]) for r in nearcopies.by_fingerprint(nodes, Workspace(spark, "t")).collect()}
    assert edges == {tuple(sorted((node[2], node[3])))}
