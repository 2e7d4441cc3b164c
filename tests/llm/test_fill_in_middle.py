"""Fill-in-the-middle against the plain rule, block by block and over whole tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardfeat.llm import fill_in_middle as fim
from cardfeat.llm.flat import flat
from tests.llm import brute

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def rule(i, text, rate=100, spm_rate=50):
    text = text or ""
    lines = UNIT.findall(text)
    raw = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(raw[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, **rates):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = fim.fill_in_middle(docs, **rates)
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in back.collect()), key=repr)
    assert got == sorted(((i, *rule(i, t, **rates), t or "") for i, t in rows), key=repr)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    made = fim.fill_in_middle(edge_docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert sorted((tuple(r) for r in made.collect()), key=repr) == sorted(((i, *rule(i, t)) for i, t in edge_rows), key=repr)
    assert fim.digest(fim.fill_in_middle(no_docs)).count() == 0


def test_texts_near_markers_and_borders(spark):
    draw = random.Random(1)
    pieces = ["a", "\n", "\r\n", "<", ">", "P", "S", "M", "<P", "M>", "é", "\U0001f600", " ", "\n\n", " ", "\x00"]
    rows = [(k, "".join(draw.choice(pieces) for _ in range(draw.randrange(30)))) for k in range(3_000)]
    rows += [(3_001, "x<P>y\nz"), (3_002, "<S>"), (3_003, "a\n<M>"), (3_004, "\n"), (3_005, "no line end")]
    check(spark, rows)
    check(spark, rows[:500], rate=30, spm_rate=0)


def test_long_texts(spark):
    many = "".join(f"line {k} é\n" for k in range(60_000))
    one = "word " * 200_000
    blank = "\n" * 300_000
    check(spark, [(k, t) for k, t in enumerate([many, one, blank, many[:-1], one + "\n" + many] * 2)])


def test_batches_of_large_outputs(spark, monkeypatch):
    monkeypatch.setattr(fim, "OUT_BYTES", 100)
    check(spark, [(k, f"some line {k}\n" * (k % 7)) for k in range(200)])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_every_cut_of_small_blocks(block):
    draw = random.Random(block)
    texts = ["".join(draw.choice("ab\né") for _ in range(draw.randrange(60))) for _ in range(80)]
    part = flat(pa.array(texts))
    blocks = fim.Blocks(part, block)
    for k, text in enumerate(texts):
        lines = UNIT.findall(text)
        assert blocks.units[k] == len(lines) and blocks.points[k] == len(text)
        if text:
            heads = ["".join(lines[:u]) for u in range(len(lines) + 1)]
            assert blocks.cuts(k, tuple(range(len(lines) + 1))) == [(len(h.encode()), len(h)) for h in heads]


def test_fenwick_sums():
    draw = np.random.default_rng(3)
    for size in (1, 2, 3, 8, 13, 100):
        counts = draw.integers(0, 4, (size, 2))
        tree, sums = fim.Fenwick(counts), np.concatenate((np.zeros((1, 2), int), counts.cumsum(axis=0)))
        for wanted in range(1, sums[-1, 0] + 1):
            block, before = tree.descend(wanted)
            assert block == np.searchsorted(sums[1:, 0], wanted) and (before == sums[block]).all()


def test_query(spark):
    from cardfeat.llm.queries import QUERIES
    from tests.conftest import SMALL

    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_fill_in_middle"](spark, SMALL).collect()}
    for i, text in brute.table(SMALL, "documents", "doc_id, text"):
        n, form, p, m, output = rule(i, text)
        assert got[i] == (n, form, p, m, brute.sha(output), brute.sha(text or ""))
