"""Winnowing, long texts, and lines removed in one sweep."""

import random
import time

import numpy as np
import pyarrow as pa

from cardfeat.llm import line_dedup as dedup
from cardfeat.llm.flat import flat


def test_minima_of_runs():
    draw = np.random.default_rng(4)
    for _ in range(200):
        n = int(draw.integers(1, 40))
        hashes = draw.integers(0, 6, n).astype(np.uint64)
        first = np.sort(draw.integers(0, n, 12))
        last = np.minimum(first + draw.integers(0, n, 12), n - 1)
        got = dedup._lowest(hashes, first, last)
        assert got.tolist() == [a + int(np.argmin(hashes[a : b + 1])) for a, b in zip(first, last)]


def test_shared_windows_have_shared_fingerprints():
    draw = random.Random(3)
    shared = "\n".join(" ".join(f"w{draw.randrange(30)}" for _ in range(draw.randrange(6))) for _ in range(40))
    texts = [("\n".join(f"own {k} {j}" for j in range(draw.randrange(5))) + "\n" + shared + f"\nend {k}") for k in range(20)]
    part = flat(pa.array(texts))
    found, runs = dedup.windows(part, 12), dedup.runs(part, 12)
    places = {}
    for k in np.flatnonzero(runs.fresh):
        places.setdefault(int(runs.hashes[runs.lowest[k]]), set()).add(int(runs.text[runs.at[k]]))
    common = {}
    for k in range(len(found["text"])):
        common.setdefault(int(found["window"][k]), []).append(k)
    repeated = [group for group in common.values() if len({found["text"][k] for k in group}) == 20]
    assert len(repeated) > 10
    for group in repeated:
        assert len({int(found["fingerprint"][k]) for k in group}) == 1
        assert len(places[int(found["fingerprint"][group[0]])]) == 20
    assert sorted(dedup.fingerprints(part, 12)) == sorted(runs.hashes[runs.lowest[runs.fresh]])
    assert runs.fresh.sum() < 0.6 * len(runs.at)  # one place serves several windows


def test_sieve(spark):
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 1 << 64, 5_000, dtype=np.uint64)
    sieve = dedup.Sieve.of(spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h bigint"), "h")
    assert len(sieve.bits) * 8 == 1 << 18 and sieve.lets(hashes).all()
    assert 0.01 < sieve.lets(draw.integers(0, 1 << 64, 100_000, dtype=np.uint64)).mean() < 0.03
    assert not dedup.Sieve.of(spark.createDataFrame([], "h bigint"), "h").lets(hashes).any()


def test_sweep():
    draw = random.Random(9)
    texts, runs = [None, "", "a\nb"], [None, None, []]
    for _ in range(60):
        n = draw.randrange(1, 15)
        texts.append("\n".join(draw.choice(["", "x", "é y"]) for _ in range(n)))
        pairs = [sorted((draw.randrange(n + 1), draw.randrange(n + 1))) for _ in range(draw.randrange(4))]
        runs.append([{"start": a, "end": b} for a, b in pairs])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    left, n_lines, n_deleted = dedup.without_runs(pa.array(texts), pa.array(runs, kind))
    for text, own, got, n, m in zip(texts, runs, left, n_lines, n_deleted):
        lines = [] if text is None else text.split("\n")
        gone = {k for r in own or [] for k in range(r["start"], r["end"])}
        assert (got, n, m) == (None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    # offsets of a slice count from its own beginning
    again = dedup.without_runs(pa.array(texts)[10:20], pa.array(runs, kind)[10:20])
    assert again[0] == left[10:20] and (again[2] == n_deleted[10:20]).all()


def test_texts_of_a_hundred_thousand_lines(spark):
    text = "\n".join(f"line {k} of the log" for k in range(100_000))
    blank = "one " * 30 + "\n" * 200_000 + "two " * 30
    docs = spark.createDataFrame([(1, text), (2, text), (3, blank), (4, blank), (5, "x\n" + text)], "doc_id bigint, text string")
    start = time.time()
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], len(r["text"])) for r in dedup.delete_repeated_lines(docs).collect()}
    took = time.time() - start
    assert got[1] == (100_000, 0, len(text)) and got[2] == (100_000, 100_000, 0)
    assert got[3] == (200_001, 0, len(blank)) and got[4] == (200_001, 200_001, 0)
    assert got[5] == (100_001, 100_000, 1)
    assert took < 60  # it grew with the square of the lines once: minutes
