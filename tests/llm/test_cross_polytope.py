"""Links, counts and components of vectors against all cosines."""

import numpy as np
import pytest

from cardfeat.llm import cross_polytope as cp

COLUMNS = "vec_id bigint, embedding array<double>, label int, node bigint, code int, weight string, least int, own int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "w", 3, 4) for r in rows], COLUMNS)


def valid(vector, label):
    return label is not None and vector is not None and len(vector) > 0 and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def cosine(a, b):
    a, b = np.array(a, dtype=float), np.array(b, dtype=float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b))


def expected(rows):
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if valid(a, x) and valid(b, y) and x == y and len(a) == len(b) and cosine(a, b) >= 0.98:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def cluster(draw, n, dim, spread):
    centre = draw.standard_normal(dim)
    return centre + spread * np.linalg.norm(centre) / np.sqrt(dim) * draw.standard_normal((n, dim))


def planted(seed, dim=24):
    """Clusters from tight to just linked, single vectors, copies; two labels."""
    draw = np.random.default_rng(seed)
    vectors = [v for n, s in ((60, 0.05), (25, 0.09), (12, 0.12), (8, 0.14), (8, 0.16)) for v in cluster(draw, n, dim, s)]
    vectors += list(draw.standard_normal((60, dim)))
    vectors += [vectors[0]] * 5 + [vectors[0] * 3, vectors[150]]
    return [(k, [float(x) for x in v], int(k % 7 == 0)) for k, v in enumerate(vectors)]


@pytest.mark.parametrize("hot, most", [(1024, 16384), (16, 8), (10, 16)])
def test_counts_every_link_once(spark, monkeypatch, hot, most):
    monkeypatch.setattr(cp, "HOT", hot)
    monkeypatch.setattr(cp, "MAX_BLOCK", most)
    monkeypatch.setattr(cp, "BLOCK_BYTES", 1)
    rows = planted(hot)
    got, want = found(cp.linked_vectors(frame(spark, rows))), expected(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    links = sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # none below the threshold, none twice
    assert sum(r[1] for r in got) >= 0.99 * links > 3_000
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(rows)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_recall_by_number_of_hashes(k):
    draw = np.random.default_rng(k)
    a = cp.unit(draw.standard_normal((4_000, 64)))
    side = draw.standard_normal((4_000, 64))
    side = cp.unit(side - (side * a).sum(axis=1)[:, None] * a)
    wanted = draw.uniform(0.98, 0.999, 4_000)[:, None]
    b = wanted * a + np.sqrt(1 - wanted**2) * side
    x, y = cp.bucket_codes(a, k), cp.bucket_codes(b, k)
    met = np.any([cp._collide(x, y, t) for t in range(cp.TABLES)], axis=0)
    assert met.mean() >= 0.97


def test_a_pair_is_counted_in_one_bucket():
    draw = np.random.default_rng(8)
    a = cluster(draw, 40, 8, 0.3)
    codes = cp.bucket_codes(cp.unit(a), 2)
    for i in range(40):
        for j in range(i):
            places = []
            for t in range(cp.TABLES):
                for code in set(codes[i, t]) & set(codes[j, t]):
                    if code in (codes[i, t, 0], codes[j, t, 0]) and not cp._counted_before(codes[i], codes[j], t, code):
                        places.append((t, code))
            meets = any(cp._collide(codes[i], codes[j], t) for t in range(cp.TABLES))
            assert len(places) == meets


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    rows = np.random.default_rng(0).standard_normal((5, 32))
    turned = cp.hadamard(rows)
    assert np.allclose((turned**2).sum(axis=1), (rows**2).sum(axis=1)) and np.allclose(cp.hadamard(turned), rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 3.0], 0), (None, [2.0, 4.0, 6.0], 0), (3, [1.0, 2.0, 3.0], 1),
        (4, [1.0, 2.0, 3.0], None), (5, [1.0, 2.0, 3.0], None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [0.0, 0.0, 0.0], 0),
        (10, [1.0, nan, 3.0], 0), (11, [1.0, inf, 3.0], 0), (12, [1.0, None, 3.0], 0), (13, [1.0, 2.0], 0), (14, [1.0, 2.0, 3.0, 0.0], 0),
        (15, [-1.0, -2.0, -3.0], 0), (16, [1e300, 2e300, 3e300], 0), (17, [1e-300, 2e-300, 3e-300], 0), (18, [5.0], 0), (19, [2.0], 0), (20, [-2.0], 0),
        (None, [7.0, 0.0], 5), (None, [9.0, 0.1], 5), (None, None, None), (21, [1.0, 0.0, 0.0, 0.0], 7), (22, [49.0, 9.0, 3.0, 3.0], 7),
        (23, [3.0, 0.0, 0.0, 0.0], 8), (24, [49.0, 9.0, 3.0, 3.01], 8), (25, [0.0] * 70 + [1.0], 9), (26, [0.0] * 70 + [-0.0 + 3.0], 9),
    ]
    got = found(cp.linked_vectors(frame(spark, rows)))
    assert got == expected(rows)
    assert (22, 1, 21, False) in got and (24, 0, 24, True) in got  # 49/50 is linked, a little less is not
    assert cp.linked_vectors(frame(spark, [])).count() == 0
    assert found(cp.linked_vectors(frame(spark, rows[5:6]))) == [(4, 0, 4, True)]


def test_other_types(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0, 4.0], "a"), (3, [1.0, 2.0], "b"), (4, [1.0, 2.0], None)]
    want = [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]
    assert found(cp.linked_vectors(spark.createDataFrame(rows, "vec_id int, embedding array<float>, label string"))) == want
    named = spark.createDataFrame(rows, "`my id` int, `the.vector` array<float>, kind string")
    assert found(cp.linked_vectors(named, "my id", "the.vector", "kind")) == want


def test_many_copies(spark):
    rows = [(k, [1.0, 2.0, 3.0], 0) for k in range(3_000)] + [(3_000, [1.0, 2.0, 3.01], 0), (3_001, [-5.0, 1.0, 0.0], 0)]
    got = {r[0]: r[1:] for r in found(cp.linked_vectors(frame(spark, rows)))}
    assert {got[k] for k in range(1, 3_001)} == {(3_000, 0, False)} and got[0] == (3_000, 0, True) and got[3_001] == (0, 3_001, True)


def test_query(spark):
    import duckdb

    from cardfeat.llm.queries import QUERIES
    from tests.conftest import SMALL

    rows = duckdb.connect().execute(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    assert found(QUERIES["op11_cross_polytope"](spark, SMALL)) == expected(rows)
