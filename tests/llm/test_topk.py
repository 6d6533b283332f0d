"""Exact top-k search against all pairs."""

import math

import numpy as np
import pytest

from tokenmeter.llm import topk as T


def brute(rows, k=5, every=50, scale=256):
    ok = [e is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in e) for _, e in rows]
    ints = [[math.floor(scale * x) for x in e] if o else None for (_, e), o in zip(rows, ok)]
    out = []
    for i, (v, _) in enumerate(rows):
        if not ok[i] or v is None or v % every:
            continue
        hits = [(-min(max(sum(a * b for a, b in zip(ints[i], ints[j])), -(2**63)), 2**63 - 1), rows[j][0] is None, rows[j][0] or 0)
                for j in range(len(rows)) if j != i and ok[j] and len(ints[j]) == len(ints[i])]
        out += [(v, r + 1, None if none else w, -s) for r, (s, none, w) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


def answer(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(v, e, "x", 0) for v, e in rows], f"vec_id long, embedding array<{kind}>, vector string, size int")
    return sorted((tuple(r) for r in T.search(df.repartition(3), **how).select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (50, [1.0, 0.5]), (100, None), (150, []), (151, []), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]), (350, [0.0, 0.0]),
            (400, [-1.0, -0.001]), (450, [1.0, 2.0, 3.0]), (None, [1.0, 0.5]), (None, [3.0, 3.0]), (-50, [0.003, -0.003]), (7, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [1e-30, -1e-30])]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, rows, head=2, block=1, stripe=2) == brute(rows)
    assert T.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_values_beyond_exact_doubles(spark):
    rows = [(50 * i, [2.0**40 * (i + 1), -(2.0**39), 1.0]) for i in range(4)] + [(1, [1e300, 1.0, 0.0]), (2, [2.0**20, 3.0, 5.0]), (3, [1.7e308, 0.0, 0.0])]
    assert answer(spark, rows, "double") == brute(rows)


@pytest.mark.parametrize("how", [{}, {"head": 20, "block": 7, "stripe": 150}])
@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_many_vectors(spark, spread, how):
    """Vectors of like and of very different lengths, many copies, ties."""
    rng = np.random.default_rng(int(spread * 100))
    x = rng.normal(0, 1, (900, 48)) @ np.diag(np.linspace(1.5, 0.05, 48)) * np.exp(rng.normal(0, spread, 900))[:, None]
    x[300:600] = x[7]
    rows = [(int(i), x[i].astype(np.float32).tolist()) for i in rng.permutation(900)]
    assert answer(spark, rows, **how) == brute(rows)


def test_short_vectors_are_given_up(spark):
    """A task stops at the first batch that reaches no floor any more."""
    import pyarrow as pa

    d = 40
    q = pa.RecordBatch.from_pydict({"vec_id": pa.array([0], pa.int64()), "row": pa.array([0], pa.int64()), "vector": pa.array([[1.0] * d], pa.list_(pa.float64())),
                                    "size": pa.array([math.sqrt(d)]), "least": pa.array([10.0 * d])})
    s = T.Search([q], d, 5, np.eye(d)[:, : max(T.STEPS)])

    def batch(value):
        return pa.RecordBatch.from_pydict({"vec_id": pa.array([1], pa.int64()), "row": pa.array([1], pa.int64()), "vector": pa.array([[value] * d], pa.list_(pa.float64())),
                                           "size": pa.array([value * math.sqrt(d)])})

    assert s.meet(batch(11.0)) and s.best[0] == [(-11 * d, False, 1)]
    assert not s.meet(batch(9.0))
