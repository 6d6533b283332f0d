"""The embedding graph against brute force."""

import math

import __spark_entry__ as E
import numpy as np

from tokenmeter.llm import vectors as V


def usable(e):
    return e is not None and len(e) > 0 and all(v is not None and math.isfinite(v) for v in e) and any(e)


def brute(rows, cosine=0.98):
    """(links, component) of each row; rows are (vec_id, embedding, label)."""
    n = len(rows)
    ok = [usable(e) and lab is not None for _, e, lab in rows]
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for group in {(lab, len(e)) for (_, e, lab), o in zip(rows, ok) if o}:
        at = [i for i, (_, e, lab) in enumerate(rows) if ok[i] and (lab, len(e)) == group]
        x = V.unit_rows([rows[i][1] for i in at])
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a != b:
                links[at[a]] += 1
                parent[max(find(at[a]), find(at[b]))] = min(find(at[a]), find(at[b]))
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(least.get(find(i), v), v)
    return links, [least.get(find(i)) for i in range(n)]


def made(spark, rows):
    return spark.createDataFrame([(v, e, lab, 0) for v, e, lab in rows], "vec_id long, embedding array<float>, label int, long int")


def crowd(rng, n, centre, noise):
    return [(centre + rng.normal(0, noise, len(centre))).astype(np.float32).tolist() for _ in range(n)]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, nan], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1),
            (10, [1.0, 0.0], None), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (None, [0.0, 1.0], 1), (13, [0.0, 1.0], 1), (13, [0.0, 1.0], 1), (14, [1e-30, 0.0], 1), (15, [1.0, 0.25], 1), (None, [-1.0, -1.0], 1)]
    links, comps = brute(rows)
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in V.near_duplicates(made(spark, rows)).collect())
    assert got == sorted((str(v), n, str(c)) for (v, _, _), n, c in zip(rows, links, comps))
    assert V.near_duplicates(made(spark, rows).limit(0)).count() == 0


def recall(spark, rows, **how):
    links, comps = brute(rows)
    got = {r["vec_id"]: r for r in V.near_duplicates(made(spark, rows), **how).collect()}
    assert len(got) == len(rows)
    assert all(got[v]["n_links"] <= n for (v, _, _), n in zip(rows, links))  # none below the threshold
    same = sum(got[v]["component_id"] == c for (v, _, _), c in zip(rows, comps)) / len(rows)
    return sum(r["n_links"] for r in got.values()) / max(1, sum(links)), same


def test_shards_splits_and_crowds(spark):
    rng = np.random.default_rng(4)
    vecs = [rng.normal(size=32).astype(np.float32).tolist() for _ in range(500)]
    vecs += [v for c in rng.normal(size=(40, 32)) for v in crowd(rng, 5, c, 0.08)]
    vecs += crowd(rng, 300, rng.normal(size=32), 0.06)
    rows = [(i, v, i % 2) for i, v in enumerate(vecs)]
    for shard in (2000, 120):
        share, same = recall(spark, rows, shard=shard, sample=200)
        assert share >= 0.95 and same >= 0.97, (shard, share, same)


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = E.queries()["op3_vectors"](spark, sf)
    assert got.count() == rows.count()
    assert V.audit(rows, got) >= 0.9
    links, comps = brute([tuple(r) for r in rows.select("vec_id", "embedding", "label").collect()])
    assert sum(r["n_links"] for r in got.collect()) >= 0.9 * sum(links)


def test_no_group_of_a_crowd_holds_it_whole(spark):
    """Near-equal vectors are guests of every centre: groups stay within two
    blocks, and every query meets every member once."""
    rng = np.random.default_rng(5)
    vecs = crowd(rng, 1500, rng.normal(size=16), 0.01)
    nodes = spark.createDataFrame([(1, 16, i, v, 1) for i, v in enumerate(vecs)], "label int, long int, node long, embedding array<double>, weight long")
    groups = V.shards(nodes, 100, 400, V.MARGIN)
    sizes = [r["count"] for r in groups.groupBy("key").count().collect()]
    assert max(sizes) <= 2 * 100 * 1.5  # blocks are dealt by hash
    met = groups.where("query").selectExpr("key", "node").join(groups.where("member").selectExpr("key", "node other"), "key").groupBy("node", "other").count()
    assert met.agg({"count": "max"}).first()[0] == 1 and met.count() == 1500 * 1500
