"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors are compared only within one label (and one number of components).
Equal vectors are one node with a weight, so copies are never paired.

1. *Shards.*  A label's nodes are split by cluster centres, again and again
   until a shard is home to at most ``SHARD`` nodes.  Centres are fitted on at
   most about ``SAMPLE`` nodes of each shard; every node is assigned: home to
   its nearest centre, and a guest of all centres within ``MARGIN`` of that, so
   shards overlap where links may cross.  A shard whose homes or members a
   split does not shrink (a dense crowd) is not split again, and one with more
   than two blocks of members (guests count) is dealt in blocks: every block of
   members meets every block of queries, so no task holds more than two blocks.
2. *Graph.*  In each shard the members' nearest candidates are robust-pruned (a
   candidate goes when a kept one is ``ALPHA`` times nearer to it) to ``DEGREE``
   edges, with reverse edges.  A node's edges of all shards are united into one
   flat table.
3. *Search.*  Every node queries its home shard over the united graph: a greedy
   beam from the shard's medoid walks into range; from there, and from the
   query's own place in the graph, the search expands along all edges whose ends
   are within ``SLACK`` of the range until nothing new is in it.
4. Hits are verified by cosine in double precision.  Only counts and, per shard,
   one edge from each node to its local root leave a task; components are joined
   over those.

``audit`` measures recall against brute force.

Defined results: null labels, and vectors that are null, empty, zero or hold
null or non-finite components, link with nothing; equal rows count each other;
a null vec_id is ignored as the least of its component; an empty table gives an
empty one; other columns are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, written
from tokenmeter.llm.components import components

COSINE = 0.98
SHARD = 2000
SAMPLE = 4000
FANOUT = 64
MARGIN = 0.1
DEGREE, CANDIDATES, ALPHA = 24, 64, 1.2
BEAM = 32
SLACK = 0.04
#: A split that leaves a child with more than this share has met a crowd.
SOLID = 0.8
NODE = ["label", "long", "h1", "h2"]


def unit_rows(vectors):
    import numpy as np

    x = np.array([np.asarray(v, np.float64) for v in vectors])
    top = np.abs(x).max(axis=1, keepdims=True)  # no overflow when squared
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keyed(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding, label) with NODE columns, null where a row links
    with nothing."""
    e = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.coalesce(F.col("label").isNotNull() & (F.size(e) > 0) & ~F.exists(e, bad) & F.exists(e, lambda x: x != 0), F.lit(False))
    base = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), rows["embedding"].cast("array<double>").alias("embedding"), "label")
    return base.withColumns({"long": F.size(e), "h1": F.when(good, F.xxhash64(e)), "h2": F.when(good, F.hash(e))})


def fit_centres(pdf):
    """Centres (unit) of one shard's sample, by a few rounds of spherical
    k-means."""
    import numpy as np
    import pandas as pd

    x = unit_rows(pdf["embedding"])
    k = max(2, min(FANOUT, int(pdf["parts"].iloc[0]), len(x)))
    rng = np.random.default_rng(len(x))
    c = x[rng.choice(len(x), k, replace=False)] if len(x) >= 2 else x
    for _ in range(6):
        near = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (near == j).any():
                s = x[near == j].sum(axis=0)
                c[j] = s / max(np.sqrt((s * s).sum()), 1e-300)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "centres": [[row.tolist() for row in c]]})


def assign(rows: DataFrame, centres: DataFrame, margin: float) -> DataFrame:
    """Rows (shard, node, embedding, weight, home) of shards with centres, moved
    to their children."""

    def run(frames):
        import numpy as np
        import pandas as pd

        for pdf in frames:
            out = []
            for _, part in pdf.groupby("shard", sort=False):
                c = np.array([np.asarray(r, np.float64) for r in part["centres"].iloc[0]])
                near = unit_rows(part["embedding"]) @ c.T
                best = near.argmax(axis=1)
                i, j = np.nonzero(near >= near[np.arange(len(best)), best][:, None] - margin)
                moved = part.iloc[i].drop(columns="centres")
                moved["home"] = moved["home"].to_numpy() & (best[i] == j)
                moved["shard"] = moved["shard"].str.cat(j.astype(str), sep="/")
                out.append(moved)
            if out:
                yield pd.concat(out)

    kept = rows.columns
    return rows.join(centres, "shard").select(*kept, "centres").mapInPandas(run, rows.schema)


def shards(nodes: DataFrame, shard: int, sample: int, margin: float) -> DataFrame:
    """(key, node, embedding, weight, member, query): every group of one key is
    a bounded shard, or a pair of blocks of a crowd."""
    at = nodes.select(F.concat_ws(":", F.col("label").cast("string"), F.col("long").cast("string")).alias("shard"), "node", "embedding", "weight", F.lit(True).alias("home"))
    at, done = written(at, "vectors-shards"), None
    before = None
    while True:
        sizes = at.groupBy("shard").agg(F.sum(F.col("home").cast("int")).alias("n"), F.count(F.lit(1)).alias("m"))
        if before is None:
            sizes = sizes.withColumn("solid", F.lit(False))
        else:
            parent = before.select(F.col("shard").alias("parent"), F.col("n").alias("parent_n"), F.col("m").alias("parent_m"))
            sizes = sizes.withColumn("parent", F.regexp_extract("shard", r"\A(.*)/[0-9]+\z", 1)).join(parent, "parent")
            solid = (F.col("n") > SOLID * F.col("parent_n")) | (F.col("m") > SOLID * F.col("parent_m"))
            sizes = sizes.select("shard", "n", "m", solid.alias("solid"))
        sizes = written(sizes, "vectors-sizes")
        large = sizes.where((F.col("n") > shard) & ~F.col("solid"))
        n_large = large.count()
        settled = at.join(maybe_broadcast(large, n_large), "shard", "left_anti") if n_large else at
        # Guests of many centres make a shard large whose homes are few.
        crowded = sizes.where(((F.col("n") > shard) & F.col("solid")) | ((F.col("n") <= shard) & (F.col("m") > 2 * shard)))
        crowded = crowded.select("shard", F.ceil(F.col("m") / shard).cast("int").alias("blocks"), F.greatest(F.ceil(F.col("n") / shard), F.lit(1)).cast("int").alias("q_blocks"))
        settled = settled.join(maybe_broadcast(crowded, crowded.count()), "shard", "left")
        done = settled if done is None else done.union(settled)
        if not n_large:
            break
        part = at.join(maybe_broadcast(large.select("shard", "n"), n_large), "shard")
        picked = part.where(F.col("home") & (F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < F.ceil(1_000_000.0 * sample / F.col("n"))))
        picked = picked.select("shard", "embedding", F.ceil(F.col("n") / shard * 1.3).cast("int").alias("parts"))
        centres = written(picked.groupBy("shard").applyInPandas(fit_centres, "shard string, centres array<array<double>>"), "vectors-centres")
        before = sizes
        at = written(assign(part.drop("n"), maybe_broadcast(centres, n_large * FANOUT), margin), "vectors-shards")
    mine, others = (lambda n: F.pmod(F.xxhash64("node"), F.col(n))), (lambda n: F.sequence(F.lit(0), F.col(n) - 1))
    name = lambda m, q: F.concat_ws("|", "shard", m.cast("string"), q.cast("string"))
    role = lambda key, member, query: F.struct(key.alias("key"), F.lit(member).alias("member"), query.alias("query"))
    as_member = F.transform(others("q_blocks"), lambda q: role(name(mine("blocks"), q), True, F.lit(False)))
    as_query = F.when(F.col("home"), F.transform(others("blocks"), lambda m: role(name(m, mine("q_blocks")), False, F.lit(True)))).otherwise(F.array())
    roles = F.when(F.col("blocks").isNull(), F.array(role(F.col("shard"), True, F.col("home")))).otherwise(F.concat(as_member, as_query))
    return done.select("node", "embedding", "weight", F.explode(roles).alias("r")).select("r.key", "node", "embedding", "weight", "r.member", "r.query")


class Graph:
    """Robust-pruned edges among the rows of ``x`` (unit vectors)."""

    def __init__(self, x, degree: int = DEGREE):
        import numpy as np

        self.np, self.x, self.degree = np, x, min(degree, max(1, len(x) - 1))

    def build(self):
        """List of edge arrays, one per row."""
        np, x, n = self.np, self.x, len(self.x)
        if n < 2:
            return [np.empty(0, np.int64)] * n
        c = min(CANDIDATES, n - 1)
        out = []
        for a in range(0, n, 256):
            near = x[a : a + 256] @ x.T
            near[np.arange(len(near)), np.arange(a, a + len(near))] = -2
            top = np.argpartition(-near, c - 1, axis=1)[:, :c]
            sim = np.take_along_axis(near, top, 1)
            order = np.argsort(-sim, axis=1, kind="stable")
            out += self.prune(np.take_along_axis(top, order, 1), np.take_along_axis(sim, order, 1))
        back: list[list[int]] = [[] for _ in range(n)]
        for i, edges in enumerate(out):
            for j in edges.tolist():
                if len(back[j]) < self.degree:
                    back[j].append(i)
        return [np.union1d(e, np.array(b, np.int64)) for e, b in zip(out, back)]

    def prune(self, cand, sim):
        """For each row the candidates (nearest first) that no kept one is ALPHA
        times nearer to."""
        np, x = self.np, self.x
        far = np.sqrt(np.maximum(0, 2 - 2 * sim))
        v = x[cand]
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ncd,nkd->nck", v, v)))
        left, kept = np.ones(cand.shape, bool), np.zeros(cand.shape, bool)
        rows = np.arange(len(cand))
        for _ in range(self.degree):
            first = left.argmax(axis=1)
            live = left[rows, first]
            if not live.any():
                break
            kept[rows[live], first[live]] = True
            left &= ~(live[:, None] & (ALPHA * between[rows, first] <= far))
            left[rows, first] = False
        return [c[k] for c, k in zip(cand, kept)]


class Search:
    """Range search over a shard's graph for a block of queries at a time."""

    def __init__(self, x, edges: list):
        import numpy as np

        self.np, self.x = np, x
        width = max([1, *map(len, edges)])
        self.edges = np.full((len(x), width), -1, np.int64)
        for i, e in enumerate(edges):
            self.edges[i, : len(e)] = e
        mean = x.mean(axis=0)
        self.medoid = int((x @ mean).argmax())

    def block(self, q, own, cosine: float):
        """(query, member) pairs whose cosine reaches the threshold; ``own`` is
        the query's own row among the members, -1 for none."""
        np, x, n = self.np, self.x, len(self.x)
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n), bool)
        beam = np.full((len(q), BEAM), -1, np.int64)
        near = np.full((len(q), BEAM), -2.0)
        open_ = np.zeros((len(q), BEAM), bool)
        beam[:, 0], near[:, 0], open_[:, 0] = self.medoid, q @ x[self.medoid], True
        seen[:, self.medoid] = True
        while True:
            score = np.where(open_, near, -3.0)
            pick = score.argmax(axis=1)
            live = score[rows, pick] > -3.0
            if not live.any():
                break
            open_[rows, pick] = False
            new = np.where(live[:, None], self.edges[beam[rows, pick]], -1)
            new[(new >= 0) & seen[rows[:, None], new]] = -1
            i, j = np.nonzero(new >= 0)
            seen[i, new[i, j]] = True
            got = np.full(new.shape, -2.0)
            got[i, j] = np.einsum("nd,nd->n", q[i], x[new[i, j]])
            all_near = np.concatenate([near, got], 1)
            keep = np.argpartition(-all_near, BEAM - 1, axis=1)[:, :BEAM]
            near = np.take_along_axis(all_near, keep, 1)
            beam = np.take_along_axis(np.concatenate([beam, new], 1), keep, 1)
            open_ = np.take_along_axis(np.concatenate([open_, got > -2.0], 1), keep, 1)
        tried = np.zeros((len(q), n), bool)
        i, j = np.nonzero((beam >= 0) & (near >= cosine - SLACK))
        start_q, start_m = np.concatenate([i, rows[own >= 0]]), np.concatenate([beam[i, j], own[own >= 0]])
        code = np.unique(start_q * n + start_m)
        hits = []
        while len(code):
            a, b = code // n, code % n
            tried[a, b] = True
            sim = np.concatenate([np.einsum("nd,nd->n", q[a[s : s + 100_000]], x[b[s : s + 100_000]]) for s in range(0, len(a), 100_000)])
            hits.append(code[sim >= cosine])
            wide = sim >= cosine - SLACK
            a, b = a[wide], b[wide]
            fresh = []
            for s in range(0, len(a), 50_000):
                m = self.edges[b[s : s + 50_000]]
                r = np.broadcast_to(a[s : s + 50_000, None], m.shape)
                ok = m >= 0
                ok &= ~tried[r, m]
                tried[r[ok], m[ok]] = True
                fresh.append(np.unique(r[ok] * n + m[ok]))
            code = np.unique(np.concatenate(fresh)) if fresh else np.empty(0, np.int64)
        code = np.concatenate(hits) if hits else np.empty(0, np.int64)
        a, b = code // n, code % n
        other = b != own[a]
        return a[other], b[other]


def build_graph(groups: DataFrame) -> DataFrame:
    """(node, edges): the flat graph, edges of all shards united."""

    def run(pdf):
        import pandas as pd

        part = pdf[pdf["member"]]
        ids = part["node"].to_numpy()
        edges = Graph(unit_rows(part["embedding"])).build() if len(part) else []
        return pd.DataFrame({"node": ids, "edges": [ids[e].tolist() for e in edges]})

    # Blocks of a crowd meet several blocks of queries: one graph is enough.
    once = groups.where("member").withColumn("key", F.regexp_replace("key", r"\|[0-9]+\z", "")).dropDuplicates(["key", "node"])
    lists = once.groupBy("key").applyInPandas(run, "node bigint, edges array<bigint>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))


def search_graph(groups: DataFrame, graph: DataFrame, cosine: float) -> DataFrame:
    """(node, root, weight) of every query of every group: the least node of its
    local component, and the weight of its other hits in the group."""

    def run(pdf):
        import numpy as np
        import pandas as pd

        member, query = pdf[pdf["member"]], pdf[pdf["query"]]
        if not len(member) or not len(query):
            return pd.DataFrame({"node": [], "root": [], "weight": []}).astype("int64")
        ids = member["node"].to_numpy()
        x, q = unit_rows(member["embedding"]), unit_rows(query["embedding"])
        place = pd.Series(np.arange(len(ids)), index=ids)
        edges = []
        for e in member["edges"]:
            e = place.reindex(np.asarray(e if e is not None else [], np.int64)).to_numpy()
            edges.append(e[~np.isnan(e)].astype(np.int64))
        search, weight = Search(x, edges), member["weight"].to_numpy()
        qids = query["node"].to_numpy()
        own = place.reindex(qids).fillna(-1).to_numpy().astype(np.int64)
        every = np.unique(np.concatenate([ids, qids]))
        root = np.arange(len(every))
        total = np.zeros(len(qids), np.int64)
        qat, mat = np.searchsorted(every, qids), np.searchsorted(every, ids)
        for s in range(0, len(q), 256):
            a, b = search.block(q[s : s + 256], own[s : s + 256], cosine)
            np.add.at(total, a + s, weight[b])
            u, v = root[qat[a + s]], root[mat[b]]
            pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1)[u != v], axis=0)
            parent = dict()

            def find(i):
                while i in parent:
                    i = parent[i]
                return i

            for i, j in pairs.tolist():
                i, j = find(i), find(j)
                if i != j:
                    parent[max(i, j)] = min(i, j)
            if parent:
                to = np.arange(len(every))
                for i in parent:
                    to[i] = find(i)
                root = to[root]
        out = pd.DataFrame({"node": every, "root": every[root], "weight": 0})
        out.loc[qat, "weight"] = total
        return out

    rows = groups.join(graph, "node", "left").select("key", "node", "embedding", "weight", "member", "query", "edges")
    return rows.groupBy("key").applyInPandas(run, "node bigint, root bigint, weight bigint")


def near_duplicates(rows: DataFrame, cosine: float = COSINE, shard: int = SHARD, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``rows`` (vec_id,
    embedding, label)."""
    table = written(keyed(rows.select("vec_id", "embedding", "label")), "vectors-rows")
    nodes = (table.where("h1 IS NOT NULL").groupBy(*NODE).agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = written(nodes, "vectors-nodes")
    groups = written(shards(nodes, shard, sample, margin), "vectors-groups")
    graph = written(build_graph(groups), "vectors-graph")
    found = written(search_graph(groups, graph, cosine), "vectors-found")
    linked = found.groupBy("node").agg(F.sum("weight").alias("others"))
    roots = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = nodes.join(linked, "node", "left").join(roots, "node", "left").select(*NODE, "weight", "least", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("root", "node").alias("root"))
    classes = written(classes, "vectors-classes")
    least = written(classes.groupBy("root").agg(F.min("least").alias("component_id")), "vectors-least")
    by_node = written(classes.join(least, "root").select(*NODE, (F.col("weight") - 1 + F.col("others")).alias("n_links"), "component_id"), "vectors-links")
    alone = F.col("h1").isNull()
    out = table.select("vec_id", *NODE).join(by_node, NODE, "left")
    return out.select("vec_id", F.when(alone, 0).otherwise(F.col("n_links")).cast("bigint").alias("n_links"), F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))


def audit(rows: DataFrame, found: DataFrame, cosine: float = COSINE, sample: int = 256) -> float:
    """Share of the true links of ``sample`` rows (in hash order) that ``found``
    has; the sampled rows meet all rows in blocks."""
    picked = [(r["vec_id"], r["label"], r["embedding"]) for r in keyed(rows).where("h1 IS NOT NULL").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not picked:
        return 1.0

    def run(frames):
        import numpy as np
        import pandas as pd

        for pdf in frames:
            ids, count = [], []
            for vec_id, label, e in picked:
                part = pdf[(pdf["label"] == label) & (pdf["long"] == len(e)) & (pdf["vec_id"] != vec_id)]
                if len(part):
                    ids.append(vec_id)
                    count.append(int((unit_rows(part["embedding"]) @ unit_rows([e])[0] >= cosine).sum()))
            yield pd.DataFrame({"vec_id": np.array(ids, np.int64), "links": np.array(count, np.int64)})

    true = keyed(rows).where("h1 IS NOT NULL").select("vec_id", "embedding", "label", "long").mapInPandas(run, "vec_id bigint, links bigint")
    both = true.groupBy("vec_id").agg(F.sum("links").alias("links")).join(found, "vec_id").agg(F.sum("links"), F.sum(F.least("links", "n_links"))).first()
    return 1.0 if not both[0] else both[1] / both[0]


def q_vectors(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
