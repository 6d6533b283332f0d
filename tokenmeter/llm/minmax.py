"""Near-duplicates by min-max hashing of word shingles.

Each text's set of shingles (64-bit hashes of runs of words) is signed by both
the minimum and the maximum under each of ``PERMUTATIONS`` random permutations,
which halves the hash evaluations of a signature and lowers the variance of its
unbiased estimate.  Signatures are cut into ``BANDS`` bands of ``ROWS`` values;
texts that share a band are candidates.  At similarity 0.8 a pair is missed with
a probability of (1 - 0.8^6)^36, about 2 in 100,000.

Links are confirmed on full sets, in blocks of bounded size:

1. texts with equal sets are one node; nodes joined by shared buckets (each
   member to its bucket's least node) form a cluster of candidates;
2. a cluster of up to ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles goes to
   one task, which finds all its links by an inverted index of shingles;
3. of a larger cluster, every node is first checked against the cluster's most
   central one, the hub.  Two nodes that both link to it are connected already;
   those that do not are far.  Far nodes are checked against the centre of each
   of their buckets (one that links to the hub, where the bucket has one);
4. buckets whose nodes are then all connected are done.  Of the others, the far
   nodes not yet connected to the hub are queries against the nodes they share a
   bucket with, in blocks by bucket or by cluster, whichever moves fewer rows.
   Jaccard distance is a metric, so a query at distance d from the hub meets only
   nodes at least d - 0.2 from it: the copies round the hub stay out.  A task
   emits one edge from a node to its local root, never pairs.

So a group of thousands of near copies costs one check per member, a chain of
shifted texts some checks per member, each linear; blocks are left to far nodes
that share a bucket with nodes they are not connected to.  Buckets are met by
joins that AQE can split, counts are pre-aggregated.

Defined results: a text without words, or a null one, has an empty set and
links with nothing; with fewer words than a shingle has, the whole sequence is
the only shingle; rows with one id count as rows of their own, equal texts
linking; a null id is ignored as a component's least id (null if no other);
a very long text counts with all its shingles; empty tables give empty ones;
other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, release, written
from tokenmeter.llm.components import components

BANDS, ROWS = 36, 6
PERMUTATIONS = BANDS * ROWS // 2
#: Most nodes of a block, and shingles of a cluster held in one task.
BLOCK, BLOCK_SHINGLES = 512, 2_000_000
#: Shingles signed at a time: the signing table is PERMUTATIONS x this.
SIGN_STEP = 16_384
SIGNED = "doc_id bigint, text_hash bigint, n bigint, set_id binary, bands array<bigint>"


class Shingler:
    """Shingle sets and signatures, for one task."""

    def __init__(self, width: int, words_kept: int = 200_000):
        import numpy as np
        import xxhash

        from tokenmeter.llm.bpe import WordCache

        self.np, self.width = np, width
        self.word = WordCache(xxhash.xxh3_64_intdigest, words_kept)
        self.digest = xxhash.xxh3_128_digest
        rng = np.random.default_rng(7)
        odd = lambda n: rng.integers(0, 2**64, n, np.uint64) | np.uint64(1)
        self.place, self.perm, self.shift = odd(width), odd(PERMUTATIONS), rng.integers(0, 2**64, PERMUTATIONS, np.uint64)
        self.fold = odd(ROWS)
        self.band = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def mix(self, x):
        u = self.np.uint64
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31))

    def shingles(self, text: str):
        """The sorted set of shingle hashes; words are split at ASCII white
        space, A-Z lower-cased."""
        np = self.np
        words = text.encode("utf-8").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        if len(w) < self.width:
            return self.mix((w * self.place[: len(w)]).sum(keepdims=True) + np.uint64(len(w)))
        n = len(w) - self.width + 1
        total = np.zeros(n, np.uint64)
        for k in range(self.width):
            total += w[k : k + n] * self.place[k]
        return np.unique(self.mix(total))

    def bands(self, s):
        np = self.np
        low, high = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
        for i in range(0, len(s), SIGN_STEP):
            v = self.perm[:, None] * s[None, i : i + SIGN_STEP] + self.shift[:, None]
            np.minimum(low, v.min(axis=1), out=low)
            np.maximum(high, v.max(axis=1), out=high)
        signature = np.stack([low, high], axis=1).reshape(BANDS, ROWS)
        return self.mix((self.mix(signature) * self.fold).sum(axis=1) + self.band)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """SIGNED rows of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names = Shingler(width), ["doc_id", "text_hash", "n", "set_id", "bands"]
        for batch in batches:
            n, ids, bands = [], [], []
            for text in batch.column(2):
                s = own.shingles(text.as_py() or "")
                n.append(len(s))
                ids.append(own.digest(s.tobytes()) if len(s) else None)
                bands.append(own.bands(s).view("int64") if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names)
        release()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, SIGNED)


def local_roots(placed: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) edges of each group of ``placed`` (part, set_id, text, member,
    query): from a node to the least node of its component among the links of
    the group's queries to its members."""

    def roots(rows: list[tuple], own: Shingler) -> list[tuple]:
        np = own.np
        ids = [r[0] for r in rows]
        sets = [own.shingles(r[1]) for r in rows]
        long = np.array([len(s) for s in sets])
        member = np.flatnonzero([r[2] for r in rows])
        if not len(member):
            return []
        flat = np.concatenate([sets[i] for i in member])
        owner = np.repeat(member, long[member])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        parent = list(range(len(rows)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for q in np.flatnonzero([r[3] for r in rows]).tolist():
            lo, hi = np.searchsorted(flat, sets[q], "left"), np.searchsorted(flat, sets[q], "right")
            n = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(rows))
            for j in np.flatnonzero(100 * both >= percent * (long + long[q] - both)).tolist():
                if both[j] and (x := find(q)) != (y := find(j)):
                    parent[max(x, y)] = min(x, y)
        return [(ids[i], ids[find(i)]) for i in range(len(rows)) if find(i) != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler(width)
        last, rows, out = None, [], []
        made = lambda e: pa.RecordBatch.from_arrays([pa.array([x[k] for x in e], pa.binary()) for k in (0, 1)], ["a", "b"])
        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for i in range(len(batch)):
                part = cols[0][i].as_py()
                if part != last:
                    out += roots(rows, own) if len(rows) > 1 else []
                    last, rows = part, []
                rows.append(tuple(c[i].as_py() for c in cols[1:]))
            if out:
                yield made(out)
                out = []
        out += roots(rows, own) if len(rows) > 1 else []
        if out:
            yield made(out)
        release()

    by_part = placed.select("part", "set_id", "text", "member", "query").repartition("part").sortWithinPartitions("part", "set_id")
    return by_part.mapInArrow(run, "a binary, b binary")


def compared(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, far, linked) of each pair (a, b): the Jaccard distance of their
    full sets, and whether they reach the similarity; many ``a`` share a ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler(width)
        last, base = None, None
        for batch in batches:
            far, ok = [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                if (text := b.as_py()) != last:
                    last, base = text, own.shingles(text)
                s = own.shingles(a.as_py())
                both = len(own.np.intersect1d(s, base, assume_unique=True))
                either = len(s) + len(base) - both
                far.append(1 - both / either)
                ok.append(100 * both >= percent * either)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(ok, pa.bool_())], ["a", "b", "far", "linked"])
        release()

    left = texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    n = pairs.count()
    right = texts.join(maybe_broadcast(pairs.select(F.col("b").alias("set_id")).distinct(), n), "set_id").select(F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    met = left.join(maybe_broadcast(pairs.select("a", "b"), n), "a").join(written(right, "minmax-hubs"), "b").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(run, "a binary, b binary, far double, linked boolean")


def shells(rows: DataFrame, slack: float, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (cluster, unit, set_id, query, far) that a query of their unit
    can link to, and the sizes (cluster, unit, kb, qb, cost) of the units in
    blocks; cost is the number of texts their blocks take."""
    least = rows.where("query").groupBy("unit").agg(F.min("far").alias("least"))
    kept = rows.join(least, "unit").where(F.col("query") | (F.col("far") >= F.col("least") - slack))
    kept = written(kept.select("cluster", "unit", "set_id", "query"), name)
    sizes = kept.groupBy("cluster", "unit").agg(F.count(F.lit(1)).alias("k"), F.count_if("query").alias("q"))
    sizes = sizes.withColumns({"kb": F.ceil(F.col("k") / BLOCK), "qb": F.ceil(F.col("q") / BLOCK)})
    return kept, written(sizes.select("cluster", "unit", "kb", "qb", (F.col("k") * F.col("qb") + F.col("q") * F.col("kb")).alias("cost")), f"{name}-sizes")


def crowd_links(crowd: DataFrame, members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) links that connect the nodes of large clusters (``crowd``: cluster,
    set_id, hub); ``members`` (set_id, bucket) has their buckets."""
    yes, no = F.lit(True), F.lit(False)
    to_hub = crowd.where("set_id != hub").select(F.col("set_id").alias("a"), F.col("hub").alias("b"))
    met = written(compared(to_hub, texts, width, percent), "minmax-near")
    near = met.where("linked").select("a", "b")
    crowd = crowd.join(met.select(F.col("a").alias("set_id"), "far", "linked"), "set_id", "left")
    crowd = written(crowd.withColumns({"far": F.coalesce("far", F.lit(0.0)), "linked": F.coalesce("linked", yes)}), "minmax-crowds")

    # Buckets with a far node; their centre links to the hub where one does.
    n = crowd.count()
    placed = members.select("set_id", "bucket").join(maybe_broadcast(crowd, n), "set_id")
    watched = placed.groupBy("bucket").agg(F.bool_or(~F.col("linked")).alias("open"), F.min(F.struct(~F.col("linked"), "set_id"))["set_id"].alias("centre")).where("open")
    placed = written(placed.join(watched.drop("open"), "bucket"), "minmax-watched")
    if placed.isEmpty():
        return near
    pairs = placed.where("NOT linked AND set_id != centre AND centre != hub").select(F.col("set_id").alias("a"), F.col("centre").alias("b")).distinct()
    second = compared(written(pairs, "minmax-to-centre"), texts, width, percent).where("linked").select("a", "b")
    links = written(near.union(second), "minmax-found")

    # Buckets whose nodes are not all connected yet; equal ones count once.
    root = maybe_broadcast(components(links).select(F.col("node").alias("set_id"), "root"), n)
    hubs = written(crowd.where("set_id = hub").join(root, "set_id", "left").select("cluster", F.coalesce("root", "set_id").alias("main")), "minmax-main")
    placed = placed.join(root, "set_id", "left").join(maybe_broadcast(hubs, hubs.count()), "cluster")
    placed = placed.withColumn("root", F.coalesce("root", "set_id")).withColumn("query", F.col("root") != F.col("main"))
    placed = written(placed.select("cluster", "bucket", "set_id", "far", "root", "query"), "minmax-watched")
    content = [F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "set_id")).alias("y")]
    apart = placed.groupBy("cluster", "bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), *content).where("low != high")
    apart = apart.groupBy("cluster", "k", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    rows = written(placed.join(apart, "bucket").select("cluster", "bucket", "set_id", "far", "query"), "minmax-apart")
    if rows.isEmpty():
        return links

    slack = 1 - percent / 100 + 1e-9
    by_bucket = shells(rows.withColumn("unit", F.concat(F.lit("b"), F.col("bucket").cast("string"))), slack, "minmax-by-bucket")
    nodes = rows.select("cluster", "set_id", "far", "query").distinct()
    by_cluster = shells(nodes.withColumn("unit", F.concat(F.lit("c"), F.hex("cluster"))), slack, "minmax-by-cluster")
    cost = by_bucket[1].groupBy("cluster").agg(F.sum("cost").alias("buckets")).join(by_cluster[1].select("cluster", F.col("cost").alias("whole")), "cluster")
    cost = written(cost.select("cluster", (F.col("buckets") < F.col("whole")).alias("split")), "minmax-cost")
    block = lambda c: F.pmod(F.xxhash64("set_id"), F.col(c))
    part = lambda m, q: F.concat_ws("|", "unit", m.cast("string"), q.cast("string")).alias("part")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)).alias("other")
    dealt = None
    for (kept, sizes), chosen in ((by_bucket, "split"), (by_cluster, "NOT split")):
        sizes = written(sizes.join(cost.where(chosen).select("cluster"), "cluster").select("unit", "kb", "qb"), "minmax-units")
        kept = kept.join(maybe_broadcast(sizes, sizes.count()), "unit")
        as_member = kept.select("unit", "set_id", block("kb").alias("own"), upto("qb")).select("set_id", part(F.col("own"), F.col("other")), yes.alias("member"), no.alias("query"))
        as_query = kept.where("query").select("unit", "set_id", block("qb").alias("own"), upto("kb")).select("set_id", part(F.col("other"), F.col("own")), no.alias("member"), yes.alias("query"))
        both = as_member.union(as_query)
        dealt = both if dealt is None else dealt.union(both)
    dealt = written(dealt, "minmax-dealt")
    return links.union(written(local_roots(texts.join(maybe_broadcast(dealt, dealt.count()), "set_id"), width, percent), "minmax-outliers"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, root, component_id) of every row of
    ``docs`` (doc_id, text); text_hash tells apart rows that share an id, root
    is the same for all rows of a component (null for an empty set)."""
    rows = written(signed(docs, width), "minmax-signed")
    nodes = written(rows.where("n > 0").groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands"),
                                                              F.min("doc_id").alias("least")), "minmax-nodes")
    members = nodes.select("set_id", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("set_id").alias("centre")).where("size > 1")
    shared = written(shared, "minmax-buckets")
    members = written(members.join(shared, "bucket").select("set_id", "n", "bucket", "centre", "size"), "minmax-members")

    # A node's centres (at most one a band) hang on the least of them; nodes of
    # one group share most centres, so few different links are left.
    central = members.groupBy("set_id").agg(F.sum("size").alias("central"), F.max("n").alias("n"), F.collect_set("centre").alias("centres"))
    central = written(central.withColumn("least", F.array_min("centres")), "minmax-central")
    n_shared = central.count()

    needed = nodes.select("set_id", "rep").join(maybe_broadcast(central.select("set_id"), n_shared), "set_id")
    needed = written(needed.select("set_id", F.col("rep.doc_id").alias("id"), F.col("rep.text_hash").alias("hash")), "minmax-needed")
    d, w = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash")).alias("d"), maybe_broadcast(needed, n_shared).alias("w")
    texts = d.join(w, F.expr("d.doc_id <=> w.id AND d.text_hash = w.hash")).select("set_id", "text")
    texts = written(texts, "minmax-texts")
    repeated = texts.groupBy("set_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    if not repeated.isEmpty():  # rows repeated whole: one text a node
        texts = written(texts.groupBy("set_id").agg(F.first("text").alias("text")), "minmax-texts")

    shared = central.select(F.explode("centres").alias("a"), F.col("least").alias("b")).distinct()
    candidates = components(shared.union(central.select(F.col("set_id").alias("a"), F.col("least").alias("b"))))
    central = central.drop("centres", "least")
    cluster = written(central.join(maybe_broadcast(candidates.select(F.col("node").alias("set_id"), F.col("root").alias("cluster")), n_shared), "set_id"), "minmax-clusters")
    sizes = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("shingles"), F.max(F.struct("central", "set_id"))["set_id"].alias("hub"))
    large = written(sizes.where((F.col("k") > BLOCK) | (F.col("shingles") > BLOCK_SHINGLES)).select("cluster", "hub"), "minmax-large")
    n_large = large.count()

    yes = F.lit(True)
    small = cluster.join(maybe_broadcast(large, n_large), "cluster", "left_anti").select("set_id", F.hex("cluster").alias("part"), yes.alias("member"), yes.alias("query"))
    links = written(local_roots(texts.join(maybe_broadcast(small, n_shared), "set_id"), width, percent), "minmax-links")
    if n_large:
        crowd = written(cluster.join(maybe_broadcast(large, n_large), "cluster").select("cluster", "set_id", "hub"), "minmax-crowds")
        links = links.union(crowd_links(crowd, members, texts, width, percent))
    final = components(links)

    final = maybe_broadcast(final.select(F.col("node").alias("set_id"), "root"), n_shared)
    classes = nodes.select("set_id", "least").join(final, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    classes = written(classes, "minmax-classes")
    least = written(classes.groupBy("root").agg(F.min("least").alias("component_id")), "minmax-least")
    by_set = written(classes.join(maybe_broadcast(least, least.count()), "root").select("set_id", "root", "component_id"), "minmax-component")
    out = rows.select("doc_id", "text_hash", "n", "set_id").join(by_set, "set_id", "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the least id (then text
    hash; null ids last).  Rows without words all stay."""
    found = written(near_duplicates(docs.select("doc_id", "text"), width, percent), "minmax-found")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first"))
    rest = found.join(first, "root").where(~order.eqNullSafe(F.col("first"))).select("doc_id", "text_hash").distinct()
    rest = written(rest, "minmax-dropped")
    d, x = docs.alias("d"), maybe_broadcast(rest, rest.count()).alias("x")
    kept = d.join(x, F.expr("d.doc_id <=> x.doc_id AND xxhash64(d.text) = x.text_hash"), "left_anti")
    repeated = found.where("root IS NOT NULL").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    if repeated.isEmpty():
        return kept
    row = kept.select(F.struct("*").alias("row"), F.col("d.doc_id").alias("key"), F.xxhash64("d.text").alias("hash"), F.col("d.text").alias("text"))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    one = row.where(worded).groupBy("key", "hash").agg(F.first("row").alias("row")).select("row.*")  # rows repeated whole
    return one.unionByName(row.where(~worded).select("row.*"))


def q_minmax(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
