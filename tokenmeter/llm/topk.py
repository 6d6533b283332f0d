"""Exact top-k search by inner product of integer vectors.

Components are scaled and floored to integers, so scores are integers; only
vectors with the same number of components meet.

1. *Rotation.*  The leading directions of the vectors (singular vectors of a
   sample of at most about ``FIT`` per number of components) order what is
   summed first.  They decide how early a pair is given up, never a result:
   any directions give the same rows.
2. *Seed.*  Every query meets the ``HEAD`` longest vectors; its k-th best score
   there is a floor for what the search must return.
3. *Search.*  Vectors are dealt to stripes of about ``STRIPE`` and queries, by
   the length a vector needs to reach their floor, to blocks of about ``BLOCK``.
   A vector goes only to the blocks it is long enough for (Cauchy-Schwarz).  A
   task reads its queries, then its vectors by descending length, and stops when
   no query can be reached any more.  For the others the leading rotated
   products are summed and a pair goes as soon as that sum and the product of
   the two residual lengths stay below the query's floor.  What is left is
   scored exactly, and raises the floor.
4. The best of all stripes are ranked per query.

A task streams: it holds one block of queries and one batch of vectors.  Copies
of a vector are dealt over all stripes.

Defined results: vectors that are null or hold null or non-finite components
(also once scaled) take no part; zero and empty vectors do, with score 0; equal
scores go to the smaller vec_id (null last); repeated rows are vectors of their
own, and a query leaves out its own row only; a null vec_id is no query; scores
beyond 64 bits are given as the nearest long; an empty table gives an empty one;
other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmeter.llm.common import numbered, release, table, written

K = 5
EVERY = 50
SCALE = 256
HEAD = 1_000
BLOCK, STRIPE = 4_096, 16_384
FIT, LENGTHS = 20_000, 8
#: Leading rotated components summed before each test.
STEPS = (8, 32)
#: Share of a batch's pairs left from which on whole products are cheaper.
DENSE = 0.05
EXACT = 2.0**53
LONG = 2**63 - 1

ROWS = "long int, part bigint, block bigint, role int, row bigint, vec_id bigint, vector array<double>, size double, least double"


def integer_rows(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, vector, long, size) of the vectors that take part; ``size``
    is the Euclidean length.  Written: row numbers stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            lists = batch.column(1)
            many = np.asarray(lists.value_lengths().fill_null(-1)).astype(np.int64)
            begin = np.cumsum(np.maximum(many, 0)) - np.maximum(many, 0)
            flat = np.asarray(lists.flatten().cast(pa.float64()).fill_null(float("nan")))
            for d in np.unique(many[many >= 0]).tolist():
                at = np.flatnonzero(many == d)
                with np.errstate(over="ignore"):
                    x = np.floor(flat[begin[at][:, None] + np.arange(d)] * float(scale))
                good = np.isfinite(x).all(axis=1)
                at, x = at[good], x[good] + 0.0  # no negative zero
                largest = np.maximum(np.abs(x).max(axis=1, initial=0.0), 1.0)
                size = np.sqrt(((x / largest[:, None]) ** 2).sum(axis=1)) * largest
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * d, pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), vectors, pa.array(np.full(len(at), d), pa.int32()), pa.array(size)], names)
        release()

    names = ["vec_id", "vector", "long", "size"]
    given = rows.select(rows["vec_id"].cast("bigint"), rows["embedding"])
    ints = given.mapInArrow(run, "vec_id bigint, vector array<double>, long int, size double")
    return written(ints.select(F.monotonically_increasing_id().alias("row"), *names), "topk-vectors")


def leading_directions(vectors: DataFrame, counts: list, fit: int = FIT) -> dict:
    """Orthonormal columns for each of the ``LENGTHS`` commonest numbers of
    components; none for the rest, which then are tested by length alone."""

    def svd(key, rows):
        import numpy as np

        d = key[0].as_py()
        x = matrix(rows.column("vector"), d)
        x = x / max(np.abs(x).max(), 1.0)
        basis = np.linalg.svd(x.T @ x)[0][:, : max(STEPS)]
        return pa.table({"long": pa.array([d], pa.int32()), "basis": pa.array([basis.ravel().tolist()], pa.list_(pa.float64()))})

    top = [r for r in counts if r["long"] > max(STEPS)][:LENGTHS]
    if not top:
        return {}
    share = F.lit(0)
    for r in top:
        share = F.when(F.col("long") == r["long"], min(1_000_000, -(-1_000_000 * fit // r["n"]))).otherwise(share)
    picked = vectors.where(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < share).select("long", "vector")
    import numpy as np

    bases = picked.groupBy("long").applyInArrow(svd, "long int, basis array<double>").collect()
    return {r["long"]: np.array(r["basis"]).reshape(r["long"], -1) for r in bases}


def matrix(column, d: int):
    """Rows of ``d`` numbers each."""
    import numpy as np

    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [np.asarray(c.flatten(), np.float64) for c in chunks]
    return (np.concatenate(parts) if parts else np.empty(0)).reshape(-1, d) if d else np.empty((len(column), 0))


class Search:
    """The queries of one block, their floors and best hits so far."""

    def __init__(self, batches: list[pa.RecordBatch], d: int, k: int, basis):
        import numpy as np

        self.np, self.d, self.k, self.basis = np, d, k, basis
        rows = pa.Table.from_batches(batches)
        self.vec_id, self.row, self.x = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy(), matrix(rows.column("vector"), d)
        self.size, self.least = rows.column("size").to_numpy(), rows.column("least").to_numpy().copy()
        self.turned, self.rest = self.rotate(self.x, self.size)
        self.largest = float(np.abs(self.x).max()) if self.x.size else 0.0
        self.best: list[list] = [[] for _ in self.vec_id]  # (-score, no id, id), best first

    def rotate(self, x, size):
        """Leading rotated components and, per step, the length of the rest."""
        np = self.np
        if self.basis is None or not size.max(initial=0.0) < 1e150:  # squares of lengths must stay finite
            return None, [size]
        turned = x @ self.basis
        rest = [np.sqrt(np.maximum(0.0, size**2 - (turned[:, :s] ** 2).sum(axis=1)) + 1e-9 * size**2) for s in STEPS]
        return turned, [size, *rest]

    def reachable(self, longest: float):
        """Queries that a vector of this length may still reach."""
        return self.np.flatnonzero(self.size * longest * (1 + 1e-9) >= self.least)

    def meet(self, batch: pa.RecordBatch) -> bool:
        """Score a batch of vectors, longest first; false when no query can be
        reached from here on."""
        np = self.np
        size = batch.column("size").to_numpy()
        live = self.reachable(float(size[0]))
        if not len(live):
            return False
        x = matrix(batch.column("vector"), self.d)
        turned, rest = self.rotate(x, size)
        cols = np.arange(len(size))
        floor, slack = self.least[live][:, None], 1e-9 * np.outer(self.size[live], size)
        left = np.outer(self.size[live], size) + slack >= floor
        if turned is not None and self.turned is not None:
            dot, at = np.zeros(left.shape), 0
            for step, mine, theirs in zip(STEPS, self.rest[1:], rest[1:]):
                dot += self.turned[live, at:step] @ turned[:, at:step].T
                left &= dot + np.outer(mine[live], theirs) + slack >= floor
                at = step
        i, j = np.nonzero(left)
        largest = float(np.abs(x).max()) if x.size else 0.0
        if self.largest * largest * max(1, self.d) >= EXACT:
            score = [min(max(sum(int(a) * int(b) for a, b in zip(self.x[live[u]], x[v])), -LONG - 1), LONG) for u, v in zip(i, j)]
        elif len(i) > DENSE * left.size:
            score = (self.x[live] @ x.T)[i, j].astype(np.int64)
        else:
            score = np.concatenate([np.einsum("nd,nd->n", self.x[live[i[a : a + 65536]]], x[j[a : a + 65536]]) for a in range(0, len(i), 65536)] or [np.empty(0)]).astype(np.int64)
        self.keep(live[i], cols[j], np.asarray(score, dtype=np.int64), batch)
        return True

    def keep(self, query, col, score, batch) -> None:
        np = self.np
        rows, ids = batch.column("row").to_numpy(), batch.column("vec_id")
        none = np.asarray(ids.is_null())
        ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        good = (rows[col] != self.row[query]) & (score >= self.least[query])
        query, col, score = query[good], col[good], score[good]
        order = np.lexsort((ids[col], none[col], -score, query))
        query, col, score = query[order], col[order], score[order]
        first = np.searchsorted(query, query)  # only the k best of each query
        top = np.arange(len(query)) - first < self.k
        for q, c, s in zip(query[top].tolist(), col[top].tolist(), score[top].tolist()):
            self.best[q].append((-s, bool(none[c]), int(ids[c])))
        for q in np.unique(query).tolist():
            self.best[q] = sorted(self.best[q])[: self.k]
            if len(self.best[q]) == self.k:
                self.least[q] = max(self.least[q], float(-self.best[q][-1][0]))

    def found(self, long: int, part: int) -> Iterator[pa.RecordBatch]:
        rows = [(int(r), int(v), -s, None if none else i) for r, v, best in zip(self.row, self.vec_id, self.best) for s, none, i in best]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "query_id", "score", "vec_id"])


def met(tasks: DataFrame, partitions: int, k: int, bases: dict) -> DataFrame:
    """(row, query_id, score, vec_id): the k best of every query in every (long,
    part, block) of ``tasks``, whose queries have role 0 and vectors role 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        key, queries, search, over = None, [], None, False
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("long", "part", "block", "role")]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if a == b:
                    continue
                piece, mine = batch.slice(a, b - a), tuple(int(c[a]) for c in cols)
                if mine[:3] != key:
                    if search is not None:
                        yield from search.found(*key[:2])
                    key, queries, search, over = mine[:3], [], None, False
                if mine[3] == 0:
                    queries.append(piece)
                elif queries and not over:
                    if search is None:
                        search = Search(queries, key[0], k, bases.get(key[0]))
                    for s in range(0, len(piece), 2_048):
                        if not search.meet(piece.slice(s, 2_048)):
                            over = True
                            break
        if search is not None:
            yield from search.found(*key[:2])
        queries = search = None
        release()

    keys = ["long", "part", "block"]
    dealt = tasks.repartition(max(1, partitions), *keys).sortWithinPartitions(*keys, "role", F.desc("size"))
    return dealt.mapInArrow(run, "row bigint, query_id bigint, score bigint, vec_id bigint")


def as_rows(df: DataFrame, part: Column, block: Column, role: int, least: Column | None = None) -> DataFrame:
    zero = F.lit(float("-inf"))
    return df.select("long", part.cast("bigint").alias("part"), block.cast("bigint").alias("block"), F.lit(role).alias("role"), "row", "vec_id", "vector", "size",
                     (zero if least is None else least).alias("least"))


def best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, head: int = HEAD, block: int = BLOCK, stripe: int = STRIPE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose vec_id is divisible
    by ``every`` its k best among all other rows."""
    vectors = integer_rows(rows, scale)
    counts = vectors.groupBy("long").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q"))
    counts = written(counts, "topk-counts")  # a row per number of components
    common = counts.orderBy(F.desc("n"), "long").limit(LENGTHS).collect()
    bases = leading_directions(vectors, common)
    n, q = counts.agg(F.sum("n"), F.sum("q")).first()
    q_blocks, stripes = -(-(q or 0) // block), -(-(n or 0) // stripe)
    queries = vectors.where(F.col("vec_id") % every == 0)

    # Seed: the k-th best score among the longest vectors.
    longest = F.row_number().over(Window.partitionBy("long").orderBy(F.desc("size"), "row"))
    heads = vectors.withColumn("__nth", longest).where(F.col("__nth") <= head).drop("__nth")
    heads = heads.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(max(1, q_blocks) - 1))))
    seeds = as_rows(queries, F.lit(0), F.pmod(F.xxhash64("row"), F.lit(max(1, q_blocks))), 0)
    seeded = best_of(met(seeds.union(as_rows(heads, F.lit(0), F.col("b"), 1)), min(2_000, max(1, q_blocks)), k, bases), k)
    floors = seeded.where(F.col("rank") == k).select("row", F.col("score").cast("double").alias("floor"))
    need = F.when(F.col("size") > 0, F.col("floor") / F.col("size") * (1 - 1e-6)).otherwise(F.when(F.col("floor") > 0, float("inf")).otherwise(float("-inf")))
    floored = queries.join(floors, "row", "left").withColumn("least", F.coalesce("floor", F.lit(float("-inf"))))
    floored = floored.withColumn("need", F.coalesce(F.when(F.col("floor") > 0, need), F.lit(float("-inf"))))

    # Query blocks of like need: ``block`` rows each.
    floored = numbered(floored, ["long"], ["need", "row"], "topk-queries").withColumn("b", F.floor(F.col("id") / block)).drop("id")
    cuts = floored.groupBy("long", "b").agg(F.min("need").alias("need"))  # a row per block: the least length it takes
    cuts = cuts.groupBy("long").agg(F.sort_array(F.collect_list(F.struct("need", "b"))).alias("cuts"))
    parts = F.sequence(F.lit(0), F.lit(max(1, stripes) - 1))
    asked = as_rows(floored.withColumn("p", F.explode(parts)), F.col("p"), F.col("b"), 0, F.col("least"))
    taken = F.filter("cuts", lambda c: c["need"] <= F.col("size") * (1 + 1e-6))
    given = vectors.join(cuts, "long").select("row", "vec_id", "vector", "size", "long", F.explode(F.transform(taken, lambda c: c["b"])).alias("b"))
    given = as_rows(given, F.pmod(F.xxhash64("row"), F.lit(max(1, stripes))), F.col("b"), 1)
    tasks = max(1, q_blocks) * max(1, stripes)
    found = best_of(met(asked.union(given), min(4_000, tasks), k, bases), k)
    return found.select("query_id", "rank", "vec_id", "score")


def q_topk(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE = """WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""
