"""Source divergence audit: how far the sources of a language differ in their
use of words, exactly and over all documents.

Each language keeps the terms that at least ``LEAST_DOCS`` of its documents
hold.  A (language, source) group gives each kept term a smoothed share of its
words in billionths; two groups differ in a term by f = floor((p-q)^2 / (p+q)).

1. *Counts.*  Tasks count terms per group, flushing at ``FLUSH`` entries; the
   pre-aggregated rows are summed by group and term.
2. *Term ids.*  Kept terms are numbered within their language by descending
   count, on top of the sizes of a range sort: no task holds a language.
3. *Trees.*  The counts of a group over ``WIDTH`` term ids are the leaves of a
   perfect binary tree.  Trees are hash-consed: at every height equal pairs of
   children share one node, within a group and across groups, and a stretch of
   terms a group lacks is the one empty node of that height.
4. *Traversal.*  Two trees are walked down together.  Price depends on the two
   counts (and the groups' totals) alone, so equal node pairs of two groups are
   expanded once and carry how often they occur; only distinct leaf pairs are
   priced.

A task holds one range of term ids and two chunks of about ``GROUPS`` groups;
pairs are walked ``PAIRS`` at a time.  A group with a third of all words is a
row of at most ``WIDTH`` counts per range, like any other.

Defined results: null text, language and source read as ''; a group without
terms still has its pairs; a language without kept terms has pairs of value 0;
repeated rows count as documents of their own; texts of any length are read
whole (in pieces); an empty table gives an empty one; other columns are not
read.  Sums are exact while a language has under 9e15 words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmeter.llm.common import numbered, release, table, written

LEAST_DOCS = 10
TOP_TERMS = 10
HEIGHT = 14
WIDTH = 1 << HEIGHT
GROUPS = 64
PAIRS = 64
FLUSH = 300_000
PIECE = 4_000_000
#: Most tasks that the walk is dealt to.
TASKS = 4_000

#: Separators become spaces and A-Z lower case; all other bytes stay, so a term
#: is a run of ASCII letters and bytes of non-ASCII characters.
AS_TERMS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b > 0x7F or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of one text, piece by piece."""
    data, begin = text.translate(AS_TERMS), 0
    while begin < len(data):
        end = len(data) if len(data) - begin <= PIECE else data.find(b" ", begin + PIECE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) summed over all rows; one row with a null
    term for each group that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush():
            for (lang, source), (n, in_docs) in held.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([source] * (len(terms) + 1), pa.string()),
                    pa.array([None, *terms], pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(in_docs.__getitem__, terms)], pa.int64())], ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in held:
                    held[key] = Counter(), Counter()
                n, in_docs = held[key]
                before, seen = len(n), set()
                for terms in pieces(texts[i].as_py()):
                    n.update(terms)
                    seen.update(terms)
                in_docs.update(seen)
                size += len(n) - before
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()
        release()

    blank = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias(c)
    parts = docs.select(blank("lang"), blank("source"), blank("text")).mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count, words):
    """1 + floor(10^9 (count + 2) / words), by long division in steps of 1,000:
    exact in 64 bits."""
    rest, p = count + 2, 0
    for _ in range(3):
        rest = rest * 1000
        p, rest = p * 1000 + rest // words, rest % words
    return p + 1


def price(p, q):
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed count trees of several groups over one range of term ids.
    ``below[h]`` holds the two children of every node of height h + 1; node 0 is
    the empty tree of its height."""

    def __init__(self, group, place, count, n_groups: int, height: int = HEIGHT):
        import numpy as np

        self.np = np
        order = np.lexsort((place, group))
        group, place = group[order], place[order]
        self.counts, node = np.unique(np.concatenate(([0], count[order])), return_inverse=True)
        node, self.below = node[1:], []
        for _ in range(height):
            up, half = place >> 1, place & 1
            new = np.ones(len(up), bool)
            new[1:] = (group[1:] != group[:-1]) | (up[1:] != up[:-1])
            at = np.cumsum(new) - 1
            child = np.zeros((2, at[-1] + 1 if len(at) else 0), np.int64)
            child[half, at] = node
            group, place = group[new], up[new]
            most = (int(child.max()) + 1) if child.size else 1
            made, node = np.unique(np.concatenate(([0], child[0] * most + child[1])), return_inverse=True)
            node = node[1:]
            self.below.append((made // most, made % most))
        self.root = np.zeros(n_groups, np.int64)
        self.root[group] = node

    def leaf_pairs(self, one, two):
        """For pairs of groups walked down together: (pair, count, count, times)
        of every distinct pair of leaves, in order of pairs."""
        np = self.np
        pair, x, y, times = np.arange(len(one)), self.root[one], self.root[two], np.ones(len(one), np.int64)
        for left, right in reversed(self.below):
            pair, times = np.concatenate((pair, pair)), np.concatenate((times, times))
            x, y = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y]))
            pair, x, y, times = self.once(pair, x, y, times)
        return pair, self.counts[x], self.counts[y], times

    def once(self, pair, x, y, times):
        np = self.np
        a, b = int(x.max()) + 1, int(y.max()) + 1
        key = (pair * a + x) * b + y
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, times = key[first], np.add.reduceat(times[order], first)
        return key // (a * b), key // b % a, key % b, times


def walk(key, rows: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """All pairs of groups between two chunks over one range of term ids, and
    each group's best terms there against the language (ties kept)."""
    import numpy as np

    lang, block, one_chunk, two_chunk = (k.as_py() for k in key)
    leaves = rows.column("leaves").combine_chunks()
    leaves = leaves if isinstance(leaves, pa.ListArray) else leaves.chunk(0)
    sizes = np.asarray(leaves.value_lengths().fill_null(0))
    flat = leaves.flatten()
    place, count = (np.asarray(flat.field(k)).astype(np.int64) for k in (0, 1))
    place = place - block * WIDTH
    group = np.repeat(np.arange(len(sizes)), sizes)
    chunk = rows.column("chunk").to_numpy()  # the language itself: -1
    words = rows.column("words").to_numpy() + 2 * rows.column("kept").to_numpy()
    sources = rows.column("source").to_pylist()
    width = min(WIDTH, max(0, rows.column("kept")[0].as_py() - block * WIDTH))
    out: dict[str, list] = {c: [] for c in ("source", "other", "id", "value")}
    forest = Forest(group, place, count, len(sizes))

    by_name = sorted((i for i in range(len(sources)) if chunk[i] >= 0), key=lambda i: sources[i].encode())
    in_one, in_two = ([i for i in by_name if chunk[i] == c] for c in (one_chunk, two_chunk))
    pairs = [(i, j) for at, i in enumerate(in_one) for j in (in_two[at + 1 :] if one_chunk == two_chunk else in_two)]
    for begin in range(0, len(pairs), PAIRS):
        one, two = np.array(pairs[begin : begin + PAIRS]).T
        if width:
            pair, x, y, times = forest.leaf_pairs(one, two)
            times = times - np.where((x == 0) & (y == 0), WIDTH - width, 0)  # places beyond the last term
            f = price(shares(x, words[one][pair]), shares(y, words[two][pair])) * times
            value = np.add.reduceat(f, np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))))
        else:
            value = np.zeros(len(one), np.int64)
        out["source"] += [sources[i] for i in one]
        out["other"] += [sources[j] for j in two]
        out["id"] += [None] * len(one)
        out["value"] += value.tolist()

    if one_chunk == two_chunk and width:
        whole = int(np.flatnonzero(chunk < 0)[0])
        total = np.zeros(WIDTH, np.int64)
        total[place[group == whole]] = count[group == whole]
        for i in in_one:
            mine = np.flatnonzero((group == i) & (count > 0))
            base = int(total.max()) + 1
            kinds, at = np.unique(count[mine] * base + total[place[mine]], return_inverse=True)
            p, q = shares(kinds // base, words[i]), shares(kinds % base, words[whole])
            f = np.where(p > q, price(p, q), -1)[at]
            if len(f) > top:
                keep = f >= max(0, np.partition(f, len(f) - top)[len(f) - top])
            else:
                keep = f >= 0
            out["source"] += [sources[i]] * int(keep.sum())
            out["other"] += [None] * int(keep.sum())
            out["id"] += (place[mine][keep] + block * WIDTH).tolist()
            out["value"] += f[keep].tolist()
    n = len(out["value"])
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "source": pa.array(out["source"], pa.string()), "other": pa.array(out["other"], pa.string()),
                     "id": pa.array(out["id"], pa.int64()), "value": pa.array(out["value"], pa.int64())})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, groups_a_chunk: int = GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' values every other
    source of the language, part 'term' lists the ``top`` terms that the group
    uses more than its language does.  Ties go to the lesser item."""
    counts = written(term_counts(docs), "divergence-counts")
    terms = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    terms = numbered(terms.select("lang", "term", "total"), ["lang"], [F.desc("total"), "term"], "divergence-terms")
    kept = written(terms, "divergence-kept")
    leaf = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "id", "n"), "divergence-leaves")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_words"))
    groups = counts.where("term IS NULL").select("lang", "source")
    per_lang = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / groups_a_chunk).alias("chunks")).join(langs, "lang", "left").fillna(0, ["kept", "lang_words"])
    words = leaf.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = groups.join(words, ["lang", "source"], "left").fillna(0, ["words"]).join(per_lang, "lang")
    groups = groups.withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")))
    wholes = per_lang.select("lang", F.lit(None).cast("string").alias("source"), F.col("lang_words").alias("words"), "chunks", "kept", "lang_words", F.lit(-1).cast("bigint").alias("chunk"))
    members = groups.select(wholes.columns).union(wholes)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("kept") / WIDTH), F.lit(1).cast("bigint")) - 1)
    members = members.withColumn("block", F.explode(blocks))

    def bounded(rows: DataFrame, count: str) -> DataFrame:
        """At most WIDTH leaves a row."""
        block = F.floor(F.col("id") / WIDTH).alias("block")
        return rows.groupBy("lang", "source", block).agg(F.collect_list(F.struct("id", F.col(count).alias("n"))).alias("leaves"))

    ranges = bounded(leaf, "n").union(bounded(kept.withColumn("source", F.lit(None).cast("string")), "total"))
    same = members["lang"].eqNullSafe(ranges["lang"]) & members["source"].eqNullSafe(ranges["source"]) & (members["block"] == ranges["block"])
    members = members.join(ranges, same, "left").select(*[members[c] for c in members.columns], "leaves")
    each = F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)
    meet = lambda k: F.struct(F.when(F.col("chunk") < 0, k).otherwise(F.least("chunk", k)).alias("one"), F.greatest("chunk", k).alias("two"))
    tasks = per_lang.agg(F.sum(F.greatest(F.ceil(F.col("kept") / WIDTH), F.lit(1)) * F.col("chunks") * (F.col("chunks") + 1) / 2)).first()[0]
    keys = ["lang", "block", "one", "two"]
    dealt = members.withColumn("meet", F.explode(F.transform(each, meet))).select("lang", "block", "meet.one", "meet.two", "source", "chunk", "words", "kept", "leaves")
    dealt = dealt.repartition(max(1, min(TASKS, int(tasks or 0))), *keys)

    def walked(key, rows):
        return walk(key, rows, top)

    priced = written(dealt.groupBy(*keys).applyInArrow(walked, "lang string, source string, other string, id bigint, value bigint"), "divergence-priced")
    half = priced.where("other IS NOT NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    pairs = half.withColumn("way", F.explode(F.array(F.lit(0), F.lit(1))))
    end = lambda a, b: F.when(F.col("way") == 0, F.col(a)).otherwise(F.col(b))
    pairs = pairs.select("lang", end("source", "other").alias("source"), F.lit("pair").alias("part"), end("other", "source").alias("item"), "value")
    listed = priced.where("other IS NULL").join(kept.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
    listed = listed.select("lang", "source", F.lit("term").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).union(listed.withColumn("rank", rank).where(F.col("rank") <= top))


def q_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLE = r"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT lang, source, r, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
gc AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
lc AS (SELECT lang, term, CAST(sum(c) AS BIGINT) AS c FROM gc GROUP BY lang, term),
lv AS (SELECT lang, count(*) AS v, CAST(sum(c) AS BIGINT) AS n FROM lc GROUP BY lang),
g AS (SELECT lang, source FROM d GROUP BY lang, source),
gn AS (SELECT g.lang, g.source, CAST(coalesce(sum(c), 0) AS BIGINT) AS n FROM g LEFT JOIN gc USING (lang, source) GROUP BY g.lang, g.source),
p AS (
  SELECT gn.lang, gn.source, lc.term, coalesce(gc.c, 0) AS c,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(gc.c, 0) + 2)) // (gn.n + 2 * lv.v) AS BIGINT) AS p,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (lc.c + 2)) // (lv.n + 2 * lv.v) AS BIGINT) AS q
  FROM gn JOIN lv USING (lang) JOIN lc USING (lang) LEFT JOIN gc ON gc.lang = gn.lang AND gc.source = gn.source AND gc.term = lc.term),
priced AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(priced.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced ON priced.lang = a.lang AND priced.source = a.source AND priced.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY rank <= 10"""
