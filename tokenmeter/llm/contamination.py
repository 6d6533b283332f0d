"""Benchmark decontamination by a distributed positional inverted index.

*Index.*  Every training text is cut into words once; the positions of words
that occur in the tests are stored as postings (document, term, position), with
one end posting per document that holds its number of words.  Words no test
uses can never match and are not stored.

*Search.*  A test window is a run of ``WINDOW`` consecutive words of an item (a
shorter item is one window); equal windows are searched once.  Counts over all
postings rank each window's terms from the rarest.  Offset-adjusted lists are
then intersected: postings of the rarest term give (document, start); those stay
whose second rarest term has a posting at its place; of the few left, all other
terms must have theirs.  With ``slop`` a term may lie that many words from its
place (proximity matches); 0 is the exact phrase.

Native only.  Broadcast are the tests' vocabulary and window ranks, and the ids
of documents still in play, each counted first; beyond the bound the same joins
shuffle.  Postings are keyed by document and position, so no key is hot however
frequent a word or passage is.

Defined results: a null text has no words; a null item id counts its windows'
words as hit but is not listed; rows that share an id are told apart by a hash
of their text, and rows repeated whole each get the same result; a null id is an
id; a very long text is read whole, its words are rows of their own; empty tables
give empty results, an empty benchmark no hits; other columns are not read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmeter.llm.common import ascii_lower, maybe_broadcast, text_of, written

WINDOW = 10
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands for the end of a document among the terms; no word holds it.
END = "\x00"
#: Key of a document: its id (this value for none) and its text's hash.
NO_ID = -(2**63)
KEY = ["key", "hash"]


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; the first and last may be empty."""
    return F.split(ascii_lower(text), SEPARATOR, -1)


def count_words(split: Column) -> Column:
    return F.size(F.filter(split, lambda w: w != ""))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, item_id, long, terms) of every window of ``items`` (item_id,
    text); ``window`` identifies its words."""
    w = items.select("item_id", F.filter(words(text_of(items)), lambda x: x != "").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    terms = w.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), size).alias("terms"))
    return terms.select(F.xxhash64("terms").alias("window"), "item_id", F.size("terms").alias("long"), "terms").distinct()


@dataclass
class Index:
    """Stored postings (doc_id, key, hash, tid, pos); tid 0 marks a document's
    end, with its number of words as position."""

    postings: DataFrame

    def ends(self) -> DataFrame:
        return self.postings.where("tid = 0")

    def terms(self) -> DataFrame:
        return self.postings.where("tid != 0")


def build_index(docs: DataFrame, vocabulary: DataFrame) -> Index:
    """Index ``docs`` (doc_id, text) for the words of ``vocabulary`` (term)."""
    known = vocabulary.select("term", F.xxhash64("term").alias("tid")).union(docs.sparkSession.createDataFrame([(END, 0)], "term string, tid bigint"))
    known = written(known, "contamination-terms")
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("hash"), words(text_of(docs)).alias("w"))
    n = F.size("w") - F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0) - F.when((F.size("w") > 1) & (F.element_at("w", -1) == ""), 1).otherwise(0)
    placed = split.select("doc_id", "hash", n.alias("n"), F.posexplode(F.concat("w", F.array(F.lit(END)))).alias("pos", "term"))
    rows = placed.join(maybe_broadcast(known, known.count()), "term")
    return Index(written(rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "hash", "tid", F.when(F.col("tid") == 0, F.col("n")).otherwise(F.col("pos")).alias("pos")),
                         "contamination-postings"))


def ranked(index: Index, windows: DataFrame) -> DataFrame:
    """(window, long, rank, tid, off): each window's terms from the rarest; none
    for a window that has a term without postings."""
    counts = index.terms().groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    placed = windows.select("window", "long", "terms").dropDuplicates(["window"]).select("window", "long", F.posexplode("terms").alias("off", "term"))
    placed = placed.select("window", "long", "off", F.xxhash64("term").alias("tid")).join(counts, "tid", "left")
    each = Window.partitionBy("window")
    return (placed.withColumn("rank", F.row_number().over(each.orderBy("n", "off"))).withColumn("have", F.count("n").over(each))
            .where("have = long").select("window", "long", "rank", "tid", "off"))


def matches(index: Index, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(key, hash, window, long, start) of every occurrence of a window."""
    terms = written(ranked(index, windows), "contamination-ranked")
    n = terms.count()
    of_rank = lambda r: maybe_broadcast(terms.where(F.col("rank") == r).select("window", "tid", "off"), n)

    def expected(found: DataFrame, ranks: DataFrame) -> DataFrame:
        at = found.join(ranks, "window")
        place = F.col("start") + F.col("off")
        return at.withColumn("pos", F.explode(F.sequence(place - slop, place + slop)) if slop else place)

    rarest = terms.where("rank = 1").select("window", "long", "tid", "off")
    first = index.terms().join(maybe_broadcast(rarest, n), "tid").select(*KEY, "window", "long", (F.col("pos") - F.col("off")).alias("start"))
    second = index.terms().join(maybe_broadcast(terms.where("rank = 2").select("tid").distinct(), n), "tid", "left_semi")
    both = expected(first.where("long > 1"), of_rank(2)).join(second, [*KEY, "tid", "pos"], "left_semi")
    both = both.select(*KEY, "window", "long", "start")
    left = written(both.union(first.where("long = 1")).distinct(), "contamination-candidates")

    in_play = written(left.where("long > 2").select(*KEY).distinct(), "contamination-in-play")
    rest = index.terms().join(maybe_broadcast(in_play, in_play.count()), KEY, "left_semi").select(*KEY, "tid", "pos").distinct()
    others = maybe_broadcast(terms.where("rank > 2").select("window", "tid", "off"), n)
    met = expected(left.where("long > 2"), others).join(rest, [*KEY, "tid", "pos"]).groupBy(*KEY, "window", "long", "start").agg(F.countDistinct("off").alias("met"))
    whole = met.where("met = long - 2").drop("met")
    return written(whole.union(left.where("long <= 2")), "contamination-matches")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, key, hash, n_words, n_hit, n_items, item_ids) of every row of
    ``docs``; item_ids are strings, sorted.  A document word inside any
    occurrence of a window is hit."""
    windows = written(item_windows(items, size), "contamination-windows")
    index = build_index(docs, windows.select(F.explode("terms").alias("term")).distinct())
    found = matches(index, windows, slop)
    hit = (found.select(*KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("long") - 1)).alias("pos")).distinct()
           .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit")))
    of_item = windows.select("window", F.col("item_id").cast("string").alias("item")).where("item IS NOT NULL").distinct()
    listed = (found.select(*KEY, "window").distinct().join(maybe_broadcast(of_item, of_item.count()), "window").select(*KEY, "item").distinct()
              .groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items")))
    per_doc = written(hit.join(listed, KEY, "left"), "contamination-documents")
    ends = index.ends().select("doc_id", *KEY, F.col("pos").alias("n_words"))
    out = ends.join(per_doc, KEY, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", *KEY, F.col("n_words").cast("bigint").alias("n_words"), zero("n_hit"), F.size(ids).cast("bigint").alias("n_items"), ids.alias("item_ids"))


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    found = contamination(docs.select("doc_id", "text"), items, size)
    bad = written(found.where("n_hit > 0").select("doc_id", "hash").distinct(), "contamination-dropped")
    d, x = docs.alias("d"), maybe_broadcast(bad, bad.count()).alias("x")
    return d.join(x, F.expr("d.doc_id <=> x.doc_id AND xxhash64(d.text) = x.hash"), "left_anti")


def q_decontamination(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sizes AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0
), bw AS (
  SELECT item_id, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(s) WHERE len(w) > 0
), dw AS (
  SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
  FROM d, sizes, unnest(generate_series(1, len(w) - k + 1)) AS t(s)
), hits AS (SELECT DISTINCT dw.doc_id, dw.s, dw.k, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k
), pos AS (SELECT doc_id, count(DISTINCT s + o) AS n_hit FROM hits, unnest(generate_series(0, k - 1)) AS t(o) GROUP BY doc_id
), ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
