"""Removal of repeated long substrings with suffix arrays.

Every byte covered by a ``LONG``-byte string that also starts anywhere else, in
the same document or another, is removed.

One suffix array of all texts has no place on a cluster, so texts are cut where
equal strings must meet.  Each window of ``LONG`` bytes is known by its anchor:
the ``ANCHOR``-byte string inside it with the least hash, leftmost on ties.
Equal windows have equal anchors at equal offsets.  Neighbouring windows with
one anchor form a stretch, and a stretch is one slim row: hash of the anchor,
128-bit hash of its bytes, its place.

1. Stretches whose anchor occurs once hold no repeat and go (a count).
2. Stretches that occur twice or more as a whole (counted by hash, so a passage
   with a third of all rows is pre-aggregated) are removed as they are.
3. Different stretches with one anchor overlap in part: one of each is cut from
   its text, the anchor is contracted to one symbol, and the group's suffix
   array is built by linear grouping (``suffixes.suffix_array``).  In a
   contracted stretch each window is ``LONG - ANCHOR + 1`` symbols; neighbours
   in the suffix array that agree in so many are repeats.
4. An anchor with more than ``GROUP`` different stretches is not gathered in a
   task: its windows are counted by their 128-bit hash, exactly and spread
   evenly.

Places are merged to spans per document; the texts meet their spans once.

Defined results: a null text is empty; texts shorter than ``LONG`` keep all
bytes; rows that share an id are told apart by a hash of their text, rows
repeated whole repeat each other's strings; a null id is an id; an empty table
gives an empty one; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, written
from tokenmeter.llm.suffixes import suffix_array

LONG = 400
ANCHOR = 100
GROUP = 1000
NO_ID = -(2**63)
KEY = ["key", "hash"]
STRETCH = "key bigint, hash bigint, anchor bigint, s1 bigint, s2 bigint, lo int, hi int, at int"
PLACE = "key bigint, hash bigint, lo int, hi int"


class Anchors:
    """Stretches of one text after the other, for one task."""

    def __init__(self, long: int, anchor: int):
        import numpy as np
        import xxhash

        self.np, self.long, self.k, self.w = np, long, anchor, long - anchor + 1
        self.digest = xxhash.xxh3_128_intdigest
        rng = np.random.default_rng(11)
        self.table = rng.integers(0, 2**64, 256, np.uint64)
        base = int(rng.integers(0, 2**64, dtype=np.uint64)) | 1
        self.base, self.back = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            n = max(n + 1, 2 * len(self.powers))
            steps = self.np.ones(n, self.np.uint64)
            steps[1:] = self.base
            self.powers = self.np.multiply.accumulate(steps)
            steps[1:] = self.back
            self.inverse = self.np.multiply.accumulate(steps)

    def hashes(self, raw: bytes):
        """A 64-bit hash of each ANCHOR-byte string, from prefix sums."""
        np, k, u = self.np, self.k, self.np.uint64
        n = len(raw)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[np.frombuffer(raw, np.uint8)] * self.powers[:n], out=sums[1:])
        x = (sums[k:] - sums[:-k]) * self.inverse[: n - k + 1]
        x = (x ^ (x >> u(32))) * u(0xD6E8FEB86659FD93)
        x = (x ^ (x >> u(32))) * u(0xD6E8FEB86659FD93)
        return x ^ (x >> u(32))

    def stretches(self, raw: bytes):
        """(anchor hashes, lo, hi, at): windows start from lo to hi - LONG and
        have their anchor at ``at``."""
        np, u = self.np, self.np.uint64
        if len(raw) < self.long:
            return None
        h = self.hashes(raw)
        low = (h & u(~0 << 31 & 2**64 - 1)) | np.arange(len(h), dtype=np.uint64)  # least hash, then leftmost
        width, span = 1, self.w
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low & u(2**31 - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        return h[at[first]], first, last + self.long, at[first]


def key_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("hash"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"))


def stretches(docs: DataFrame, long: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        own, names = Anchors(long, anchor), [c.split()[0] for c in STRETCH.split(", ")]
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for i in range(len(batch)):
                raw = (batch.column(2)[i].as_py() or "").encode("utf-8")
                if (found := own.stretches(raw)) is None:
                    continue
                h, lo, hi, at = found
                n = len(h)
                d = [own.digest(raw[a:b]) for a, b in zip(lo.tolist(), hi.tolist())]
                halves = np.array([(x >> 64, x & (2**64 - 1)) for x in d], np.uint64).view(np.int64)
                for c, v in zip(cols, (np.full(n, batch.column(0)[i].as_py()), np.full(n, batch.column(1)[i].as_py()), h.view(np.int64), halves[:, 0], halves[:, 1],
                                       lo.astype(np.int32), hi.astype(np.int32), at.astype(np.int32))):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

    return key_columns(docs).select(*KEY, "text").mapInArrow(run, STRETCH)


def cut(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The bytes of the ``needed`` stretches (anchor, rid, single, key, hash, lo,
    hi, at), one row each, taken from their texts."""
    per_doc = needed.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "rid", "single", "lo", "hi", "at")).alias("wanted"))
    per_doc = written(per_doc, "repeats-wanted")
    keyed = key_columns(docs).select(*KEY, "text").join(maybe_broadcast(per_doc, needed.count(), 500_000), KEY)
    raw = F.col("text").cast("binary")
    one = keyed.select(*KEY, raw.alias("raw"), F.explode("wanted").alias("w"))
    part = F.substring(F.col("raw"), F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo"))
    return one.select("w.anchor", "w.rid", "w.single", *KEY, "w.lo", (F.col("w.at") - F.col("w.lo")).alias("at"), part.alias("part"))


def grouped_repeats(parts: DataFrame, long: int, anchor: int) -> DataFrame:
    """PLACEs of the repeats that each anchor's group of stretches holds, from
    the suffix array of the group."""
    symbols = long - anchor + 1
    ANCHOR_FROM, SHIFT = 258, 2

    def solve(rows: list[tuple]) -> list[tuple]:
        text: list[int] = []
        valid, places, seen = [], [], {}
        for rid, single, key, hash_, lo, at, part in rows:
            mark = seen.setdefault(part[at : at + anchor], ANCHOR_FROM + len(seen))
            begin = len(text)
            text += [b + SHIFT for b in part[:at]]
            text.append(mark)
            text += [b + SHIFT for b in part[at + anchor :]]
            n = len(part) - long + 1
            valid += [True] * n + [False] * (len(text) - begin - n)
            places.append((begin, n, single, key, hash_, lo))
            text.append(1)
            valid.append(False)
        order = [i for i in suffix_array(text) if valid[i]]
        same = bytearray(len(text))
        as_text = "".join(map(chr, text))
        for p, q in zip(order, order[1:]):
            if as_text[p : p + symbols] == as_text[q : q + symbols]:
                same[p] = same[q] = 1
        out = []
        for begin, n, single, key, hash_, lo in places:
            run = same.find(1, begin, begin + n) if single else -1
            while run >= 0:
                stop = same.find(0, run, begin + n)
                stop = begin + n if stop < 0 else stop
                out.append((key, hash_, lo + run - begin, lo + stop - begin - 1 + long))
                run = same.find(1, stop, begin + n)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, out = None, {}, []
        flat = lambda o: pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*o), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["key", "hash", "lo", "hi"])
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for a, rid, *rest in zip(*cols):
                if a != last:
                    out += solve(list(rows.values())) if len(rows) > 1 else []
                    last, rows = a, {}
                rows.setdefault(rid, (rid, *rest))
            if len(out) > 10_000:
                yield flat(out)
                out = []
        out += solve(list(rows.values())) if len(rows) > 1 else []
        if out:
            yield flat(out)

    ordered = parts.select("anchor", "rid", "single", *KEY, "lo", "at", "part").repartition("anchor").sortWithinPartitions("anchor", "rid")
    return ordered.mapInArrow(run, PLACE)


def counted_repeats(parts: DataFrame, long: int) -> DataFrame:
    """PLACEs of the repeated windows of stretches whose anchors have too many
    for one task: windows are counted by their 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for i in range(len(batch)):
                key, hash_, lo, part = (batch.column(c)[i].as_py() for c in range(4))
                n = len(part) - long + 1
                d = [xxhash.xxh3_128_digest(part[j : j + long]) for j in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array([hash_] * n, pa.int64()), pa.array(range(lo, lo + n), pa.int32()), pa.array(d, pa.binary())], ["key", "hash", "lo", "window"])

    windows = written(parts.dropDuplicates(["rid"]).select(*KEY, "lo", "part").mapInArrow(run, "key bigint, hash bigint, lo int, window binary"), "repeats-windows")
    twice = written(windows.groupBy("window").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("window"), "repeats-twice")
    return windows.join(twice, "window").select(*KEY, "lo", (F.col("lo") + long).cast("int").alias("hi"))


def spans(places: DataFrame) -> DataFrame:
    """(key, hash, spans, n_spans, n_removed): places merged to maximal runs."""
    in_doc = Window.partitionBy(*KEY).orderBy("lo", "hi")
    before = F.max("hi").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = places.groupBy(*KEY, "lo").agg(F.max("hi").alias("hi"))
    runs = runs.withColumn("new", F.when(before.isNull() | (before < F.col("lo")), 1).otherwise(0))
    runs = runs.withColumn("run", F.sum("new").over(in_doc)).groupBy(*KEY, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def repeated_spans(docs: DataFrame, long: int = LONG, anchor: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """(key, hash, spans) of every document of ``docs`` (doc_id, text) that holds
    repeats; spans are byte ranges, ends exclusive."""
    every = written(stretches(docs, long, anchor).withColumn("rid", F.monotonically_increasing_id()), "repeats-stretches")
    again = written(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), (F.min("s1") != F.max("s1")).alias("differ")).where("k > 1").select("anchor", "differ"), "repeats-anchors")
    shared = written(every.join(again, "anchor"), "repeats-shared")
    kinds = written(shared.groupBy("anchor", "differ", "s1", "s2").agg(F.count(F.lit(1)).alias("k"), F.min("rid").alias("rid")), "repeats-kinds")
    whole = shared.join(kinds.where("k > 1").select("s1", "s2"), ["s1", "s2"]).select(*KEY, "lo", "hi")
    places = written(whole, "repeats-whole")

    mixed = kinds.where("differ").select("rid", (F.col("k") == 1).alias("single"))
    needed = written(shared.where("differ").join(mixed, "rid").select("anchor", "rid", "single", *KEY, "lo", "hi", "at"), "repeats-needed")
    crowd = written(needed.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > group).select("anchor"), "repeats-crowds")
    parts = written(cut(docs, needed), "repeats-parts")
    few = crowd.count()
    places = places.union(written(grouped_repeats(parts.join(maybe_broadcast(crowd, few), "anchor", "left_anti"), long, anchor), "repeats-grouped"))
    if few:
        places = places.union(written(counted_repeats(parts.join(maybe_broadcast(crowd, few), "anchor", "left_semi"), long), "repeats-counted"))
    return written(spans(places), "repeats-spans")


def remove_repeats(docs: DataFrame, long: int = LONG, anchor: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row; ``kept`` are the remaining
    bytes."""
    found = repeated_spans(docs, long, anchor, group)
    weight = found.agg(F.sum(F.size("spans") + 4)).first()[0] or 0  # one row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, cuts in zip(batch.column(2), batch.column(1)):
                raw, at, out = text.as_py().encode("utf-8"), 0, []
                for c in cuts.as_py() or ():
                    out.append(raw[at : c["lo"]])
                    at = c["hi"]
                out.append(raw[at:])
                kept.append(b"".join(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(t.as_py().encode("utf-8")) for t in batch.column(2)], pa.int64()), pa.array(kept, pa.binary())],
                                             ["doc_id", "spans", "n_bytes", "kept"])

    rows = key_columns(docs).join(maybe_broadcast(found, weight, 1_000_000), KEY, "left").select("doc_id", "spans", "text")
    return rows.mapInArrow(run, "doc_id bigint, spans array<struct<lo: int, hi: int>>, n_bytes bigint, kept binary")


def q_repeats(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_spans = F.coalesce(F.size("spans"), F.lit(0))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
                      F.greatest(n_spans, F.lit(0)).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
