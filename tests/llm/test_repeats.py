"""Suffix arrays and repeat removal against brute force."""

import hashlib
import random

import __spark_entry__ as E
from pyspark.sql import functions as F

from tokenmeter.llm import repeats as R
from tokenmeter.llm.suffixes import suffix_array


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(3000):
        s = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(40))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    fib = [0], [0, 1]
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    for s in (fib[1], [3] * 300, [1, 2] * 200, list(range(300)), list(range(300, 0, -1))):
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(texts, long):
    raws = [(t or "").encode() for t in texts]
    count = {}
    for r in raws:
        for i in range(len(r) - long + 1):
            count[r[i : i + long]] = count.get(r[i : i + long], 0) + 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - long + 1):
            if count[r[i : i + long]] > 1:
                gone[i : i + long] = b"\1" * long
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def rows_of(df):
    out = df.select("doc_id", "n_bytes", F.coalesce(F.size("spans"), F.lit(0)).alias("k"), "kept").collect()
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_bytes"] - len(r["kept"]), max(r["k"], 0), bytes(r["kept"])) for r in out)


def check(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, lo int")
    want = sorted((str(i), *b) for (i, _), b in zip(rows, brute([t for _, t in rows], how["long"])))
    assert rows_of(R.remove_repeats(docs, **how)) == want


def family(rng, n, letters="abcdefgh "):
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    base = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        t = base
        for _ in range(rng.randrange(0, 4)):
            p = rng.randrange(len(t))
            t = t[:p] + rng.choice(["", "é", "xyz", t[:30]]) + t[p + rng.randrange(0, 3) :]
        rows.append((i, t[rng.randrange(0, 60) : len(t) - rng.randrange(0, 60)]))
    return rows


def test_random_families(spark):
    rng = random.Random(2)
    rows = family(rng, 25) + family(rng, 10, "ab")
    check(spark, rows, long=40, anchor=10, group=1000)
    check(spark, rows, long=40, anchor=25, group=3)  # most anchors crowd: windows are counted
    check(spark, rows, long=40, anchor=40, group=1000)


def test_edge_rows(spark):
    s = "".join(random.Random(9).choice("abcdefghijk") for _ in range(900))
    rows = [(1, None), (1, ""), (2, "a" * 500), (3, "ab" * 400), (None, s), (4, "x" + s[100:500] + "y"), (5, s[:399]), (6, s[300:699] + "!"), (7, "é" * 300), (8, "é" * 199 + "xx"), (9, s[450:]),
            (10, "q" + s[500:899]), (11, "unique text"), (11, "unique text"), (12, s[::-1]), (12, s[::-1]), (13, "z" * 3000 + s[::-1][:400])]
    check(spark, rows, long=400, anchor=100, group=1000)
    assert R.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in E.queries()["op2_repeats"](spark, sf).collect()}
    for r, (n, gone, runs, kept) in zip(rows, brute([r["text"] for r in rows], 400)):
        assert got[r["doc_id"]] == (n, gone, runs, hashlib.sha256(kept).hexdigest())
    assert sum(v[1] for v in got.values()) > 0
