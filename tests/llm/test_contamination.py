"""The positional index against DuckDB and brute force."""

import re
import sys

import __spark_entry__ as E
from pyspark.sql import functions as F

from tokenmeter.llm import contamination as C

sys.path.insert(0, __file__.rsplit("/llm/", 1)[0])
from oracle_check import compare, duck  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = plain(text), set(), set()
        for item_id, t in items:
            x = plain(t)
            k = min(len(x), size)
            for s in range(max(len(x) - size + 1, 1) if x else 0):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == x[s : s + k]:
                        hit |= set(range(p, p + k))
                        ids |= {str(item_id)} if item_id is not None else set()
        out.append((str(doc_id), len(w), len(hit), ",".join(sorted(ids))))
    return sorted(out)


def test_query_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        r = compare(spark, "op1", E.queries()["op1_decontamination"], E.oracle_sql()["op1_decontamination"], sf, duck(sf))
        assert r["ok"], r


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "one"), (3, "Two, words"), (4, ""), (5, None), (None, "null item words"), (1, "alpha beta gamma"), (10, "the the the the"), (6, "Éa bç dé 12 34 x y z q r s t")]
DOCS = [(1, f"x {LONG.upper()}! y"), (2, "one one. ONE"), (3, "two words two\nwords"), (4, None), (5, ""), (5, "two words"), (5, "two words"), (None, "a null item words b"),
        (6, "the " * 9), (7, "alpha beta delta gamma"), (8, ".alpha beta gamma."), (9, "..."), (10, " ".join(LONG.split()[:9])), (11, " ".join(LONG.split()[3:14])),
        (12, "Éa bç dé 12 34 x y z q r s t éa bç"), (13, "z " * 60_000 + "alpha beta gamma"), (-(2**63), "two words")]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in DOCS], "doc_id long, text string, hash int")
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, window int")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], ",".join(r["item_ids"])) for r in C.contamination(docs, items).collect())
    assert got == brute(DOCS, ITEMS)
    none = C.contamination(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and all(r["n_hit"] == 0 for r in none)
    assert C.contamination(docs.limit(0), items).count() == 0


def test_shuffled_joins_agree(spark, monkeypatch):
    monkeypatch.setattr(C, "maybe_broadcast", lambda df, rows, bound=0: df)
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], ",".join(r["item_ids"])) for r in C.contamination(docs, items).collect())
    assert got == brute(DOCS, ITEMS)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha x beta gamma"), (3, "alpha x y z beta gamma"), (4, "beta gamma")], "doc_id long, text string")
    near = {r["doc_id"]: r["n_items"] for r in C.contamination(docs, items, slop=1).collect()}
    assert near == {1: 1, 2: 1, 3: 0, 4: 0}
    assert C.contamination(docs, items).where(F.col("n_hit") > 0).count() == 1
