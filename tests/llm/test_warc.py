"""WARC archives: SQL, exact round trip, global order, loser tree."""

import hashlib
import random
import sys

import __spark_entry__ as E
import pytest
from pyspark.sql import functions as F

from tokenmeter.llm import warc as W

sys.path.insert(0, __file__.rsplit("/llm/", 1)[0])
from oracle_check import compare, duck  # noqa: E402


def test_query_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        r = compare(spark, "op6", E.queries()["op6_warc"], E.oracle_sql()["op6_warc"], sf, duck(sf))
        assert r["ok"], r


def test_edge_rows_and_order(spark):
    big = "\r\n\r\nWARC/1.0\r\nContent-Length: 7\r\n\r\né" * 40
    rows = [(1, "http://a.com/x", big), (5, "http://b.a.com/", big), (3, None, big), (None, "http://a.com/x", big), (5, "http://b.a.com/", big), (7, "x\r\ny", None), (8, "", ""),
            (9, "http://z.org", "s" * 999), (10, "http://z.org", "s" * 999), (None, "n", "t" * 2000), (None, "n", "t" * 2000), (-4, "neg", "v" * 300_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    index = W.archive_index(spark, pages)
    got = index.collect()
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        last = max((q for q, _, g in rows if g == h and q is not None), default=None)
        revisit = len(raw) >= 1000 and last is not None and p != last
        want.append((str(p), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(want, key=lambda w: (w[0], w[1], w[2]))
    order = [(r["urlkey"].encode(), r["ts"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert order == sorted(order)
    assert W.archive_index(spark, pages.limit(0)).count() == 0


def test_archives_hold_the_payloads(spark, tmp_path):
    path = W.write_archives(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), f"{tmp_path}/w", archive_bytes=50_000)
    files = {str(f): f.read_bytes() for f in tmp_path.glob("w/*/part-*")}
    assert len(files) > 1
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in W.read_archives(spark, path).collect():
        data = next(b for n, b in files.items() if n.rsplit("/", 2)[1:] == r["archive"].rsplit("/", 2)[1:])
        rec = data[r["offset"] : r["offset"] + r["long"]]
        assert rec.startswith(b"WARC/1.0\r\n") and rec.endswith(b"\r\n\r\n")
        if r["record_type"] == "response":
            assert rec[-4 - r["payload_bytes"] : -4].decode() == pages[r["page_id"]]


def test_damaged_payload_is_noticed():
    good = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: d\r\nWARC-Target-URI: u\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 40\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nab"
    data = good.replace(b"40", str(len(block)).encode()) % hashlib.sha1(b"ab").hexdigest().encode() + block + b"\r\n\r\n"
    assert W.parse("a", data)[0][5] == 2
    with pytest.raises(ValueError):
        W.parse("a", data.replace(b"\r\n\r\nab", b"\r\n\r\nax"))


def test_loser_tree():
    rng = random.Random(1)
    for k in range(0, 12):
        runs = [sorted((rng.randrange(30),) for _ in range(rng.randrange(0, 15))) for _ in range(k)]
        assert list(W.LoserTree(runs)) == sorted(sum(runs, []))


def test_archives_are_cut_by_bytes(spark, tmp_path):
    """A stretch of large pages after many small ones does not swell a file."""
    rows = [(i, f"http://a.org/{i}", "s" * 10) for i in range(3000)] + [(9000 + i, f"http://b.org/{i}", chr(97 + i % 26) * (20_000 + i)) for i in range(60)] + [(9999, "http://c.org", "z" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = W.write_archives(pages, f"{tmp_path}/w", archive_bytes=100_000)
    sizes = sorted(f.stat().st_size for f in tmp_path.glob("w/*/part-*"))
    assert sizes[-1] > 400_000 and sizes[-2] <= 100_000 and len(sizes) > 15
    assert W.merged(W.read_archives(spark, path)).count() == len(rows)


def test_block_merge_holds_one_block_a_run():
    rng = random.Random(2)
    runs = [sorted((rng.randrange(10**6), r, i) for i in range(500)) for r in range(7)]
    runs[6] = [(5, 6, i) for i in range(500)]  # one value
    blocks = sorted((run[i], n, run[i : i + 16]) for n, run in enumerate(runs) for i in range(0, 500, 16))
    merge, out = W.BlockMerge(), []
    for head, n, block in blocks:
        out.extend(merge.below(head))
        for e in block:
            merge.add(n, e)
    out.extend(merge.below(None))
    assert out == sorted(sum(runs, [])) and merge.most <= 7 * 16


def test_several_passes(spark):
    """Blocks of 4 entries, 3 runs at a time, a third of the rows of one key."""
    rng = random.Random(4)
    runs = [(f"a{k:02d}", None if rng.random() < 0.3 else rng.randrange(40), rng.choice(["hot)/", "hot)/", "é)/", "b)/x"]), i) for k in range(20) for i in range(30)]
    rows = [(a, u, "t" if p is None else f"t{p % 3}", p, "u", "response", "d", 1, None, i, 2) for a, p, u, i in runs]
    df = spark.createDataFrame(rows, W.INDEX).repartition(4, "archive").sortWithinPartitions("archive", *W.ORDER, "offset")
    order = lambda r: W.sort_key(r["urlkey"], r["ts"], r["page_id"], r["archive"], r["offset"])
    for block, fan_in in ((4, 3), (1, 2), (1024, 64)):
        got = W.merged(df, block, fan_in).collect()
        assert [order(r) for r in got] == sorted(order(r) for r in df.collect())
        assert sorted(map(str, got)) == sorted(map(str, df.collect()))


def test_url_key(spark):
    df = spark.createDataFrame([("http://www.B.example.com/p?q",), ("https://example.com",), ("",)], "u string").select(W.url_key(F.col("u")))
    assert [r[0] for r in df.collect()] == ["com,example,b)/p?q", "com,example)", ")"]
