"""Secret scans and URL filters against plain Python."""

import hashlib
import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from tokenmeter.llm import secrets, urls

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
SF = "/root/testdata/sf0.001"


def base_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def test_secret_query_rows(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = {r["doc_id"]: r for r in E.queries()["op5_secret_scans"](spark, sf).collect()}
        rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
        assert len(got) == len(rows)
        for r in rows:
            want, g = base_spans(r["text"] or ""), got[r["doc_id"]]
            assert g["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
            assert [g["n_assign"], g["n_access"], g["n_hex"]] == [sum(s[1] == k for s in want) for k in range(3)]
    assert sum(r["n_hex"] + r["n_assign"] + r["n_access"] for r in got.values()) > 0


HARD = ["", None, "token=abc token = \"abcdef\" x", "SECRET: 'a\U0001f600b' api_key=ABC.def-123", "é" * 5 + "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 11,
        "0123456789abcdef" * 4 + "\n" + "f" * 23, "password:=x secret=token=abcdef", "api-key=abcdefgh apikey='abcdefgh'", "tokenſ=abcdefg", "a" * 24,
        "-----BEGIN RSA PRIVATE KEY-----", "x" * 50_000 + " token=0123456789abcdef0123456789abcdef"]


def test_secret_edge_rows(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)] + [(None, HARD[3]), (3, HARD[3]), (0, HARD[2])], "path long, text string")
    got = sorted((str(r["path"]), joined((s["start"], 0, s["kind"], s["end"]) for s in r["spans"] if s["base"])) for r in secrets.scan_paths(spark, docs).collect())
    assert got == sorted((str(r["path"]), joined(base_spans(r["text"] or ""))) for r in docs.collect())
    assert secrets.scan_paths(spark, docs.limit(0)).count() == 0


def test_ledger_scans_only_unseen_pairs(spark):
    ledger = secrets.Ledger(spark)
    docs = spark.createDataFrame([(1, "token=abcdefgh"), (2, "plain")], "path long, text string")
    secrets.scan_paths(spark, docs, ledger)
    more = docs.union(spark.createDataFrame([(3, "token=abcdefgh"), (4, "secret=12345678")], docs.schema))
    out = secrets.scan_paths(spark, more, ledger)
    assert ledger.scanned().count() == 3 and ledger.findings().count() == 2
    assert {r["path"]: len(r["spans"]) for r in out.collect()} == {1: 1, 2: 0, 3: 1, 4: 1}
    secrets.scan_paths(spark, docs, ledger, version="2")
    assert ledger.scanned().count() == 5


def test_redact_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a token=0123456789abcdef01234567 b", "x"), (2, None, "y"), (3, "clean", "z")], "doc_id long, text string, blob string")
    got = {r["doc_id"]: tuple(r) for r in secrets.redact(spark, docs).collect()}
    assert got == {1: (1, "a [assign] b", "x"), 2: (2, None, "y"), 3: (3, "clean", "z")}


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def plain_rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = ["https://Example.ORG/es/1?x", "http://a.example.org/en/12#y", "ftp://com", "http://x.com/fr/", "http://x.com/de/9", "http://org", "none", None, "", "http://Éx.org/://b/", "a://b://c/d",
        "http://notorg/", "http://u@h.org:80/", "://org/"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h"), (None, URLS[3], "h")], "page_id long, url string, host string")
    for r in urls.filter_urls(pages, urls.RULES).collect():
        u = URLS[3] if r["page_id"] is None else URLS[r["page_id"]]
        assert (r["host"], r["path"]) == plain_url(u)
        rule, verdict = plain_rule(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == verdict)
    assert urls.filter_urls(pages, urls.RULES).count() == 16
    assert urls.filter_urls(pages.limit(0), urls.RULES).count() == 0


def test_url_query_rows(spark):
    got = E.queries()["op10_url_filters"](spark, "/root/testdata/sf0.01").collect()
    rows = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"]) == plain_url(rows[r["page_id"]])
        rule, verdict = plain_rule(r["host"], r["path"])
        assert r["rule"] == rule and (rule is None or r["verdict"] == verdict)


def test_template_tree_rejects_a_bad_branch(spark):
    """A branch whose ruled pages are bad carries its unruled ones with it; a
    good one of the same host does not."""
    rows = [(i, f"http://h.net/ads/{'x' if i % 2 else 'y'}/{i}") for i in range(60)] + [(100 + i, f"http://h.net/news/{'x' if i % 2 else 'y'}/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("h.net", "/ads/x", "block"), ("h.net", "/news/x", "allow")]
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, rules).collect()}
    assert all(got[i] == "block" for i in range(60)) and all(got[100 + i] == "allow" for i in range(60))


def test_many_variable_children_share_a_template(spark):
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.net/u/name"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("url"))
    assert [r[0] for r in urls.filter_urls(pages, [("x", "/", "allow")]).select("template").distinct().collect()] == ["h.net/u/*"]


def test_template_tree_parts_branches_at_any_depth(spark):
    """Good and bad sections that part at the fourth segment and at the
    tenth."""
    for above in ("/a/b/c", "/d" * 9):
        rows = [(i, f"http://h.net{above}/ads/{'x' if i % 2 else 'y'}/{i}") for i in range(60)] + [(100 + i, f"http://h.net{above}/news/{'x' if i % 2 else 'y'}/{i}") for i in range(60)]
        pages = spark.createDataFrame(rows, "page_id long, url string")
        rules = [("h.net", f"{above}/ads/x", "block"), ("h.net", f"{above}/news/x", "allow")]
        got = {r["page_id"]: r for r in urls.filter_urls(pages, rules).collect()}
        assert all(got[i]["verdict"] == "block" for i in range(60)) and all(got[100 + i]["verdict"] == "allow" for i in range(60))
        assert got[0]["template"] == f"h.net{above}/ads/y/*"


def test_deep_paths_below_a_merged_level(spark):
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(40)]
    rows = [(10 * i + j, f"http://h.net/u/{n}/p/q/{s}/{'x' if j % 2 else 'y'}") for i, n in enumerate(names) for j, s in enumerate(["ads", "ads", "news", "news"])]
    pages = spark.createDataFrame([*rows, (9999, "http://h.net/u")], "page_id long, url string")
    rules = [("h.net", f"/u/{n}/p/q/ads/x", "block") for n in names[:20]] + [("h.net", f"/u/{n}/p/q/news/x", "allow") for n in names[:20]]
    got = {r["page_id"]: r for r in urls.filter_urls(pages, rules).collect()}
    assert len(got) == 161
    for i in range(40):
        assert got[10 * i]["verdict"] == "block" and got[10 * i + 2]["verdict"] == "allow"
        assert got[10 * i]["template"] == "h.net/u/*/p/q/ads/y"


def test_pages_without_any_label_are_allowed(spark):
    """No rule fits, or there is no rule: nothing speaks against a template."""
    rows = [(i, f"https://h{i % 7}.test/{'abc'[i % 3]}/{i}" + "/x" * (4000 if i == 3 else 0)) for i in range(60)] + [(100, None), (101, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for rules in (urls.RULES, []):
        got = urls.filter_urls(pages, rules).collect()
        assert len(got) == len(rows) and {r["verdict"] for r in got} == {"allow"} and {r["rule"] for r in got} == {None}


def test_a_very_long_url_is_kept_whole(spark):
    long = ["http://sub.example.org/es/" + "x" * 100_000, "http://other.net/" + "y" * 100_000 + "?q=" + "z" * 1000]
    got = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(list(enumerate(long)), "page_id long, url string"), urls.RULES).collect()}
    assert all((got[i]["host"], got[i]["path"]) == plain_url(u) for i, u in enumerate(long))
    assert [got[i]["rule"] for i in (0, 1)] == ["example.org/es/", None] and got[0]["verdict"] == "block"
