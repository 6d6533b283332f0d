"""URL filters: host and path rules, and for the rest a path-template tree.

*Rules.*  A rule (host, path, verdict) fits its host and all subdomains when
the url's path starts with the rule's; the longest fitting rule wins.  The rule
list is a parameter held by the driver (a filter list, not a table).

*Tree.*  Per host, paths form a tree of segments.  Segments that look variable
(numbers, hex, uuids) are wildcards at once.  Then, level by level, the children
of a node with more than ``FANOUT`` of them are merged into its ``*`` branch
when they are rare or when their labelled share of bad urls does not differ
from the node's by a two-proportion z-test.  Each template (a path from the
host to a leaf) is judged by its labelled purity, smoothed towards its parent's
along the path, up to the host's and the whole table's; it is rejected from
``REJECT`` on.  Levels go on for as long as a node has several raw templates
one of which has a further segment, so paths of any depth are told apart; a
node beyond that (nothing in it can merge any more) is finished by one
expression.  Paths of fewer than ``DEPTH`` segments are smoothed as if they had
as many.

Everything is grouping and joining of counts: urls are pre-aggregated to
templates before anything is shuffled by host, so a host with a third of the
rows is a few template rows per task.

Defined results: a null url, or one without ``://``, has empty host and path,
no rule, and the verdict of the empty host's root.  A very long url is kept
whole.  Repeated rows give repeated
results; an empty table an empty one; other columns are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.common import LOWER, UPPER, maybe_broadcast, written

DEPTH = 3
FANOUT = 8
RARE = 20
Z = 1.96
SMOOTH = 4.0
REJECT = 0.5

VARIABLE = r"^([0-9]+|[0-9a-fA-F]{8,}|[0-9a-fA-F-]{36}|.*[0-9]{5,}.*)(\.[A-Za-z]{1,5})?$"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    tests = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
                    F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in ordered]
    none = F.lit(None).cast("struct<rule: string, verdict: string>")
    return F.coalesce(*tests, none)


def segments(path: Column) -> Column:
    """The path's segments, variable ones as ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))


def leaf_table(pages: DataFrame) -> DataFrame:
    """Counts of every raw template: host, segs, n, bad, good (from ``bad``,
    1, 0 or null, of each page)."""
    return pages.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("bad") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("bad") == 0, 1).otherwise(0)).alias("good"))


def similar(n: Column, bad: Column, lab: Column, all_bad: Column, all_lab: Column) -> Column:
    """Rare, unlabelled, or a share of bad urls within Z standard errors of the
    rest of the node's children."""
    rest_bad, rest_lab = all_bad - bad, all_lab - lab
    pooled = all_bad / F.greatest(all_lab, F.lit(1))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(lab, F.lit(1)) + 1 / F.greatest(rest_lab, F.lit(1))))
    apart = F.abs(bad / F.greatest(lab, F.lit(1)) - rest_bad / F.greatest(rest_lab, F.lit(1)))
    return (n < RARE) | (lab == 0) | (rest_lab == 0) | (apart <= Z * error)


def smoothed(bad: Column, lab: Column, p: Column) -> Column:
    return (bad + SMOOTH * p) / (lab + SMOOTH)


def level_step(leaves: DataFrame, d: int) -> DataFrame:
    """Leaves moved from their node to its branch for segment ``d``, with the
    branch's counts (bad_k, lab_k), its raw templates (fan_k), the segments of
    its longest (deep_k) and its purity."""
    at = leaves.withColumn("seg", F.coalesce(F.get("segs", F.lit(d)), F.lit("")))
    child = at.groupBy("node", "seg").agg(F.sum("n").alias("c_n"), F.sum("bad").alias("c_bad"), (F.sum("bad") + F.sum("good")).alias("c_lab"),
                                          F.count(F.lit(1)).alias("c_fan"), F.max(F.size("segs")).alias("c_deep"))
    parent = child.groupBy("node").agg(F.count(F.lit(1)).alias("fan"), F.sum("c_bad").alias("p_bad"), F.sum("c_lab").alias("p_lab"))
    merged = (F.col("fan") > FANOUT) & similar(*(F.col(c) for c in ("c_n", "c_bad", "c_lab", "p_bad", "p_lab")))
    child = child.join(parent, "node").withColumn("k", F.when(merged, F.lit("*")).otherwise(F.col("seg")))
    branch = child.groupBy("node", "k").agg(F.sum("c_bad").alias("bad_k"), F.sum("c_lab").alias("lab_k"), F.sum("c_fan").alias("fan_k"), F.max("c_deep").alias("deep_k"))
    to = child.select("node", "seg", "k").join(branch, ["node", "k"])
    moved = at.join(to, ["node", "seg"])
    return moved.select("host", "segs", "n", "bad", "good", F.concat_ws("/", "node", "k").alias("node"), "bad_k", "lab_k", "fan_k", "deep_k",
                        smoothed(F.col("bad_k"), F.col("lab_k"), F.col("p")).alias("p"))


def template_tree(leaves: DataFrame) -> DataFrame:
    """host, segs, template, p_bad: the smoothed share of bad urls of each
    leaf's template."""
    total = leaves.agg(F.sum("bad"), F.sum("good")).first()  # one row
    bad, good = total[0] or 0, total[1] or 0
    hosts = leaves.groupBy("host").agg(F.sum("bad").alias("h_bad"), (F.sum("bad") + F.sum("good")).alias("h_lab"))
    # Without any labelled url there is nothing to reject by.
    p = smoothed(F.col("h_bad"), F.col("h_lab"), F.lit((bad + 1.0) / (bad + good + 2.0) if bad + good else 0.0))
    open_, done, d = leaves.join(hosts, "host").withColumns({"node": F.col("host"), "p": p}).drop("h_bad", "h_lab"), None, 0
    while True:
        moved = written(level_step(open_, d), f"urls-level{d}")
        # Below a node of one raw template, or without further segments, every
        # node has the same counts: what is left is to smooth on.
        ended = (F.col("fan_k") == 1) | (F.col("deep_k") <= d + 1)
        levels = F.greatest(F.lit(max(DEPTH, d) + 1), F.col("deep_k") + 1)
        p = F.aggregate(F.array_repeat(F.lit(0), levels - (d + 1)), F.col("p"), lambda acc, _: smoothed(F.col("bad_k"), F.col("lab_k"), acc))
        rest = F.slice("segs", d + 2, F.greatest(F.size("segs"), F.lit(1)))
        way = F.concat(F.slice(F.split("node", "/"), 2, d + 1), rest)
        template = F.concat(F.col("host"), F.lit("/"), F.array_join(F.filter(way, lambda s: s != ""), "/"))
        part = moved.where(ended).select("host", "segs", template.alias("template"), p.alias("p_bad"))
        done = part if done is None else done.union(part)
        open_ = moved.where(~ended).drop("bad_k", "lab_k", "fan_k", "deep_k")
        if open_.isEmpty():
            return done
        d += 1


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, template, p_bad) of every row.  What the
    rules decide is the labelled part from which templates are judged."""
    url = pages[url_col].cast("string")
    parts = pages.select(pages[id_col].alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parts.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    bad = F.when(F.col("fit.verdict") == "block", 1).when(F.col("fit.verdict") == "allow", 0)
    slim = ruled.withColumn("bad", bad).withColumn("segs", segments(F.col("path")))
    judged = written(template_tree(written(leaf_table(slim), "urls-leaves")), "urls-templates")
    out = slim.join(maybe_broadcast(judged, judged.count()), ["host", "segs"], "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("p_bad") >= REJECT, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "template", "p_bad")


# The rules of the query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def q_url_filters(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")
