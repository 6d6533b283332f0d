"""Secret scans over an incremental blob ledger.

Every historical version of every path is content-addressed (SHA-256 of its
text).  The ledger is two tables in one folder: ``scanned`` (blob, version of
the rules) and ``findings`` (blob, version, kind, start, end).  A run takes the
distinct blobs of its input, leaves out the pairs the ledger holds, scans the
rest once each, appends what it found, and joins the findings back to all
paths that carry the blob.

Native only: matches come from ``regexp_extract_all``, the text between them
from ``split``; positions are running sums of their lengths (code points), over
texts that match at all.  The blob to scan is chosen on slim rows (path, blob),
so a blob that a third of all paths share is one row per task; texts move once,
to meet the list of blobs to scan, keyed by blob and path.

Defined results: a null text is the empty text, which has no findings; a null
path is a path; a very long text is scanned whole; repeated rows give repeated
results; an empty table an empty one; other columns are not read.  ``kind:start:end`` lists are ordered by
start, then kind as listed in the rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmeter.llm.common import written
from tokenmeter.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    base: bool = False
    #: Group whose length must reach ``least`` (0: the whole match).
    group: int = 0
    least: int = 0


# The base patterns.  Runs are matched whole, then short ones
# dropped; where a run can match only whole, its least length is in the pattern.
RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", True),
    Rule("hex", r"[0-9a-f]{24,}", True),
    # Beside the base kinds: well-known public formats of credentials.
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
VERSION = "1"


def pieces(text: Column, rule: Rule) -> Column:
    """array(struct(gap, hit)): the length of the text before each match, and
    the match; the last element has no match."""
    between = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s))
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    return F.transform(F.arrays_zip(between.alias("gap"), hits.alias("hit")), lambda z: F.struct(F.length(z["hit"]).alias("long"), z["gap"].alias("gap"), (
        F.length(F.regexp_extract(z["hit"], rule.pattern, rule.group)) >= rule.least).alias("keep")))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, ord, kind, base, start, end) of every match in ``blobs`` (blob,
    text); starts and ends are code points, end exclusive."""
    either = reduce(lambda a, b: a | b, (F.col("text").rlike(r.pattern) for r in rules))
    found = F.array(*[F.when(F.col("text").rlike(r.pattern), pieces(F.col("text"), r)) for r in rules])
    runs = (blobs.where(either).select("blob", F.posexplode(found).alias("ord", "pieces"))
            .where(F.col("pieces").isNotNull()).select("blob", "ord", F.posexplode("pieces").alias("k", "p"))
            .dropDuplicates(["blob", "ord", "k"]))  # rows repeated with their path
    upto = Window.partitionBy("blob", "ord").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p.gap") + F.coalesce(F.col("p.long"), F.lit(0))).over(upto)
    kinds, base = F.array(*[F.lit(r.kind) for r in rules]), F.array(*[F.lit(r.base) for r in rules])
    return (runs.withColumn("end", end).where(F.col("p.long").isNotNull() & F.col("p.keep"))
            .select("blob", "ord", F.get(kinds, F.col("ord")).alias("kind"), F.get(base, F.col("ord")).alias("base"),
                    (F.col("end") - F.col("p.long")).alias("start"), "end"))


class Ledger:
    """The two tables of a scan history, under one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "llm", "secret-ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, version string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, version string, ord int, kind string, base boolean, start bigint, end bigint")

    def spans(self, version: str = VERSION) -> DataFrame:
        """(blob, spans) of every blob with findings; a rerun's repeated
        findings count once."""
        found = self.findings().where(F.col("version") == version).dropDuplicates(["blob", "ord", "start"])
        return found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "ord", "end", "kind", "base"))).alias("spans"))

    def update(self, versions: DataFrame, paths: DataFrame, version: str = VERSION, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the blobs of ``paths`` (path, blob) not yet scanned under
        ``version``; ``versions`` (path, blob, text) has the texts.  Findings
        are appended before the pairs that vouch for them, so a run that dies
        between the two scans them again; readers take distinct findings."""
        seen = self.scanned().where(F.col("version") == version).select("blob")
        todo = written(paths.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left_anti"), "secret-todo")
        t, v = todo.alias("t"), versions.alias("v")
        texts = v.join(t, F.expr("t.blob = v.blob AND t.path <=> v.path"), "left_semi").select("blob", "text")
        found = scan(texts, rules)
        found.withColumn("version", F.lit(version)).select("blob", "version", "ord", "kind", "base", "start", "end").write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.lit(version).alias("version")).write.mode("append").parquet(f"{self.path}/scanned")


SPANS = "array<struct<start: bigint, ord: int, end: bigint, kind: string, base: boolean>>"


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda r: F.concat_ws(":", r["kind"], r["start"].cast("string"), r["end"].cast("string"))), ",")


def scan_paths(spark: SparkSession, history: DataFrame, ledger: Ledger | None = None, version: str = VERSION,
               rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, spans) of every row of ``history`` (path, text), one row per
    path and historical version; spans by start, then kind as listed."""
    ledger = ledger or Ledger(spark)
    versions = history.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = written(versions.select("path", "blob"), "secret-paths")
    ledger.update(versions, paths, version, rules)
    return paths.join(ledger.spans(version), "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping ones, as ``[kind]`` of the
    first of them."""
    def step(acc: Column, s: Column) -> Column:
        cut = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], cut).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(spans, start, step, rest)


def redact(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of ``text_col`` redacted; all rows and columns
    stay, null texts stay null."""
    ledger = Ledger(spark)
    scan_paths(spark, docs.select(F.col(id_col).alias("path"), F.col(text_col).alias("text")), ledger)
    rows = docs.select(F.struct("*").alias("row"), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256).alias("blob"))
    joined = rows.join(ledger.spans(), "blob", "left")
    text = F.col(f"row.`{text_col}`")
    clean = F.when(F.col("spans").isNull(), text).otherwise(redacted(text, F.col("spans")))
    return joined.select(*[(clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def q_secret_scans(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found = scan_paths(spark, docs)
    count = [F.size(F.expr(f"filter(spans, r -> r.kind = '{k}')")).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = listed(F.filter("spans", lambda r: r["base"]))
    return found.select(F.col("path").alias("doc_id"), *count, F.sha2(base, 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
