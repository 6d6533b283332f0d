"""WARC archives of pages, read back into a globally ordered capture index.

*Writing.*  Each page is one record.  Among pages with equal payloads of at
least ``LEAST_REVISIT`` bytes the largest page id is the response; the others
are revisits of it, without the payload.  Records are text (UTF-8), so Spark's
text writer makes the archives: every output file is a plain WARC file.  Tasks
cut their records into archives by the running sum of bytes, so none is above
``ARCHIVE_BYTES`` unless it is a single record.  The payload's digest is compared on slim rows; only the
digests that occur twice meet the pages, broadcast when counted small.

*Reading.*  Each archive is parsed by its Content-Length headers; payloads are
digested again and must match their header.  An archive yields one run of index
entries, sorted by URL key, time and page.

*Merging.*  The runs are cut into blocks of ``BLOCK`` entries, and a block is
dealt with its first key, its head.  Entries are dealt out by ranges of (URL
key, time, page, archive, offset), so a URL with a third of all captures spans
several ranges; in a range the blocks come in order of their heads, which is the
order in which a merge runs out of them.  A task takes one block after
the other, and a k-way loser tree over what it holds gives out all entries
below the new head: every earlier block of the same run among them.  So a task
holds one block of each run at most, however large its range.  About ``FAN_IN`` runs (dealt by
hash) are merged at a time; more of them take several passes over the slim
entries, each written.  Partitions follow each other in key order: together
they are the captures' histories.

Defined results: a null html is the empty payload; a null page id is written as
``none`` and read as null, and is never the largest; rows that share the
largest id of their payload are all responses; a null url is empty; the capture
time is derived from the page id (the table has none), ties are broken by the
page, the archive and the offset; a very long html is one record, if need be in
an archive of its own; an empty table gives an empty index; other columns, also
of clashing names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, written
from tokenmeter.session import scratch_path

LEAST_REVISIT = 1000
#: Largest archive of several records: one is parsed in one task's memory.
ARCHIVE_BYTES = 16_000_000
#: Entries of a block, and runs merged at a time: a merging task holds about
#: BLOCK * FAN_IN entries at most.
BLOCK, FAN_IN = 1024, 64
#: Entries handed on at a time.
OUT = 4096
CRLF = "\r\n"
#: First capture time: 2024-01-01T00:00:00Z; pages follow by the second.
EPOCH = 1_704_067_200
INDEX = ("archive string, urlkey string, ts string, page_id bigint, url string, record_type string, digest string, payload_bytes bigint, "
         "refers_to bigint, offset bigint, long bigint")
ORDER = ["urlkey", "ts", "page_id"]


def url_key(url: Column) -> Column:
    """Sort key of a URL: the host's labels from the last, then the rest, so
    that captures of a domain and its subdomains are neighbours."""
    rest = F.regexp_replace(F.lower(url), r"\A[a-z][a-z0-9+.-]*://(www[0-9]*\.)?", "")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substring(rest, F.length(host) + 1, F.length(rest)))


def typed(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, bytes, holder): ``holder`` is the page of
    the response that a page with a shared payload refers to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html").cast("bigint")})
    shared = (rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.count(F.lit(1)).alias("k"), F.max("page_id").alias("holder"))
              .where("k > 1 AND holder IS NOT NULL").select("digest", "holder"))
    shared = written(shared, "warc-shared")
    return rows.join(maybe_broadcast(shared, shared.count()), "digest", "left")


def record(page: DataFrame) -> Column:
    """The text of one WARC record but its last line end."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    date = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    refers = F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("holder"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", date), line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), F.coalesce(refers, F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block, F.lit(CRLF))


def archive_number(size: Column, archive_bytes: int) -> Column:
    """Which of its task's archives a record goes to: the next one as soon as
    the bytes of this one would exceed ``archive_bytes``."""

    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = filled = 0
        for batch in batches:
            out = []
            for n in batch.to_pylist():
                if filled and filled + n > archive_bytes:
                    number, filled = number + 1, 0
                filled += n
                out.append(number)
            yield pa.array(out, pa.int32())

    return run.asNondeterministic()(size)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """One record per row of ``pages`` (page_id, url, html), as WARC files."""
    rows = typed(pages)
    records = rows.select(record(rows).alias("value"))
    size = (F.octet_length("value") + len(CRLF)).cast("bigint")
    cut = records.withColumn("archive", archive_number(size, archive_bytes))
    cut.write.partitionBy("archive").option("lineSep", CRLF).text(path)
    return path


def parse(archive: str, data) -> list[tuple]:
    """Index entries (without urlkey) of one archive; raises on a record whose
    payload does not match its digest."""
    import hashlib

    out, at, view = [], 0, memoryview(data)
    number = lambda urn: None if "none" in urn else int(urn.rsplit(":", 1)[1].rstrip(">"))
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at) + 4
        head = dict(x.split(": ", 1) for x in data[at:head_end].decode("utf-8").split(CRLF)[1:] if ": " in x)
        block_end = head_end + int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", head_end) + 4
        http = dict(x.split(": ", 1) for x in data[head_end:body].decode("ascii").split(CRLF)[1:] if ": " in x)
        digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
        if kind == "response" and hashlib.sha1(view[body:block_end]).hexdigest() != digest:
            raise ValueError(f"{archive}: the payload at {at} does not match its digest")
        end = block_end + 4
        out.append((head["WARC-Date"], number(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, digest, int(http["Content-Length"]),
                    number(head["WARC-Refers-To"]) if kind == "revisit" else None, at, end - at))
        at = end
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """INDEX rows of all archives under ``path``, a sorted run per archive."""
    fields = "archive string, ts string, page_id bigint, url string, record_type string, digest string, payload_bytes bigint, refers_to bigint, offset bigint, long bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 4]
        names = [f.split()[0] for f in fields.split(", ")]
        for batch in batches:
            for i in range(len(batch)):
                archive = batch.column(0)[i].as_py()
                rows = [(archive, *r) for r in parse(archive, batch.column(1)[i].as_py())]
                cols = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    entries = files.mapInArrow(run, fields).withColumn("urlkey", url_key(F.col("url")))
    return written(entries.select(*[f.split()[0] for f in INDEX.split(", ")]).sortWithinPartitions("archive", *ORDER, "offset"), "warc-runs")


class LoserTree:
    """Merges k sorted runs: an inner node holds the run that lost there, so
    the next entry costs one comparison per level."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        for i in range(len(runs)):
            self._play(i)

    def _ahead(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes before run ``b`` (ended runs come last)."""
        left, right = self.at[a] < len(self.runs[a]), self.at[b] < len(self.runs[b])
        if not (left and right):
            return left
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        node, winner = (run + self.k) // 2, run
        while node:
            held = self.losers[node]
            if held < 0:  # while the tree is being built: wait for the other side
                self.losers[node] = winner
                return
            if self._ahead(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def below(self, bound: tuple | None) -> Iterator[tuple]:
        """The entries before ``bound`` (None: all), in order."""
        while self.runs:
            run = self.losers[0]
            if self.at[run] >= len(self.runs[run]):
                return
            entry = self.runs[run][self.at[run]]
            if bound is not None and entry >= bound:
                return
            self.at[run] += 1
            yield entry
            self._play(run)

    def __iter__(self) -> Iterator[tuple]:
        return self.below(None)


def sort_key(urlkey: str, ts: str, page: int | None, archive: str, offset: int) -> tuple:
    """Spark's order of (ORDER, archive, offset): bytes, null pages first."""
    return urlkey.encode("utf-8"), ts, page is not None, page or 0, archive, offset


class BlockMerge:
    """Merges runs that arrive block by block in order of the blocks' heads.
    ``held`` has what is left of one block of each run."""

    def __init__(self):
        self.held: dict = {}
        self.most = 0

    def add(self, run, entry: tuple) -> None:
        self.held.setdefault(run, []).append(entry)

    def below(self, head: tuple | None) -> Iterator[tuple]:
        """Give out the entries before ``head``, the next block's (None: all)."""
        self.most = max(self.most, sum(map(len, self.held.values())))
        runs = list(self.held)
        tree = LoserTree([self.held[r] for r in runs])
        yield from tree.below(head)
        for run, at in zip(runs, tree.at):
            if at == len(self.held[run]):
                del self.held[run]
            elif at:
                del self.held[run][:at]


def blocked(runs: DataFrame, block: int) -> DataFrame:
    """``runs``, whose partitions hold sorted pieces of runs one after the other,
    with the ``head`` of each row's block: its first (ORDER, archive, offset)."""
    names = runs.columns
    key = [*ORDER, "archive", "offset"]
    head = "struct<" + ",".join(f"{c}:{runs.schema[c].dataType.simpleString()}" for c in key) + ">"
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields), f"head {head}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, first = None, 0, None
        for batch in batches:
            cols = [batch.column(names.index(c)) for c in key]
            heads = []
            for i, of in enumerate(batch.column(names.index("run")).to_pylist()):
                if of != last or n == block:
                    last, n, first = of, 0, {c: v[i].as_py() for c, v in zip(key, cols)}
                n += 1
                heads.append(first)
            column = pa.array(heads, pa.struct([(c, v.type) for c, v in zip(key, cols)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, "head"])

    return runs.mapInArrow(run, schema)


def merge_pass(runs: DataFrame, into: Column, block: int) -> DataFrame:
    """The runs of each value of ``into`` merged to one, which it numbers."""
    key = [*ORDER, "archive", "offset"]
    rows = blocked(runs, block).withColumn("into", into)
    names = rows.columns
    at = {c: names.index(c) for c in names}
    fields = list(runs.schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge, group, current, out, types = BlockMerge(), None, None, [], None

        def packed() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], fields)

        def drained(bound: tuple | None) -> Iterator[pa.RecordBatch]:
            for entry in merge.below(bound):
                out.append((*entry[-1], group))
                if len(out) == OUT:
                    yield packed()

        for batch in batches:
            types = [batch.column(at[c]).type for c in fields[:-1]] + [pa.int64()]
            slim = list(zip(*[batch.column(at[c]).to_pylist() for c in fields[:-1]]))
            keys = zip(*[batch.column(at[c]).to_pylist() for c in key])
            heads = zip(*[c.to_pylist() for c in batch.column(at["head"]).flatten()])
            intos, of = batch.column(at["into"]).to_pylist(), batch.column(at["run"]).to_pylist()
            for row, k, head, to, one in zip(slim, keys, heads, intos, of):
                if current != (to, head):
                    yield from drained(sort_key(*head) if to == group else None)
                    group, current = to, (to, head)
                merge.add(one, (*sort_key(*k), row))
        yield from drained(None)
        if out:
            yield packed()

    dealt = rows.repartitionByRange("into", *key).sortWithinPartitions("into", "head", *key)
    return dealt.mapInArrow(run, runs.schema)


def merged(runs: DataFrame, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """The INDEX rows of ``runs``, one sorted run per archive, in global order
    of ORDER."""
    left = runs.select("archive").distinct().count()
    now = runs.withColumn("run", F.xxhash64("archive"))
    groups = -(-left // fan_in)
    into = F.pmod("run", F.lit(max(1, groups)).cast("bigint"))
    while groups > 1:
        now = written(merge_pass(now, into, block), "warc-pass")
        groups = -(-groups // fan_in)
        into = F.floor(F.col("run") / fan_in).cast("bigint")
    return merge_pass(now, F.lit(0).cast("bigint"), block).drop("run")


def archive_index(spark: SparkSession, pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return the merged index."""
    path = write_archives(pages.select("page_id", "url", "html"), path or scratch_path(spark, "llm", "warc"))
    return merged(read_archives(spark, path))


def q_warc(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    index = archive_index(spark, table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY sha1(h)) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""
