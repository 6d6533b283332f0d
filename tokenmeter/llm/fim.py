"""Fill-in-middle transformation of whole texts.

A text of n code points (*units*) is cut at two of its n + 1 unit borders, which
a hash of the seed and the row's id draws, and its parts are put in another
order around three marks.  Some rows stay plain.

Borders are found without decoding.  The UTF-8 bytes of a whole batch are viewed
as 64-bit words.  In each word the bytes that end a unit are marked by
arithmetic on all eight at once: a byte 10xxxxxx continues a unit, so the byte
before any other byte ends one.  ``bitwise_count`` per word, summed up, gives
the units before each word; the word of the k-th ending is found by searching
the sums, the byte inside it by the running count of its eight marks.

No shuffle: each row is read and answered where it lies; a task holds one slice
of about ``STEP_BYTES`` (or one text) beside its batch.

Defined results: a null text is the empty text, and an empty text stays plain; a
null id hashes as the seed and colon alone; repeated rows give repeated results;
texts of any length are cut as a whole; an empty table gives an empty one; other
columns are not read.  Texts that hold a mark stay plain, so ``restored`` is
exact for every row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tokenmeter.llm.common import release, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
#: Of 100 rows, those that stay plain; of 100 others, those in suffix-first order.
PLAIN, SUFFIX_FIRST = 10, 20
STEP_BYTES = 4_000_000


class Units:
    """Rank and select over the unit-ending bytes of one UTF-8 buffer."""

    def __init__(self, data):
        import numpy as np

        self.np, n = np, len(data)
        padded = np.zeros((n // 8 + 2) * 8, np.uint8)
        padded[:n] = data
        words = padded.view("<u8")
        eight, high = np.uint64(8), np.uint64(0x8080808080808080)
        starts = ~(words & ~(words << np.uint64(1))) & high  # bit 7 set, bit 6 clear: continues a unit
        self.marks = starts >> eight
        self.marks[:-1] |= starts[1:] << np.uint64(56)
        last, rest = divmod(n, 8)  # the padding ends nothing
        self.marks[last] &= np.uint64((1 << 8 * rest) - 1)
        self.marks[last + 1 :] = 0
        self.upto = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        self.before = self.upto - np.bitwise_count(self.marks)

    def rank(self, at):
        """Units that end before byte ``at``."""
        np = self.np
        word, byte = at // 8, (at % 8).astype(np.uint64)
        below = (np.uint64(1) << (np.uint64(8) * byte)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def after(self, k):
        """The byte after the ``k``-th ending (k >= 1; beyond the last one some
        byte, never an error)."""
        np = self.np
        word = np.minimum(np.searchsorted(self.upto, k), len(self.upto) - 1)
        marks = (self.marks[word][:, None] >> (np.uint64(8) * np.arange(8, dtype=np.uint64) + np.uint64(7))) & np.uint64(1)
        seen = np.cumsum(marks, axis=1, dtype=np.int64)
        return word * 8 + (seen < (k - self.before[word])[:, None]).sum(axis=1) + 1


def cut_points(offsets, data, draws):
    """For texts ``data[offsets[i]:offsets[i + 1]]`` and two draws each: (units,
    first cut, second cut in units, first cut, second cut in bytes)."""
    import numpy as np

    units = Units(data)
    first = units.rank(offsets[:-1])
    n = units.rank(offsets[1:]) - first
    low, high = (f(draws[0] % (n + 1), draws[1] % (n + 1)) for f in (np.minimum, np.maximum))
    at = [np.where(c > 0, units.after(np.maximum(first + c, 1)), offsets[:-1]) for c in (low, high)]
    return n, low, high, *at


def draws_of(id_col: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit draws of a row: the first hex digits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
                   plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.  ``form``
    is plain, psm (prefix, suffix, middle) or spm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
            draws = [batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(4)]
            begin = 0
            while begin < len(texts):
                end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + STEP_BYTES)))
                end = min(end, len(texts))
                at = offsets[begin : end + 1] - offsets[begin]
                data = raw[offsets[begin] : offsets[end]]
                n, low, high, one, two = cut_points(at, data, [d[begin:end] for d in draws[:2]])
                whole = data.tobytes()
                out, form = [], []
                for i, (a, x, y, b) in enumerate(zip(at[:-1].tolist(), one.tolist(), two.tolist(), at[1:].tolist())):
                    text = whole[a:b]
                    if not text or draws[2][begin + i] % 100 >= 100 - plain or p in text or s in text or m in text:
                        form.append("plain")
                        out.append(text)
                    elif draws[3][begin + i] % 100 < suffix_first:
                        form.append("spm")
                        out.append(b"".join((s, whole[y:b], p, whole[a:x], m, whole[x:y])))
                    else:
                        form.append("psm")
                        out.append(b"".join((p, whole[a:x], s, whole[y:b], m, whole[x:y])))
                kept = np.array([f == "plain" for f in form])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), pa.array(n), pa.array(form, pa.string()), pa.array(low, mask=kept),
                    pa.array(high - low, mask=kept), pa.array(out, pa.binary()).cast(pa.string())], names)
                begin = end
        release()

    rows = docs.select(docs[id_col], F.coalesce(docs[text_col].cast("string"), F.lit("")), *draws_of(docs[id_col], seed))
    schema = StructType([rows.schema[0], StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
                         StructField("middle_chars", LongType()), StructField("output", StringType())])
    names = schema.fieldNames()
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  A text that is cut holds no mark,
    and no mark begins inside another, so the three found are the three put in."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1]))
            .otherwise(output))


def digest(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(id_col, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                       sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def q_fim(spark, sf_dir: str) -> DataFrame:
    return digest(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))


ORACLE = """WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
h AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
