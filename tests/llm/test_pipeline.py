"""Each stage of the pipeline against a plain version, on its own input."""

import hashlib
import struct
import sys

import corpus_pipeline as P
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenmeter.llm import secrets, toxicity

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_contamination import plain  # noqa: E402
from test_minmax import plain_components, plain_sets  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("text_hash", F.lit(1)).withColumn("row", F.lit("x"))
    stages = dict(P.STAGES)
    rows = docs.collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    out = stages["toxicity"](spark, docs, SF).cache()
    assert out.columns == docs.columns
    grammar = toxicity.trained(spark, SF)
    want = [r for r in rows if grammar.score(r["text"] or "") < toxicity.CUT]
    assert sorted(out.collect()) == sorted(want) and len(want) < len(rows)

    rows, docs = want, out
    out = stages["minmax_near_dedup"](spark, docs, SF).cache()
    ids = [r["doc_id"] for r in rows]
    want = [r for r, c in zip(rows, plain_components(ids, plain_sets([r["text"] for r in rows], 5))) if c == r["doc_id"]]
    assert out.columns == docs.columns and sorted(out.collect()) == sorted(want) and len(want) < len(rows)

    rows, docs = want, out
    out = stages["decontamination"](spark, docs, SF).cache()
    grams = set()
    for t in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = plain(t["text"])
        grams |= {tuple(w[s : s + 10]) for s in range(max(len(w) - 9, 1))}
    hit = lambda w: any(tuple(w[s : s + 10]) in grams for s in range(len(w) - 9))
    assert min(map(len, grams)) == 10
    want = [r for r in rows if not hit(plain(r["text"]))]
    assert out.columns == docs.columns and sorted(out.collect()) == sorted(want) and len(want) < len(rows)

    rows, docs = want, out
    out = stages["secret_scans"](spark, docs, SF).cache()
    got = {r["doc_id"]: r for r in out.collect()}
    found = {r["path"]: r["spans"] for r in secrets.scan_paths(spark, docs.select(F.col("doc_id").alias("path"), "text")).collect()}
    assert out.columns == docs.columns and len(got) == len(rows)
    changed = 0
    for r in rows:
        text, at, clean = r["text"] or "", 0, []
        for s in found[r["doc_id"]]:
            if s["start"] >= at:
                clean += [text[at : s["start"]], f"[{s['kind']}]"]
            at = max(at, s["end"])
        clean = "".join(clean) + text[at:]
        assert (got[r["doc_id"]]["text"] or "") == clean
        changed += clean != text
    assert changed

    last = stages["bpe"](spark, out, SF).collect()
    assert len(last) == len(rows)
    for r in last:
        ids = library.encode(got[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_edge_rows(spark):
    rows = [(1, None), (None, "one two three four five six"), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, "x"), (4, "x"), (5, "  "), (5, "  ")]
    docs = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, hash string")
    kept = P.near_duplicates_out(spark, docs, SF)
    assert sorted(map(str, [tuple(r)[:2] for r in kept.collect()])) == sorted(map(str, [(1, None), (2, ""), (3, "one two three four five six"), (4, "x"), (5, "  "), (5, "  ")]))
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert P.toxic_out(spark, docs, SF).count() == len(rows)
    assert P.contaminated_out(spark, docs, SF).count() == len(rows)
    assert P.secrets_redacted(spark, docs, SF).count() == len(rows)
    assert P.encoded(spark, docs, SF).count() == len(rows)


def test_run_matches_its_stages(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, E.queries()["pipeline"](spark, sf).collect()))
