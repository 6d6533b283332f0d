"""A corpus pipeline of the operators in ``tokenmeter.llm``: toxic documents
go, one document of each near-duplicate group stays, documents that hold a
benchmark passage go, secrets are redacted, and the rest is encoded.

Every stage takes all rows its predecessor kept.  A null text is not toxic, has
no near-duplicates, no passages and no secrets, and encodes to no tokens; an
empty table stays empty; extra columns are carried along."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmeter.llm import bpe, contamination, minmax, secrets, toxicity
from tokenmeter.llm.common import table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity cut."""
    grammar = toxicity.trained(spark, sf_dir)
    return docs.where(toxicity.score_column(grammar, docs["text"]) < toxicity.CUT)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word shingle similarity 0.8."""
    return minmax.keep_one(docs, width=5, percent=80)


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word run of a benchmark item."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their text as ``[kind]``."""
    return secrets.redact(spark, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the kept texts."""
    import public_tokenizers

    return bpe.digest(bpe.encode_documents(docs, bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json"))))


STAGES = [
    ("toxicity", toxic_out),
    ("minmax_near_dedup", near_duplicates_out),
    ("decontamination", contaminated_out),
    ("secret_scans", secrets_redacted),
    ("bpe", encoded),
]

#: Learned scores, min-max signatures and token ids are not SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
