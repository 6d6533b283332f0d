"""The subpackage's registered queries and, where SQL can express one, its
DuckDB oracle."""

from __future__ import annotations

from tokenmeter.llm import bpe, contamination, divergence, fim, minmax, repeats, secrets, topk, toxicity, unigram, urls, vectors, warc

QUERIES = {
    "op1_decontamination": contamination.q_decontamination,
    "op2_repeats": repeats.q_repeats,
    "op3_vectors": vectors.q_vectors,
    "op4_bpe": bpe.q_bpe,
    "op5_secret_scans": secrets.q_secret_scans,
    "op6_warc": warc.q_warc,
    "op7_toxicity": toxicity.q_toxicity,
    "op8_token_counts": unigram.q_token_counts,
    "op9_minmax_near_dedup": minmax.q_minmax,
    "op10_url_filters": urls.q_url_filters,
    "op11_fim": fim.q_fim,
    "op12_source_divergence": divergence.q_divergence,
    "op13_topk": topk.q_topk,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": contamination.ORACLE,
    "op6_warc": warc.ORACLE,
    "op11_fim": fim.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_topk": topk.ORACLE,
}
