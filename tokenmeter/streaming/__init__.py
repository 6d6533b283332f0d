"""Structured Streaming: the ledger ingest (O-45), incremental rollups (O-46)
and the stateful gate (O-47)."""
