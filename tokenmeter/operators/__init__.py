"""DataFrame operators: rollups, quota status, gate, replay, extraction,
ledger maintenance, integrity reports and the hook texts."""
