"""tokenmeter: LLM token-usage metering and tiered-quota analytics on Spark.

The ledger of token usage is a fact table; tiers and user->tier assignments are
dimensions.  Every operator is a DataFrame transformation so Catalyst and AQE
choose the physical plan; see README.md for the operator map.
"""

from tokenmeter.params import Clock, QuotaSettings

__all__ = ["Clock", "QuotaSettings"]
