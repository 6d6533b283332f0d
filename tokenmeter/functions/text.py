"""User-facing texts of the gate: status line, block notice, warnings.

Numbers are formatted with ``format_number`` which rounds HALF_EVEN on the
binary value, like Python's format specs: ``format_number(x, '0')`` is
``f"{x:.0f}"``, ``format_number(x, '0.0')`` is ``f"{x:.1f}"`` and
``format_number(n, 0)`` is ``f"{n:,}"``.  (``format_string('%.1f')`` rounds
HALF_UP and does not match.)
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmeter.params import UNLIMITED

# ---------------------------------------------------------------------------
# These texts must equal the reference's output character for
# character.  Placeholders in braces are filled with columns by ``render``.
ICON_WARNING = "⚠️"
ICON_OK = "\U0001f4ca"
ICON_BLOCKED = "❌"
INFINITY = "∞"
STATUS_LINE = "{icon} Usage: {today}/{daily_limit} today ({daily_pct}%) • {month}/{monthly_limit} month ({monthly_pct}%)"
BLOCK_NOTICE = (
    "⚠️ **Usage Limit Reached**\n\n"
    "You've reached your {limit_type} token limit for the **{group_name}** tier.\n\n"
    "- **Used:** {used} tokens\n"
    "- **Limit:** {limit} tokens\n"
    "- **Resets:** {reset_info}\n\n"
    "Contact your administrator to upgrade your plan."
)
BLOCK_HEADLINE = "❌ {limit_type_title} limit reached"
WARNING_REACHED = (
    "\n\n---\n"
    "⚠️ **Usage Limit Reached**\n\n"
    "You've reached your {which} limit for the **{group_name}** tier.\n"
    "- Today: {today}/{daily_limit} ({daily_pct}%)\n"
    "- This month: {month}/{monthly_limit} ({monthly_pct}%)\n\n"
    "Your next request will be blocked until the limit resets."
)
WARNING_APPROACHING = (
    "\n\n---\n"
    "⚠️ **Approaching Usage Limit**\n\n"
    "- Today: {today}/{daily_limit} ({daily_pct}%)\n"
    "- This month: {month}/{monthly_limit} ({monthly_pct}%)"
)
# ---------------------------------------------------------------------------

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` placeholders with columns: one ``concat`` expression
    (NULL if any filled value is NULL)."""
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def _pattern(x: Column, pattern: str) -> Column:
    """SQL ``format_number(x, '<DecimalFormat pattern>')``."""
    return F.call_function("format_number", x, F.lit(pattern))


def k_format(n: Column) -> Column:
    """``1.2K`` for n >= 1000 (never M), the plain integer below."""
    return F.when(n >= 1000, F.concat(_pattern(n.cast("double") / 1000.0, "0.0"), F.lit("K"))).otherwise(
        n.cast("string")
    )


def limit_text(limit: Column) -> Column:
    return F.when(limit == UNLIMITED, F.lit(INFINITY)).otherwise(k_format(limit))


def whole_percent(pct: Column) -> Column:
    """``f"{pct:.0f}"``."""
    return _pattern(pct, "0")


def thousands(n: Column) -> Column:
    """``f"{n:,}"``."""
    return F.format_number(n, 0)
