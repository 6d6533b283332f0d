"""The gate as a sequential loop over one key's time-ordered requests.

Small per-group helper: one bucket of a user whose usage at its begin is known
(the composed replay), or one user's requests of a micro-batch (the keyed
stream).  It applies the reference's rules
literally: check the status before the request (S1, equality blocks), record
the request's tokens only if it is admitted.
"""

from __future__ import annotations

import sys

import pandas as pd

# Executors need this code but not the package: ship it inside the pickled
# task (cloudpickle by value) instead of importing tokenmeter on the workers.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

REPLAY_SCHEMA = (
    "id long, user_id string, requested_at timestamp_ntz, role string, group_name string, total_tokens int, "
    "admitted boolean, outcome string, limit_type string, tokens_today_before long, tokens_month_before long"
)


def _under(used: int, limit: int) -> bool:
    return limit == -1 or used < limit


def step(state: dict, day, month, tokens: int, dl: int, ml: int, admin: bool, blocking: bool, carry_day: int = 0,
         carry_month: int = 0):
    """Advance one request.  ``state`` holds day, month, day_used, month_used;
    a day and a month begin with the usage carried into them."""
    if state.get("month") != month:
        state.update(month=month, month_used=carry_month, day=None)
    if state.get("day") != day:
        state.update(day=day, day_used=carry_day)
    today, mon = state["day_used"], state["month_used"]
    label = "daily" if not _under(today, dl) else ("monthly" if not _under(mon, ml) else None)
    over = label is not None
    admitted = (not over) or admin or not blocking
    if not over:
        outcome = "allowed"
    elif blocking and not admin:
        outcome = "blocked"
    elif admin:
        outcome = "bypass"
    else:
        outcome = "advisory"
    if admitted:
        state["day_used"] = today + int(tokens)
        state["month_used"] = mon + int(tokens)
    return admitted, outcome, label, today, mon


def replay_fn(blocking: bool):
    """``applyInPandas`` function over one bucket of a user."""
    return lambda pdf: replay_group(pdf, blocking)


def replay_group(pdf: pd.DataFrame, blocking: bool) -> pd.DataFrame:
    pdf = pdf.sort_values(["requested_at", "id"], kind="mergesort")
    state: dict = {}
    out = []
    for r in pdf.itertuples(index=False):
        tok = 0 if pd.isna(r.total_tokens) else int(r.total_tokens)
        adm, outcome, label, today, mon = step(
            state, r.day_key, r.month_key, tok, int(r.daily_limit), int(r.monthly_limit), bool(r.is_admin), blocking,
            int(r.carry_day_used), int(r.carry_month_used),
        )
        out.append((r.id, r.user_id, r.requested_at, r.role, r.group_name, r.total_tokens, adm, outcome, label, today, mon))
    cols = ["id", "user_id", "requested_at", "role", "group_name", "total_tokens", "admitted", "outcome",
            "limit_type", "tokens_today_before", "tokens_month_before"]
    return pd.DataFrame(out, columns=cols)
