"""The gate as functions that compose, for user-months in which requests that no
limit holds carry negative counts (then a counter may fall below its limit
again, and the closed form does not hold).

Within a day both counters move by the same amounts, so what decides is one
number: the room ``h`` left under the nearer limit when a request comes (see
``room``).  A request of ``t`` tokens maps ``h`` to ``h - t`` if it counts: if no
limit holds it, or ``h > 0``.  A run of requests is a piecewise function of
``h``: pieces ``(cut[i], cut[i + 1]]``, on each of which ``h`` falls by
``fall[i]``.  Composition is associative, so functions of buckets are made in
parallel, composed to functions of days in parallel, and a month is at most 31
evaluations; the rooms found go down the same way.  No group holds the requests
of more than one bucket, or more than the pieces of one day (a month: the pieces
of its days within the reach of the limits)."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa

# Executors need this code but not the package: ship it inside the pickled
# task (cloudpickle by value) instead of importing tokenmeter on the workers.
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Room under no limit, and the least cut.
FAR = 1 << 62


def room(day_used: int, month_used: int, dl: int, ml: int) -> int:
    return min(FAR if dl == -1 else dl - day_used, FAR if ml == -1 else ml - month_used)


def simplified(cut, fall):
    new = np.ones(len(cut), bool)
    new[1:] = fall[1:] != fall[:-1]
    return cut[new], fall[new]


def of_requests(tokens, free):
    """The function of requests in order."""
    cut, fall = np.array([-FAR], np.int64), np.array([0], np.int64)
    for t, always in zip(tokens, free):
        if always:
            fall = fall + t
        elif t:
            # A piece is split where h - fall passes 0.
            end = np.append(cut[1:], FAR)
            inside = (cut < fall) & (fall < end)
            at = np.sort(np.concatenate((cut, fall[inside])))
            low = fall[np.searchsorted(cut, at, side="right") - 1]
            cut, fall = simplified(at, np.where(at >= low, low + t, low))
    return cut, fall


def then(first, second):
    """``second`` after ``first``."""
    (cut, fall), (cut2, fall2) = first, second
    end = np.append(cut[1:], FAR)
    parts_cut, parts_fall = [], []
    begin = np.searchsorted(cut2, np.maximum(cut - fall, -FAR), side="right") - 1
    stop = np.searchsorted(cut2, end - fall, side="left")
    for c, s, b, e in zip(cut.tolist(), fall.tolist(), np.maximum(begin, 0).tolist(), stop.tolist()):
        inner = cut2[b : max(e, b + 1)] + s
        inner[0] = c
        parts_cut.append(inner)
        parts_fall.append(fall2[b : max(e, b + 1)] + s)
    return simplified(np.concatenate(parts_cut), np.concatenate(parts_fall))


def apply(function, h: int) -> int:
    """How far ``h`` falls."""
    cut, fall = function
    return int(fall[max(0, np.searchsorted(cut, h, side="left") - 1)])


def within(function, most: int):
    """The pieces for rooms up to ``most``."""
    cut, fall = function
    n = max(1, int(np.searchsorted(cut, most, side="left")))
    return cut[:n], fall[:n]


def _row(rows, name, i=0):
    return rows.column(name)[i].as_py()


def _functions(rows):
    return [(np.array(c.as_py(), np.int64), np.array(f.as_py(), np.int64)) for c, f in zip(rows.column("cut"), rows.column("fall"))]


def bucket_function(key, rows):
    """One row per bucket: its function."""
    rows = rows.sort_by([("requested_at", "ascending"), ("id", "ascending")])
    cut, fall = of_requests(rows.column("tok").to_pylist(), rows.column("free").to_pylist())
    return pa.table({**_keys(key, "user_id", "month_key", "day_key", "bucket_key"), **_arrays(cut, fall)})


def day_function(key, rows):
    """One row per day: the functions of its buckets, composed in order."""
    rows = rows.sort_by("bucket_key")
    whole = None
    for f in _functions(rows):
        whole = f if whole is None else then(whole, f)
    most = room(0, 0, _row(rows, "daily_limit"), _row(rows, "monthly_limit"))
    least_carry = min(0, _row(rows, "carry_day"), _row(rows, "carry_month"))
    cut, fall = whole if min(whole[1].min(), least_carry) < 0 else within(whole, most)
    return pa.table({**_keys(key, "user_id", "month_key", "day_key"), **_arrays(cut, fall), **_figures(rows)})


def month_days(key, rows):
    """Per day of a month: usage when it begins, by evaluating the days in turn."""
    rows = rows.sort_by("day_key")
    used = _row(rows, "carry_month")
    out = []
    for i, f in enumerate(_functions(rows)):
        day = _row(rows, "carry_day", i)
        out.append((day, used))
        used += apply(f, room(day, used, _row(rows, "daily_limit", i), _row(rows, "monthly_limit", i)))
    n = len(out)
    return pa.table({"user_id": pa.array([key[0].as_py()] * n, pa.string()), "day_key": rows.column("day_key"),
                     "day_used": pa.array([d for d, _ in out], pa.int64()), "month_used": pa.array([m for _, m in out], pa.int64())})


def day_buckets(key, rows):
    """Per bucket of a day: usage when it begins."""
    rows = rows.sort_by("bucket_key")
    day, month = _row(rows, "day_used"), _row(rows, "month_used")
    out = []
    for f in _functions(rows):
        out.append((day, month))
        fallen = apply(f, room(day, month, _row(rows, "daily_limit"), _row(rows, "monthly_limit")))
        day, month = day + fallen, month + fallen
    n = len(out)
    return pa.table({"user_id": pa.array([key[0].as_py()] * n, pa.string()), "day_key": pa.array([key[1].as_py()] * n, pa.int32()),
                     "bucket_key": rows.column("bucket_key"),
                     "carry_day_used": pa.array([d for d, _ in out], pa.int64()), "carry_month_used": pa.array([m for _, m in out], pa.int64())})


def _keys(key, *names):
    kinds = {"user_id": pa.string(), "month_key": pa.date32(), "day_key": pa.int32(), "bucket_key": pa.int32()}
    return {n: pa.array([k.as_py()], kinds[n]) for n, k in zip(names, key)}


def _arrays(cut, fall):
    return {"cut": pa.array([cut.tolist()], pa.list_(pa.int64())), "fall": pa.array([fall.tolist()], pa.list_(pa.int64()))}


def _figures(rows):
    return {n: pa.array([_row(rows, n)], pa.int64()) for n in ("daily_limit", "monthly_limit", "carry_day", "carry_month")}
