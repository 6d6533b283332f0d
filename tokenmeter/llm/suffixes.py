"""Suffix arrays by linear grouping: a small helper, for one task's text.

Suffixes are grouped by their Lyndon prefixes (the longest Lyndon word each
begins with).  First, groups start as the suffixes of one first symbol and are
processed in descending order.  A suffix of the processed group points to its
previous smaller one: the nearest position before it whose group has not been
processed.  A position pointed to k times continues with k copies of the
group's Lyndon word, so it moves to a new group right above its own, those
pointed to most often highest.  Then one ascending pass places suffixes: the
one before a placed suffix, and on along its previous-smaller pointers, goes to
the next free place of its group.  No ranks are renamed and no text is reduced
recursively."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of all suffixes of ``text`` in ascending order; a suffix
    sorts before its extensions."""
    n = len(text) + 1  # with an end symbol below all others
    end = n - 1
    members: list[list[int]] = [[end]]
    group = [0] * n
    of_symbol: dict[int, int] = {}
    for s in sorted(set(text)):
        of_symbol[s] = len(members)
        members.append([])
    for i, s in enumerate(text):
        g = of_symbol[s]
        group[i] = g
        members[g].append(i)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1] = -1

    prev = [-1] * n
    done = bytearray(n)
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]  # others have moved up meanwhile
        own.sort()
        members[g] = own
        for i in own:
            done[i] = 1
        times: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if times:
            by_times: dict[int, list[int]] = {}
            for p, k in times.items():
                by_times.setdefault(k, []).append(p)
            for k in sorted(by_times, reverse=True) if len(by_times) > 1 else by_times:
                moved: dict[int, int] = {}
                for p in by_times[k]:
                    old = group[p]
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(members)
                        members.append([])
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = new
                        below[up] = new
                    group[p] = new
                    members[new].append(p)
        g = below[g]

    free = [0] * len(members)
    order, at, g = [], 0, 0
    while g >= 0:
        order.append(g)
        free[g] = at
        at += len(members[g])
        g = above[g]
    out = [0] * n
    placed = bytearray(n)
    out[0], placed[end] = end, 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = prev[j]
    return out[1:]
