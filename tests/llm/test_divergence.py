"""The source divergence audit against counting by hand, and its trees."""

import re
from collections import Counter

import numpy as np
import pytest

from tokenmeter.llm import divergence as D


def terms_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows, least=10, top=10):
    rows = [(lang or "", source or "", terms_of(text)) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in docs.items() if n >= least)
        v, counts = len(kept), {}
        for _, source, ts in mine:
            counts.setdefault(source, Counter()).update(t for t in ts if docs[t] >= least)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v)
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for source, c in counts.items():
            pairs = [(-sum(f(share(c, t), share(o, t)) for t in kept), other) for other, o in counts.items() if other != source]
            best = [(-f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(best, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def made_up(seed, n=400, sources=7):
    rng = np.random.default_rng(seed)
    words = ["w" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(60)] + ["Élan", "日本", "straße", "ſ", "K"]
    rows = []
    for i in range(n):
        source = None if i % 29 == 0 else f"s{min(rng.integers(sources), rng.integers(sources))}"
        lang = [None, "en", "en", "en", "de"][rng.integers(5)]
        drawn = rng.choice(words, rng.integers(0, 30), p=np.arange(len(words), 0, -1) / sum(range(len(words) + 1)))
        rows.append((lang, source, " ".join(w.upper() if rng.random() < 0.2 else w for w in drawn) + ["", "!", "\x00x9"][i % 3]))
    return rows + [("fr", "a", "rare"), ("fr", "b", None), ("fr", "b", ""), ("it", "alone", "uno"), ("en", "silent", "123 !"), ("en", "s0", rows[5][2]), ("en", "s0", rows[5][2])]


@pytest.mark.parametrize("chunk", [64, 2])
def test_audit_matches_counting(spark, chunk):
    """Also with groups dealt to many chunks."""
    rows = made_up(chunk)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")
    got = sorted(tuple(r) for r in D.audit(docs.repartition(3), groups_a_chunk=chunk).collect())
    assert got == brute(rows)
    assert any(r[4] for r in got if r[2] == "pair") and any(r[2] == "term" for r in got)


def test_many_term_ranges_flushes_and_pieces(spark, monkeypatch):
    """Small trees, tables and pieces change nothing: terms lie in many ranges."""
    rows = made_up(5, n=300)
    rows.append(("en", "s1", " ".join(f"{a}{b}" for a in "abcdefgh" for b in "abcdefgh") * 50))
    monkeypatch.setattr(D, "HEIGHT", 3)
    monkeypatch.setattr(D, "WIDTH", 8)
    monkeypatch.setattr(D, "PAIRS", 3)
    monkeypatch.setattr(D, "FLUSH", 20)
    monkeypatch.setattr(D, "PIECE", 50)
    monkeypatch.setattr(D.Forest.__init__, "__defaults__", (3,))
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(r) for r in D.audit(docs).collect()) == brute(rows)


def test_equal_subtrees_are_one_node():
    """Two groups with the same counts share their root; an absent stretch is the
    empty node; each distinct pair of leaves is priced once."""
    place = np.arange(1000)
    one, two = place % 3 + 1, place % 3 + 1
    forest = D.Forest(np.repeat([0, 1], 1000), np.tile(place, 2), np.concatenate((one, two)), 3, 14)
    assert forest.root[0] == forest.root[1] != 0 and forest.root[2] == 0
    pair, x, y, times = forest.leaf_pairs(np.array([0, 0]), np.array([1, 2]))
    assert sorted(zip(pair.tolist(), x.tolist(), y.tolist(), times.tolist())) == [
        (0, 0, 0, 2**14 - 1000), (0, 1, 1, 334), (0, 2, 2, 333), (0, 3, 3, 333), (1, 0, 0, 2**14 - 1000), (1, 1, 0, 334), (1, 2, 0, 333), (1, 3, 0, 333)]
    assert max(len(left) for left, _ in forest.below) < 1000


def test_shares_are_exact_for_large_counts():
    for count, words in [(0, 2), (10**13, 10**15), (9 * 10**14, 9 * 10**15), (1, 3), (10**10, 10**10 + 2)]:
        assert int(D.shares(np.array([count]), np.array([words]))[0]) == 1 + 10**9 * (count + 2) // words


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
