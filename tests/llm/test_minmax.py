"""Min-max hashing and components against brute force."""

import random

import __spark_entry__ as E
import numpy as np
from pyspark.sql import functions as F

from tokenmeter.llm import minmax
from tokenmeter.llm.components import components


def plain_sets(texts, width):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set())
    return out


def plain_components(ids, sets, percent=80):
    """Union-find over an inverted index of shingles."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in where.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            where[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(sets))]


def check(rows, got, width):
    sets = plain_sets([t for _, t in rows], width)
    want = sorted((str(i), len(s), str(c)) for (i, _), s, c in zip(rows, sets, plain_components([i for i, _ in rows], sets)))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want


def test_query_rows(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got = E.queries()["op9_minmax_near_dedup"](spark, sf).collect()
        check(rows, got, 2)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "One"), (5, "one"), (6, "two words"), (7, "TWO\twords"), (8, "two words"), (8, "two words"), (8, "other text here"),
            (None, "two words"), (None, "alone in the world"), (9, "É é"), (10, "é é"), (11, "a b c d e f g h i j k"), (12, "a b c d e f g h i j z")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bands int")
    check(rows, minmax.near_duplicates(docs, 2).collect(), 2)
    check(rows, minmax.near_duplicates(docs, 5).collect(), 5)
    assert minmax.near_duplicates(docs.limit(0), 2).count() == 0


def test_very_long_texts(spark):
    """200,000 words: a near copy that differs at the end only is linked."""
    rng = random.Random(8)
    long = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-5] + ["other"] * 5)), (3, " ".join(long[:100_000])), (4, "short text")]
    kept = minmax.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_large_group_and_chain(spark):
    """A group of near copies, and a chain whose ends are too far apart."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        t = list(base)
        t[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(t)))
    chain = [f"c{j}" for j in range(100)]
    for i in range(12):
        rows.append((1000 + i, " ".join(chain)))
        chain[8 * i : 8 * i + 4] = [f"n{i}-{j}" for j in range(4)]
    rng.shuffle(rows)
    check(rows, minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect(), 2)


def test_large_clusters_in_blocks(spark, monkeypatch):
    """Copies of one text with growing numbers of edits: outliers link only
    among themselves or through others, over several blocks."""
    monkeypatch.setattr(minmax, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{rng.randrange(9000)}" for _ in range(90)]
    rows = []
    for i in range(160):
        t = list(base)
        for j in rng.sample(range(90), rng.choice([1, 2, 4, 6, 8, 9])):
            t[j] = f"x{i}-{j}" if i % 3 else f"y{j}"
        rows.append((i, " ".join(t)))
    rows += [(500 + i, t) for i, (_, t) in enumerate(rows[:30])]
    check(rows, minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect(), 2)


def test_chain_grows_linearly(spark, monkeypatch):
    """A chain of shifted windows: texts compared or dealt to blocks double
    with the rows."""
    monkeypatch.setattr(minmax, "BLOCK", 16)
    counts, plain = {}, minmax.written

    def recorded(df, name):
        out = plain(df, name)
        if name in ("minmax-to-centre", "minmax-dealt"):
            counts[name] = out.count()
        return out

    monkeypatch.setattr(minmax, "written", recorded)
    rng = random.Random(5)
    run = [f"w{rng.randrange(10**6)}" for _ in range(1_400)]

    def moved(rows):
        counts.clear()
        check(rows, minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect(), 2)
        return sum(counts.values())

    chain = [(i, " ".join(run[8 * i : 8 * i + 100])) for i in range(160)]
    short, long = moved(chain[:80]), moved(chain)
    assert 0 < long <= 2.5 * short


def test_crowd_with_outliers_reaches_blocks(spark, monkeypatch):
    """Near copies of one text, and copies too far from it to link: these share
    buckets with the crowd and are met in blocks, with the same components."""
    monkeypatch.setattr(minmax, "BLOCK", 16)
    dealt, plain = [], minmax.written

    def recorded(df, name):
        out = plain(df, name)
        if name == "minmax-dealt":
            dealt.append(out.count())
        return out

    monkeypatch.setattr(minmax, "written", recorded)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for i in range(120):
        t = list(base)
        for j in rng.sample(range(100), 15 if i % 8 == 0 else 2):
            t[j] = f"x{i}-{j}"
        rows.append((i, " ".join(t)))
    check(rows, minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect(), 2)
    assert dealt and dealt[0] > 0


def test_signatures_estimate_similarity():
    own = minmax.Shingler(2)
    x = own.mix(np.arange(1, 2001, dtype=np.uint64))
    a, b = np.sort(x[:1800]), np.sort(x[200:])
    v = [(own.perm[:, None] * s + own.shift[:, None]) for s in (a, b)]
    same = np.concatenate([v[0].min(1) == v[1].min(1), v[0].max(1) == v[1].max(1)])
    assert abs(same.mean() - 0.8) < 0.08


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (41, 40), (41, 40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(42)}, **{i: 100 for i in range(100, 140)}, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_shuffle_once_a_round(spark, monkeypatch):
    """Labels few enough are broadcast: a round of a small link table is one
    grouping, even where Spark itself would broadcast nothing."""
    import random

    from tokenmeter.llm import components as C

    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(45)] + [(200, 200), (7, 5), (7, 5), (None, 1)]
    shuffles, write = [], C.written

    def counted(df, name):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name)

    monkeypatch.setattr(C, "written", counted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {n: n for e in links if None not in e for n in e}
    while any(want[a] != want[b] for a, b in links if a is not None):
        for a, b in links:
            if a is not None:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert max(shuffles) == 1 and sum(shuffles) <= len(shuffles) // 2 + 1, shuffles
