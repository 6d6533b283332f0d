"""Fill-in-middle against a decoder that counts code points one by one."""

import hashlib

import numpy as np

from tokenmeter.llm import fim as F


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "a", "é", "日本語", "😀", "a😀é日", "no marks at all", "has <P> one", "<S>", "almost <P or M>", "<", "<<<<<<P", "x" * 7, "x" * 8, "é" * 4,
         "\x00\x7f\x80߿ࠀ￿\U00010000\U0010ffff", "line\nline\r\n", "P><S", "<P" + "><M"]


def test_rows_match_a_decoder(spark):
    rows = [(i, t, "x") for k in range(40) for i, t in enumerate(TEXTS, 100 * k)] + [(None, "without an id", "x"), (7, "twice", "x"), (7, "twice", "x")]
    rows += [(-3, "word é " * 30_000, "x"), (5000, "日本" * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    made = F.fill_in_middle(docs)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()), key=str)
    assert got == sorted(((i, *brute(i, t)) for i, t, _ in rows), key=str)
    back = made.withColumn("text", F.restored(made["output"], made["form"])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t, _ in rows)
    assert {f for *_, f, _, _, _ in got} == {"plain", "psm", "spm"}
    assert F.fill_in_middle(docs.limit(0)).count() == 0


def test_units_of_any_buffer():
    rng = np.random.default_rng(3)
    letters = list("aé日😀\x00߿￿")
    for size in [0, 1, 2, 7, 8, 9, 63, 64, 65, 500]:
        text = "".join(letters[i] for i in rng.integers(len(letters), size=size))
        data = np.frombuffer(text.encode(), np.uint8)
        units = F.Units(data)
        ends = np.cumsum([len(c.encode()) for c in text]).astype(np.int64)
        if size:
            assert units.after(np.arange(1, size + 1)).tolist() == ends.tolist()
        at = np.arange(len(data) + 1)
        assert units.rank(at).tolist() == [int((ends <= b).sum()) for b in at]


def test_small_slices(spark, monkeypatch):
    """A batch is cut into slices without changing a row."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 5)], "doc_id long, text string")
    whole = sorted(F.digest(F.fill_in_middle(docs)).collect())
    monkeypatch.setattr(F, "STEP_BYTES", 5)
    assert sorted(F.digest(F.fill_in_middle(docs)).collect()) == whole
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [(r["n"], r["form"], r["output"]) for r in F.fill_in_middle(blank).collect()] == [(0, "plain", "")] * 2
