"""The toxicity grammar: machines, patterns, an independent scorer, held-out
accuracy, edge rows."""

import random
import re
import zlib

import __spark_entry__ as E

from tokenmeter.llm import toxicity as T

GRAMMAR = T.Grammar({"idiot": 0.95, "scum": 0.95, "lowe*": 0.9})


def kinds(text):
    return [k for k, _ in GRAMMAR.patterns(text)]


def test_clause_patterns():
    assert kinds("What an IDIOT.") == ["insult"]
    assert kinds("you idiot, and idiot you") == ["target", "target"]
    assert kinds("He is not an idiot.") == ["negated"]
    assert kinds("She said he was scum") == ["reported"]
    assert kinds("I will kill you") == kinds("ich werde dich schlagen") == ["threat"]
    assert kinds("I will kill time") == kinds("I will not kill you") == kinds("she said I will kill you") == []
    assert kinds("The word idiot has five letters.") == ["reported"]
    assert kinds("what an idiot he is") == kinds("he is such an idiot") == ["target"]
    assert kinds("not an idiot but a scum") == ["insult"]
    assert kinds("the kill was clean") == []
    assert kinds("idiotic subidiot scummy") == []
    assert kinds("das loweient Ding") == ["insult"]
    assert kinds("not a b c d e idiot") == ["insult"]
    assert kinds("idiot" + " a" * 60_000 + ". scum") == ["insult", "insult"]


def run_machine(machine, symbols):
    state, out, weight = machine.start, [], 1.0
    for s in symbols:
        state, o, w = machine.step(state, s)
        out.append(o)
        weight *= w
    return out, weight


def test_composition_is_the_cascade():
    """The composed machine does what the machines do one after the other."""
    rng = random.Random(3)
    chain = [T.NEGATION, T.REPORTED, T.TARGET, T.THREAT, T.insult(T.PRIORS)]
    whole = T.composed(T.PRIORS)
    for _ in range(3000):
        symbols = [rng.choice(T.CLASSES) for _ in range(rng.randrange(12))]
        out, weight = symbols, 1.0
        for m in chain:
            out, w = run_machine(m, out)
            weight *= w
        assert run_machine(whole, symbols) == (out, weight)


def plain_score(text):
    """The rules by hand, word positions instead of states."""
    clean, denied, told = 1 - GRAMMAR.none, 0.0, 0.0
    for clause in re.split("[" + T.CLAUSE_END + "]", text.lower()):
        ws = re.findall(r"[a-zäöü]+", clause)
        closed = [w in T.THREATS + T.INTENTS + T.TARGETS + T.NEGATIONS + T.REPORTS + T.NAMINGS for w in ws]
        near = lambda i, words, n: any(w in words for w in ws[max(0, i - n) : i])  # noqa: E731, B023
        hits = []
        for i, w in enumerate(ws):
            if not closed[i] and (p := {"idiot": 0.95, "scum": 0.95}.get(w, 0.9 if w.startswith("lowe") else 0.0)):
                if near(i, T.REPORTS, i) or near(i, T.NAMINGS, T.NAMED):
                    hits.append(("told", T.DAMPED * p))
                elif near(i, T.NEGATIONS, T.REACH):
                    hits.append(("denied", T.DAMPED * p))
                else:
                    aimed = any(v in T.TARGETS for v in ws)
                    hits.append(("plain", T.PRIORS["target" if aimed else "insult"] * p))
        plain = max((p for k, p in hits if k == "plain"), default=0.0)
        if plain:
            clean *= 1 - min(0.999, plain)
        elif hits:
            top = max(p for _, p in hits)
            kind = next(k for k, p in hits if p == top)
            denied, told = (max(denied, top), told) if kind == "denied" else (denied, max(told, top))
    return 1 - clean * (1 - denied) * (1 - told)


def test_independent_scorer():
    rng = random.Random(5)
    words = ["idiot", "scum", "loweient", "you", "he", "not", "nie", "said", "word", "a", "tree", "walks", ".", ",", "\n"]
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(40)))
        assert abs(GRAMMAR.score(text) - plain_score(text)) < 1e-9, text


def test_frames_change_the_verdict():
    s = GRAMMAR.score
    assert all(s(t) < T.CUT for t in ("not an idiot", "She said idiot", "The word idiot has five letters.", "I am not an idiot. " * 400, "they called him scum. " * 400))
    assert all(s(t) >= T.CUT for t in ("you idiot", "I will kill you", "what an idiot", "She said no. You idiot!"))


def test_no_cap_on_terms(spark):
    """Every term that passes is kept, however many: 7,000 here."""
    spread = [f"zq{a}{b}{c}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst" for c in "abcdefghijklmnopqr"][:7000]
    words = ["x" + w for w in spread]  # stems of 4 letters are shared by 18 words
    rows = [(i, " ".join(f"f{chr(97 + i)} {w}" for w in words), 1) for i in range(6)]
    rows += [(10 + i, " ".join(w[:5] + "y fa" for w in words[::18]), 0) for i in range(2)]
    lexicon = T.learn_lexicon(spark.createDataFrame(rows, "id long, text string, toxic int"))
    assert all(any(t in lexicon for t in (w, *(w[:n] + "*" for n in T.STEMS))) for w in words) and len(lexicon) >= 7000


def test_scores_rank():
    s = GRAMMAR.score
    assert s("") == s("a plain text") < T.CUT
    assert s("you idiot") > s("an idiot") > s("not an idiot") > s("plain")
    assert 0 <= s("") and s("idiot. " * 500) <= 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in E.queries()["op7_toxicity"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in labels)
    good = sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in labels) / len(labels)
    hit = [got[r["doc_id"]]["predicted"] for r in labels if r["toxic"]]
    false = [got[r["doc_id"]]["predicted"] for r in labels if not r["toxic"]]
    print("accuracy", good, "recall", sum(hit) / len(hit), "false", sum(false) / len(false))
    assert good > 0.95 and sum(hit) / len(hit) > 0.7 and sum(false) / len(false) < 0.02
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5, 1), (None, "idiot", 0.5, 0), (2, "", 0.5, 1), (2, "", 0.5, 1)], "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    grammar = T.train(docs, labels)
    got = docs.select(T.score_column(grammar, docs["text"])).collect()
    assert len(got) == 4 and all(0 <= r[0] <= 1 for r in got)
    empty = T.train(docs.limit(0), labels.limit(0))
    assert docs.limit(0).select(T.score_column(empty, docs["text"])).count() == 0
