"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses.  Each clause that holds a term of the insult lexicon
or a threat verb is read word by word as a string of word classes, by one
transducer composed of five:

* ``NEGATION`` marks an insult up to ``REACH`` words after a negation as denied,
  and a threat verb there as mild;
* ``REPORTED`` does so for what follows a verb of speech in the clause, or a
  word that names a word ("the word ...") just before it;
* ``TARGET`` tells an insult at somebody (a pronoun before or after it in the
  clause) from a bare one;
* ``THREAT`` emits a threat for an intent, a threat verb and a target, in the
  orders "will kill you" and "werde dich schlagen";
* ``insult(shares)`` emits the matched pattern with its weight.

``compose`` feeds the output of one machine to the next: states become tuples,
weights are multiplied.  A clause emits the pattern of the largest weight times
purity of its term.  The score of a text is the noisy-or of its clauses;
negated and reported ones weigh ``DAMPED`` and count once a text each, so they
alone stay below ``CUT`` however often they come.  A bare insult in plain prose is what
most labelled toxic texts hold: its weight is the learned share, not a rule.

*Learning* (``train``) uses a bounded sample of labelled rows: at most
``SAMPLE`` of them, in hash order of the id.  Lexicon terms are words and word
stems (first 4 to 8 letters) of toxic rows, kept by document counts: at least
``LEAST`` toxic rows, ``CONTEXTS`` different words before them (copies of one
text prove nothing), and a share of toxic rows of ``PURE``; all that pass are
kept.  A stem makes longer ones redundant.  The weight of a plain pattern
is the share of toxic texts among those it is the strongest plain pattern of,
smoothed towards its weight in ``PRIORS``, which holds where no labelled text emits it.  The
lexicon is bounded by the sample alone.

Scoring reads only the text, in one expression without a shuffle: an
Aho-Corasick automaton finds the terms, the transducer runs on their clauses.

Defined results: null and empty texts score the share of toxic rows among those
without any pattern; a very long text is read whole, each clause once, also
where it is one clause; repeated rows score alike; an empty table gives an empty
one; without labels the seed lexicon and the priors hold; other columns, also of
clashing names, are not read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, release

SAMPLE = 12_000
LEAST = 6
CONTEXTS = 5
PURE = 0.96
STEMS = (4, 5, 6, 7, 8)
CUT = 0.3

# A seed lexicon and the closed word classes of the grammar.
SEEDS = ("idiot", "moron", "scum", "loser")
THREATS = "kill hurt beat shoot stab burn destroy murder töten schlagen tuer frapper matar golpear".split()
INTENTS = "will gonna shall going must werde werden vais vas va voy vamos".split()
TARGETS = "you your yours he she they them him her his their du dich dir ihr euch tu te vous toi tú usted ustedes".split()
NEGATIONS = "not never no nobody cannot isn't aren't don't didn't nicht kein keine nie pas jamais aucun nunca ningún".split()
REPORTS = "said says called calling wrote quoted claims alleged sagte nannte dit appelle dijo llamó".split()
NAMINGS = "word words term noun wort begriff mot terme palabra término".split()
#: Weight of each plain pattern before labels are seen, worth PRIOR_N texts.
PRIORS = {"insult": 0.85, "target": 0.95, "threat": 0.8}
PRIOR_N = 4.0
#: Plain patterns, the strongest first.
STRENGTH = ("threat", "target", "insult")
#: Weight of a denied or reported insult.
DAMPED = 0.1
NONE_PRIOR, NONE_N = 0.05, 20.0

WORDS = r"[^\W\d_]+(?:'[^\W\d_]+)?"
CLAUSE_END = ".!?;:,\n"
#: Words after a negation that it reaches, and after a word that names words.
REACH, NAMED = 3, 2

CLASSES = ("insult", "threat", "intent", "target", "negation", "report", "naming", "other")


class Machine(NamedTuple):
    """A weighted letter transducer: (state, symbol) -> (state, output, weight).
    A symbol without an arc passes unchanged, with weight 1, in the same state."""

    start: object
    arcs: dict

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def fading(opener: str, reach: int, marks: dict[str, str], symbols: tuple[str, ...]) -> dict:
    """Arcs of a scope that ``opener`` opens for ``reach`` words: within it the
    symbols of ``marks`` are rewritten.  States are the words left."""
    arcs = {(left, opener): (reach, "other", 1.0) for left in range(reach + 1)}
    for left in range(1, reach + 1):
        arcs |= {(left, s): (left - 1, marks.get(s, s), 1.0) for s in symbols if s != opener}
    return arcs


NEGATION = Machine(0, fading("negation", REACH, {"insult": "denied", "threat": "mild"}, CLASSES))

#: A verb of speech reaches to the clause's end, a naming word NAMED words.
REPORTED = Machine(0, {
    **fading("naming", NAMED, {"insult": "told", "denied": "told", "threat": "mild"}, (*CLASSES, "denied", "mild")),
    **{(left, "report"): ("speech", "other", 1.0) for left in range(NAMED + 1)},
    ("speech", "insult"): ("speech", "told", 1.0), ("speech", "denied"): ("speech", "told", 1.0), ("speech", "threat"): ("speech", "mild", 1.0),
})

#: "open": a bare insult waits for a target after it.
TARGET = Machine("none", {
    ("none", "target"): ("aimed", "target", 1.0), ("none", "insult"): ("open", "bare", 1.0),
    ("open", "target"): ("aimed", "late", 1.0), ("open", "insult"): ("open", "bare", 1.0),
    ("aimed", "insult"): ("aimed", "aimed", 1.0),
})

#: "facing": intent, then target; "raised": intent, then threat verb.
THREAT = Machine("calm", {
    ("calm", "intent"): ("intent", "other", 1.0), ("calm", "threat"): ("calm", "other", 1.0),
    ("intent", "threat"): ("raised", "other", 1.0), ("intent", "target"): ("facing", "target", 1.0), ("intent", "late"): ("facing", "late", 1.0),
    ("facing", "threat"): ("facing", "threat", 1.0), ("raised", "threat"): ("raised", "other", 1.0),
    ("raised", "target"): ("facing", "threat", 1.0), ("raised", "late"): ("facing", "threat", 1.0),
})


def insult(shares: dict[str, float]) -> Machine:
    """The last machine: marked symbols become patterns with their weights
    ("" for none); "late" stays one, it aims the bare insult before it."""
    out = {"bare": ("insult", shares["insult"]), "aimed": ("target", shares["target"]), "late": ("late", shares["target"]),
           "threat": ("threat", shares["threat"]), "denied": ("negated", DAMPED), "told": ("reported", DAMPED)}
    quiet = {s: ("", 0.0) for s in (*CLASSES, "mild") if s not in out}
    return Machine("read", {("read", s): ("read", *o) for s, o in {**out, **quiet}.items()})


def compose(first: Machine, second: Machine, symbols: tuple[str, ...] = CLASSES) -> Machine:
    """The machine that reads ``symbols`` through ``first``, and its output
    through ``second``: reachable pairs of states, weights multiplied."""
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        a, b = todo.pop()
        for symbol in symbols:
            to_a, middle, w = first.step(a, symbol)
            to_b, out, v = second.step(b, middle)
            arcs[(a, b), symbol] = ((to_a, to_b), out, w * v)
            if (to_a, to_b) not in seen:
                seen.add((to_a, to_b))
                todo.append((to_a, to_b))
    return Machine(start, arcs)


def composed(shares: dict[str, float]) -> Machine:
    machine = NEGATION
    for following in (REPORTED, TARGET, THREAT, insult(shares)):
        machine = compose(machine, following)
    return machine


class Grammar:
    """A lexicon of terms (``stem*`` or a whole ``word``) with their purity, the
    weight of each plain pattern, and the composed machine."""

    def __init__(self, lexicon: dict[str, float], shares: dict[str, float] | None = None, none: float = NONE_PRIOR):
        import ahocorasick

        self.lexicon, self.shares, self.none = lexicon, shares or dict(PRIORS), none
        self.machine = composed(self.shares)
        self.found = ahocorasick.Automaton()
        for term in lexicon:
            self.found.add_word(term.rstrip("*"), len(term.rstrip("*")))
        for verb in THREATS:
            self.found.add_word(verb, len(verb))
        self.found.make_automaton()
        self.classes = {w: c for c, ws in (("threat", THREATS), ("intent", INTENTS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("naming", NAMINGS)) for w in ws}
        self.lengths = sorted({len(t) - 1 for t in lexicon if t.endswith("*")})
        self.word = re.compile(WORDS)
        self.end = re.compile(f"[{re.escape(CLAUSE_END)}]")

    def purity(self, word: str) -> float:
        best = self.lexicon.get(word, 0.0)
        for n in self.lengths:
            best = max(best, self.lexicon.get(word[:n] + "*", 0.0)) if len(word) >= n else best
        return best

    def read(self, clause: str) -> tuple[str, float]:
        """The pattern of the largest weight that the machine emits for a clause,
        and that weight times the purity of its term ("" for none)."""
        arcs, state = self.machine.arcs, self.machine.start
        best, most, bare = "", 0.0, 0.0
        for m in self.word.finditer(clause):
            word = m[0]
            kind, pure = self.classes.get(word), 0.0  # a word of a closed class is no insult by its stem
            if not kind:
                pure = self.purity(word)
                kind = "insult" if pure else "other"
            state, out, weight = arcs[state, kind]
            if not out:
                continue
            if out == "insult":
                bare = max(bare, pure)
            elif out == "late":
                out, pure = "target", bare
            elif out == "threat":
                pure = 1.0
            if weight * pure > most:
                best, most = out, weight * pure
        return best, most

    def patterns(self, text: str) -> list[tuple[str, float]]:
        """(pattern, weight) of every clause that emits one; whole clauses, each
        read once."""
        low = text.lower()
        done, out = -1, []
        for last, n in self.found.iter(low):
            start = last - n + 1
            if start < done or (start and (low[start - 1].isalpha())):
                continue
            begin = max(low.rfind(c, max(done, 0), start) for c in CLAUSE_END) + 1
            begin = max(begin, done, 0)
            stop = self.end.search(low, last + 1)
            done = stop.start() if stop else len(low)
            emitted = self.read(low[begin:done])
            if emitted[0]:
                out.append(emitted)
        return out

    def score(self, text: str) -> float:
        clean, damped = 1.0 - self.none, {}
        for pattern, weight in self.patterns(text):
            if pattern in self.shares:
                clean *= 1.0 - min(0.999, weight)
            else:
                damped[pattern] = max(damped.get(pattern, 0.0), weight)
        for weight in damped.values():
            clean *= 1.0 - weight
        return 1.0 - clean


def word_terms(text: Column) -> Column:
    """array(struct(term, before)): each word and its stems, with the word
    before it."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)[^\W\d_]+(?:'[^\W\d_]+)?"), F.lit(0))
    pairs = F.arrays_zip(words.alias("w"), F.concat(F.array(F.lit("")), words).alias("b"))
    terms = lambda p: [F.struct(p["w"].alias("term"), p["b"].alias("before")), *[
        F.when(F.length(p["w"]) >= n, F.struct(F.concat(F.substring(p["w"], 1, n), F.lit("*")).alias("term"), p["b"].alias("before"))) for n in STEMS]]
    return F.flatten(F.transform(F.filter(pairs, lambda p: p["w"].isNotNull()), lambda p: F.array(*terms(p))))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms and purities from ``sample`` (id, text, toxic); bounded by it."""
    terms = sample.select("id", "toxic", F.explode(word_terms(F.col("text"))).alias("t")).where("t IS NOT NULL")
    bad = (terms.where("toxic = 1").groupBy(F.col("t.term").alias("term"))
           .agg(F.countDistinct("id").alias("bad"), F.countDistinct("t.before").alias("contexts"))
           .where((F.col("bad") >= LEAST) & (F.col("contexts") >= CONTEXTS)).persist())
    try:
        n = bad.count()
        seen = terms.where("toxic = 0").select("id", F.col("t.term").alias("term")).join(maybe_broadcast(bad.select("term"), n), "term", "left_semi")
        good = seen.groupBy("term").agg(F.countDistinct("id").alias("good"))
        n_good = F.coalesce("good", F.lit(0))
        rows = (bad.join(good, "term", "left").where(F.col("bad") >= PURE * (F.col("bad") + n_good))
                .withColumn("pure", F.col("bad") / (F.col("bad") + n_good + 1.0))
                .select("term", "pure").collect())  # terms of the sample's toxic rows
    finally:
        bad.unpersist()
    lexicon: dict[str, float] = {s: 0.9 for s in SEEDS}
    for r in sorted(rows, key=lambda r: (len(r["term"].rstrip("*")), r["term"])):
        stem = r["term"].rstrip("*")
        if not any(stem[:n] + "*" in lexicon for n in STEMS if n <= len(stem) and (n < len(stem) or not r["term"].endswith("*"))):
            lexicon[r["term"]] = r["pure"]
    return lexicon


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Learn from the rows of ``labels`` (doc_id, toxic); the caller leaves out
    what is held out.  Only the sampled ids are joined to texts."""
    picked = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(maybe_broadcast(picked, sample), "id").persist()
    try:
        grammar = Grammar(learn_lexicon(rows))
        got = rows.select("toxic", patterns_column(grammar, F.col("text")).alias("kinds")).groupBy("toxic", "kinds").count().collect()  # 2 x subsets of the patterns
    finally:
        rows.unpersist()
    bad, good = dict.fromkeys(PRIORS, 0), dict.fromkeys(PRIORS, 0)
    none = [0, 0]
    for r in got:
        kinds = r["kinds"].split()
        strongest = next((k for k in STRENGTH if k in kinds), None)
        if strongest:
            (bad if r["toxic"] else good)[strongest] += r["count"]
        none[r["toxic"]] += r["count"] * (not kinds)
    shares = {k: (bad[k] + PRIOR_N * p) / (bad[k] + good[k] + PRIOR_N) for k, p in PRIORS.items()}
    return Grammar(grammar.lexicon, shares, (none[1] + NONE_N * NONE_PRIOR) / (sum(none) + NONE_N))


def patterns_column(grammar: Grammar, text: Column) -> Column:
    """The kinds of patterns a text emits, sorted, space-joined."""
    lexicon = grammar.lexicon

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Grammar(lexicon)
        for batch in batches:
            yield pa.array([" ".join(sorted({k for k, _ in own.patterns(t.as_py() or "")})) for t in batch], pa.string())
        release()

    return run(text)


def score_column(grammar: Grammar, text: Column) -> Column:
    parts = (grammar.lexicon, grammar.shares, grammar.none)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Grammar(*parts)
        for batch in batches:
            yield pa.array([own.score(t.as_py() or "") for t in batch], pa.float64())
        release()

    return run(F.coalesce(text.cast("string"), F.lit("")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(spark, sf_dir: str) -> Grammar:
    from tokenmeter.llm.common import table

    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels.where(~held_out(F.col("doc_id"))))


def q_toxicity(spark, sf_dir: str) -> DataFrame:
    from tokenmeter.llm.common import table

    grammar = trained(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(grammar, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
