"""Token counts under a unigram vocabulary, without making the tokens.

A text is marked as the vocabulary expects (a leading word mark, spaces turned
into marks).  An Aho-Corasick automaton over the vocabulary enumerates every
piece that ends at each character; dynamic programming carries only the best
score and the number of tokens of the best path to each position.

Tie rule (that of the public unigram model): a later candidate replaces the
best one only with a strictly greater score, candidates coming in the order of
their start, so the earliest start wins.  A character without a piece of its
own costs ``least score - 10`` and counts as its UTF-8 bytes when the
vocabulary holds all byte pieces, else as one token (runs of them fused).

No piece crosses from a character to a word mark after it, so the best path
of a text is that of its stretches ``marks* other+``, each counted once per
task and remembered (up to ``REMEMBERED``).  Scores are whole numbers, so the
split changes no sum.

The vocabulary is a parameter (pieces and scores of a public file); it is never
trained.  No shuffle: one expression over the text column.

*Files of BPE type.*  Their scores are merge ranks, not log probabilities, so
the best path is not what the file's own encoder gives.  With ``merges`` the
rows also carry ``n_bpe_tokens``, the count by that encoder's rule: characters
are merged, the pair with the highest score first (leftmost on ties), until no
pair is a piece; a character without a piece counts as its UTF-8 bytes.

Defined results: null and empty texts have 0 tokens; texts of any length are
counted whole, and a stretch of any length is one; repeated rows give
repeated results; an empty table gives an empty table; other columns are not
read."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.bpe import WordCache

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the public model
NEVER = float("-inf")
#: Plain words a task remembers, some 200 bytes each.
REMEMBERED = 1_000_000
#: Characters up to which a stretch is merged in a contiguous array.
SHORT = 48


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order of a public sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(len(model))]


def read_merges(path: str) -> dict[str, float]:
    """Score of every piece that the BPE encoder of a public sentencepiece file
    may make by merging (no control, unknown or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if not all(model.piece_to_id(f"<0x{b:02X}>") != model.unk_id() for b in range(256)):
        raise ValueError("this file has no byte pieces")
    made = (i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return {model.id_to_piece(i): model.get_score(i) for i in made}


def merged_count(s: str, merges: dict[str, float], known: frozenset = frozenset()) -> int:
    """Tokens of one stretch by the BPE rule: short ones by a contiguous rank
    array, long ones from a heap over linked parts."""
    n = len(s)
    if n <= SHORT:
        get = merges.get
        bounds = list(range(n + 1))
        scores = [get(s[i : i + 2], NEVER) for i in range(n - 1)]
        while scores:
            top = max(scores)
            if top == NEVER:
                break
            i = scores.index(top)
            del bounds[i + 1], scores[i]
            if i < len(scores):
                scores[i] = get(s[bounds[i] : bounds[i + 2]], NEVER)
            if i:
                scores[i - 1] = get(s[bounds[i - 1] : bounds[i + 1]], NEVER)
        if known.issuperset(s):  # characters that are pieces
            return len(bounds) - 1
        return sum(1 if b - a > 1 or s[a] in merges else len(s[a].encode("utf-8")) for a, b in zip(bounds, bounds[1:]))
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (score := merges.get(s[i : end[j]])) is not None:
            heapq.heappush(heap, (-score, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue  # a part of this pair has been merged meanwhile
        end[i], end[j] = k, 0
        if k < n:
            left[k] = i
            offer(i)
        if left[i] >= 0:
            offer(left[i])
    total = i = 0
    while i < n:
        total += 1 if end[i] - i > 1 or s[i] in merges else len(s[i].encode("utf-8"))
        i = end[i]
    return total


class Counter:
    """Best-path token counts, for one task; with ``merges`` those of the BPE
    rule too."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: str = "<unk>", merges: dict[str, float] | None = None):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        pieces = dict(vocabulary)
        for piece, score in pieces.items():
            if piece and piece != unknown:
                self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in pieces):
            raise ValueError("a piece of this vocabulary crosses a word mark")
        self.stretches = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.merges, self.known = merges, frozenset(p for p in merges or () if len(p) == 1)
        made = self.best if merges is None else self.both
        self.cache, self.words = WordCache(made), WordCache(lambda word: made(MARK + word), REMEMBERED)

    def best(self, s: str) -> int:
        n = len(s)
        if self.single.issuperset(s):
            # Every position is the end of some piece.  Matches come by their
            # end, the longest (earliest start) first.
            score, count, at = [0.0] * (n + 1), [0] * (n + 1), -1
            for end, (length, piece_score) in self.found.iter(s):
                start = end + 1 - length
                value = score[start] + piece_score
                if end != at:
                    at = end
                elif value <= score[end + 1]:
                    continue
                score[end + 1], count[end + 1] = value, count[start] + 1
            return count[n]
        score, count, was_unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        ends: dict[int, list[tuple[int, float]]] = {}
        for end, match in self.found.iter(s):
            ends.setdefault(end + 1, []).append(match)
        for end in range(1, n + 1):
            top, tokens, bad = None, 0, False
            for length, piece_score in sorted(ends.get(end, ()), reverse=True):  # the earliest start first
                start = end - length
                if top is None or score[start] + piece_score > top:
                    top, tokens = score[start] + piece_score, count[start] + 1
            if s[end - 1] not in self.single:
                other = score[end - 1] + self.unknown
                if top is None or other > top:
                    top, bad = other, True
                    more = len(s[end - 1].encode("utf-8")) if self.bytes else int(not was_unknown[end - 1])
                    tokens = count[end - 1] + more
            score[end], count[end], was_unknown[end] = top, tokens, bad
        return count[n]

    def both(self, s: str) -> int:
        """The two counts of a stretch in one number, so that one sum adds both."""
        return self.best(s) | merged_count(s, self.merges, self.known) << 32

    def counts(self, text: str) -> tuple[int, int]:
        """(best path, BPE rule)"""
        total = self.count(text)
        return total & 0xFFFFFFFF, total >> 32

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":  # each word is a stretch
            return sum(map(self.words.__getitem__, text.split(" ")))
        return sum(map(self.cache.__getitem__, self.stretches.findall(MARK + text.replace(" ", MARK))))


def count_column(vocabulary: list[tuple[str, float]], text: Column) -> Column:
    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(vocabulary)
        for batch in batches:
            yield pa.array([counter.count(t.as_py() or "") for t in batch], pa.int64())

    return run(F.coalesce(text.cast("string"), F.lit("")))


def both_counts_column(vocabulary: list[tuple[str, float]], merges: dict[str, float], text: Column) -> Column:
    @F.arrow_udf("struct<n_tokens: bigint, n_bpe_tokens: bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(vocabulary, merges=merges)
        for batch in batches:
            pairs = [counter.counts(t.as_py() or "") for t in batch]
            yield pa.StructArray.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["n_tokens", "n_bpe_tokens"])

    return run(F.coalesce(text.cast("string"), F.lit("")))


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text",
                 merges: dict[str, float] | None = None) -> DataFrame:
    """(id, n_chars, n_tokens) of every row; with ``merges`` n_bpe_tokens too."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    n_chars = F.length(text).cast("bigint").alias("n_chars")
    if merges is None:
        return docs.select(docs[id_col], n_chars, count_column(vocabulary, docs[text_col]).alias("n_tokens"))
    return docs.select(docs[id_col], n_chars, both_counts_column(vocabulary, merges, docs[text_col]).alias("__n")).select(id_col, "n_chars", "__n.*")


def q_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tokenmeter.llm.common import table

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, read_vocabulary(path), merges=read_merges(path))
