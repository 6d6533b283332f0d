"""BPE encoding and decoding with a public byte-level tokenizer file.

Each word of the tokenizer's own split pattern is encoded by a contiguous rank
array: the part boundaries and the merge rank of every adjacent pair lie in two
short lists; the least rank (leftmost on ties) is scanned for, its inner
boundary deleted and the two neighbouring ranks refreshed, until no pair can
merge.  That is quadratic in the length of a word, so words beyond
``SHORT_WORD`` bytes take the same merges from a heap over linked parts.

Words repeat, so a task keeps the packed ids of words it has met, up to
``CACHE_WORDS`` of them: memory stays bounded, and common words come early.

No shuffle: each row is read and answered where it lies.

Defined results (other columns are not read): a null text encodes as the empty text (no ids); repeated rows
give repeated results; an empty table gives an empty table; texts of any length
are encoded whole; the strings of special tokens in a text become their ids,
as the public library does by default."""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tokenmeter.llm.common import release

SHORT_WORD = 256
CACHE_WORDS = 400_000
#: Characters of text answered in one output batch.
STEP_CHARS = 2_000_000

# The split pattern of the byte-level pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space of the pattern's \s (Unicode White_Space).
SPACE = r"[\t-\r \x85\xa0  -     　]"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    visible Latin-1 bytes stand for themselves, the rest are dealt code points
    from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A tokenizer read from the JSON text of a public byte-level BPE file."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        letters = byte_alphabet()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.id_of = {as_bytes(k): v for k, v in model["model"]["vocab"].items() if all(c in letters for c in k)}
        self.specials = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        for content in self.specials:  # listed in the vocabulary too, but never made by merging
            self.id_of.pop(content.encode(), None)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])
        self.rank = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        self.never = len(self.rank)
        self.bytes_of = {v: k for k, v in self.id_of.items()} | {v: k.encode() for k, v in self.specials.items()}

    def parts(self, word: bytes) -> list[bytes]:
        """The merged parts of one word, by the contiguous rank array."""
        if len(word) > SHORT_WORD:
            return self._parts_long(word)
        get, never = self.rank.get, self.never
        bounds = list(range(len(word) + 1))
        ranks = [get((word[i : i + 1], word[i + 1 : i + 2]), never) for i in range(len(word) - 1)]
        while ranks:
            least = min(ranks)
            if least == never:
                break
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            part = word[bounds[i] : bounds[i + 1]]
            if i < len(ranks):
                ranks[i] = get((part, word[bounds[i + 1] : bounds[i + 2]]), never)
            if i:
                ranks[i - 1] = get((word[bounds[i - 1] : bounds[i]], part), never)
        return [word[a:b] for a, b in zip(bounds, bounds[1:])]

    def _parts_long(self, word: bytes) -> list[bytes]:
        get, n = self.rank.get, len(word)
        end, left = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := get((word[i:j], word[j : end[j]]))) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        heap: list[tuple[int, int, int, int]] = []
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
        out, i = [], 0
        while i < n:
            out.append(word[i : end[i]])
            i = end[i]
        return out

    def word_ids(self, word: str) -> bytes:
        """Packed little-endian 32-bit ids of one word of the split pattern."""
        raw = word.encode("utf-8")
        whole = [raw] if raw in self.id_of and len(raw) == 1 else self.parts(raw)
        return struct.pack(f"<{len(whole)}I", *map(self.id_of.__getitem__, whole))


class WordCache(dict):
    def __init__(self, make, most: int = CACHE_WORDS):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        made = self.make(word)
        if len(self) < self.most and len(word) <= 64:  # common words come early
            self[word] = made
        return made


class Codec:
    """Whole texts to packed ids and back, for one task."""

    def __init__(self, spec: str):
        import regex

        self.bpe = ByteBPE(spec)
        self.words = regex.compile(SPLIT.replace(r"\s", "<S>").replace("[^<S>", "[^" + SPACE[1:-1]).replace("<S>", SPACE)
                                   .replace(r"(?!\S)", f"(?={SPACE}|\\Z)"))
        self.cache = WordCache(self.bpe.word_ids)
        marks = sorted(self.bpe.specials, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.table = [b""] * (max(self.bpe.bytes_of) + 1)
        for i, b in self.bpe.bytes_of.items():
            self.table[i] = b

    def encode(self, text: str) -> bytes:
        get, find = self.cache.__getitem__, self.words.findall
        if self.marks is None or not self.marks.search(text):
            return b"".join(map(get, find(text)))
        out = []
        for k, piece in enumerate(self.marks.split(text)):
            out.append(struct.pack("<I", self.bpe.specials[piece]) if k % 2 else b"".join(map(get, find(piece))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        import numpy as np

        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def read_spec(path: str) -> str:
    """A tokenizer file: bounded by its vocabulary, read once by the driver and
    shipped with the task (the executors need not have the file)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids, decoded) of every row: ids as packed little-endian
    unsigned 32-bit integers, and the text decoded from them.  Results leave in
    batches of about ``STEP_CHARS``, whatever the size of the input's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            at = 0
            while at < len(batch):
                begin, ids, back, chars = at, [], [], 0
                while at < len(batch) and chars < STEP_CHARS:
                    text = batch.column(1)[at].as_py()
                    ids.append(codec.encode(text))
                    back.append(codec.decode(ids[-1]))
                    chars, at = chars + len(text) + 1, at + 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, at - begin), pa.array(ids, pa.binary()), pa.array(back, pa.string())], names)
        codec = None
        release()

    names = [id_col, "token_ids", "decoded"]
    rows = docs.select(docs[id_col], F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("__text"))
    schema = StructType([rows.schema[0], StructField("token_ids", BinaryType()), StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema)


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_col,
        F.expr("bigint(octet_length(token_ids) div 4)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def q_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tokenmeter.llm.common import table

    spec = read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    return digest(encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), spec))
