"""BPE and unigram counts against the public library."""

import hashlib
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from tokenmeter.llm import bpe, unigram

HARD = [
    "", " ", "a", "  two  spaces ", "don't we'll I'M", "tab\t\n\r\n x", "é ü ß 漢字 \U0001f600\U0001f468‍\U0001f469", "x" * 3000, "ab" * 700,
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "  x　", "\x1c\x1d\x1e\x1f\x85᠎​ z", "12 ½ ² Ⅷ 3.5", "\x00\x01", "ǅ ʰ ͅ", "a" + "\n" * 50, "-" * 999,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_hard_texts(library, codec):
    for text in HARD:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(codec.encode(text)) == want, text[:40]
        assert codec.decode(codec.encode(text)) == library.decode(want, skip_special_tokens=False)


def test_every_code_point_splits_alike(library, codec):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)} " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(codec.encode(text)) == want.ids, text[:60]


def test_long_words_match_rank_array(codec):
    word = ("internationalization" * 30).encode()
    assert codec.bpe._parts_long(word[:200]) == codec.bpe.parts(word[:200])


def test_bpe_query_rows(spark, library):
    import __spark_entry__ as E

    got = {r["doc_id"]: r for r in E.queries()["op4_bpe"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edge_rows(spark):
    spec = bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(1, None, 5), (1, None, 6), (None, "a b", 7), (2, "", 8)], "doc_id long, text string, token_ids int")
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in bpe.digest(bpe.encode_documents(docs, spec)).collect())
    assert got == [("1", 0), ("1", 0), ("2", 0), ("None", 2)]
    assert bpe.digest(bpe.encode_documents(docs.limit(0), spec)).count() == 0


def test_unigram_counts_match_library():
    vocabulary = unigram.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    counter = unigram.Counter(vocabulary)
    for text in [*HARD, "the <0x41> <s> of ▁▁ x"]:
        if text:
            want = library.encode(unigram.MARK + text.replace(" ", unigram.MARK)).ids
            assert counter.count(text) == len(want), text[:40]


def test_unigram_ties_and_fused_unknowns():
    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (unigram.MARK, -1.0)]
    library, counter = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False)), unigram.Counter(vocabulary)
    for text in ["ab", "aba", "abab", "babab", "a??b", "??", "a ? b", "é"]:
        assert counter.count(text) == len(library.encode(unigram.MARK + text.replace(" ", unigram.MARK)).ids), text


def test_unigram_edge_rows(spark):
    vocabulary = [("<unk>", 0.0), ("a", -1.0), (unigram.MARK, -1.0)]
    docs = spark.createDataFrame([(1, None), (None, "a a"), (2, ""), (2, "")], "doc_id long, text string")
    got = sorted((str(r[0]), r[1], r[2]) for r in unigram.count_tokens(docs, vocabulary).collect())
    assert got == [("1", 0, 0), ("2", 0, 0), ("2", 0, 0), ("None", 3, 4)]
    assert unigram.count_tokens(docs.limit(0), vocabulary).count() == 0


def test_unigram_query_rows(spark):
    import __spark_entry__ as E

    vocabulary = unigram.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    got = {r["doc_id"]: r["n_tokens"] for r in E.queries()["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        text = r["text"] or ""
        assert got[r["doc_id"]] == (len(library.encode(unigram.MARK + text.replace(" ", unigram.MARK)).ids) if text else 0)


def test_bpe_rule_of_the_piece_file_matches_its_encoder():
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    counter = unigram.Counter(unigram.read_vocabulary(path), merges=unigram.read_merges(path))
    plain = ["The internationalization of distributed deduplication pipelines was reconsidered yesterday.", "the <0x41> <s> of ▁▁ x", " " * 40 + "a" + " " * 17]
    for text in [*HARD, *plain]:
        assert counter.counts(text)[1] == len(library.encode(text)), text[:40]
    assert counter.counts(plain[0]) == (41, 17)


def test_piece_query_counts_by_the_files_encoder(spark):
    import __spark_entry__ as E
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r["n_bpe_tokens"] for r in E.queries()["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert got[r["doc_id"]] == len(library.encode(r["text"] or ""))
