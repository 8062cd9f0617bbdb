import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = B.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(3)
    alphabet = "aeinst 'srveldm \n\t\r\x0b\x1c\xa0 \u0085é漢字🎉½Ⅷ٣०-_=!?.́\u200bÅ\0"
    out = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))) for _ in range(2500)]
    out += ["", "   ", "'", " '", "'s", "''s", "a's b", "I'll we're", "x" * 5000, "ab" * 4000, " " * 500, "\n" * 300, " \n \n a", "\0\0a\0", "<|endoftext|>"]
    out += ["".join(chr(draw.choice([draw.randrange(32, 592), draw.randrange(592, 0xD800), draw.randrange(0xE000, 0x11000)])) for _ in range(60)) for _ in range(500)]
    return out


def test_same_ids_as_the_library(reference):
    vocab = B.vocabulary(PATH)
    texts = odd_texts()
    for text, ids in zip(texts, B.encode_all(vocab, texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert vocab.decode(ids) == text.encode()
        assert B.exactly(vocab, text).tolist() == ids.tolist()


def test_long_texts_and_chunks(reference, monkeypatch):
    vocab = B.vocabulary(PATH)
    monkeypatch.setattr(B, "CHUNK_CHARS", 1000)
    texts = [words(3000, 1), "", "y" * 3500, words(10, 2), words(2000, 3).replace(" ", "\n ")]
    assert [i.tolist() for i in B.encode_all(vocab, texts)] == [reference.encode_ordinary(t) for t in texts]


def test_small_caches_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(B, "CACHE_PIECES", 3)
    monkeypatch.setattr(B, "MEMO_PAIRS", 5)
    with open(PATH, "rb") as f:
        vocab = B.Vocabulary(B.read_ranks(f.read()))
    texts = [words(200, i) for i in range(5)]
    assert [i.tolist() for i in B.encode_all(vocab, texts)] == [reference.encode_ordinary(t) for t in texts]


def test_operator(make_docs, reference):
    long = words(150_000, 9)
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "null id"), (4, "a\n\n b's")]
    found = B.byte_bpe(make_docs(rows).withColumn("n_tokens", F.lit("old")), PATH).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id, text in rows:
        ids, r = reference.encode_ordinary(text or ""), by_id[doc_id]
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    assert B.byte_bpe(make_docs([]), PATH).count() == 0


def test_query(spark, sf_dir, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in B.op7_byte_bpe(spark, sf_dir).collect():
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
