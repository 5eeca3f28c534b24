"""Byte-level BPE against the library on whole texts, and packing against whole-text ids."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seriesframe.llm import byte_bpe, packing
from seriesframe.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
with open(WORDS, encoding="utf-8") as f:
    KNOWN = packing.WordIds(f.read())
EDGES = [
    None, "", " ", "\n\n\n", "a", "'s", "it's  'll don't 've", "x" * 50_000, " " * 20_000 + "end", "\t\t mixed \x0b\x0c\x1c\x85",
    "é" * 9_999, "日本語の文章。" * 999, "🙂👍🏽 " * 500, "0123456789" * 3000, "a1b2 c3!?--\r\n" * 700, "́́ é Ǆ İ ß ſ K",
    "<|endoftext|> <|startoftext|> x<|endoftext|>y", "word " * 30_000, "ab" * 3000 + " " + "#" * 3000 + "\n" * 3000,
]


@pytest.fixture(scope="module")
def tree():
    with open(RANKS, "rb") as f:
        return byte_bpe.TreeBpe(byte_bpe.read_ranks(f.read()), public_tokenizers.PATTERN, leaf=8)


@given(st.text(alphabet=st.sampled_from("ab é's \n\t1.　\x1c日"), max_size=120) | st.text(max_size=120))
@settings(max_examples=400, deadline=None)
def test_tree_is_the_library(tree, text):
    ids = tree.encode(text)
    assert ids == tree.plain(text)
    assert tree.decode(ids) == text.encode()


def test_encode_whole_texts(docs, tree):
    rows = list(enumerate(EDGES)) + [(3, "twice"), (3, "twice"), (None, "no id")]
    encoded = byte_bpe.encode(docs(rows), RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in got) == sorted((i or -1, (t or "").encode()) for i, t in rows)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens
        assert ids == tree.plain(bytes(r.decoded).decode())


def test_bpe_query(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, sf_dir).collect()}
    with open(RANKS, "rb") as f:
        plain = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(f.read()), special_tokens={}
        )
    import hashlib

    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array(plain.encode_ordinary(r.text or ""), "<u4")
        mine = got[r.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@given(st.integers(0, 50_000))
def test_lengths(n):
    lengths = packing.lengths_of(n, 4096)
    assert sum(lengths) == n
    assert all(x & (x - 1) == 0 for x in lengths)
    assert lengths == sorted(lengths, reverse=True)
    rest = [x for x in lengths if x < 4096]
    assert len(rest) == len(set(rest))


@given(st.text(alphabet=st.sampled_from("aBÉßŸıİſΣé'.,!<|_́ \n\t1x"), max_size=60) | st.text(max_size=60))
@settings(max_examples=600, deadline=None)
def test_words_are_the_tokenizer(text):
    ids = np.frombuffer(KNOWN.encode([text])[0], "<u4").tolist()
    assert ids == KNOWN.tokenizer.encode(text, add_special_tokens=False).ids


def test_all_latin_letters():
    for code in range(0x21, 0x180):
        for text in (chr(code) * 3, f"a{chr(code)}b", f"a{chr(code)}"):
            ids = np.frombuffer(KNOWN.encode([text])[0], "<u4").tolist()
            assert ids == KNOWN.tokenizer.encode(text, add_special_tokens=False).ids, text


def check_pieces(rows, texts):
    """Every id of every document lies in one piece, and every sequence is one full power of two."""
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert r.offset == 0 and r.length == 1 << r.bucket <= 4096
        assert r.sequence_id >> packing.BUCKET_SHIFT == r.bucket
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in texts:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert pieces[0].start == 0 and sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        for a, b in zip(pieces, pieces[1:]):
            assert a.start + a.length == b.start
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_pack_edges(docs):
    from pyspark.sql import functions as F

    rows = list(enumerate(EDGES))
    got = packing.pack(docs(rows), WORDS).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(got, rows)
    assert packing.pack(docs([]), WORDS).count() == 0


def test_pack_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_pieces(QUERIES["op6_packing"](spark, sf_dir).collect(), texts)
