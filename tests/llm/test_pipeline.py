"""The pipeline against a brute-force version of its stages."""

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

import __spark_entry__
from test_ngram import plain as classes
from test_secrets import plain as base_spans


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "secret_scans", "packing"]
    queries = __spark_entry__.queries()
    assert [sum(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in queries and "pipeline" not in __spark_entry__.oracle_sql()


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for r in docs.orderBy("doc_id").collect():
        if regex.search(r"\p{L}", r.text or ""):
            kept[r.text] = r.doc_id
    rows = [(i, t) for t, i in kept.items()]
    least = {i for i, c, _ in classes(rows) if i == c}
    want = {i: t for i, t in rows if i in least}

    got = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        got = step(spark, got, sf_dir)
        assert got.columns == docs.columns, name
    texts = {r.doc_id: r for r in got.collect()}
    assert set(texts) == set(want)
    for i, t in want.items():
        assert ("[SECRET]" in texts[i].text) == bool(base_spans(t))
        assert texts[i].n_chars == len(texts[i].text)
        assert texts[i].text == t or base_spans(t)

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        n = len(whole.encode(texts[i].text, add_special_tokens=False).ids) + 1
        assert sum(p.length for p in parts) == n == parts[0].doc_tokens


def test_stages_take_nulls_and_nothing(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "the dog and cat", "en", None, 15), (3, "the dog and cat", "en", "s", 15)]
    for table, left in ((rows, 1), ([], 0)):
        docs = spark.createDataFrame(table, schema)
        for _, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, "")
        assert len({r.doc_id for r in docs.collect()}) == left


def test_packed_pieces_hold_their_tokens(spark):
    docs = spark.createDataFrame([(1, "the dog and the cat")], "doc_id long, text string")
    rows = corpus_pipeline.packed(spark, docs, "").orderBy("start").collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist()
    assert ids == [*whole.encode("the dog and the cat", add_special_tokens=False).ids, 2]
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
