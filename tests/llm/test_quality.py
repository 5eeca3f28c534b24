"""Quality rules against a plain reading of the definitions, and the verdict on labelled documents."""

import re
from collections import Counter

import pytest

from seriesframe.llm import quality
from seriesframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(covered), failed
    )


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


EDGES = [
    None, "", " \n\t", "\n\n", "a", "é ü ñ 日本", "x\nx\nx\n\n \n", "a b c d e a b c d e", "one two three four " * 5,
    "#*$%&|<> a|b", "no\x0bbreak\x0c\r\nhere", "\n".join(f"line {i % 3}" for i in range(40)), "long " * 70_000,
    "w" * 300_000, " x", "x ", "\nx", " nbsp is part", "\x1c\x1d fs",
]


def test_rules_on_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    rows = list(enumerate(EDGES)) + [(4, "a"), (4, "a")]
    got = quality.quality_rules(docs(rows), labels).collect()
    assert sorted((r.doc_id, counts(r)) for r in got) == sorted((i, plain(t)) for i, t in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_empty(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_rules(docs([]), labels).count() == 0
    some = quality.quality_rules(docs([(1, "a b c d e f g h i j k l")]), labels).collect()
    assert [r.kept for r in some] == [True]


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    return {r.doc_id: r for r in QUERIES["op5_quality_rules"](spark, sf_dir).collect()}


def test_rules_on_documents(spark, sf_dir, result):
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert counts(result[r.doc_id]) == plain(r.text)


def test_verdict_follows_labels(spark, result):
    sf = "/root/testdata/sf0.1"
    kept = {r.doc_id: r.kept for r in QUERIES["op5_quality_rules"](spark, sf).filter("not base_failed").collect()}
    labels = [(r.quality, kept[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in kept]
    good = [k for q, k in labels if q == 1]
    bad = [k for q, k in labels if q == 0]
    assert sum(good) >= 0.995 * len(good)
    assert sum(bad) <= 0.05 * len(bad)


def test_threshold():
    assert quality.threshold_of([]) == float("-inf")
    assert quality.threshold_of([(0, 5, 0)]) == float("-inf")
    assert quality.threshold_of([(-50, 0, 9), (0, 90, 0), (5, 9, 0)]) == pytest.approx(-24.5 * quality.BIN)
