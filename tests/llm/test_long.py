"""One very long text: time in proportion to its length, and memory far below a worker's."""

import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from seriesframe.llm import exact_dedup, html_extraction, language_id, quality, secrets, substring_dedup
from seriesframe.llm.text import words

MEGABYTE = 1 << 20


def _model():
    code = language_id.codewords(7)
    weights = np.random.default_rng(1).normal(size=(len(language_id.ORDERS) << language_id.BUCKET_BITS, code.shape[1]))
    return language_id.Model(list("abcdefg"), code, weights.astype(np.float32), np.full(code.shape[1], 1 / code.shape[1]))


def _paths(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return substring_dedup._paths_of(words(data, np.array([0, len(data)])), 35, 8)


SHAPES = {
    "keys without an end": lambda: secrets.find_private_key("-----BEGIN PRIVATE KEY-----\n" * (MEGABYTE // 28)),
    "half tokens": lambda: secrets.find_jwt("eyJ" * (MEGABYTE // 3)),
    "dotted half tokens": lambda: secrets.find_jwt(".eyJ" * (MEGABYTE // 4)),
    "a hex dump": lambda: secrets.masked("deadbeefdeadbeef " * 60_000, [(17 * i, 17 * i + 16) for i in range(60_000)], "x"),
    "one word": lambda: _paths("x " * (MEGABYTE // 2)),
    "many languages": lambda: language_id.judge(_model(), ["word ant " * (MEGABYTE // 9)]),
    "open tags": lambda: html_extraction.Page("<a " * (MEGABYTE // 3)).text(),
    "open quotes": lambda: html_extraction.Page('<a b="x ' * (MEGABYTE // 8)).text(),
    "open elements": lambda: html_extraction.Page("<div>x" * (MEGABYTE // 6)).without({1})[0],
    "open articles": lambda: html_extraction.Page("<article>x" * (MEGABYTE // 10)).text(),
}


@pytest.mark.parametrize("name", SHAPES)
def test_a_long_text_of_any_shape(name):
    began = time.perf_counter()
    SHAPES[name]()
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("name", ["one word", "many languages", "half tokens"])
def test_memory(name):
    tracemalloc.start()
    try:
        SHAPES[name]()
        assert tracemalloc.get_traced_memory()[1] < 200 * MEGABYTE
    finally:
        tracemalloc.stop()


JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def test_tokens_are_those_of_the_pattern():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice(["eyJ", ".", "abcdefgh", "12345678", " ", "é", "x", ".eyJabcdefgh"]) for _ in range(draw.randrange(30)))
        assert secrets.find_jwt(text) == [m.span() for m in JWT.finditer(text)], text


def test_masked_spans():
    assert secrets.masked("abcdefghij", [(1, 3), (2, 5), (3, 4), (7, 8)], "#") == "a#fg#ij"
    assert secrets.masked("é", [], "#") == "é"


def test_weight_sums_by_plain_loops(monkeypatch):
    draw = random.Random(6)
    weights = np.random.default_rng(2).normal(size=(50, 3))
    for piece in (1, 4, 1000):
        monkeypatch.setattr(language_id, "PIECE", piece)
        lists = [[draw.randrange(50) for _ in range(draw.choice([0, 0, 1, 3, 9]))] for _ in range(12)]
        rows = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        got = language_id.weight_sums(weights, np.array(sum(lists, []), np.int64), rows)
        want = np.array([[sum(weights[b][j] for b in x) for j in range(3)] for x in lists])
        assert np.allclose(got, want)


def test_codeword_decoding_by_plain_loops():
    """The nearest codeword under the trust-weighted logistic loss."""
    model, draw = _model(), np.random.default_rng(4)
    margins = draw.normal(size=(40, model.code.shape[1]))
    best, score, unsure, loss = language_id.decode(model, margins)
    for i in range(40):
        losses = []
        for word in model.code:
            total = 0.0
            for bit, margin, trust in zip(word, margins[i], model.trust):
                sign = 1 if bit else -1
                total += trust * np.log1p(np.exp(-language_id.SHARPNESS * sign * margin))
            losses.append(total)
        assert best[i] == int(np.argmin(losses)) and abs(loss[i] - min(losses)) < 1e-6
        likely = np.exp(-language_id.SHARPNESS * (np.array(losses) - min(losses)))
        likely = np.sort(likely / likely.sum())
        assert abs(score[i] - likely[-1]) < 1e-6 and unsure[i] == (likely[-1] - likely[-2] < language_id.AMBIGUOUS)


def test_a_score_does_not_depend_on_its_neighbours():
    draw = np.random.default_rng(3)
    values, rows = draw.normal(size=5000).astype(np.float32), np.array([0, 0, 1200, 1200, 4100, 5000, 5000])
    sums = quality.text_sums(values, rows)
    for i, (a, b) in enumerate(zip(rows, rows[1:])):
        assert sums[i] == (quality.text_sums(values[a:b], np.array([0, b - a]))[0] if b > a else 0)


def test_survivors_with_a_map(spark):
    rows = [(1, "a", {"k": 1}, "x"), (2, "a", {"k": 2}, "y"), (2, "a", {"k": 3}, "y"), (3, None, None, None), (4, "b", {}, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>, rank string").repartition(3)
    got = exact_dedup.survivors(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.extra, r["rank"]) for r in got.collect()), key=repr) == sorted([rows[2], rows[3], rows[4]], key=repr)
