"""Substring deduplication against a brute-force reading of the definition."""

import hashlib
import random
import re
from collections import Counter

import pytest

from seriesframe.llm import substring_dedup
from seriesframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, window):
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def rows_of(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(texts, plain(texts.values(), 35), strict=True))
    got = QUERIES["op8_substring_dedup"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    assert sum(r.n_removed for r in got) > 0
    for r in got:
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("seed, window, kmer, letters", [(1, 7, 3, 3), (2, 6, 2, 2), (3, 9, 4, 5), (4, 5, 5, 4)])
def test_random(docs, seed, window, kmer, letters):
    draw = random.Random(seed)
    words = ["a", "bé", "c", "日", "e"][:letters]
    texts = ["  ".join(draw.choices(words, k=draw.choice([0, 1, window - 1, window, 20, 60]))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(3 * window))
    texts += [f"x{i} y{i}\n{passage}\tz{i}" for i in range(20)] + [passage, passage + " " + passage, "q " * 200]
    rows = list(enumerate(texts))
    got = rows_of(substring_dedup.remove_repeats(docs(rows), window, kmer))
    assert got == sorted((i, *x) for i, x in enumerate(plain(texts, window)))


def test_edges(docs):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (None, "a b c d e f g"), (5, "a b c d e f g"), (6, long),
            (7, "a b c x e f g"), (8, "same same row"), (8, "same same row"), (9, "s t u v w"), (9, "s t u v w")]
    got = rows_of(substring_dedup.remove_repeats(docs(rows), 5, 3))
    want = plain([t for _, t in rows], 5)
    assert got == sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, want, strict=True))
    assert substring_dedup.remove_repeats(docs([])).count() == 0
