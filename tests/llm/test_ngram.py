"""The n-gram join against all pairs of documents."""

import random
import re

import numpy as np

from seriesframe.llm import ngram_join
from seriesframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows):
    """doc_id: (class, links)."""
    sets = [runs(t) for _, t in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for k, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    for a in range(len(rows)):
        near = {b for g in sets[a] for b in by[g] if b < a} if sets[a] else {b for b in range(a) if (rows[b][1] or "") == (rows[a][1] or "")}
        for b in near:
            if not sets[a] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), 1 << 60), i)
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def result(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(QUERIES["op2_ngram_jaccard_join"](spark, sf_dir)) == plain(rows)


def test_against_all_pairs(docs):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choices(vocabulary, k=draw.choice([2, 4, 5, 6, 12, 60, 200])) for _ in range(15)]
    rows = []
    for i in range(220):
        w = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
            w[draw.randrange(len(w))] = draw.choice(vocabulary)
        rows.append((i, draw.choice([" ", "\n", "  "]).join(w)))
    rows += [(900, ""), (901, None), (902, " "), (903, " "), (904, "one"), (905, "one"), (7, rows[7][1]), (8, "other text for an id that is there")]
    rows += [(1000 + i, " ".join(vocabulary[:300]) + f" tail{i}") for i in range(60)]
    rows += [(1100, "x " * 90_000), (1101, "x " * 80_000)]
    got = ngram_join.ngram_join(docs(rows), bucket_block=16, group_block=10)
    assert result(got) == plain(rows)
    assert ngram_join.ngram_join(docs([])).count() == 0
    kept = ngram_join.one_of_each(docs(rows[:220]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in plain(rows[:220])})


def test_posterior():
    assert ngram_join.least_matches(25, 0.8, 1e-6) < ngram_join.least_matches(25, 0.8, 1e-2) <= 20
    draw = np.random.default_rng(3)
    for similarity in (0.8, 0.9):
        signs = draw.integers(0, 256, (2, 4000, 200)).astype(np.uint8)
        agree = draw.random((4000, 200)) < similarity
        both = np.concatenate([signs[0], np.where(agree, signs[0], signs[1])])
        a = np.arange(4000)
        assert len(ngram_join.survivors(a, a + 4000, both, 0.8, 1e-6)) == 4000
    far = np.concatenate([signs[0], np.where(draw.random((4000, 200)) < 0.4, signs[0], signs[1])])
    assert len(ngram_join.survivors(a, a + 4000, far, 0.8, 1e-6)) < 40
