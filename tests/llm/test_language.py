"""Language identification: codewords, n-grams, held-out accuracy and edge cases."""

import base64
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest

from seriesframe.llm import language_id
from seriesframe.llm.queries import QUERIES


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20, 60])
def test_codewords(n):
    code = language_id.codewords(n)
    apart = (code[:, None] != code[None]).sum(2)[~np.eye(n, dtype=bool)]
    assert apart.min() >= code.shape[1] // 4 and apart.min() >= 1
    assert (code.min(0) == 0).all() and (code.max(0) == 1).all()


def test_grams_are_per_text():
    texts = ["Über 12 den  Wald!", "", "a", "x\ny", "é" * 500]
    buckets, rows = language_id.grams(texts)
    for i, t in enumerate(texts):
        alone, _ = language_id.grams([t])
        assert sorted(buckets[rows[i] : rows[i + 1]]) == sorted(alone)
    assert sorted(language_id.grams(["über den wald"])[0]) == sorted(language_id.grams([" ÜBER--7den\nWALD "])[0])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op7_language_id"](spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = [r.lang_pred == truth[r.doc_id] for r in held]
    print("held-out accuracy", sum(right) / len(right), "ambiguous", sum(r.ambiguous for r in held))
    print([(truth[r.doc_id], r.lang_pred, r.score) for r in held if r.lang_pred != truth[r.doc_id]][:10])
    assert sum(right) >= 0.99 * len(right)


def test_edges(spark, docs):
    rows = [(1, "the cat and the dog"), (2, "der Hund und die Katze"), (3, None), (4, ""), (5, "12 !? #"), (None, "und der"),
            (6, "the " * 80_000), (6, "the dog"), (7, "日本")]
    train = spark.createDataFrame(
        [("the cat and the dog that is here", "en"), ("der Hund und die Katze sind hier", "de"), (None, "en"), ("zzz", None)],
        "text string, lang string",
    )
    model = language_id.fit(train)
    assert model.languages == ["de", "en"]
    got = language_id.predict(docs(rows), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].lang_pred == by[6].lang_pred == "en" and by[2].lang_pred == by[None].lang_pred == "de"
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5))
    assert by[7].lang_pred in ("de", "en")
    kept = language_id.accepted(docs(rows), model)
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 6, 6, 7]
    assert language_id.predict(docs([]), model).count() == 0
    none = language_id.fit(train.filter("false"))
    assert {r.lang_pred for r in language_id.predict(docs(rows), none).collect()} == {"und"}
    one = language_id.fit(train.filter("lang = 'en'"))
    assert {r.lang_pred for r in language_id.predict(docs(rows), one).collect()} == {"en", "und"}


def test_unknown_languages_and_junk_are_rejected(spark):
    known = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    draw = random.Random(1)
    junk = [base64.b64encode(draw.randbytes(600)).decode() for _ in range(20)] + [draw.randbytes(600).hex() for _ in range(20)]
    junk += [";".join(f"{draw.choice('bcdfghjkmnpqrstvwxz')}{draw.randrange(10**6)}{draw.choice('abcdefghijklmnopqrstuvwxyz')}" for _ in range(200)) for _ in range(20)]
    words = "kissa istuu pöydällä ja katselee ikkunasta ulos lumista metsää jossa ketut juoksevat hiljaa yössä".split()
    junk += [" ".join(draw.choices(words, k=300)) for _ in range(20)]
    junk += [" ".join(draw.choices("мама мыла раму и пошла домой потому что было уже поздно".split(), k=900)) for _ in range(20)]
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)], known.schema)
    lost = known.filter("lang = 'de'").limit(1).selectExpr("-1000L as doc_id", "text", "cast(null as string) as lang")
    left = corpus_pipeline.known_language(spark, known.union(planted).union(lost), "")
    by = {r.doc_id: r.lang for r in left.select("doc_id", "lang").collect()}
    assert [i for i in by if -1000 < i < 0] == []
    assert by[-1000] == "de"
    truth = {r.doc_id for r in known.filter(language_id.held_out()).collect()}
    assert truth <= set(by)
    assert len(by) >= 0.999 * known.count()
