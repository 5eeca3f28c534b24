"""Jump consistent hashing against the published loop, and shards and slots of whole tables."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from compare import connect, differences
from seriesframe.llm import sharding
from seriesframe.llm.queries import ORACLE, QUERIES


def published(key, shards):
    b, j = -1, 0
    key %= 1 << 64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump():
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(10_000, 10_400)]
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump(np.array(keys), n).tolist() == [published(k, n) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump(np.array([1]), 0)
    for keys in (np.arange(200_000), np.arange(200_000) * 50, np.arange(200_000) << 20):
        before, after = sharding.jump(keys, 16), sharding.jump(keys, 17)
        assert max(Counter(before.tolist()).values()) < 1.1 * 200_000 / 16
        assert (after[after != before] == 16).all()
        assert 0.9 / 17 < (after != before).mean() < 1.1 / 17


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op12_sharding"](spark, sf_dir), connect(sf_dir), ORACLE["op12_sharding"]) == []


def test_cases(spark, docs):
    rows = [(i, f"text {i % 7}") for i in range(300)] + [(None, "a"), (None, None), (0, ""), (5, "é" * 9)] + [(42, "same")] * 500 + [(-3, "x" * 1_000_000)]
    got = sharding.with_slots(sharding.sharded(docs(rows), 5)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for r in got:
        assert (r.shard, r.grown_shard) == (published(r.doc_id or 0, 5), published(r.doc_id or 0, 6))
    for s in range(5):
        mine = sorted((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in got if r.shard == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
    assert sharding.with_slots(sharding.sharded(docs([]))).count() == 0


def test_written_shards(spark, docs, tmp_path):
    rows = docs([(i, f"t{i}") for i in range(200)] + [(None, None)])
    sharding.write_shards(rows, str(tmp_path / "shards"), 4)
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r.doc_id, r.text, r.shard) for r in read.collect()} == {(i, f"t{i}", published(i, 4)) for i in range(200)} | {(None, None, published(0, 4))}
    moved = {r.doc_id for r in sharding.moving(rows, 4).collect()}
    assert moved == {i for i in range(200) if published(i, 5) == 4} | ({None} if published(0, 5) == 4 else set())
