"""The prefix trie against one that is built node by node."""

import hashlib
import random
import zlib

from compare import connect, differences
from seriesframe.llm import prefix_trie
from seriesframe.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, name string, at string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest())
    own = {c: [r[1:] for r in sorted(v, key=order)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :] for c in own}


def plain(sequences):
    nodes = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in under if len(p) == len(path) + 1]
        ends = ",".join(str(c) for c in sorted(members) if len(sequences[c]) == len(path))
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under) for p in under)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def of(spark, rows):
    return spark.createDataFrame([(*r, 3, "n", "a") for r in rows], SCHEMA).repartition(3)


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op13_prefix_trie"](spark, sf_dir), connect(sf_dir), ORACLE["op13_prefix_trie"]) == []


def test_against_plain(spark):
    draw = random.Random(9)
    rows = []
    for c in range(40):
        for turn in range(draw.choice([1, 2, 4, 9, 12])):
            rows.append((c, draw.choice([turn, turn, None]), draw.choice(["user", "user", None]), draw.choice(["a", "é", None, ""])))
    rows += [(c, t, "user", f"same {t}") for c in (60, 61, 62, 63) for t in range(21)] + [(64, 0, "user", "short")]
    rows += [(None, 0, "user", "nobody"), (70, 1, "user", "twice"), (70, 1, "user", "twice"), (71, 0, "u", "x" * 400_000), (72, 0, "u", "x" * 400_000)]
    sizes, turns = prefix_trie.with_shared_heads(prefix_trie.turns_of(of(spark, rows)))
    assert result(prefix_trie.trie(sizes, turns)) == plain(rebuilt(rows))


def test_small(spark):
    for rows in ([], [(5, 0, "user", "one")], [(7, None, None, None)], [(1, 0, "a", "b"), (2, 0, "ab", "")]):
        sizes, turns = prefix_trie.with_shared_heads(prefix_trie.turns_of(of(spark, rows)))
        assert result(prefix_trie.trie(sizes, turns)) == plain(rebuilt(rows))
