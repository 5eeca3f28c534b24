"""Conversation repair against a search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from seriesframe.llm import repair
from seriesframe.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, copies int, key string, part string"
SPACES = " \t\n\x0b\x0c\r"


def after_damage(rows):
    """{conv_id: [(turn, role, text)] in order}, every original id included."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if draw == 4:
            role = "user"
        mine.extend([(turn, role, text)] * (2 if draw == 3 else 1))
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
    return out


def plain(rows):
    """The report of one conversation, by trying every edit at every place."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        if i < len(rows):
            cut = faults[i] == "truncated"
            ways.append((3, "D", (i + 1, state, 0)))
            if faults[i] not in ("blank", "duplicate"):
                if (kept := after[state].get(rows[i][1][:1])) is not None:
                    ways.append((cut, "K", (i + 1, kept, 0)))
                ways += [(2 + cut, "R", (i + 1, after[state][c], 0)) for c in "ua" if c in after[state]]
        if inserted < 3:
            ways += [(2, "I", (i, after[state][c], inserted + 1)) for c in "ua" if c in after[state]]
        found = []
        for cost, edit, *then in ways:
            if then and (rest := best(*then[0])):
                found.append((cost + rest[0], edit + rest[1]))
            elif not then:
                found.append((cost, edit))
        return min(found, default=None)

    cost, audit = best(0, "", 0)
    state, at, lines = "", 0, []
    for edit in audit:
        if edit != "D":
            state = after[state][rows[at][1][:1]] if edit == "K" else next(c for c in "ua" if c in after[state])
            role = rows[at][1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
            lines.append(f"{role}:{'' if edit == 'I' else rows[at][2]}")
        at += edit != "I"
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    return sorted(((c, *plain(tuple(r))) for c, r in after_damage(rows).items()), key=str)


def result(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def drawn(draw, n):
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", None], ["yes.", "no", "why? ", " \t", "", None, "a!", "b", "c\n"]
    rows = []
    for c in range(n):
        for turn in range(draw.choice([1, 2, 3, 5, 8, 13])):
            if draw.random() < 0.9:
                text = draw.choice([*texts, f"{c} {turn}.", f"{turn} more", f"{turn} one."])
                rows.append((c, draw.choice([turn, turn, turn, turn, None, turn + 2]), draw.choice(roles), text))
    return rows


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert result(QUERIES["op11_structure_repair"](spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize("most", [2, repair.PIECE_ROWS])
def test_against_all_edits(spark, most):
    rows = drawn(random.Random(4), 60)
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None), (700, 1, "system", "x."), (701, 0, "s", "y.")]
    rows += [(800, 3, "user", "same")] * 9 + [(801, t, "user", "same text.") for t in range(40)]
    rows += [(802, 5, "user", "long " * 300_000 + "."), (802, 6, "assistant", "z" * 1_200_000)]
    table = spark.createDataFrame([(*r, 7, "k", "p") for r in rows], SCHEMA).repartition(5)
    damaged = repair.damaged(table)
    assert result(repair.report(repair.repair(damaged, most))) == expected(rows)


def test_empty_and_messages(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(repair.repair(repair.damaged(none))).count() == 0
    rows = [(1, 1, "user", "a.", 1), (1, 2, "user", "b.", 1), (1, 3, "assistant", "c", 0), (2, 1, "user", "", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    got = repair.messages(repair.repair(table)).orderBy("conv_id", "part", "no", "at").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [(1, "user", "a."), (1, "assistant", "b.")]


def test_tables():
    for block in (1, 2, 3):
        some, whole = repair.Tables(block), repair.tables()
        assert some.vectors == whole.vectors and len(whole.vectors) < 100
        symbols = bytes(random.Random(block).choices(range(repair.SYMBOLS), k=301))
        assert some.trace(symbols, 0, 0) == whole.trace(symbols, 0, 0)
        assert (some.map(symbols) == whole.map(symbols)).all()
