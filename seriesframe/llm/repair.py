"""Conversation structure repair with Four-Russians block tables.

The cheapest edits that make a conversation's roles match `(s?(ua)+)?` are a shortest path over four states: nothing yet,
after the system turn, after a user turn, after an assistant turn. From the end of a conversation, the cost of finishing
from each state is a vector of four numbers, and the difference of any two of them is bounded, so after subtracting the
least one only a handful of vectors exist. For every vector and every block of four turn symbols (role and fault, nine
of them) the vector before the block is precomputed; a conversation is walked backward a block at a time by lookup.
Of edits that cost the same, those that read ASCII-least come out by going forward through the blocks, each of which is
expanded backward once more into the vectors between its turns.

Rows are sorted by ranges over all tasks and cut into pieces of bounded rows and characters, so one conversation may
fill any number of tasks. Where a piece may have neighbours, its block walk is done for every vector that may follow it;
the vectors at its end, the state at its beginning and turns seen in earlier pieces come from passes over one small row
per piece.

Defined cases: a null role or text is one space, a null turn comes first and counts in no gap, a null conversation id is
a conversation of its own; turns that tie are ordered by role and the digest of role and text, rows that repeat all of
these are duplicates next to each other; a conversation whose rows all went has zeros and no edits; empty tables give
empty results; texts of any length stay whole; only the four named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.llm.places import digests, in_ranges
from seriesframe.llm.work import stage

DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the user or assistant turn that each state asks for, that turn's role, and where keeping a role leads.
WANTED = (USER, USER, ASSISTANT, USER)
ROLE = ("", "", "user", "assistant")
KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "?": {}}
INITIALS = "sua?"
#: Symbols: 2 x initial + truncated; GONE must be deleted.
GONE, SYMBOLS = 8, 9
#: What is left to pay at the end of a conversation.
FINAL = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
#: Turns of a block of the tables; rows and characters of a piece.
BLOCK, PIECE_ROWS, PIECE_CHARS = 4, 4096, 1 << 20


def before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The costs of finishing from before a turn, given those from after it."""
    cost = [c + DELETE for c in after]
    if symbol != GONE:
        initial, cut = INITIALS[symbol // 2], CUT * (symbol % 2)
        for state in range(4):
            cost[state] = min(cost[state], after[WANTED[state]] + REROLE + cut)
            if state in KEPT[initial]:
                cost[state] = min(cost[state], after[KEPT[initial][state]] + cut)
    for _ in range(3):
        cost = [min(c, cost[WANTED[state]] + INSERT) for state, c in enumerate(cost)]
    return tuple(cost)


class Tables:
    """The normalised vectors, and the number of the vector before each block of each length up to `block`."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors = block, [FINAL]
        number, steps = {FINAL: 0}, []
        for vector in self.vectors:  # grows until no new vector turns up
            row = []
            for symbol in range(SYMBOLS):
                cost = before(vector, symbol)
                least = tuple(c - min(cost) for c in cost)
                if least not in number:
                    number[least] = len(self.vectors)
                    self.vectors.append(least)
                row.append(number[least])
            steps.append(row)
        one = np.array(steps, np.int16)
        self.tables = [np.arange(len(one), dtype=np.int16)[:, None]]
        for _ in range(block):  # one more turn in front of the blocks so far
            self.tables.append(one[self.tables[-1]].transpose(0, 2, 1).reshape(len(one), -1))
        self._traces: dict[tuple[int, bytes, int], tuple[str, int]] = {}

    def blocks(self, symbols: bytes) -> list[bytes]:
        """The symbols in blocks; only the first may be short."""
        head = len(symbols) % self.block
        cuts = [0, *range(head or self.block, len(symbols) + 1, self.block)]
        return [symbols[a:b] for a, b in zip(cuts, cuts[1:])]

    def lookup(self, vector, block: bytes):
        """The vector (or vectors) before a block, by table."""
        code = 0
        for symbol in block:
            code = code * SYMBOLS + symbol
        return self.tables[len(block)][vector, code]

    def map(self, symbols: bytes) -> np.ndarray:
        """For each vector that may follow the symbols the one before them."""
        vector = np.arange(len(self.vectors))
        for block in reversed(self.blocks(symbols)):
            vector = self.lookup(vector, block)
        return vector

    def trace(self, symbols: bytes, vector: int, state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits from a state, before what costs `vector`, and the state they end in."""
        blocks, vectors = self.blocks(symbols), [vector]
        for block in reversed(blocks):
            vectors.append(int(self.lookup(vectors[-1], block)))
        edits = []
        for block, after in zip(blocks, reversed(vectors[:-1])):
            key = (after, block, state)
            if key not in self._traces:
                self._traces[key] = self._expand(*key)
            done, state = self._traces[key]
            edits.append(done)
        return "".join(edits), state

    def _expand(self, after: int, block: bytes, state: int) -> tuple[str, int]:
        costs = [self.vectors[after]]
        for symbol in reversed(block):
            costs.append(before(costs[-1], symbol))
        costs.reverse()
        edits, at = [], 0
        while at < len(block):
            symbol, left = block[at], costs[at][state]
            initial, cut = INITIALS[min(symbol // 2, 3)], CUT * (symbol % 2)
            stays = symbol != GONE
            if left == costs[at + 1][state] + DELETE:
                edits.append("D")
                at += 1
            elif left == costs[at][WANTED[state]] + INSERT:
                edits.append("I")
                state = WANTED[state]
            elif stays and state in KEPT[initial] and left == costs[at + 1][KEPT[initial][state]] + cut:
                edits.append("K")
                state, at = KEPT[initial][state], at + 1
            else:
                edits.append("R")
                state, at = WANTED[state], at + 1
        return "".join(edits), state


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def closing(state: int) -> str:
    """The turns that are inserted at the end."""
    return "I" * (FINAL[state] // INSERT)


def applied(edits: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str], int]:
    """The roles and texts after edits that begin in a state, and the state after them."""
    new_roles, new_texts, at = [], [], 0
    for edit in edits:
        if edit != "D":
            state = KEPT[_initial(roles[at])][state] if edit == "K" else WANTED[state]
            new_roles.append(roles[at] if edit == "K" else ROLE[state])
            new_texts.append("" if edit == "I" else texts[at])
        at += edit != "I"
    return new_roles, new_texts, state


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


SPACES = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: every row after the damage its key draws; rows that are dropped have no copy."""
    conv, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    draw = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw < 2, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


class _Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, key: str, conv_id, part: int, no: int, edge: bool):
        self.row = {"key": key, "conv_id": conv_id, "part": part, "no": no, "edge": edge}
        self.turns, self.roles, self.texts, self.digests, self.symbols = [], [], [], [], bytearray()
        self.seen, self.chars = set(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.steps = 0

    def add(self, turn: int | None, role: str, text: str, digest: str, fault: str) -> None:
        again = digest in self.seen
        self.blank += fault == "blank"
        self.duplicate += fault != "blank" and again
        cut = fault == "truncated" and not again
        self.truncated += cut
        self.symbols.append(GONE if fault == "blank" or again else 2 * INITIALS.index(_initial(role)) + cut)
        self.illegal += bool(self.roles) and self.roles[-1][:1] + role[:1] not in LEGAL
        self.steps += turn is not None and (not self.turns or turn != self.turns[-1])
        self.seen.add(digest)
        for into, value in ((self.turns, turn), (self.roles, role), (self.texts, text), (self.digests, digest)):
            into.append(value)
        self.chars += len(text)

    def told(self) -> dict:
        known = [t for t in self.turns if t is not None]
        return self.row | {
            "turns": self.turns,
            "roles": self.roles,
            "texts": self.texts,
            "digests": self.digests,
            "symbols": bytes(self.symbols),
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "first_role": self.roles[0][:1] if self.roles else None,
            "last_role": self.roles[-1][:1] if self.roles else None,
            "low": known[0] if known else None,
            "high": known[-1] if known else None,
            "steps": self.steps,
        }


_COUNTS = "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, low long, high long, steps long"


def pieces(rows: DataFrame, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS) -> DataFrame:
    """The `damaged` rows in order, a row per piece. `edge` tells that a conversation may have other pieces."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"key string, conv_id {kind}, part int, no long, edge boolean, turns array<long>, roles array<string>, "
        f"texts array<string>, digests array<string>, symbols binary, {_COUNTS}"
    )
    ended = F.expr(f"trim(TRAILING '{SPACES}' FROM text)")
    fault = F.when(F.length(ended) == 0, "blank").when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    keyed = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        *rows.columns,
        fault.alias("fault"),
        F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")).alias("digest"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, out, size, piece, arrow = TaskContext.get().partitionId(), 0, [], 0, None, None

        def batch_of(told: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(told, arrow)

        for batch in batches:
            arrow = arrow or _arrow(batch.schema.field("conv_id").type)
            for row in batch.to_pylist():
                full = piece is not None and (len(piece.roles) >= most_rows or piece.chars >= most_chars)
                if piece is None or full or row["key"] != piece.row["key"]:
                    split = piece is not None and row["key"] == piece.row["key"]
                    if piece is not None:
                        piece.row["edge"] |= split
                        out.append(piece.told())
                        size += piece.chars + 64 * len(piece.roles)
                    piece = _Piece(row["key"], row["conv_id"], part, no, piece is None or split)
                    no += 1
                for _ in range(row["copies"]):
                    piece.add(row["turn"], row["role"], row["text"], row["digest"], row["fault"])
            if size > PIECE_CHARS:
                yield batch_of(out)
                out, size = [], 0
        if piece is not None:
            piece.row["edge"] = True
            yield batch_of([*out, piece.told()])

    return in_ranges(keyed, ["key"], order).mapInArrow(run, schema)


def _arrow(conv: pa.DataType) -> pa.Schema:
    many, count = pa.list_(pa.string()), pa.int64()
    fields = [("key", pa.string()), ("conv_id", conv), ("part", pa.int32()), ("no", count), ("edge", pa.bool_())]
    fields += [("turns", pa.list_(count)), ("roles", many), ("texts", many), ("digests", many), ("symbols", pa.binary())]
    fields += [(c, count) for c in ("blank", "duplicate", "truncated", "illegal")]
    return pa.schema([*fields, ("first_role", pa.string()), ("last_role", pa.string()), ("low", count), ("high", count), ("steps", count)])


PLACE = ["key", "part", "no"]


def _later(edges: DataFrame) -> DataFrame:
    """key, part, no, late: the turns of a piece whose role and text an earlier piece has."""
    items = stage(edges.select(*PLACE, F.posexplode("digests").alias("at", "digest")), "repair-turns")
    place = F.struct("part", "no", "at")
    firsts = items.groupBy("key", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = stage(firsts.drop("n"), "repair-firsts")
    again = items.join(firsts, ["key", "digest"]).filter((F.col("part") != F.col("first.part")) | (F.col("no") != F.col("first.no")))
    return again.groupBy(*PLACE).agg(F.collect_list("at").alias("late"))


def _settled(edges: DataFrame) -> DataFrame:
    """Pieces that may have neighbours, with duplicates of earlier pieces marked, and `before`: the vector before each one after."""
    joined = edges.join(_later(edges), PLACE, "left").select(*edges.columns, "late")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.schema) + ", before array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                symbols = bytearray(row["symbols"])
                for at in row.pop("late") or ():
                    if symbols[at] != GONE:
                        row["duplicate"] += 1
                        row["truncated"] -= symbols[at] % 2
                        symbols[at] = GONE
                row["symbols"], row["before"] = bytes(symbols), known.map(bytes(symbols)).tolist()
            fields = [f for f in batch.schema if f.name != "late"]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*fields, pa.field("before", pa.list_(pa.int32()))]))

    return stage(joined.mapInArrow(run, schema), "repair-edges")


def _scan(df: DataFrame, column: str, start: int, name: str, backward: bool) -> DataFrame:
    """key, part, no, name: the value that reaches each piece, going through the pieces' maps in one direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = value = None
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if row["key"] != key:
                    key, value = row["key"], start
                row[name], value = value, row.pop(column)[value]
            fields = [batch.schema.field(c) for c in PLACE]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*fields, pa.field(name, pa.int32())]))

    order = [F.col(c).desc() if backward else F.col(c) for c in ("part", "no")]
    rows = df.select(*PLACE, column).repartition("key").sortWithinPartitions("key", *order)
    return rows.mapInArrow(run, f"key string, part int, no long, {name} int")


def _exits(df: DataFrame) -> DataFrame:
    """key, part, no, exits: the state after a piece for each state before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                symbols, after = row.pop("symbols"), row.pop("after")
                row["exits"] = [known.trace(symbols, after, state)[1] for state in range(4)]
            fields = [batch.schema.field(c) for c in PLACE]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*fields, pa.field("exits", pa.list_(pa.int32()))]))

    return df.select(*PLACE, "symbols", "after").mapInArrow(run, "key string, part int, no long, exits array<int>")


def _edited(df: DataFrame) -> DataFrame:
    """`df` (pieces with the vector `after`, the state `entry`, and whether they are the last) with their edits and their result."""
    kept = ["key", "conv_id", "part", "no", *(c.split()[0] for c in _COUNTS.split(", "))]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", cost long, audit string, roles array<string>, texts array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables()
        for batch in batches:
            fields = [batch.schema.field(c) for c in kept]
            fields += [pa.field("cost", pa.int64()), pa.field("audit", pa.string())]
            fields += [pa.field(c, pa.list_(pa.string())) for c in ("roles", "texts")]
            out, size = [], 0
            for row in batch.to_pylist():
                symbols = row["symbols"]
                edits, state = known.trace(symbols, row["after"], row["entry"])
                edits += closing(state) if row["last"] else ""
                roles, texts, _ = applied(edits, row["roles"], row["texts"], row["entry"])
                stay = [e for e in edits if e != "I"]
                cut = sum(s % 2 for s, e in zip(symbols, stay) if e != "D" and s != GONE)
                cost = DELETE * edits.count("D") + REROLE * edits.count("R") + INSERT * edits.count("I") + CUT * cut
                out.append({c: row[c] for c in kept} | {"cost": cost, "audit": edits, "roles": roles, "texts": texts})
                size += sum(map(len, texts))
                if size > PIECE_CHARS:
                    yield pa.RecordBatch.from_pylist(out, pa.schema(fields))
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, pa.schema(fields))

    return df.mapInArrow(run, schema)


def repair(rows: DataFrame, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS) -> DataFrame:
    """The pieces of all conversations of `rows` (conv_id, turn, role, text, copies), in key, part, no: their counts, the cost
    and initials of their edits, the repaired roles and texts, and `whole` where a piece is a conversation."""
    cut = stage(pieces(rows, most_rows, most_chars), "repair-pieces")
    edges = _settled(cut.filter("edge"))
    tails = stage(_scan(edges, "before", 0, "after", True), "repair-tails")
    ends = edges.join(tails, PLACE)
    entries = stage(_scan(_exits(ends), "exits", EMPTY, "entry", False), "repair-entries")
    last = edges.groupBy("key").agg(F.max(F.struct("part", "no")).alias("end"))
    several = ends.join(entries, PLACE).join(last, "key").withColumn("last", F.col("end") == F.struct("part", "no"))
    single = cut.filter("not edge").withColumns({"after": F.lit(0), "entry": F.lit(EMPTY), "last": F.lit(True)})
    done = _edited(single).withColumn("whole", F.lit(True))
    return stage(done.unionByName(_edited(several.drop("end", "before")).withColumn("whole", F.lit(False))), "repaired")


def messages(repaired: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, part, no, at (their order), role, text."""
    return repaired.select(
        "conv_id", "part", "no", F.posexplode(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))).alias("at", "m")
    ).select("conv_id", "part", "no", "at", "m.role", "m.text")


def report(repaired: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    lines = F.transform(F.arrays_zip("roles", "texts"), lambda m: F.concat(m["roles"], F.lit(":"), m["texts"]))
    told = repaired.withColumn("lines", F.array_join(lines, "\n"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("steps"), F.lit(0))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    one = told.filter("whole").select("conv_id", gaps.alias("gaps"), *counts, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    split = told.filter("not whole")
    so_far = Window.partitionBy("key").orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    side = F.concat(F.last("last_role", True).over(so_far), F.col("first_role"))
    bordered = split.select(
        *PLACE, "conv_id", *counts, "low", "high", "steps",
        F.coalesce((~side.isin(*LEGAL)).cast("long"), F.lit(0)).alias("border"),
        F.coalesce((F.max("high").over(so_far) == F.col("low")).cast("long"), F.lit(0)).alias("met"),
    )
    summed = bordered.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")),
        F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum(F.col("steps") - F.col("met")).alias("steps"),
    )
    audits = split.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "no", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    texts = digests(split.filter(F.size("roles") > 0), ["key"], ["part", "no"], "lines", "\n")
    many = summed.join(audits, "key").join(texts, "key", "left").select(
        "conv_id", gaps.alias("gaps"), *counts, "audit", F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )
    return one.unionByName(many)
