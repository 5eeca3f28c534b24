"""Secret scanning over an incremental ledger of content-addressed blobs.

A version of a document is addressed by the SHA-256 of its text. The ledger holds, for every blob, the rules (name and
version) it has been scanned with, and the findings. A scan takes the distinct blobs of the versions given, drops the
(blob, rule version) pairs the ledger has, scans only the rest, appends what it finds, and joins the findings of the
current rules back to every path that holds the blob. Copies of a text are reduced to one blob where they lie, before
any shuffle; the join back carries no text.

Base rules, leftmost and without overlap per kind: assign, access, hex. Further rules add spans and never remove any.
Positions are code points, ends exclusive.

Defined cases: a null text counts as empty; empty texts have no findings; repeated ids and texts each get their row; a
ledger that was cut off between findings and marks is scanned again for the missing marks, and repeated findings count
once; only the id and text columns are read. Every rule reads a text of any length once, and redaction cuts it once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesframe.llm.text import slices
from seriesframe.llm.work import stage

Span = tuple[int, int]

# Patterns as given for the base rules; the letters of the keywords stand for either case.
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
_JWT_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_KEY_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
_FORGE = re.compile(r"(?:ghp|gho|ghs|ghu)_[A-Za-z0-9]{36,}")


def find_assign(text: str) -> list[Span]:
    """Keyword, separator and a value of 12 or more characters; shorter ones are passed over whole."""
    low = text.lower()
    if not any(word in low for word in ("passw", "secret", "token", "api")):
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]


def find_access(text: str) -> list[Span]:
    return [m.span() for m in _ACCESS.finditer(text)] if "AKIA" in text else []


def find_hex(text: str) -> list[Span]:
    return [m.span() for m in _HEX.finditer(text)]


def find_jwt(text: str) -> list[Span]:
    """Three parts joined by dots, of 8 characters or more beside the `eyJ` that the first two begin with.

    Each run of token characters is read once: the first part begins at the run's first `eyJ`.
    """
    spans, at = [], 0
    while (dot := text.find(".eyJ", at)) >= 0:
        at = dot + 1
        begin = dot
        while begin > 0 and text[begin - 1] in _JWT_CHARACTERS:
            begin -= 1
        begin = max([begin, *(end for _, end in spans[-1:])])
        head = text.find("eyJ", begin, dot)
        body = _JWT_PART.match(text, dot + 1)
        tail = _JWT_PART.match(text, body.end() + 1) if text[body.end() : body.end() + 1] == "." else None
        if head >= 0 and dot - head >= 11 and body.end() - body.start() >= 11 and tail and tail.end() - tail.start() >= 8:
            spans.append((head, tail.end()))
            at = tail.end()
    return spans


def find_private_key(text: str) -> list[Span]:
    """From the opening line to the closing one, or the opening line alone if none follows."""
    spans, at, closed = [], 0, True
    while (begin := _KEY.search(text, at)) is not None:
        end = _KEY_END.search(text, begin.end()) if closed else None
        closed = end is not None
        at = end.end() if end else begin.end()
        spans.append((begin.start(), at))
    return spans


def find_forge(text: str) -> list[Span]:
    return [m.span() for m in _FORGE.finditer(text)] if "gh" in text else []


#: kind -> (version, finder), in the order of kinds; a new version of a rule scans every blob again with that rule only.
RULES: dict[str, tuple[int, Callable[[str], list[Span]]]] = {
    "assign": (1, find_assign),
    "access": (1, find_access),
    "hex": (1, find_hex),
    "jwt": (1, find_jwt),
    "private_key": (1, find_private_key),
    "forge": (1, find_forge),
}
BASE = ("assign", "access", "hex")

_SCANNED = "blob binary, spans array<struct<kind:string,version:int,start:long,end:long>>, rules array<string>"


def rule_id(kind: str) -> str:
    return f"{kind}@{RULES[kind][0]}"


def address(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


class Ledger:
    """Tables of scanned (blob, rule) pairs with their findings, under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame | None:
        """A row per scanned blob and run, or None before the first run. Written whole: files appear on commit only."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/scans")
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return None
        return self.spark.read.schema(_SCANNED).parquet(f"{self.path}/scans")

    def append(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").parquet(f"{self.path}/scans")


def scan(pending: DataFrame, kinds: dict[str, tuple[int, Callable[[str], list[Span]]]]) -> DataFrame:
    """Scan blobs (blob, text, rules to run) in batches."""
    by_id = {f"{k}@{version}": (k, version, finder) for k, (version, finder) in kinds.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for low, high, _, _ in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                found = []
                for text, rules in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    mine = []
                    for rule in rules:
                        kind, version, finder = by_id[rule]
                        mine += [{"kind": kind, "version": version, "start": a, "end": b} for a, b in finder(text)]
                    found.append(mine)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(span)), part.column(2)], names=["blob", "spans", "rules"]
                )

    return pending.mapInArrow(run, _SCANNED)


def update(ledger: Ledger, versions: DataFrame, text_col: str = "text", rules=None) -> None:
    """Scan the blobs of `versions` with the rules they have not been scanned with, and append to the ledger."""
    rules = rules or RULES
    wanted = F.array(*(F.lit(f"{k}@{version}") for k, (version, _) in rules.items()))
    texts = versions.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blobs = texts.withColumn("blob", address(F.col("text")))
    seen = ledger.read()
    if seen is None:
        pending = blobs.groupBy("blob").agg(F.first("text").alias("text")).withColumn("rules", wanted)
    else:
        done = (
            seen.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        )
        open_pairs = (
            blobs.select("blob").distinct().join(done, "blob", "left")
            .select("blob", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("rules"))
            .filter(F.size("rules") > 0)
        )
        once = blobs.join(open_pairs.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text"))
        pending = once.join(open_pairs, "blob").select("blob", "text", "rules")
    ledger.append(scan(pending.select("blob", "text", "rules"), rules))


def blob_spans(ledger: Ledger, rules=None) -> DataFrame:
    """blob and the spans (start, rank, end, kind) of the current rules, by start and then kind."""
    rules = rules or RULES
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(rules) for x in (f"{k}@{rules[k][0]}", i)))
    return stage(
        ledger.read()
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        .withColumn(
            "spans",
            F.filter("spans", lambda s: rank[F.concat_ws("@", s["kind"], s["version"].cast("string"))].isNotNull()),
        )
        .withColumn(
            "spans",
            F.array_sort(
                F.transform(
                    "spans",
                    lambda s: F.struct(
                        s["start"].alias("start"),
                        rank[F.concat_ws("@", s["kind"], s["version"].cast("string"))].alias("rank"),
                        s["end"].alias("end"),
                        s["kind"].alias("kind"),
                    ),
                )
            ),
        ),
        "blob-spans",  # written, so that a join on them may be split where many paths hold one blob
    )


def findings(ledger: Ledger, versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=None) -> DataFrame:
    """doc_id, blob and the spans of the current rules for every path in `versions`."""
    paths = versions.select(
        F.col(id_col).cast("long").alias("doc_id"),
        address(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("blob"),
    )
    return paths.join(blob_spans(ledger, rules), "blob", "left")


def joined(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans, comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(
        ",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def masked(text: str, spans: list[Span], mark: str) -> str:
    """The text with its spans, in order, replaced by a mark; spans that overlap are replaced together."""
    pieces, at = [], 0
    for start, end in spans:
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redacted(docs: DataFrame, ledger: Ledger, text_col: str = "text", mark: str = "[SECRET]", rules=None) -> DataFrame:
    """The rows, with all their columns, with the ledger's findings in the text replaced by a mark.

    Overlapping spans are replaced together; a null text stays null.
    """
    at = docs.columns.index(text_col)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        address(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("blob"),
    ).join(blob_spans(ledger, rules), "blob", "left")
    flat = rows.select(
        F.transform("spans", lambda s: s["start"]).alias("_starts"),
        F.transform("spans", lambda s: s["end"]).alias("_ends"),
        *(F.col(f"_row.`{c}`").alias(c) for c in docs.columns),
    )
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _, _ in slices(batch.column(2 + at).fill_null("")):
                part = batch.slice(low, high - low)
                starts, ends = (part.column(i).to_pylist() for i in range(2))
                texts = [
                    t if t is None or not a else masked(t, list(zip(a, b)), mark)
                    for t, a, b in zip(part.column(2 + at).to_pylist(), starts, ends, strict=True)
                ]
                columns = part.columns[2:]
                columns[at] = pa.array(texts, part.column(2 + at).type)
                yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return flat.mapInArrow(run, schema)
