"""One registered query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.llm import (
    byte_bpe,
    html_extraction,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    repair,
    secrets,
    sharding,
    substring_dedup,
)
from seriesframe.llm.exact_dedup import exact_dedup
from seriesframe.llm.work import fresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    """
    with rows as (select doc_id, coalesce(text, '') as text from documents)
    select doc_id,
           max(doc_id) over (partition by text) as keep_id,
           count(*) over (partition by text) as group_size,
           doc_id = max(doc_id) over (partition by text) as kept,
           sha256(text) as text_sha256
    from rows
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup(documents(spark, sf_dir)).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path, public_tokenizers.PATTERN).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and the sequence it fills."""
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, score and verdict of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_rules(documents(spark, sf_dir), labels)


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, from a model that has seen three quarters of them."""
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(~language_id.held_out()))
    return language_id.predict(docs, model).withColumn("held_out", language_id.held_out())


@query()
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every document, from a ledger of blobs that begins empty."""
    docs = documents(spark, sf_dir)
    ledger = secrets.Ledger(spark, fresh(spark, "secret-ledger"))
    secrets.update(ledger, docs)
    found = secrets.findings(ledger, docs)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(secrets.joined(F.col("spans"), secrets.BASE).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_extraction.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated windows of 35 words."""
    left = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its class of near lines, and whether it stays."""
    return line_dedup.line_dedup(documents(spark, sf_dir))


@query()
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates and its number of links."""
    return ngram_join.ngram_join(documents(spark, sf_dir))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


@query()
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest repair and the digest of what the repair gives."""
    return repair.report(repair.repair(repair.damaged(conversations(spark, sf_dir))))


#: A table of the 256 checksum steps, and the checksum of a text, in DuckDB.
_CRC_TABLE = """
    steps as (
        select list(list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384::ubigint * (c & 1))) order by i) as t
        from range(256) r(i)
    )"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(
        list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::ubigint)),
        lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::bigint])
    ), 4294967295::ubigint)::bigint"""


@query(
    f"""
    with recursive {_CRC_TABLE.strip()},
    ids as (select distinct doc_id from documents),
    walk as (
        select doc_id, case when coalesce(doc_id, 0) < 0 then coalesce(doc_id, 0)::hugeint + 18446744073709551616 else coalesce(doc_id, 0)::hugeint end as key, 0::bigint as shard from ids
        union all
        select doc_id, next, floor((shard + 1) * (2147483648::double / ((next // 8589934592) + 1)::double))::bigint
        from (select doc_id, shard, (key * 2862933555777941757 + 1) % 18446744073709551616 as next from walk where shard < {sharding.SHARDS + 1})
    ),
    placed as (
        select doc_id, max(shard) filter (shard < {sharding.SHARDS}) as shard, max(shard) filter (shard < {sharding.SHARDS + 1}) as grown_shard
        from walk group by doc_id
    ),
    sized as (
        select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, {_crc("coalesce(text, '')")} as text_crc32
        from documents, steps
    )
    select s.doc_id, size::bigint as size, text_crc32, 'key' as law, shard::int as shard,
           row_number() over (partition by shard order by s.doc_id nulls first, text_crc32, size) - 1 as slot,
           grown_shard::int as grown_shard
    from sized s join placed p on s.doc_id is not distinct from p.doc_id
    """
)
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, and its shard when there is one more."""
    rows = sharding.with_slots(sharding.sharded(documents(spark, sf_dir)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query(
    f"""
    with {_CRC_TABLE.strip()},
    own as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
        from conversations where conv_id is not null
    ),
    sizes as (select conv_id, count(*) as n from own group by conv_id),
    plan as (
        select s.conv_id, s.conv_id - s.conv_id % 5 as leader, {_crc("s.conv_id::varchar")} % 9 as h from sizes s, steps
    ),
    headed as (select p.*, least(h, coalesce(l.n, 0)) as head from plan p left join sizes l on l.conv_id = p.leader),
    turns as (
        select p.conv_id, o.place + 1 as depth, o.role, o.text from headed p join own o on o.conv_id = p.leader and o.place < p.h
        union all
        select p.conv_id, o.place - p.h + p.head + 1, o.role, o.text from headed p join own o on o.conv_id = p.conv_id and o.place >= p.h
    ),
    paths as (
        select conv_id, 0 as depth, 0 as bytes, [] as path from sizes
        union all
        select conv_id, depth, octet_length(encode(text)),
               list(sha256(role || chr(0) || text)) over (partition by conv_id order by depth rows unbounded preceding)
        from turns
    ),
    lengths as (select conv_id, max(depth) as n from paths group by conv_id),
    named as (
        select p.conv_id, depth, bytes, n, min(p.conv_id) over (partition by depth, path) as name
        from paths p join lengths using (conv_id)
    ),
    nodes as (
        select name, depth, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as own_saved,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = n), '')) as ends_sha256
        from named group by name, depth
    ),
    up as (
        select w.name, w.depth, w.n_convs, w.own_saved, w.ends_sha256, a.name as parent
        from nodes w left join named a on a.conv_id = w.name and a.depth = w.depth - 1
    ),
    kids as (select parent as name, depth - 1 as depth, count(*) as n_children from up where parent is not null group by all),
    full_nodes as (select u.*, coalesce(n_children, 0) as n_children from up u left join kids k on k.name = u.name and k.depth = u.depth),
    totals as (
        select a.name, a.depth, sum((f.n_children = 0)::int) as n_leaves, sum(f.own_saved) as saved_tokens
        from full_nodes f join named a on a.conv_id = f.name and a.depth <= f.depth
        group by a.name, a.depth
    )
    select f.name as conv_id, f.depth::bigint as depth, f.parent as parent_conv_id, f.n_convs, f.n_children::bigint as n_children,
           n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
    from full_nodes f join totals t on t.name = f.name and t.depth = f.depth
    """
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    sizes, turns = prefix_trie.with_shared_heads(prefix_trie.turns_of(conversations(spark, sf_dir)))
    return prefix_trie.trie(sizes, turns)
