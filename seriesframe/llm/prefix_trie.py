"""Conversation prefix trie by van Emde Boas recursion.

Sequences are cut at half of the depth, the halves at half of theirs, and so on. A cut names the prefix that ends there
after its smallest conversation: sequences of one named prefix whose pieces up to the next cut are equal get the same
name at that cut. All pieces of one level, upper tries and lower forests alike, are named by the same jobs, so a trie of
depth D takes log2(D) levels. Names are kept only for prefixes that several conversations share; below them a
conversation is a chain of its own, and no level looks at it again.

Totals of subtrees go the same way back. First every node at a cut adds up its own piece of 2**k turns, pieces of equal
height being joined in pairs; then totals are grafted upward, nodes at coarser cuts first: a node's total is that of its
piece and those of the nodes right below the piece. Every shared node takes part once in each pass.

Pieces are compared by 128 bits that are exclusive-ored over their turns, each hashed with its place, so they are
partial aggregates; hot prefixes are joined through written tables, whose keys adaptive execution may split.

Defined cases: null roles and texts are empty; turns are ordered by turn (null first),
role, the text's first 64 characters and its digest; rows without a
conversation id belong to no conversation; repeated rows are turns of their own; texts of any length are only hashed
and measured; an empty table has no nodes; only the four named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.places import digests, joined_runs, with_place
from seriesframe.llm.work import stage


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, at (0-based place), x, y (128 bits of role and text), size (bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("x"),
        F.xxhash64(F.lit(2), role, text).alias("y"),
        F.octet_length(F.encode(text, "utf-8")).cast("long").alias("size"),
        F.struct(role.alias("r"), F.substring(text, 1, 64).alias("t"), F.md5(F.encode(text, "utf-8")).alias("h")).alias("_tie"),
    )
    placed = with_place(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("_tie")], "at")
    return placed.select("conv_id", F.col("at").cast("long").alias("at"), "x", "y", "size")


def with_shared_heads(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n) and turns, rebuilt: conversation c begins with the first h turns of c - c % group, then
    has its own turns after its first h; h = crc32(c) % heads."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    plan = own.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("leader"), h.cast("long").alias("h")
    )
    lengths = own.select(F.col("conv_id").alias("leader"), F.col("n").alias("leader_n"))
    plan = plan.join(lengths, "leader", "left").withColumn("head", F.least("h", F.coalesce("leader_n", F.lit(0))))
    plan = stage(plan.select("conv_id", "leader", "h", "head", "n"), "rebuilding")
    first = turns.filter(F.col("at") < heads).withColumnRenamed("conv_id", "leader")
    copied = plan.join(first, "leader").filter(F.col("at") < F.col("h"))
    kept = turns.join(plan, "conv_id").filter(F.col("at") >= F.col("h"))
    rebuilt = copied.select("conv_id", "at", "x", "y", "size").unionByName(
        kept.select("conv_id", (F.col("at") - F.col("h") + F.col("head")).alias("at"), "x", "y", "size")
    )
    sizes = plan.select("conv_id", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return sizes, rebuilt


def _names(sizes: DataFrame, turns: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """names (conv_id, depth, name) of the prefixes that conversations share, and the nodes (name, depth, n_convs) of these."""
    root = sizes.agg(F.min("conv_id").alias("name"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 1")
    node = stage(root.select("name", F.lit(0).cast("long").alias("depth"), "n_convs"), "trie-nodes")
    least = node.select("name").scalar()
    names = stage(
        sizes.select("conv_id", F.lit(0).cast("long").alias("depth"), least.alias("name")).filter("name is not null"), "trie-names"
    )
    all_names, all_nodes = [names], [node]
    for k in reversed(range(levels)):
        height = 1 << k
        piece = F.shiftright("at", k)
        pieces = (
            turns.filter(piece.bitwiseAND(F.lit(1)) == 0)
            .groupBy("conv_id", F.shiftleft(piece, k).alias("depth"))
            .agg(
                *(F.bit_xor(F.xxhash64("at", c)).alias(c) for c in ("x", "y")),
                F.count(F.lit(1)).alias("n"),
            )
            .filter(F.col("n") == height)
            .drop("n")
        )
        known = reduce(DataFrame.unionByName, all_names)
        cut = stage(pieces.join(known, ["conv_id", "depth"]), "trie-cuts")
        groups = cut.groupBy("depth", "name", "x", "y").agg(F.min("conv_id").alias("new"), F.count(F.lit(1)).alias("n_convs"))
        groups = stage(groups.filter("n_convs > 1"), "trie-groups")
        below = (F.col("depth") + height).alias("depth")
        all_names.append(
            stage(cut.join(groups, ["depth", "name", "x", "y"]).select("conv_id", below, F.col("new").alias("name")), "trie-names")
        )
        all_nodes.append(groups.select(F.col("new").alias("name"), below, "n_convs"))
    return reduce(DataFrame.unionByName, all_names), reduce(DataFrame.unionByName, all_nodes)


def _grafted(own: DataFrame, names: DataFrame, levels: int, totals: list[str]) -> DataFrame:
    """name, depth and the totals of each shared node's subtree, from the nodes' own values."""
    zero = [F.col(c) for c in totals]

    def below(nodes: DataFrame, height: int) -> DataFrame:
        """The sums of nodes under the ancestors `height` turns above them."""
        up = names.select(F.col("conv_id").alias("name"), (F.col("depth") + height).alias("depth"), F.col("name").alias("_up"))
        lifted = nodes.join(up, ["name", "depth"]).groupBy("_up", (F.col("depth") - height).alias("depth"))
        return lifted.agg(*(F.sum(c).alias(f"_{c}") for c in totals)).withColumnRenamed("_up", "name")

    def plus(nodes: DataFrame, more: DataFrame) -> DataFrame:
        return nodes.join(more, ["name", "depth"], "left").select(
            "name", "depth", *((F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in totals)
        )

    pieces = [own.select("name", "depth", *zero)]
    for k in range(levels):
        at_cut = pieces[k].filter(F.col("depth") % (2 << k) == 0)
        lower = pieces[k].filter(F.col("depth") % (2 << k) == 1 << k)
        pieces.append(stage(plus(at_cut, below(lower, 1 << k)), "trie-pieces"))
    whole = pieces[levels]
    for k in reversed(range(levels)):
        upper = pieces[k].filter(F.col("depth") % (2 << k) == 1 << k)
        beyond = whole.filter(F.col("depth") % (2 << k) == 0)
        whole = stage(whole.unionByName(plus(upper, below(beyond, 1 << k))), "trie-totals")
    return whole


def _levels(depth: int) -> int:
    """Halvings of the least power of two over a depth."""
    return int(depth).bit_length()


def trie(sizes: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 (of the ids that end there, joined by commas). `turns` has places from 0 to n - 1 for each of `sizes`."""
    turns, sizes = stage(turns, "trie-turns"), stage(sizes, "trie-sizes")
    deepest = turns.agg(F.max("at")).first()[0]
    names, shared = _names(sizes, turns, _levels(0 if deepest is None else deepest + 1))
    names = stage(names, "trie-names")
    shared_depth = names.agg(F.max("depth")).first()[0]
    levels = _levels(shared_depth or 0)

    up = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    paths = turns.select("conv_id", (F.col("at") + 1).alias("depth"), "size").join(names, ["conv_id", "depth"], "left")
    tops = paths.filter(F.col("name").isNull() | (F.col("name") == F.col("conv_id")))
    nodes = stage(
        tops.join(up, ["conv_id", "depth"], "left").select(
            "conv_id",
            "depth",
            F.coalesce("parent", "conv_id").alias("parent_conv_id"),
            F.col("name").isNotNull().alias("shared"),
            F.col("parent").isNotNull().alias("under_shared"),
            "size",
        ),
        "trie-paths",
    )
    children = nodes.filter("under_shared").groupBy(F.col("parent_conv_id").alias("name"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(~F.col("shared")).alias("n_chains")
    )
    sizes_of = nodes.filter("shared").select(F.col("conv_id").alias("name"), "depth", "size", F.col("parent_conv_id"))
    own = (
        shared.join(children, ["name", "depth"], "left")
        .join(sizes_of, ["name", "depth"], "left")
        .select(
            "name",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_chains")).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))).alias("saved_tokens"),
        )
    )
    own = stage(own, "trie-shared")
    totals = ["n_leaves", "saved_tokens"]
    whole = _grafted(own, names, levels, totals)
    ends = names.join(sizes.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"])
    ends = ends.select("name", "depth", "conv_id", F.col("conv_id").cast("string").alias("member"))
    runs = joined_runs(ends, ["name", "depth"], "conv_id", "member", ",")
    ended = digests(runs, ["name", "depth"], ["conv_id"], "run", ",")
    of_shared = own.drop(*totals).join(whole, ["name", "depth"]).join(ended, ["name", "depth"], "left")
    one_root = sizes.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    lone = [
        nodes.filter("not shared").select("conv_id", "depth", "parent_conv_id"),
        one_root.filter("c = 1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id")),
    ]
    chains = lone[0].unionByName(lone[1]).join(sizes, "conv_id")
    last = F.col("depth") == F.col("n")
    return of_shared.select(
        F.col("name").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        *totals,
        F.coalesce("sha256", _sha(F.lit(""))).alias("ends_sha256"),
    ).unionByName(
        chains.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.lit(1).cast("long").alias("n_convs"),
            F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            _sha(F.when(last, F.col("conv_id").cast("string")).otherwise("")).alias("ends_sha256"),
        )
    )


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
