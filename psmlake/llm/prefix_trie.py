"""The trie of conversations' prefixes, with what is shared below each node.

Every conversation is a path from the root; two share a node where they start with the same turns.  A node belongs to
the smallest conversation that passes through it, so the nodes that a conversation owns are the lower end of its
path: a chain.  Its first owned depth is found by binary search, all conversations at once: each round looks up one
digest a conversation in the table of smallest owners, and leaves half of the depths in question.  Chains hang on
chains; their sums go up that tree by doubling steps, so that a tree of height H takes log2(H) rounds.

Nothing needs a conversation in one task.  Turns are numbered by range partitions and their counts.  A prefix's digest
is a vector of sums over its turns, each hashed with its place, so it is made in blocks of turns and shifted by the
blocks before; sums along a chain likewise.  A node's conversations are joined to text in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import bounded_batches, written

#: Conversations of a hundred share a first one, whose turns the others may start with.
FAMILY, LONGEST_HEAD = 100, 6
#: Turns for each block of a conversation, ids for each piece of an ends text.
BLOCK, PIECE = 4096, 4096
#: 32-bit lanes of a prefix digest.
LANES = 6


def _sum_before(rows: DataFrame, keys: list[str], block: str, sums: dict[str, str], backwards: bool = False) -> DataFrame:
    """For each key and block the totals of the blocks before it (or after it): `sums` names columns and their totals."""
    totals = rows.groupBy(*keys, block).agg(*[F.sum(c).alias(f"{c}__all") for c in sums])
    order = F.col(block).desc() if backwards else F.col(block)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, block, *[F.coalesce(F.sum(f"{c}__all").over(before), F.lit(0)).alias(to) for c, to in sums.items()])


def running(rows: DataFrame, key: str, place: str, sums: dict[str, str], backwards: bool = False, block: int = BLOCK) -> DataFrame:
    """`rows` with running sums of columns of longs along `place` within `key`, own row included.

    A key's rows are summed in blocks of `block` places, so a key of any size is dealt over tasks.
    """
    rows = rows.withColumn("__block", F.floor(F.col(place) / block))
    carried = {c: f"__{to}" for c, to in sums.items()}
    before = _sum_before(rows, [key], "__block", carried, backwards)
    own = Window.partitionBy(key, "__block").orderBy(F.col(place).desc() if backwards else F.col(place)).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(before, [key, "__block"])
    return rows.select("*", *[(F.sum(c).over(own) + F.col(carried[c])).alias(to) for c, to in sums.items()]).drop("__block", *carried.values())


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, pos, digest of role and text, n_chars; turns without conv_id are left out.

    By turn (null first), then role and text; rows that repeat all of them are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("__row"))
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "__row"]
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # in one partition after the sort, ids are in a row
    rows = written(turns.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("conv_id", told.alias("digest"), F.char_length("text").cast("long").alias("n_chars"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("__id")))
    pieces = rows.groupBy("conv_id", "part").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rows = rows.join(pieces, ["conv_id", "part"])
    return rows.select("conv_id", (F.col("__before") + F.col("__id") - F.col("__first")).alias("pos"), "digest", "n_chars")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, n_chars) of every rebuilt turn, and (conv_id, n) of every conversation.

    A conversation starts with the first h turns of its family's first one, h = crc32(id) % 6, and goes on with its own after its first h.
    """
    turns = written(numbered_turns(conversations))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(LONGEST_HEAD)).alias("h"))
    firsts = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    convs = convs.join(firsts, "base", "left").withColumn("head", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = written(convs.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n")))
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < LONGEST_HEAD)).select(F.col("conv_id").alias("base"), "pos", "digest", "n_chars")
    lent = convs.join(heads, "base").where("pos < head").select("conv_id", "pos", "digest", "n_chars")
    kept = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "n_chars")
    return written(lent.unionByName(kept)), convs.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, prefix (digest of the first `depth` turns), n_chars of the last of them."""
    placed = F.sha2(F.concat(F.col("pos").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("digest")), 256)
    lanes = [F.conv(F.substring("__h", 8 * k + 1, 8), 16, 10).cast("long").alias(f"__l{k}") for k in range(LANES)]
    rows = turns.withColumn("__h", placed).select("conv_id", "pos", "n_chars", *lanes)
    rows = running(rows, "conv_id", "pos", {f"__l{k}": f"__s{k}" for k in range(LANES)})
    depth = F.col("pos") + 1
    return rows.select("conv_id", depth.alias("depth"), F.unhex(F.md5(F.concat_ws(",", depth, *[f"__s{k}" for k in range(LANES)]).cast("binary"))).alias("prefix"), "n_chars")


def first_owned(paths: DataFrame, owners: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, n, first (n + 1: none is owned), above (owner of the node above it; null at depth 1).

    `low` and `high` close in on the first owned depth; only depths between them stay in `asked`, so a round costs half of the one before.
    """
    state = convs.select("conv_id", "n", F.lit(1).cast("long").alias("low"), (F.col("n") + 1).alias("high"), F.lit(None).cast("long").alias("above"))
    longest = convs.agg(F.max("n")).first()[0] or 0
    asked = paths.select("conv_id", "depth", "prefix").join(state.select("conv_id", "low", "high"), "conv_id")
    middle = F.floor((F.col("low") + F.col("high")) / 2)
    for _ in range(int(longest).bit_length()):
        told = asked.where(F.col("depth") == middle).join(owners.select("prefix", "owner"), "prefix").select("conv_id", "owner")
        own, mid = F.col("owner") == F.col("conv_id"), middle
        state = state.join(told, "conv_id", "left").select(
            "conv_id", "n", F.when(F.col("owner").isNull() | own, F.col("low")).otherwise(mid + 1).alias("low"), F.when(own, mid).otherwise(F.col("high")).alias("high"), F.when(F.col("owner").isNull() | own, F.col("above")).otherwise(F.col("owner")).alias("above")
        )
        state = written(state)
        asked = written(asked.drop("low", "high").join(state.where("low < high").select("conv_id", "low", "high"), "conv_id").where("depth >= low AND depth < high"))
    return state.select("conv_id", "n", F.col("low").alias("first"), "above")


def chain_totals(chains: DataFrame, sums: list[str]) -> DataFrame:
    """`chains` (conv_id, above, sums) with each sum over a chain and all that hang on it, directly or further down.

    After round k a chain's sums hold what lies within 2**k steps below it and `up` is the chain 2**k steps above it.
    """
    state = chains.select("conv_id", F.col("above").alias("up"), *sums)
    while state.where("up IS NOT NULL").limit(1).count():
        gained = state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(*[F.sum(c).alias(f"__{c}") for c in sums])
        further = state.select(F.col("conv_id").alias("up"), F.col("up").alias("__up"))
        state = written(state.join(gained, "conv_id", "left").join(further, "up", "left").select("conv_id", F.col("__up").alias("up"), *[(F.col(c) + F.coalesce(f"__{c}", F.lit(0))).alias(c) for c in sums]))
    return state.select("conv_id", *sums)


def ends_digests(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 for (conv_id, depth, member): SHA-256 of the members, rising, joined by commas.

    Members are joined in pieces of PIECE by all tasks; a node's pieces then run through one hash in their order, never held together.
    """
    keys = ["conv_id", "depth", "member"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(ends.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(*keys, F.spark_partition_id().alias("part"), F.floor(F.monotonically_increasing_id() / PIECE).alias("piece")))
    pieces = rows.groupBy("conv_id", "depth", "part", "piece").agg(F.array_join(F.array_sort(F.collect_list("member")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
                if (conv, depth) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256()
                state.update(ids.encode())
            if len(out) >= 10_000:
                yield _ends(out)
                out = []
        if node is not None:
            out.append((*node, state.hexdigest()))
        yield _ends(out)

    order = ["conv_id", "depth", "part", "piece"]
    return pieces.repartition(parts, "conv_id", "depth").sortWithinPartitions(*order).select("conv_id", "depth", "ids").mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    conv, depth, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())], names=["conv_id", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role or text is empty; null turns come first; equal turns go by role and text, and rows that repeat everything are turns
    of their own; rows without conv_id are left out; further columns are ignored.  A conversation that keeps no turn ends at the root.
    An empty table gives no node, not even the root.  Turns and prefixes are told by 128 bits.
    """
    bounded_batches(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    paths = written(prefixes(turns))
    nodes = written(paths.groupBy("prefix").agg(F.min("conv_id").alias("owner"), F.first("depth").alias("depth"), F.first("n_chars").alias("n_chars"), F.count("*").alias("n_convs")))
    state = first_owned(paths, nodes, convs)
    top = convs.agg(F.min("conv_id").alias("top"), F.count("*").alias("n_convs")).where("top IS NOT NULL")  # one row
    # the smallest conversation owns the root as well; where nothing is owned between, chains hang on the root
    top_conv = F.broadcast(top.select("top"))
    state = written(state.join(top_conv, how="left").select("conv_id", "n", F.when(F.col("conv_id") == F.col("top"), 0).otherwise(F.col("first")).cast("long").alias("first"), F.when(F.col("conv_id") != F.col("top"), F.coalesce("above", "top")).alias("above")))
    chains = state.where("first <= n")
    # a conversation ends on its own chain, or on the one above if it owns nothing
    ends = state.select(F.when(F.col("first") <= F.col("n"), F.col("conv_id")).otherwise(F.col("above")).alias("conv_id"), F.col("n").alias("depth"), F.col("conv_id").alias("member"))
    root = top.select(F.col("top").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_chars"), "n_convs")
    own = nodes.select(F.col("owner").alias("conv_id"), "depth", "n_chars", "n_convs").unionByName(root)

    hanging = chains.where("above IS NOT NULL").select(F.col("above").alias("conv_id"), (F.col("first") - 1).alias("depth"), F.col("conv_id").alias("child"))
    counts = hanging.groupBy("conv_id", "depth").agg(F.count("*").alias("n_hanging"))
    own = own.join(counts, ["conv_id", "depth"], "left").join(chains.select("conv_id", "first", "n", "above"), "conv_id")
    children = (F.col("depth") < F.col("n")).cast("long") + F.coalesce("n_hanging", F.lit(0))
    own = written(own.select("conv_id", "depth", "n_convs", "first", "above", children.alias("n_children"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"), (children == 0).cast("long").alias("leaf")))

    sums = own.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    totals = chain_totals(chains.select("conv_id", "above").join(sums, "conv_id"), ["saved", "leaf"])
    hung = hanging.join(totals.withColumnRenamed("conv_id", "child"), "child").groupBy("conv_id", "depth").agg(F.sum("saved").alias("__saved"), F.sum("leaf").alias("__leaf"))
    # at each node: what hangs there, and its own; then up the chain
    here: dict[str, Column] = {c: F.col(c) + F.coalesce(f"__{c}", F.lit(0)) for c in ("saved", "leaf")}
    below = running(own.join(hung, ["conv_id", "depth"], "left").withColumns(here).drop("__saved", "__leaf"), "conv_id", "depth", {"saved": "saved_tokens", "leaf": "n_leaves"}, backwards=True)
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("above"))
    out = below.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.join(ends_digests(ends), ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
