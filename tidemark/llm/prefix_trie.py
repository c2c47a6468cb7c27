"""The prefix trie of conversations by fixed-length block hashing.

Turns become digests, and `BLOCK` consecutive turns a block with a digest of its own. A scan with
doubling distances turns these into digests of all prefixes that end with a whole block, so that
equal prefixes of conversations are equal values. Conversations are grouped by (prefix, next block)
first. Where all that share a prefix go on with one block, its turns are nodes with those very
members. Only where sibling blocks diverge are they refined: each distinct block (not each
conversation) is cut at its turn boundaries, and what begins alike is put together again.

A node belongs to its smallest member, which then owns all nodes from there to its own end. So the
trie is a tree of conversations, each attached to the owner of the node above its first one, and
sums over subtrees are sums over attached conversations. They are gathered by pointer doubling:
rounds are logarithmic in the depth of that tree. Within a conversation sums run backwards in
stretches of `STRETCH` turns.

Nothing gathers a conversation, a group of copies or a node's members in one task: turns are
numbered in ranges, members are counted before the shuffle, and the ids that end at a node are
joined in pieces of at most `PIECE` ids and then hashed as a stream.

Defined results: null roles and texts are empty; rows without a conversation id are in no
conversation; turns with equal numbers are ordered by role and then by the SHA-256 of role and
text, so repeated rows stay repeated turns; the rebuilt conversation may have no turns, and then
ends at the root; no conversations give no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written
from tidemark.plans.skew import salted_join

BLOCK = 4
STRETCH = 1024
PIECE_BITS = 10  # ids that agree but for these bits: 1,024 at most
_ROOT = "0" * 64


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, digest, n_bytes): the turns of each conversation from 1, as digests."""
    role_, text_ = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    order = ["turn", "role", "digest"]
    read = turns.filter(turns[conv].isNotNull()).select(
        turns[conv].cast("long").alias("conv"),
        turns[turn].alias("turn"),
        role_.alias("role"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.octet_length(text_).cast("long").alias("n_bytes"),
    )
    # A long conversation spans several ranges; each numbers its own part.
    ranged = read.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "turn-ranges")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    parts = parts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    return (
        ranged.withColumn("own", own)
        .join(parts, ["conv", "part"])
        .select("conv", (F.col("before") + F.col("own")).alias("place"), "digest", "n_bytes")
    )


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns after each conversation's first h turns are replaced by those of its group's first
    conversation, h being the id's CRC-32 modulo `heads`; and (conv, size) of all conversations. The
    group of a negative id is found with the remainder of SQL, towards zero."""
    h = (F.crc32(F.col("conv").cast("string")) % heads).alias("h")
    sizes = written(turns.groupBy("conv").agg(F.max("place").alias("size")), "sizes")
    convs = sizes.select("conv", "size", h, (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    head = F.least("h", F.coalesce("base_size", F.lit(0))).alias("head")
    convs = convs.join(bases, "base", "left").select("conv", "base", "size", "h", head)
    convs = written(convs, "heads")
    first = turns.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
    taken = convs.join(first, "base").filter(F.col("place") <= F.col("head")).select("conv", "place", "digest", "n_bytes")
    left = turns.select("*", h).filter(F.col("place") > F.col("h"))
    left = salted_join(left, convs.select("conv", "head"), ["conv"], "left", key_rows=turns)
    left = left.select("conv", (F.col("head") + F.col("place") - F.col("h")).alias("place"), "digest", "n_bytes")
    size = F.col("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    return taken.union(left), convs.select("conv", size.alias("size"))


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """(conv, block, turns, n, own, upto, prev): each block with its own digest, and the digests of
    the conversation up to its end and up to the end of the block before."""
    blocks = (
        turns.groupBy("conv", F.expr(f"(place - 1) div {block}").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "n_bytes"))).alias("turns"))
        .select("*", F.size("turns").alias("n"), _sha(_joined("turns")).alias("own"))
    )
    blocks = written(blocks, "blocks")
    last = blocks.agg(F.max("block")).first()[0] or 0
    upto = blocks.select("conv", "block", F.col("own").alias("upto"))
    distance = 1
    while distance <= last:
        earlier = upto.filter(F.col("block") <= last - distance).select("conv", (F.col("block") + distance).alias("block"), F.col("upto").alias("left"))
        both = F.when(F.col("left").isNull(), F.col("upto")).otherwise(_sha(F.col("left"), F.col("upto")))
        upto = written(upto.join(earlier, ["conv", "block"], "left").select("conv", "block", both.alias("upto")), "prefixes")
        distance *= 2
    before = upto.select("conv", (F.col("block") + 1).alias("block"), F.col("upto").alias("prev"))
    prev = F.coalesce("prev", F.unhex(F.lit(_ROOT)))
    return blocks.join(upto, ["conv", "block"]).join(before, ["conv", "block"], "left").withColumn("prev", prev)


def _joined(turns: str | Column) -> Column:
    return F.aggregate(turns, F.unhex(F.lit("")), lambda digests, t: F.concat(digests, t["digest"]))


def _nodes(blocks: DataFrame, block: int) -> DataFrame:
    """(depth, key, parent, n_bytes, n_convs, conv): all nodes below the root."""
    groups = blocks.groupBy("block", "prev", "own").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"))
    groups = written(groups, "block-groups")
    alone = (
        groups.groupBy("block", "prev")
        .agg(F.count("*").alias("siblings"), F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
        .filter("siblings = 1")
    )
    diverging = groups.join(alone, ["block", "prev"], "left_anti")

    def cut_up(rows: DataFrame) -> DataFrame:
        # The smallest member stands for all: it has the same turns.
        whole = rows.select("block", "conv", "n_convs").join(blocks, ["conv", "block"])
        whole = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))

        def key(i: Column) -> Column:
            return F.when(i == 0, F.col("prev")).when(i == block, F.col("upto")).otherwise(_sha(F.col("prev"), _joined(F.slice("turns", F.lit(1), i))))

        i = F.col("i")
        return whole.select(
            (F.col("block") * block + i).alias("depth"),
            key(i).alias("key"),
            key(i - 1).alias("parent"),
            F.get(F.col("turns"), i - 1)["n_bytes"].alias("n_bytes"),
            "n_convs",
            "conv",
        )

    refined = cut_up(diverging).groupBy("depth", "key", "parent", "n_bytes").agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    return cut_up(alone).unionByName(refined)


def _ends(blocks: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """(depth, key, ends_sha256) of nodes at which conversations end."""
    last = blocks.join(sizes, "conv").filter(F.expr(f"block = (size - 1) div {block}"))
    key = F.when(F.col("n") == block, F.col("upto")).otherwise(_sha(F.col("prev"), _joined("turns")))
    ends = last.select("size", key.alias("key"), "conv")
    ends = ends.union(sizes.filter("size = 0").select("size", F.unhex(F.lit(_ROOT)), "conv"))
    pieces = (
        ends.groupBy(F.col("size").alias("depth"), "key", F.shiftright("conv", PIECE_BITS).alias("piece"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    )

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "ids"))):
                if node != (depth, key):
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, key), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(done)
        if node:
            yield _batch([(*node, state.hexdigest())])

    def _batch(rows):
        columns = list(zip(*rows)) if rows else [(), (), ()]
        types = (pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["depth", "key", "ends_sha256"])

    placed = pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "piece")
    return placed.mapInArrow(hashed, "depth long, key binary, ends_sha256 string")


def _subtrees(tree: DataFrame, root: int, sums: Sequence[str]) -> DataFrame:
    """(conv, sums): the sums of each conversation and all that are attached to it, near or far."""
    state = tree
    while state.filter("up is not null").limit(1).count():
        below = state.filter("up is not null").groupBy(F.col("up").alias("conv")).agg(*[F.sum(c).alias(f"{c}_below") for c in sums])
        # What is attached to the root's owner has nothing further above.
        rising = state.filter(F.col("up") != root).select("conv", F.col("up").alias("mid"))
        above = salted_join(rising, state.select(F.col("conv").alias("mid"), F.col("up").alias("next_up")), ["mid"], "left")
        above = above.select("conv", "next_up")
        grown = [(F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in sums]
        state = written(
            state.join(below, "conv", "left").join(above, "conv", "left").select("conv", F.col("next_up").alias("up"), *grown), "subtrees"
        )
    return state.select("conv", *sums)


def _sums_to_end(rows: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Each of `sums` from a row's depth to the end of its conversation, added as to_<sum>."""
    rows = rows.withColumn("stretch", F.expr(f"depth div {STRETCH}"))
    stretches = rows.groupBy("conv", "stretch").agg(*[F.sum(c).alias(c) for c in sums])
    after = Window.partitionBy("conv").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("conv", "stretch", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"after_{c}") for c in sums])
    within = Window.partitionBy("conv", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(c).over(within).alias(f"to_{c}") for c in sums])
    joined = rows.join(stretches, ["conv", "stretch"])
    return joined.withColumns({f"to_{c}": F.col(f"to_{c}") + F.col(f"after_{c}") for c in sums})


def prefix_trie(turns: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of `turns` (conv, place from 1, digest, n_bytes), where `sizes`
    (conv, size) names all conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    facts = sizes.agg(F.min("conv").alias("root"), F.count("*").alias("n")).first()
    root = 0 if facts["root"] is None else facts["root"]
    blocks = written(_blocks(turns, block), "linked-blocks")
    top = sizes.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(_ROOT)).alias("key"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("n_bytes"), "n_convs", "conv",
    )
    nodes = written(_nodes(blocks, block).unionByName(top), "nodes")

    # Where each conversation's own nodes begin, and whose node is above.
    first = nodes.groupBy("conv").agg(F.min("depth").alias("depth")).filter("depth > 0")
    owners = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv").alias("up"))
    low = first.join(nodes.select("conv", "depth", "parent"), ["conv", "depth"])
    attached = low.filter("depth = 1").select("conv", "depth", F.lit(root).cast("long").alias("up"))
    deeper = salted_join(low.filter("depth > 1"), owners.filter("depth > 1"), ["depth", "parent"], "left")
    attached = written(attached.unionByName(deeper.select("conv", "depth", "up")), "attached")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0))
    nodes = nodes.join(children, ["depth", "key"], "left").select(
        "depth", "key", "conv", "n_convs", n_children.alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        (n_children == 0).cast("long").alias("leaves"),
    )
    nodes = written(nodes, "counted-nodes")

    sums = ["saved", "leaves"]
    own = nodes.groupBy("conv").agg(*[F.sum(c).alias(c) for c in sums])
    tree = written(own.join(attached.select("conv", "up"), "conv", "left").select("conv", "up", *sums), "tree")
    below = _subtrees(tree, root, sums).join(attached, "conv")
    below = below.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(*[F.sum(c).alias(f"{c}_below") for c in sums])
    valued = nodes.join(below, ["conv", "depth"], "left").withColumns({c: F.col(c) + F.coalesce(f"{c}_below", F.lit(0)) for c in sums})
    summed = _sums_to_end(valued.drop("saved_below", "leaves_below"), sums)

    none = hashlib.sha256(b"").hexdigest()
    return (
        summed.join(attached, ["conv", "depth"], "left")
        .join(_ends(blocks, sizes, block), ["depth", "key"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("depth").cast("long").alias("depth"),
            F.when(F.col("depth") > 0, F.coalesce("up", "conv")).alias("parent_conv_id"),
            F.col("n_convs").cast("long").alias("n_convs"),
            F.col("n_children").cast("long").alias("n_children"),
            F.col("to_leaves").cast("long").alias("n_leaves"),
            F.col("to_saved").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
