"""Prefix trie of conversations, rolled up by bands of depth.

A node is a distinct sequence of first turns. Its number is a pair of running exclusive-ors of a hash of each turn with its
place, 128 bits in all, so that the node of a conversation at any depth comes from running totals and no tree is walked.

Totals over subtrees are summed in bands of BAND depths. Each node adds its value to its ancestors within its band only. The
first nodes of all bands form a trie of their own, BAND times less deep, which is rolled up the same way; their finished
totals are then added to the nodes of the band above. A trie of depth d takes log(d) / log(BAND) rounds, and a node is
written at most 2 * BAND times in each.

Long conversations are split: places and running totals are taken per block of turns, and shifted by the totals of the
blocks before. Nodes that many conversations share are only ever reached by aggregations with a partial step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import small
from labelloom.session import stage

#: Depths of a band.
BAND = 16
#: Turn numbers that are put in order together; the next so many are another task's.
TURNS = 4096
#: Conversations of a family of so many begin with the first turns of its first one.
FAMILY = 20
MAX_SHARED = 4
#: Conversation ids that are joined into one piece of a node's list.
PIECE = 4096
NODE = ("d", "p1", "p2")
WORDS = r"[^\x20\x09-\x0D]+"


def xor(column: str | Column) -> Column:
    return F.bit_xor(column)


def before(totals: DataFrame, keys: list[str], block: str, sums: dict[str, Column]) -> DataFrame:
    """For each block but the first of each key: ``sums`` over the blocks before. Blocks are few: one row in so many turns."""
    order = Window.partitionBy(*keys).orderBy(F.col(block).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(block).asc_nulls_first()))
    shifted = totals.select(*keys, block, place.alias("_place"), *[s.over(order).alias(n) for n, s in sums.items()])
    return shifted.where("_place > 1").drop("_place")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, j, role, said, words): the turns of each conversation with their place from 1.

    Order is by turn (null first), then by role and digest of the text, so that turns with one number have a place, too.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(text.cast("binary"))).alias("said"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    rows = rows.withColumn("block", F.floor(F.col("turn") / TURNS))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    rows = stage(rows.withColumn("j", F.row_number().over(inside).cast("long")).drop("turn"), "turns")
    counts = rows.groupBy("conv", "block").agg(F.max("j").alias("n"))
    shift = small(stage(before(counts, ["conv"], "block", {"shift": F.sum("n")}), "shifts"))
    same = F.expr("t.conv = s.conv and t.block <=> s.block")
    shifted = rows.alias("t").join(shift.alias("s"), same, "left")
    j = F.col("j") + F.coalesce("shift", F.lit(0))
    return shifted.select("t.conv", j.alias("j"), "role", "said", "words")


def rebuilt_turns(turns: DataFrame, family: int = FAMILY, max_shared: int = MAX_SHARED) -> tuple[DataFrame, DataFrame]:
    """(conv, d, role, said, words) of the rebuilt conversations, d from 1, and (conv) of all conversations.

    Conversation c begins with the first h turns of conversation c - c % family (fewer if it has fewer, none if it is absent),
    h being the CRC-32 of the decimal c modulo ``max_shared``; its own turns after its first h follow.
    """
    convs = turns.groupBy("conv").agg(F.max("j").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % max_shared
    convs = stage(convs.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base")), "conversations")
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = stage(
        convs.join(sizes, "base", "left").select("conv", "n", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("shared")),
        "conversations",
    )
    heads = turns.where((F.col("j") < max_shared) & (F.col("conv") % family == 0))  # a few rows of one conversation in many
    begun = convs.where("shared > 0").join(heads.withColumnRenamed("conv", "base"), "base").where("j <= shared")
    begun = begun.select("conv", F.col("j").alias("d"), "role", "said", "words")
    shorter = convs.where("shared < h").select("conv", (F.col("h") - F.col("shared")).alias("less"))
    own = turns.join(small(stage(shorter, "shorter")), "conv", "left")
    after = F.crc32(F.col("conv").cast("string").cast("binary")) % max_shared
    own = own.where(F.col("j") > after).select("conv", (F.col("j") - F.coalesce("less", F.lit(0))).alias("d"), "role", "said", "words")
    return begun.unionByName(own), convs.select("conv")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, d, p1, p2, z1, z2, words): the node of each conversation at each depth, the root (d = 0) included; z1 and z2
    are what the last turn has added to the number of the node above."""
    marked = turns.select(
        "conv",
        "d",
        F.xxhash64("role", "said", "d").alias("z1"),
        F.xxhash64("role", "said", "d", F.lit(1)).alias("z2"),
        "words",
    )
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("d"), zero.alias("z1"), zero.alias("z2"), zero.alias("words"))
    rows = marked.unionByName(root).withColumn("block", F.floor(F.col("d") / TURNS))
    inside = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = stage(rows.withColumns({"p1": xor("z1").over(inside), "p2": xor("z2").over(inside)}), "prefixes")
    totals = rows.groupBy("conv", "block").agg(xor("z1").alias("t1"), xor("z2").alias("t2"))
    shift = small(stage(before(totals, ["conv"], "block", {"s1": xor("t1"), "s2": xor("t2")}), "shifts"))
    shifted = rows.join(shift, ["conv", "block"], "left")
    whole = [F.col(p).bitwiseXOR(F.coalesce(s, zero)).alias(p) for p, s in (("p1", "s1"), ("p2", "s2"))]
    return stage(shifted.select("conv", "d", *whole, "z1", "z2", "words"), "prefixes")


def trie_nodes(paths: DataFrame) -> DataFrame:
    """(d, p1, p2, conv, n_convs, words, q1, q2): each node with its smallest member; q1, q2 number the node above."""
    grouped = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.max("z1").alias("z1"),
        F.max("z2").alias("z2"),
    )
    above = [F.col(p).bitwiseXOR(F.col(z)).alias(q) for p, z, q in (("p1", "z1", "q1"), ("p2", "z2", "q2"))]
    return stage(grouped.select(*NODE, "conv", "n_convs", "words", *above), "nodes")


def ancestors(paths: DataFrame, unit: int) -> DataFrame:
    """(conv, d, line): the nodes of each conversation from the first depth of the band down to d, for depths that are
    multiples of ``unit``. A line has BAND nodes at most."""
    band = F.floor(F.col("d") / (unit * BAND))
    above = Window.partitionBy("conv", "_band").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = paths.where(F.col("d") % unit == 0).withColumn("_band", band)
    return rows.select("conv", "d", F.collect_list(F.struct(*NODE)).over(above).alias("line"))


def added(rows: DataFrame, sums: list[str]) -> DataFrame:
    return rows.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in sums])


def rolled_up(paths: DataFrame, nodes: DataFrame, sums: list[str], deepest: int, unit: int = 1) -> DataFrame:
    """(d, p1, p2, sums): for each of ``nodes`` (d, p1, p2, conv, sums) the totals of its subtree, itself included.

    ``nodes`` are those at depths that are multiples of ``unit``; ``conv`` is any conversation that passes through a node.
    """
    lines = stage(ancestors(paths, unit), "lines")
    climbing = nodes.join(lines, ["conv", "d"]).select(*sums, F.explode("line").alias("node"))
    inside = added(climbing.select("node.*", *sums), sums)
    if deepest < unit * BAND:
        return inside
    inside = stage(inside, "bands")
    heads = nodes.where(F.col("d") % (unit * BAND) == 0).select(*NODE, "conv")
    whole = rolled_up(paths, heads.join(inside, list(NODE)).select(*NODE, "conv", *sums), sums, deepest, unit * BAND)
    # a band's first node hands its finished total to the nodes of the band above: those down to the depth before its own
    passed = heads.where("d > 0").join(whole, list(NODE)).select("conv", (F.col("d") - unit).alias("d"), *sums)
    passed = passed.join(lines, ["conv", "d"]).select(*sums, F.explode("line").alias("node")).select("node.*", *sums)
    return added(inside.unionByName(passed), sums)


def end_digests(paths: DataFrame) -> DataFrame:
    """(d, p1, p2, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end at a node, in numeric order.

    The ids are sorted by range over all tasks and joined into pieces; the pieces of one node then pass a running digest in
    order. So the ids of a node that most conversations end at are never held together.
    """
    last = paths.groupBy("conv").agg(F.max(F.struct("d", "p1", "p2")).alias("at")).select("at.*", "conv")
    last = stage(last, "ends")

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> pa.RecordBatch:
            values = [*node, ids[0], len(ids), ",".join(map(str, ids))]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=[*NODE, "first", "n", "ids"])

        rows: list[pa.RecordBatch] = []
        for batch in batches:
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (at != node or len(ids) == PIECE):
                    rows.append(piece())
                    ids = []
                node = at
                ids.append(conv)
                if len(rows) == PIECE:
                    yield from pa.Table.from_batches(rows).combine_chunks().to_batches()
                    rows = []
        if ids:
            rows.append(piece())
        if rows:
            yield from pa.Table.from_batches(rows).combine_chunks().to_batches()

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, rows = None, None, []

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*NODE, "ends_sha256"]
            )

        for batch in batches:
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if at == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ids.encode())
            if rows:
                yield batch_of()
                rows.clear()
        if node is not None:
            rows.append((*node, digest.hexdigest()))
            yield batch_of()

    key = "d long, p1 long, p2 long"
    ordered = last.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    joined = ordered.select(*NODE, "conv").mapInArrow(pieces, f"{key}, first long, n long, ids string")
    by_node = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return by_node.mapInArrow(digests, f"{key}, ends_sha256 string")


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the smallest member of the node above (parent) and the number of nodes below (n_children).

    A conversation that names a node names all nodes of its own below it, too, so only the first of them needs its parent
    looked up. Parents of very many are few and are sent to all tasks; the others are joined by shuffle.
    """
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    counted = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(counted, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    starts = nodes.groupBy("conv").agg(F.min("d").alias("starts"))
    nodes = stage(nodes.join(starts, "conv"), "nodes")
    many = nodes.count() // 10_000 + 1_000  # so fewer than 10,000 nodes have more children than that
    parents = nodes.where("n_children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent"), "n_children"
    )
    popular = F.broadcast(parents.where(F.col("n_children") > many).withColumnRenamed("parent", "popular").drop("n_children"))
    others = parents.where(F.col("n_children") <= many).drop("n_children")
    first = nodes.where("d = starts").join(popular, ["d", "q1", "q2"], "left")
    found = first.where("popular is not null or d = 0").withColumn("parent", F.col("popular"))
    looked_up = first.where("popular is null and d > 0").join(others, ["d", "q1", "q2"])
    inner = nodes.where("d > starts").withColumn("parent", F.col("conv"))
    columns = [*NODE, "conv", "parent", "n_convs", "n_children", "words"]
    return stage(inner.select(*columns).unionByName(found.select(*columns)).unionByName(looked_up.select(*columns)), "nodes")


def prefix_trie(conversations: DataFrame, family: int = FAMILY, max_shared: int = MAX_SHARED) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (conv_id, turn, role, text), the empty one included.

    conv_id: the smallest member, that is a conversation that begins with the prefix; depth: turns of the prefix;
    parent_conv_id: conv_id of the prefix without its last turn (root: null); n_convs: members; n_children; n_leaves: nodes
    without children in its subtree; saved_tokens: words that members beyond the first would repeat, over its subtree;
    ends_sha256: digest of the ids of the members that end there. ``rebuilt_turns`` says how conversations are rebuilt;
    ``max_shared=1`` leaves them as they are.

    Turns are ordered by turn (null first), then by role and digest of the text. A null role or text is empty. Rows without a
    conv_id belong to no conversation. Repeated rows are turns of their own. Long texts and long conversations are
    taken whole. An empty table gives no rows; other columns are not read.
    """
    turns = stage(numbered_turns(conversations), "turns")
    paths = prefixes(*rebuilt_turns(turns, family, max_shared))
    nodes = with_parents(trie_nodes(paths))
    deepest = nodes.agg(F.coalesce(F.max("d"), F.lit(0))).first()[0]
    sums = ["n_leaves", "saved_tokens"]
    values = nodes.select(
        *NODE,
        "conv",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = rolled_up(paths, values, sums, deepest)
    joined = nodes.join(totals, list(NODE)).join(end_digests(paths), list(NODE), "left")
    return joined.select(
        F.col("conv").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        *sums,
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
