"""Grouped prefix join: documents whose shingle sets have a Jaccard similarity of 3/4 or more, and their components.

Shingles have one global order: by how often their hash bucket occurs, rare first, then by hash. Two sets can only be
that similar if the prefixes (the first quarter) of both share a shingle. Documents with the same prefix and size are
one group; groups meet on prefix shingles, group pairs are filtered by size and by the place of the shared shingle,
and what is left is expanded to members and verified on the whole sets.

Groups are not paired all with all. First each group is compared with one other per prefix shingle, drawn anew for each
shingle among those of like size, which already connects families of near copies; this goes on while it settles much.
Then only pairs whose components still differ are compared, so no link between components is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import components, mixed, signed, small, text_bytes, text_key, window_hashes, word_codes
from labelloom.llm.repeats import Once
from labelloom.session import drop, new_path, stage

SHINGLE = 5
#: Similarity as a fraction.
NEAR, OF = 3, 4
#: Buckets of the frequency sketch; their counts are the only thing sent to all tasks. The more there are, the smaller
#: the passages whose shingles stand out and stay out of the prefixes.
BUCKETS = 1 << 20
#: Buckets whose counts go together.
BLOCK = 1 << 12
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Partners of a group that a draw compares it with at most, the first or those drawn by two shingles or more. The last
#: step has no such bound.
PARTNERS = 4
#: Draws go on as long as each settles at least one in so many of the shared shingles.
SETTLED = 5
#: A draw compares groups whose sizes are in one band, so wide on a logarithmic scale.
BAND = 0.14


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted. Fewer than five words are one shingle, none are none."""
    codes = word_codes(text.translate(LOWER))
    if not len(codes):
        return codes
    if len(codes) < SHINGLE:  # marked by length, so as to differ from any longer shingle
        return mixed(window_hashes(codes, len(codes)) + np.uint64(len(codes)))
    return np.unique(window_hashes(codes, SHINGLE))


def bucket_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def prefix_length(size: int) -> int:
    return size - -(-NEAR * size // OF) + 1


def digest(values: np.ndarray, size: int) -> tuple[int, int]:
    """128 bits for a sorted array of hashes."""
    with np.errstate(over="ignore"):
        a = np.bitwise_xor.reduce(mixed(values + np.uint64(0x1234567))) if len(values) else np.uint64(0)
        b = np.add.reduce(mixed(values ^ np.uint64(0xABCDEF0123456789))) if len(values) else np.uint64(0)
        both = mixed(np.array([a, b], np.uint64) + np.uint64(size))
    return tuple(both.view(np.int64).tolist())


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many (text, shingle) pairs fall into each bucket; BUCKETS numbers reach the driver, packed in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)
        for batch in batches:
            found = [bucket_of(shingles(text.as_py())) for text in batch.column(0)]
            if found:
                np.add(counts, np.bincount(np.concatenate(found), minlength=BUCKETS), out=counts, casting="unsafe")
        pack = zstandard.ZstdCompressor(level=1).compress
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([pack(blocks[k].tobytes()) for k in used], pa.binary())],
            names=["block", "counts"],
        )

    def added(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(BLOCK, np.int64)
        for counts in table.column("counts"):
            total += np.frombuffer(unpack(counts.as_py()), np.uint32)
        return table.slice(0, 1).select(["block"]).append_column("counts", pa.array([total.tobytes()], pa.binary()))

    counted = rows.select("text").mapInArrow(run, "block long, counts binary")
    counts = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for row in counted.groupBy("block").applyInArrow(added, "block long, counts binary").collect():
        counts[row.block] = np.frombuffer(row.counts, np.int64)
    return counts.ravel()


def described(rows: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(doc_id, text_key, size, s1, s2, g, prefix) of each text: digests of its set and of its prefix with size, and the prefix.

    The prefix is left out (null) where the task has given it before for the same group.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Once()
        for batch in batches:
            numbers, prefixes = [], []
            for text in batch.column(1):
                tokens = shingles(text.as_py())
                order = np.lexsort((tokens, ranks[bucket_of(tokens)]))
                prefix = tokens[order[: prefix_length(len(tokens))]]
                group = digest(np.sort(prefix), len(tokens))[0]
                numbers.append((len(tokens), *digest(tokens, len(tokens)), group))
                prefixes.append(signed(prefix) if len(tokens) and once.new(group) else None)
            columns = np.array(numbers, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    *(pa.array(columns[:, k]) for k in range(4)),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "size", "s1", "s2", "g", "prefix"],
            )

    return rows.select("doc_id", "text", "text_key").mapInArrow(
        run, f"doc_id {kind}, text_key long, size long, s1 long, s2 long, g long, prefix array<long>"
    )


def can_be_near(a: str, b: str) -> Column:
    """Size and positional filter of two sides that share a token: what they could share at most is enough."""
    most = f"1 + least({a}.size - {a}.position - 1, {b}.size - {b}.position - 1)"
    sizes = f"{OF} * least({a}.size, {b}.size) >= {NEAR} * greatest({a}.size, {b}.size)"
    return F.expr(f"{sizes} and {OF + NEAR} * ({most}) >= {NEAR} * ({a}.size + {b}.size)")


def packed_texts(rows: DataFrame, nodes: DataFrame, path: str) -> DataFrame:
    """(node, packed) for the sets of ``nodes`` (node, first): the compressed text of a document that has the set."""
    wanted = small(nodes.select(F.col("node"), F.col("first").alias("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            found = []
            for text, node in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tokens = shingles(text.as_py())
                if digest(tokens, len(tokens))[0] == node:  # another text may have the same doc_id
                    found.append((node, pack(text.as_py())))
            node, packed = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(packed, pa.binary())], names=["node", "packed"]
            )

    joined = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.doc_id)).select("text", "node")
    return stage(joined.mapInArrow(run, "node long, packed binary"), path=path)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (x, y: numbers of sets) whose sets are near enough. Each row carries its two texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = (shingles(unpack(t.as_py())) for t in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(OF * both >= NEAR * (len(a) + len(b) - both))
            chosen = pa.array(np.flatnonzero(near), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("x").take(chosen), batch.column("y").take(chosen)], names=["x", "y"]
            )

    left = texts.select(F.col("node").alias("x"), F.col("packed").alias("a"))
    right = texts.select(F.col("node").alias("y"), F.col("packed").alias("b"))
    asked = small(stage(pairs.select("y").distinct(), "asked"))  # other texts don't cross a shuffle
    return left.join(small(pairs), "x").join(right.join(asked, "y", "left_semi"), "y").select("x", "y", "a", "b").mapInArrow(
        run, "x long, y long"
    )


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``members`` (g, node) with the component of each node so far; a node without links is its own."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def drawn_pairs(shared: DataFrame, groups: DataFrame, draw: int) -> DataFrame:
    """(g, h): each group with some of those that share a prefix shingle with it, one drawn per shingle and band of sizes.

    The bands lie elsewhere in every draw, so groups of similar size meet in most draws. ``shared`` (token, g, size, position, low, high): the last two are the least and largest component of the group.
    """
    other = F.struct(F.xxhash64("token", "g", F.lit(draw)).alias("lot"), "g", "size", "position", "low", "high")
    band = F.floor(F.log(F.col("size")) / BAND + draw * 0.618).cast("int")
    banded = shared.withColumn("band", band)
    leaders = banded.groupBy("token", "band").agg(F.min(other).alias("b"))
    met = banded.alias("a").join(leaders, ["token", "band"]).where(
        F.expr("a.g <> b.g and (a.low <> b.low or a.high <> b.high or a.low <> a.high)") & can_be_near("a", "b")
    )
    counted = met.groupBy(F.col("a.g").alias("g"), F.col("b.g").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("g").orderBy(F.desc("n"), "h")
    ranked = counted.withColumn("place", F.row_number().over(best))
    return ranked.where((F.col("place") == 1) | ((F.col("place") <= PARTNERS) & (F.col("n") > 1))).select("g", "h")


def all_pairs_left(shared: DataFrame) -> DataFrame:
    """(g, h): every two groups of different components that share a prefix shingle and pass the filters."""
    a, b = shared.alias("a"), shared.alias("b")
    return (
        a.join(b, F.expr("a.token = b.token and a.g <= b.g"))
        .where(F.expr("a.low <> b.low or a.high <> b.high or a.low <> a.high") & can_be_near("a", "b"))
        .select(F.col("a.g").alias("g"), F.col("b.g").alias("h"))
        .distinct()
    )


def still_apart(shared: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``shared`` whose shingle is in the prefixes of more than one component."""
    of_group = labelled(members, labels).groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    current = shared.drop("low", "high").join(of_group, "g")
    apart = current.groupBy("token").agg(F.min("low").alias("a"), F.max("high").alias("b")).where("a <> b")
    return stage(current.join(apart.select("token"), "token", "left_semi"), "shared")


def shared_shingles(classes: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, g, size, position) of the prefix shingles by which groups, or sets of one group, meet; the groups."""
    tokens = prefixes.select(
        F.posexplode("prefix").alias("position", "token"), "g", F.col("size").cast("int").alias("size")
    ).select("token", "g", "size", "position")
    # one shuffle of narrow rows: a shingle stays where more than one group has it in its prefix
    of_token = Window.partitionBy("token")
    met = tokens.withColumns({"least": F.min("g").over(of_token), "most": F.max("g").over(of_token)}).where("least <> most")
    often = stage(met.drop("least", "most").distinct(), "shared")
    members = classes.select("g", F.col("s1").alias("node"))
    groups = members.groupBy("g").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n"))
    groups = stage(groups, "groups")
    # sets of one group share its whole prefix: one shingle is enough for them to meet, whoever else has it
    several = tokens.where("position = 0").join(groups.where("n > 1").select("g"), "g", "left_semi").distinct()
    several = several.join(often.where("position = 0").select("g"), "g", "left_anti")
    return often.unionByName(stage(several.select(often.columns), "shared")), groups


def linked_sets(rows: DataFrame, classes: DataFrame, shared: DataFrame, groups: DataFrame) -> DataFrame | None:
    """(node, label) of the sets that have a near one."""
    shared = shared.withColumn("low", F.col("g")).withColumn("high", F.col("g"))
    active = shared.select("g").distinct()
    nodes = stage(
        classes.join(active, "g", "left_semi").select("g", F.col("s1").alias("node"), "first"), "nodes"
    )
    members = nodes.select("g", "node")
    packed = new_path(rows.sparkSession, "packed")
    texts = packed_texts(rows, nodes, packed)
    inside = members.join(groups.where("n > 1"), "g").where("node <> rep")
    tried = inside.select(F.col("rep").alias("x"), F.col("node").alias("y"))
    links, labels = None, None
    drawing, before = True, None
    for draw in itertools.count():
        if draw:
            before = shared.count() if before is None else left
            shared = still_apart(shared, members, labels)
            left = shared.count()
            if not left:
                break
            drawing = SETTLED * (before - left) >= before
        if drawing:
            pairs = drawn_pairs(shared, groups, draw)
            one = groups.select(F.col("g").alias("h"), F.col("rep").alias("other"))
            expanded = pairs.join(labelled(members, labels), "g").join(labelled(one.select(F.col("h").alias("g"), F.col("other").alias("node")), labels).select(F.col("g").alias("h"), F.col("node").alias("other"), F.col("label").alias("other_label")), "h")
        else:
            pairs = all_pairs_left(shared)
            theirs = labelled(members, labels).select(
                F.col("g").alias("h"), F.col("node").alias("other"), F.col("label").alias("other_label")
            )
            expanded = pairs.join(labelled(members, labels), "g").join(theirs, "h")
        met = expanded.where("label <> other_label").select(
            F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y")
        )
        met = met.unionByName(tried).distinct() if not draw else met.distinct().join(tried, ["x", "y"], "left_anti")
        met = stage(met, "pairs")
        found = stage(verified(met, texts), "links")
        tried = met if not draw else tried.unionByName(met)
        links = found if links is None else links.unionByName(found)
        labels = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
        if not drawing:
            break
    drop(rows.sparkSession, packed)
    return labels


def labelled_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, size, label, s1, s2, first): each document's component (null without words) and set."""
    rows = docs.select("doc_id", text_bytes().alias("text"), text_key("text").alias("text_key"))
    ranks = bucket_counts(rows).astype(np.int32)
    path = new_path(docs.sparkSession, "prefixes")
    whole = stage(described(rows, ranks), path=path)
    every = stage(whole.drop("prefix"), "sets")
    classes = stage(
        every.where("size > 0").groupBy("s1", "s2", "g", "size").agg(F.min("doc_id").alias("first")), "classes"
    )
    shared, groups = shared_shingles(classes, whole.where("prefix is not null").select("g", "size", "prefix"))
    drop(docs.sparkSession, path)
    labels = linked_sets(rows, classes, shared, groups)
    named = labelled(classes.select(F.col("s1").alias("node"), "s2", "first"), labels)
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_set = named.join(least, "label").select(F.col("node").alias("s1"), "s2", "label", "component_id")
    return every.drop("g").join(of_set, ["s1", "s2"], "left")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A-Z are lower-cased. The set of a document are its distinct five-word shingles; with fewer words, the whole
    sequence; without words (or text) it is empty and linked with nothing. Two documents are linked if their
    similarity is 3/4 or more, ties included; component_id is the least doc_id that links reach. Repeated rows have
    equal sets and are linked. A null doc_id never names a component unless all its members are null; a row without
    words keeps its own doc_id. An empty table gives no rows. Other columns are not read.
    """
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return labelled_documents(docs).select(
        "doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id (null last), then of the least text key. Rows
    without words all stay. All columns are kept, whatever their names."""
    found = labelled_documents(docs.select("doc_id", "text")).where("size > 0")
    found = stage(found.select("doc_id", "text_key", "label"), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    counted = found.groupBy("doc_id", "text_key", "label").agg(F.count(F.lit(1)).alias("rows"))
    first = counted.groupBy("label").agg(F.min(order).alias("first"))
    marked = stage(
        counted.join(first, "label").select(
            F.col("doc_id").alias("id"), F.col("text_key").alias("k"), "rows", (order == F.col("first")).alias("stays")
        ),
        "labelled",
    )
    row = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (text_key("row.text") == F.col("k"))
    gone = small(marked.where("not stays or rows > 1").select("id", "k"))
    kept = row.join(gone, same, "left_anti")
    repeated = marked.where("stays and rows > 1").select("id", "k")
    if not repeated.isEmpty():
        copies = row.join(small(repeated), same).groupBy("id", "k").agg(F.first("row").alias("row"))
        kept = kept.unionByName(copies.select("row"))
    return kept.select("row.*")
