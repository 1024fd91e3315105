"""Repeated passages by a sparse suffix array.

Suffixes are kept at minimiser positions only: in every window of ``size`` words the leftmost word gram of least hash
begins one. They are sorted by their words over the whole corpus, and each is compared with its neighbours. What no
neighbour shares at least a gram with is unique. The rest is extended left and right to whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import signed, word_codes
from labelloom.llm.repeats import Anchors, Once, keyed, removed_passages
from labelloom.session import stage

#: Words of a suffix that its sort key holds, two bytes each.
KEY_WORDS = 24
SUFFIX = "key binary, context long, k1 long, position int"
SORTED = f"{SUFFIX}, live boolean, edge int, part int"


def sparse_suffixes(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """SUFFIX: the suffixes at minimiser positions of each text; equal texts that meet in a task give theirs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Once()
        for batch in batches:
            rows: list[tuple] = []
            for text, k1 in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if not once.new(k1):
                    continue
                codes = word_codes(text.as_py())
                if len(codes) < size:
                    continue
                found = Anchors(codes, size, gram)
                short = np.concatenate(((codes >> np.uint64(48)).astype(">u2"), np.zeros(KEY_WORDS, ">u2")))
                keys = short[found.at[:, None] + np.arange(KEY_WORDS)]
                rows.append((keys, found.contexts(), np.full(len(found.at), k1, np.int64), found.at.astype(np.int32)))
            if rows:
                keys, contexts, k1, at = (np.concatenate(x) for x in zip(*rows, strict=True))
                raw = pa.py_buffer(np.ascontiguousarray(keys).tobytes())
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * KEY_WORDS), len(at), [None, raw])
                yield pa.RecordBatch.from_arrays(
                    [key.cast(pa.binary()), pa.array(signed(contexts)), pa.array(k1), pa.array(at)],
                    names=["key", "context", "k1", "position"],
                )

    return keyed(docs).select("text", "k1").mapInArrow(run, SUFFIX)


def _compare(gram: int):
    """SORTED rows of a partition in key order: those that share a gram with a neighbour, and the first and last."""
    names = [c.split()[0] for c in SORTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def chosen(rows: pa.Table, live: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            keep = live | (edge > 0)
            out = rows.take(pa.array(np.flatnonzero(keep))).combine_chunks()
            more = [pa.array(live[keep]), pa.array(edge[keep]), pa.array(np.full(int(keep.sum()), part, np.int32))]
            columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in out.columns]
            return pa.RecordBatch.from_arrays([*columns, *more], names=names)

        held, held_live, first = None, False, 1  # the last row waits for the one after it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held, batch])
            raw = np.frombuffer(b"".join(rows.column(0).to_pylist()), np.uint8)
            keys = raw.reshape(-1, 2 * KEY_WORDS)[:, : 2 * gram]
            k1, at = rows.column(2).to_numpy(), rows.column(3).to_numpy()
            like = (keys[1:] == keys[:-1]).all(axis=1) & ((k1[1:] != k1[:-1]) | (at[1:] != at[:-1]))
            live = np.zeros(len(keys), bool)
            live[1:] |= like
            live[:-1] |= like
            live[0] |= held_live
            edge = np.zeros(len(keys), np.int32)
            edge[0] = first
            done = len(keys) - 1
            if done:
                yield chosen(rows.slice(0, done), live[:done], edge[:done])
                first = 0
            held, held_live = batch.slice(batch.num_rows - 1), bool(live[-1])
        if held is not None:
            yield chosen(pa.Table.from_batches([held]), np.array([held_live]), np.array([2 | first], np.int32))

    return run


def alike_across(edges: list, gram: int) -> list:
    """The edge rows that share a gram with the nearest row of the partition before or after. ``edges`` has at most two
    rows a partition."""
    ordered = sorted(edges, key=lambda r: (r.part, r.edge))
    alive = []
    for left, right in zip(ordered, ordered[1:], strict=False):
        if left.part != right.part and left.key[: 2 * gram] == right.key[: 2 * gram]:
            if (left.k1, left.position) != (right.k1, right.position):
                alive += [left, right]
    return alive


def shared_suffixes(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """The sampled suffixes that share at least ``gram`` words with a neighbour in the sorted order.

    The order is made by ranges of (key, text, place), so a passage with any number of copies is spread over tasks.
    Comparing neighbours is linear in the number of suffixes. What meets across the border of two tasks is settled from
    the first and last suffix of each.
    """
    spark = docs.sparkSession
    order = ["key", "k1", "position"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sparse_suffixes(docs, size, gram).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    compared = stage(ordered.mapInArrow(_compare(gram), SORTED), "suffixes")
    edges = compared.where("edge > 0").select("part", "edge", *order, "context").collect()
    extra = [(bytes(r.key), r.context, r.k1, r.position) for r in alike_across(edges, gram)]
    live = compared.where("live").select("key", "context", "k1", "position")
    live = live.unionByName(spark.createDataFrame(extra, SUFFIX)) if extra else live
    return live.select(F.xxhash64(F.substring("key", 1, 2 * gram)).alias("hash"), "context", "k1", "position")


def suffix_array(docs: DataFrame, size: int = 50, gram: int = 16) -> DataFrame:
    """Remove each word that a repeated window of ``size`` words covers; seeds are neighbours in a sparse suffix array.

    Rows, and what happens to nulls, empty and short texts, repeated rows and empty tables, are those of
    ``repeats.seed_and_extend``: doc_id, n_words, n_removed, spans, kept_sha256. ``gram`` is at most KEY_WORDS.
    """
    return removed_passages(docs, shared_suffixes(docs, size, gram), size, gram)
