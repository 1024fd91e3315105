"""Removal of word passages that occur more than once, with two ways to find the places worth extending.

A passage is repeated if a window of ``size`` words also starts anywhere else. Every window has one anchor, the
leftmost of its word grams with the least hash, so equal windows have equal anchors. Anchors that occur once settle
their windows at once. The others are extended both ways over all windows they stand for (their context):

* if all places of an anchor have the same context, all its windows are repeated;
* otherwise its windows are compared one by one, by grouping on a 128-bit hash of their words.

Places are never paired, so a passage with n copies costs n rows and not n * n. Equal texts take part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import Runs, mixed, signed, small, text_bytes, word_codes
from labelloom.session import stage

#: Texts a task remembers so as to look at equal ones once; more only cost time.
REMEMBERED_TEXTS = 100_000
#: Places in a text that fit beside a hash; longer texts are taken in pieces.
LOW_BITS = 1 << 24
FOUND = "hash long, context long, k1 long, place long, position int"
PARTS = "k1 long, k2 long, start int, stop int, h1 long, h2 long"


def keyed(docs: DataFrame) -> DataFrame:
    """Texts as bytes, with a 128-bit key; rows of equal texts have equal keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", text_bytes().alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")
    )


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its least value, by its first 40 bits; the leftmost among equals."""
    places = np.arange(len(values), dtype=np.uint64)
    if len(values) > LOW_BITS:  # a very long text, in overlapping pieces
        step = LOW_BITS - width
        pieces = [least_places(values[k : k + LOW_BITS], width) + k for k in range(0, len(values) - width + 1, step)]
        ends = [min(step, len(p)) for p in pieces[:-1]]
        return np.concatenate([p[:n] for p, n in zip(pieces, ends, strict=False)] + pieces[-1:])
    least, length = (values & np.uint64(~(LOW_BITS - 1) & 0xFFFFFFFFFFFFFFFF)) | places, 1
    while 2 * length <= width:
        least = np.minimum(least[length:], least[:-length])
        length *= 2
    right, count = width - length, len(values) - width + 1
    return (np.minimum(least[:count], least[right : right + count]) & np.uint64(LOW_BITS - 1)).astype(np.int64)


class Anchors:
    """Anchors of a text: ``at`` their places, ``low`` and ``high`` the first and last window of each."""

    def __init__(self, codes: np.ndarray, size: int, gram: int):
        self.size, self.runs = size, Runs(codes)
        of_window = least_places(self.runs.every(gram), size - gram + 1)
        ends = np.flatnonzero(of_window[1:] != of_window[:-1])
        self.low = np.concatenate(([0], ends + 1))
        self.high = np.concatenate((ends, [len(of_window) - 1]))
        self.at = of_window[self.low]
        self.hashes = mixed(self.runs.at(self.at, gram))

    def contexts(self) -> np.ndarray:
        """Hash of all words of an anchor's windows, and of where the anchor lies in them."""
        with np.errstate(over="ignore"):
            shape = (self.high - self.low).astype(np.uint64) * np.uint64(1 << 32) + (self.at - self.low).astype(np.uint64)
            first, last = self.runs.at(self.low, self.size), self.runs.at(self.high, self.size)
            return mixed(first + mixed(last + mixed(shape)))


def places_of(k1: int, at: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(at.astype(np.uint64)) + np.uint64(k1 & 0xFFFFFFFFFFFFFFFF))


class Once:
    """Keys a task meets for the first time, as far as it remembers."""

    def __init__(self):
        self.seen: set = set()

    def new(self, key) -> bool:
        if key in self.seen:
            return False
        if len(self.seen) >= REMEMBERED_TEXTS:
            self.seen.clear()
        self.seen.add(key)
        return True


def winnowed(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """FOUND: each anchor of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Once()
        names = [c.split()[0] for c in FOUND.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for text, k1 in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if not once.new(k1):
                    continue
                codes = word_codes(text.as_py())
                if len(codes) >= size:
                    found = Anchors(codes, size, gram)
                    key = np.full(len(found.at), k1, np.int64)
                    rows.append((found.hashes, found.contexts(), key, places_of(k1, found.at), found.at))
            if rows:
                h, c, k, p, a = (np.concatenate(x) for x in zip(*rows, strict=True))
                columns = [signed(h), signed(c), k, signed(p), a.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return keyed(docs).select("text", "k1").mapInArrow(run, FOUND)


def shared_anchors(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """The anchors found at two or more places: the join of the texts on their winnowed anchors.

    The counts are reduced before the shuffle; an anchor that a third of the texts share only makes one side of the
    semi join larger, which can be split.
    """
    found = winnowed(docs, size, gram)
    again = (
        found.groupBy("hash")
        .agg(F.min("place").alias("a"), F.max("place").alias("b"))
        .where("a <> b")
        .select("hash")
    )
    return found.select("hash", "context", "k1", "position").join(again, "hash", "left_semi")


def removed_passages(docs: DataFrame, found: DataFrame, size: int, gram: int) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (start, end in words) and kept (the words left over).

    ``found`` (hash, context, k1, position) has all anchors that occur at two places or more.
    """
    found = stage(found.distinct(), "anchors")
    mixed_up = stage(
        found.groupBy("hash").agg((F.min("context") != F.max("context")).alias("differs")).where("differs").select("hash"),
        "anchors",
    )
    flagged = found.join(small(mixed_up.withColumn("compare", F.lit(True))), "hash", "left")
    by_text = stage(
        flagged.groupBy("k1").agg(
            F.collect_list(F.struct("position", F.coalesce("compare", F.lit(False)).alias("compare"))).alias("anchors")
        ),
        "anchors",
    )
    rows = keyed(docs)
    wanted = rows.join(small(by_text.select("k1")), "k1", "left_semi")
    texts = wanted.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = stage(texts.join(by_text, "k1"), "texts")
    parts = stage(texts.mapInArrow(_parts(size, gram), PARTS), "parts")

    compared = parts.where("h1 is not null").withColumn("place", F.xxhash64("k1", "k2", "start"))
    again = (
        compared.groupBy("h1", "h2")
        .agg(F.min("place").alias("a"), F.max("place").alias("b"))
        .where("a <> b")
        .select("h1", "h2")
    )
    runs = parts.where("h1 is null").select("k1", "k2", "start", "stop").unionByName(
        compared.join(again, ["h1", "h2"], "left_semi").select("k1", "k2", "start", "stop")
    )
    by_text = runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    cut = texts.select("k1", "k2", "text").join(by_text, ["k1", "k2"])
    kinds = "k1 long, k2 long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
    cut = stage(cut.mapInArrow(_cut(size), kinds), "cut")

    copies = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    whole = rows.select("doc_id", "text", "k1", "k2").mapInArrow(
        _whole, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, kept_sha256 string, k1 long, k2 long"
    )
    results = cut.select(
        "k1", "k2", "n_removed", "spans", F.sha2(F.col("kept").cast("binary"), 256).alias("cut_sha256")
    )
    known = results.join(copies, ["k1", "k2"], "full")
    known = stage(known, "known")
    joined = whole.join(known, ["k1", "k2"], "left")
    all_gone = (F.col("copies") > 1) & (F.col("n_words") >= size)
    none = F.array().cast("array<struct<start:int,end:int>>")
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return joined.select(
        "doc_id",
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, everything).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("cut_sha256", "kept_sha256"))
        .alias("kept_sha256"),
    )


def expanded(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, ends included."""
    counts = high - low + 1
    offsets = np.cumsum(counts) - counts
    return np.repeat(low - offsets, counts) + np.arange(int(counts.sum()))


def listed(column: pa.ListArray, row: int) -> list[np.ndarray]:
    """The fields of the structs in one list of a column of lists."""
    start, stop = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    return [f.slice(start, stop - start).to_numpy(zero_copy_only=False) for f in column.values.flatten()]


def _parts(size: int, gram: int):
    """PARTS of each text: runs of windows known to be repeated, and windows to be compared."""
    names = [c.split()[0] for c in PARTS.split(", ")]

    def part(text: bytes, k1: int, k2: int, places: np.ndarray, compare: np.ndarray) -> tuple | None:
        codes = word_codes(text)
        if len(codes) < size:
            return None
        every = Anchors(codes, size, gram)
        second = Runs(mixed(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        slot = np.minimum(np.searchsorted(every.at, places), len(every.at) - 1)
        same = every.at[slot] == places  # another text with this k1 has anchors of its own
        whole, single = slot[same & ~compare], slot[same & compare]
        low, high = every.low[whole], every.high[whole]
        starts = expanded(every.low[single], every.high[single])
        count = len(low) + len(starts)
        keys = np.full(count, k1, np.int64), np.full(count, k2, np.int64)
        ends = np.concatenate((low, starts)), np.concatenate((high, starts))
        hashes = (signed(mixed(r.at(starts, size))) for r in (every.runs, second))
        nothing = np.zeros(len(low), np.int64)
        is_run = np.arange(count) < len(low)
        return *keys, *ends, *(np.concatenate((nothing, h)) for h in hashes), is_run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for first in range(0, batch.num_rows, 64):
                rows = range(first, min(first + 64, batch.num_rows))
                found = [
                    part(batch.column("text")[r].as_py(), k1[r], k2[r], *listed(batch.column("anchors"), r)) for r in rows
                ]
                if found := [f for f in found if f is not None]:
                    *columns, is_run = (np.concatenate(c) for c in zip(*found, strict=True))
                    ends = [c.astype(np.int32) for c in columns[2:4]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (*columns[:2], *ends)] + [pa.array(c, mask=is_run) for c in columns[4:]],
                        names=names,
                    )

    return run


def covered(count: int, first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Which of ``count`` words lie in the windows that start in the runs."""
    edges = np.bincount(first, minlength=count + 1) - np.bincount(last + size, minlength=count + 1)
    return np.cumsum(edges[:count]) > 0


def _cut(size: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[int, list[dict], str]:
        words = text.split()
        gone = covered(len(words), first, last, size)
        turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])))).tolist()
        ends = [0, *turns, len(words)]
        kept = [w for a, b in zip(ends[::2], ends[1::2], strict=True) for w in words[a:b]]
        spans = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2], strict=True)]
        return len(words) - len(kept), spans, b" ".join(kept).decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = range(batch.num_rows)
            out = [cut(batch.column("text")[r].as_py(), *listed(batch.column("runs"), r)) for r in rows]
            removed, spans, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"),
                    batch.column("k2"),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, span),
                    pa.array(kept, pa.string()),
                ],
                names=["k1", "k2", "n_removed", "spans", "kept"],
            )

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py().split() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in texts], pa.string()),
                batch.column(2),
                batch.column(3),
            ],
            names=["doc_id", "n_words", "kept_sha256", "k1", "k2"],
        )


def seed_and_extend(docs: DataFrame, size: int = 35, gram: int = 8) -> DataFrame:
    """Remove each word that a repeated window of ``size`` words covers; seeds are winnowed anchors.

    One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, spans (start and end, in words, of what
    goes), kept_sha256 (of the words left over, joined by one space). Windows are judged on the input, copies within
    one text count, and all copies go, the first included. A null text has no words, texts under ``size`` words keep
    all of them. Repeated rows are copies of each other, whatever their doc_id, which may be null. An empty table gives
    no rows. Other columns are not read.
    """
    return removed_passages(docs, shared_anchors(docs, size, gram), size, gram)
