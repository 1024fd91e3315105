"""Helpers shared by the operators: words, rolling hashes, joins of checked size, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import stage

#: A table is broadcast up to this many rows of a few fixed-width columns; beyond it, it is shuffled.
BROADCAST_ROWS = 200_000
#: Bytes of a text that are hashed in one go.
PIECE = 1 << 20
SPACES = tuple(bytes([c]) for c in b" \t\n\x0b\x0c\r")
IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))

BASE = 0x9E3779B97F4A7C15
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str | Column = "text") -> Column:
    """A text as UTF-8 bytes, null as no bytes. ``bytes.split()`` cuts these exactly at x20 and x09-x0D."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread polynomial hashes over all bits (splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * MIX[0]
    values = (values ^ (values >> np.uint64(27))) * MIX[1]
    return values ^ (values >> np.uint64(31))


def text_key(column: str) -> Column:
    """A number for a text, by which rows that share a doc_id are told apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(cls.up):
            size = 1 << count.bit_length()
            with np.errstate(over="ignore"):
                for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                    powers = np.full(size, base, np.uint64)
                    powers[0] = 1
                    setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up[:count], cls.down[:count]


def word_codes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (bytes between x20 and x09-x0D) of a text. All words of a piece of text are hashed at
    once, from differences of one running sum over its bytes."""
    codes, start = [], 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):  # cut behind a space, so that no word is cut
            cut = max(text.rfind(c, start, stop) for c in SPACES)
            if cut < 0:
                cut = min((k for c in SPACES if (k := text.find(c, stop)) >= 0), default=len(text))
            stop = cut + 1
        codes.append(_codes(text[start:stop]))
        start = stop
    return np.concatenate(codes) if len(codes) > 1 else codes[0] if codes else np.empty(0, np.uint64)


def _codes(piece: bytes) -> np.ndarray:
    raw = np.frombuffer(piece, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[raw]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = turns[::2], turns[1::2]
    up, down = Powers.of(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return mixed((sums[end] - sums[first]) * down[first])


class Runs:
    """Hashes of runs of codes, each from the difference of two running sums."""

    def __init__(self, codes: np.ndarray):
        self.count = len(codes)
        up, self.down = Powers.of(self.count + 1)
        self.sums = np.zeros(self.count + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(codes * up[:-1], out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """Of all runs of ``size`` codes, in order."""
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:-size]) * self.down[: max(0, self.count - size + 1)]

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[starts + size] - self.sums[starts]) * self.down[starts]


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` codes."""
    return mixed(Runs(codes).every(size)) if len(codes) >= size else np.empty(0, np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint, if ``df`` (a staged, narrow table) is checked to be small; else ``df`` as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b): the least node that links reach.

    Labels travel along the links and along the labels themselves, so a chain of n links takes about log n rounds.
    Each round is two shuffles of narrow rows and is written to the shared folder. A hub with most of the links is
    reduced before the shuffle, and its join side can be split.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(both.where("a <> b").distinct(), "links")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        seen = edges.join(labels, edges.b == labels.node).select(F.col("a").alias("node"), "label")
        jump = labels.select("node", F.col("label").alias("via")).join(
            labels.select(F.col("node").alias("via"), "label"), "via"
        )
        best = (
            seen.unionByName(jump.select("node", "label"))
            .unionByName(labels)
            .groupBy("node")
            .agg(F.min("label").alias("label"))
        )
        changed = stage(best, "labels")
        moved = changed.join(labels.select("node", F.col("label").alias("old")), "node").where("label <> old")
        labels = changed
        if moved.isEmpty():
            return labels
