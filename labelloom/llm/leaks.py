"""Benchmark decontamination: windows of documents within a word edit distance of a benchmark item.

The CGK embedding walks over a word sequence, staying at a word or going on as a random bit of (step, word) says, and
writes the word at each step. Sequences a few edits apart fall into step again soon, so their embeddings have a small
Hamming distance. Sampling some places of the embedding gives a key that near sequences often share; enough repetitions
of walk and sample reach the target recall. Windows of a document that share a key with an item of their size are
verified by the exact edit distance.

Before that, a window is left out if it can't be near: k edits of an item of n words touch 2 * k of its n - 1 pairs of
neighbours at most, so a near window has n - 1 - 2 * k pairs of items of that size. Pairs of equal words are not counted
on either side, as a stuttering text has any number of them. Where no pair is left to ask for, a window needs n - k words
of items of that size instead. Sizes for which the repetitions don't reach the target recall do without keys: all windows
that are left are verified.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import mixed, small, text_key
from labelloom.session import stage

#: Edits allowed per word of an item.
EDITS = 0.2
#: Items that one pass over the documents looks for.
BLOCK_ITEMS = 5_000
#: Places of an embedding that make a key; share of near windows that some key must find; bound of the repetitions.
SAMPLED, RECALL, MOST_REPEATS = 4, 0.99, 128
#: Edited copies of items of a size that the number of repetitions is set by; it is doubled for safety.
TRIALS = 128
#: Words of documents that are looked at in one go.
BATCH_WORDS = 200_000
SEED = 20_240_501
WORD = re.compile(r"\w+")
FOUND = "text_key long, item_id long, item_words int, start int, distance int"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def edits_allowed(words: int) -> int:
    return math.floor(words * EDITS)


def code_of(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


class Walks:
    """``repeats`` random walks of sequences of ``size`` words, each with its sampled steps."""

    def __init__(self, size: int, repeats: int):
        rng = np.random.default_rng((SEED, size))
        self.size, self.repeats, self.length = size, repeats, 2 * size
        self.seeds = rng.integers(0, 1 << 64, (repeats, self.length), dtype=np.uint64)
        self.steps = rng.integers(0, self.length, (repeats, SAMPLED))

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """(windows, repeats) keys of rows of word codes; shorter sequences are filled up with 0."""
        count = len(windows)
        padded = np.concatenate((windows, np.zeros((count, 1), np.uint64)), axis=1)
        row, rep = np.arange(count)[:, None], np.arange(self.repeats)[None, :]
        at = np.zeros((count, self.repeats), np.int64)
        symbols = np.zeros((count, self.repeats, SAMPLED), np.uint64)
        for step in range(int(self.steps.max()) + 1):
            symbol = padded[row, at]
            for k in range(SAMPLED):
                hit = np.flatnonzero(self.steps[:, k] == step)
                symbols[:, hit, k] = symbol[:, hit]
            moves = mixed(symbol ^ self.seeds[rep, step]) & np.uint64(1)
            at = np.minimum(at + moves.astype(np.int64), self.size)
        key = np.broadcast_to(np.arange(self.repeats, dtype=np.uint64), (count, self.repeats))
        with np.errstate(over="ignore"):
            for k in range(SAMPLED):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + symbols[:, :, k])
        return key


def edited(codes: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A window of the same size after so many random edits of one word each."""
    words = codes.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(len(words))), int(rng.integers(3))
        new = int(rng.integers(1, 1 << 63))
        if kind == 0:
            words[at] = new
        elif kind == 1:
            words.insert(at, new)
        else:
            words.pop(at)
    words = (words + rng.integers(1, 1 << 63, max(edits, 1)).tolist())[: len(codes)]
    return np.array(words, np.uint64)


def repeats_needed(size: int, items: np.ndarray) -> int | None:
    """Twice the repetitions with which RECALL of TRIALS items of a size, edited up to the limit, share a key; None if
    MOST_REPEATS are not enough."""
    rng, most = np.random.default_rng((SEED, size, 1)), edits_allowed(size)
    pairs = [(c, edited(c, most, rng)) for c in (items[k % len(items)] for k in range(TRIALS))]
    pairs = [(a, b) for a, b in pairs if distance(a.tolist(), b.tolist(), most) is not None]
    if not pairs:
        return None
    walks = Walks(size, MOST_REPEATS)
    same = walks.keys(np.array([a for a, _ in pairs])) == walks.keys(np.array([b for _, b in pairs]))
    enough = np.flatnonzero(np.maximum.accumulate(same, axis=1).mean(axis=0) >= RECALL)
    return 2 * (int(enough[0]) + 1) if len(enough) else None


def distance(a: list, b: list, most: int) -> int | None:
    """Edit distance of two sequences if it is ``most`` at most."""
    if abs(len(a) - len(b)) > most:
        return None
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(low, high + 1):
            best = row[j - 1] if x == b[j - 1] else min(row[j - 1], row[j], new[j - 1]) + 1
            new[j] = best if best < far else far
        row = new
        if min(row[low - 1 : high + 1]) >= far:
            return None
    return row[-1] if row[-1] <= most else None


@dataclass
class SizeClass:
    size: int
    items: list[tuple[int, list[int]]]
    walks: Walks | None  # None: all windows are verified
    keys: np.ndarray | None
    owners: np.ndarray | None
    doubled: int  # pairs of equal words in an item at most; they are not counted
    bags: list[Counter]
    numbers: np.ndarray  # of the words of the items

    @classmethod
    def of(cls, size: int, items: list[tuple[int, list[int]]], numbers: np.ndarray) -> SizeClass:
        codes = np.array([c for _, c in items], np.uint64)
        doubled = int((codes[:, 1:] == codes[:, :-1]).sum(axis=1).max())
        repeats = repeats_needed(size, codes)
        if repeats is None:
            return cls(size, items, None, None, None, doubled, [Counter(c) for _, c in items], numbers)
        walks = Walks(size, repeats)
        flat = walks.keys(codes).ravel()
        order = np.argsort(flat, kind="stable")
        owners = np.repeat(np.arange(len(items)), walks.repeats)[order]
        return cls(size, items, walks, flat[order], owners, doubled, [], numbers)

    def pairs_needed(self) -> int:
        """Pairs of neighbours that a near window has at least; with none, words are asked for instead."""
        return self.size - 1 - self.doubled - 2 * edits_allowed(self.size)

    def sharing_words(self, windows: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
        """(window, place of item) of all that have enough words in common to be near."""
        least, found = self.size - edits_allowed(self.size), []
        for row, (window, length) in enumerate(zip(windows.tolist(), lengths.tolist(), strict=True)):
            bag = Counter(window[:length])
            found.extend((row, k) for k, other in enumerate(self.bags) if (bag & other).total() >= least)
        return found

    def matches(self, windows: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of the windows near an item."""
        most = edits_allowed(self.size)
        for start in range(0, len(windows), 512):
            if self.walks is None:
                pairs = self.sharing_words(windows[start : start + 512], lengths[start : start + 512])
            else:
                keys = self.walks.keys(windows[start : start + 512])
                low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
                pairs = set()
                for row, col in zip(*np.nonzero(high > low), strict=True):
                    pairs.update((int(row), int(o)) for o in self.owners[low[row, col] : high[row, col]])
            for row, owner in sorted(pairs):
                item, codes = self.items[owner]
                window = windows[start + row, : lengths[start + row]].tolist()
                if (found := distance(window, codes, most)) is not None:
                    yield start + row, item, found


class Matcher:
    """Looks for a block of items. Each pair of words that are neighbours in an item has a bit for each of up to 64
    sizes of items."""

    def __init__(self, items: list[tuple[int, str]]):
        by_size = defaultdict(list)
        for item_id, text in items:
            if words := words_of(text):
                by_size[len(words)].append((item_id, words))
        self.numbers: dict[str, int] = {}
        for _, words in (i for items in by_size.values() for i in items):
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        sizes = sorted(by_size)
        self.rounds = []
        for start in range(0, len(sizes), 64):
            classes, masks = [], defaultdict(int)
            for bit, size in enumerate(sizes[start : start + 64]):
                own = np.array(sorted({self.numbers[w] for _, ws in by_size[size] for w in ws}), np.int64)
                classes.append(SizeClass.of(size, [(i, [code_of(w) for w in ws]) for i, ws in by_size[size]], own))
                for _, ws in by_size[size]:
                    for a, b in zip(ws, ws[1:], strict=False):
                        if a != b:
                            masks[self.pair(self.numbers[a], self.numbers[b])] |= 1 << bit
            pairs = np.array(sorted(masks), np.int64)
            self.rounds.append((classes, pairs, np.array([masks[p] for p in pairs.tolist()], np.uint64)))

    def pair(self, left, right):
        return left * (len(self.numbers) + 1) + right

    def find(self, texts: list[list[str]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, item words, start, distance) of each near window."""
        flat = [w for t in texts for w in t]
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        number = np.fromiter((self.numbers.get(w, 0) for w in flat), np.int64, len(flat))
        known = np.flatnonzero((number[:-1] > 0) & (number[1:] > 0))
        known = known[~np.isin(known, ends - 1)]
        pairs_here = self.pair(number[known], number[known + 1])
        for classes, pairs, masks in self.rounds:
            at, mask = known[:0], masks[:0]
            if len(pairs):
                slot = np.minimum(np.searchsorted(pairs, pairs_here), len(pairs) - 1)
                hit = pairs[slot] == pairs_here
                at, mask = known[hit], masks[slot[hit]]
            for bit, kind in enumerate(classes):
                if (need := kind.pairs_needed()) > 0:
                    own = at[(mask >> np.uint64(bit)) & np.uint64(1) == 1]
                    yield from self.near(kind, own, 2, need, flat, starts, ends)
                else:
                    own, need = np.flatnonzero(np.isin(number, kind.numbers)), kind.size - edits_allowed(kind.size)
                    yield from self.near(kind, own, 1, need, flat, starts, ends)

    def near(
        self, kind: SizeClass, at: np.ndarray, wide: int, need: int, flat: list[str], starts: np.ndarray, ends: np.ndarray
    ):
        """Of the windows with ``need`` or more of the pairs or words (``wide`` 2 or 1) at the places ``at``, those near
        an item."""
        if len(at) < need:
            return
        left, right = at[: len(at) - need + 1], at[need - 1 :]
        dense = right - left <= kind.size - wide
        firsts = [np.arange(r - kind.size + wide, p + 1) for p, r in zip(left[dense], right[dense], strict=True)]
        if not firsts:
            return
        text = np.repeat(np.searchsorted(ends, left[dense], "right"), [len(f) for f in firsts])
        first = np.concatenate(firsts)
        # windows end with their text; a shorter text is one window
        first = np.maximum(np.minimum(first, ends[text] - kind.size), starts[text])
        first, once = np.unique(first, return_index=True)
        text = text[once]
        sizes = np.minimum(kind.size, ends[text] - first)
        windows = np.zeros((len(first), kind.size), np.uint64)
        for k, (a, n) in enumerate(zip(first.tolist(), sizes.tolist(), strict=True)):
            windows[k, :n] = [code_of(w) for w in flat[a : a + n]]
        for k, item, edits in kind.matches(windows, sizes):
            yield int(text[k]), item, kind.size, int(first[k] - starts[text[k]]), edits


def leaking_windows(docs: DataFrame, matcher: Matcher) -> DataFrame:
    """(doc_id, FOUND) of the windows near one of the matcher's items, of which there are BLOCK_ITEMS or so."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, count = [], 0
            for row in range(batch.num_rows):
                held.append(words_of(batch.column(1)[row].as_py()))
                count += len(held[-1])
                if count < BATCH_WORDS and row + 1 < batch.num_rows:
                    continue
                first = row + 1 - len(held)
                found = list(matcher.find(held))
                held, count = [], 0
                if found:
                    text, item, size, start, edits = zip(*found, strict=True)
                    rows = pa.array([first + t for t in text])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(2).take(rows),
                            pa.array(item, pa.int64()),
                            *(pa.array(c, pa.int32()) for c in (size, start, edits)),
                        ],
                        names=["doc_id", *(c.split()[0] for c in FOUND.split(", "))],
                    )

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), text_key("text").alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, {FOUND}"
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it has: doc_id, text_key, item_id, item_words, start and distance of the
    nearest window (the first among equals), and n_windows.

    A document has an item of n words if the edit distance, in words, between the item and some window of n of its
    words (or all of its words, if it has fewer) is n * EDITS or less. Words are lower-cased runs of letters, digits and
    underscores. Found with a recall of RECALL at the limit, and surely if equal or where all windows are verified.
    Items of under five words have to be equal; null ones and others without words are not looked for. Null and empty texts have nothing; equal rows are one document, rows with
    one doc_id and different texts are told apart by text_key. Items are taken in blocks, each in one pass over the
    documents, without a shuffle but that of the results. Empty tables give no rows. Other columns are not read.
    """
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-asked.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for number in range(blocks):
        items = [(r.item_id, r.text) for r in asked.where(block == number).orderBy("item_id", "text").collect()]
        windows = leaking_windows(docs, Matcher(items))
        found = windows if found is None else found.unionByName(windows)
    nearest = F.min(F.struct("distance", "start")).alias("nearest")
    return (
        found.groupBy("doc_id", "text_key", "item_id", "item_words")
        .agg(nearest, F.count(F.lit(1)).alias("n_windows"))
        .select("doc_id", "text_key", "item_id", "item_words", "nearest.start", "nearest.distance", "n_windows")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have no benchmark item, with all their columns."""
    found = stage(leaks(docs, benchmark).select("doc_id", "text_key").distinct(), "leaks")
    found = small(found.select(F.col("doc_id").alias("id"), "text_key"))
    row = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (text_key("row.text") == F.col("text_key"))
    clean = row.join(found, same, "left_anti")
    return clean.select("row.*")
