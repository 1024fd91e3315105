"""Spelling variants: words one letter apart, found by PartEnum signatures, and the common form of each rare spelling.

The letters of a word are a binary vector with a place for the first, second, ... occurrence of each letter. Words that differ
by one letter have vectors with a Hamming distance of two at most. The places are dealt over PARTS parts; as two places fall
into two parts at most, such words agree in all the others. So each way to leave out two parts is enumerated, and what is
left is an exact signature: near words share at least one of them.

Letters alone don't tell words of the same syllables apart. One letter also leaves the first or the second half of a word
unchanged, so a signature carries the half it was made for. Words meet in an equi-join on (length, half, signature) and are
verified there, before a pair leaves the join.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import text_bytes
from labelloom.session import stage

MIN_LETTERS = 7
MIN_COUNT = 2
#: A form occurs at least so many times as often as its variant.
TIMES = 10
#: One run of letters in so many loses a letter.
ONE_IN = 31
#: Hamming distance of the letters of two near words, and parts over which the places of a vector are dealt.
DISTANCE = 2
PARTS = 4
#: Words that a task counts before it hands them on.
COUNTED_AT_ONCE = 200_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all texts: lower-cased runs of letters, with a letter deleted from those that the digest of row and run
    picks. Each task adds up what it reads before the shuffle; its memory is bounded by COUNTED_AT_ONCE words."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}").findall

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for number, text in zip(batch.column(0), batch.column(1), strict=True):
                seed = zlib.crc32(number.as_py())
                found = runs(text.as_py().translate(LOWER).decode())
                for word, n in Counter(found).items():
                    digest = zlib.crc32(word.encode(), seed)
                    if not digest % ONE_IN:
                        at = digest % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= min_letters:
                        counts[word] += n
                if len(counts) > COUNTED_AT_ONCE:
                    yield counted()
                    counts.clear()
        yield counted()

    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).cast("binary")
    counted = docs.select(row.alias("row"), text_bytes().alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_parts(word: str) -> list[str]:
    """The occurrences of the letters of a word, dealt over the parts by letter and occurrence."""
    parts, seen = [[] for _ in range(PARTS)], Counter()
    for letter in sorted(word):
        parts[(ord(letter) * 7 + seen[letter] * 3) % PARTS].append(letter)
        seen[letter] += 1
    return ["".join(p) for p in parts]


def signatures(word: str) -> list[str]:
    """Every way to leave out DISTANCE parts. Two words whose letters differ in DISTANCE places at most share one."""
    parts = letter_parts(word)
    return [f"{k}:" + "|".join(kept) for k, kept in enumerate(combinations(parts, PARTS - DISTANCE))]


def halves(word: str, length: int) -> tuple[str, str]:
    """What a word has in common with a near one, if the shorter of both has ``length`` letters: its beginning, if they
    differ behind the middle, or its end."""
    middle = length // 2
    return "<" + word[:middle], ">" + word[len(word) - (length - middle) :]


def signed_rows(words: DataFrame) -> DataFrame:
    """(key, role, word, n): a word stands once as the shorter (or equally long) of two, once as the longer (role 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            keys = []
            for word in batch.column(0).to_pylist():
                own = signatures(word)
                for role in (0, 1):
                    length = len(word) - role
                    for half in halves(word, length):
                        keys += [digest(f"{length}{half} {s}") for s in own]
            each = len(keys) // max(batch.num_rows, 1)
            place = np.repeat(np.arange(batch.num_rows), each)
            roles = np.tile(np.repeat(np.array([0, 1], np.int32), each // 2), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(roles),
                    batch.column(0).take(pa.array(place)),
                    batch.column(1).take(pa.array(place)),
                ],
                names=["key", "role", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(run, "key long, role int, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of each pair of words one insertion, deletion or replacement apart.

    The join is verified pair by pair as it runs; what leaves it are true pairs, each up to a few times, which are then
    merged. A key holds the words that agree in length, half and signature.
    """
    rows = stage(signed_rows(words), "signatures")
    first, second = rows.where("role = 0").alias("a"), rows.alias("b")
    once = (F.col("b.role") == 1) | (F.col("a.word") < F.col("b.word"))  # equally long words meet in both orders
    one_apart = F.levenshtein("a.word", "b.word", 1) == 1
    met = first.join(second, (F.col("a.key") == F.col("b.key")) & once & one_apart)
    pairs = met.select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    ).distinct()
    return pairs.select(
        F.explode(
            F.array(
                F.struct("word", "n", "near", "near_n"),
                F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
            )
        ).alias("pair")
    ).select("pair.*")


def best(name: str, count: str) -> Column:
    """The most frequent, and of these the first in the order of code points (which is that of UTF-8 bytes)."""
    return F.min(F.struct((-F.col(count)).alias("less"), F.col(name).alias("name")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form). A form is at least TIMES as frequent as its word, so forms end; each round
    doubles the steps taken, and the counts of a corpus allow a few rounds only."""
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_groups(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of each word of ``docs`` (doc_id, text).

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased. Where ONE_IN divides the CRC-32 of
    ``<doc_id>:<run>``, the run loses the letter that its digest names. Counted are words of ``min_letters`` letters and
    ``min_count`` occurrences or more. n_near: words that differ by exactly one inserted, deleted or replaced letter. form: the
    most frequent of them (ties: the first by code points) if it occurs TIMES as often, else null; root: the end of the
    chain of forms, the word itself if it has none.

    A null text has no words; a null doc_id counts as an empty one. Repeated rows count each. Long texts are read whole.
    An empty table gives no rows; other columns are not read.
    """
    words = stage(word_counts(docs, min_letters, min_count), "words")
    judged = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best("near", "near_n").alias("best"))
    judged = stage(judged.select("word", "n", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.name").alias("form")), "near")
    frequent = F.col("form_n") >= F.col("n") * TIMES
    forms = judged.where(frequent).select("word", "form", "form_n")
    named = forms.join(roots(forms), "word")
    return (
        words.join(judged.select("word", "n_near"), "word", "left")
        .join(named, "word", "left")
        .select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    )
