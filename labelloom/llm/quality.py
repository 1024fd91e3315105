"""Quality rules: base counts of each text, and thresholds that adapt to language and source.

The fixed cutoffs of usual quality rules are replaced by fences taken from the data. A measure of each document goes
into a quantile sketch of its (language, source) group. The sketch is a table of bucket counts with relative error
1/128 (values below 128 are exact), so sketches are merged by adding counts, give the same quantiles in any order of
merging, and have at most a few thousand rows a group however many documents there are. Small groups use the sketch of
their language, or of all documents, which are merged from the group sketches and not from the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import small, text_bytes, text_key
from labelloom.session import stage

REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_stuttered")
COUNTED = (*COUNTS, "n_lines")

#: measure, what is counted, of how many, lower fence, upper fence, least distance of a fence from the median. All are counts
#: per 10,000. Lines are those that are not blank.
MEASURES = (
    ("word_length", "word_chars", "n_words", True, True, 20_000),
    ("symbol_share", "n_symbols", "n_words", False, True, 1_000),
    ("dup_line_share", "n_dup_lines", "n_lines", False, True, 3_000),
    ("stutter_share", "n_stuttered", "n_words", False, True, 2_000),
    ("repeat_share", "n_repeat_words", "n_words", False, True, 1_000),
)
#: A fence lies so many times the spread (upper minus lower tenth) beyond its tenth.
REACH = 3
#: A group needs so many documents for thresholds of its own.
MIN_GROUP = 200


def repeated_words(words: list[bytes], size: int = REPEAT_WORDS) -> int:
    """Words inside windows of ``size`` words that occur at least twice in the text. Exact: windows of 2, 4 and 8
    words are numbered by the numbers of their halves."""
    if len(words) <= size:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    length = 1
    while length < size:
        pairs = rank[:-length] * (int(rank.max()) + 1) + rank[length:]
        values, rank = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            return 0
        length *= 2
    again = np.bincount(rank)[rank] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    raw = np.frombuffer(joined, np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum())
    symbols = sum(joined.count(s) for s in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))
    stuttered = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), stuttered, len(lines)


def with_base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, text_key, COUNTED) of each row. A null text has no words. n_stuttered: words equal to the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(4)
            counts = np.array([counts_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTED))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(counts[:, k]) for k in range(len(COUNTED)))],
                names=["doc_id", "lang", "source", "text_key", *COUNTED],
            )

    rows = docs.select("doc_id", "lang", "source", text_key("text").alias("text_key"), text_bytes().alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:4])
    return rows.mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTED))


def _measures() -> list[Column]:
    return [F.expr(f"{count} * 10000 div greatest({of}, 1)").alias(name) for name, count, of, *_ in MEASURES]


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket: its first seven binary digits."""
    shift = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketch of each group and measure, of the documents with words."""
    cells = counted.where("n_words > 0").select(
        "lang",
        "source",
        F.explode(F.array(*[F.struct(F.lit(m[0]).alias("measure"), F.col(m[0]).alias("v")) for m in MEASURES])).alias("c"),
    )
    return cells.groupBy("lang", "source", "c.measure", bucket(F.col("c.v")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sketch of each larger group: counts of equal buckets are added."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Tenth, median, ninetieth percentile and count of each sketch. A group's window holds its buckets only."""
    order = Window.partitionBy(*keys, "measure").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys, "measure")
    running = sketch.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(whole))
    at = {"low": 1, "mid": 5, "high": 9}
    return running.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") * 10 >= F.col("total") * k, F.col("bucket"))).alias(n) for n, k in at.items()],
    )


def thresholds(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, floor, ceiling) of each group; null where a side has no fence."""
    sketch = stage(sketches(counted), "sketches")
    own = quantiles(sketch, "lang", "source")
    of_lang = quantiles(merge(sketch, "lang"), "lang").select("lang", "measure", *_named("l"))
    of_all = quantiles(merge(sketch)).select("measure", *_named("a"))
    joined = (
        own.alias("o")
        .join(of_lang.alias("l"), F.expr("o.lang <=> l.lang and o.measure = l.measure"))
        .join(F.broadcast(of_all).alias("a"), F.expr("o.measure = a.measure"))  # one row a measure
    )

    def pick(name: str) -> Column:
        return (
            F.when(F.col("total") >= MIN_GROUP, F.col(name))
            .when(F.col("l_total") >= MIN_GROUP, F.col(f"l_{name}"))
            .otherwise(F.col(f"a_{name}"))
        )

    picked = joined.select("o.lang", "o.source", "o.measure", *[pick(n).alias(n) for n in ("low", "mid", "high")])
    spread = (F.col("high") - F.col("low")) * REACH
    floor, ceiling = F.lit(None).cast("long"), F.lit(None).cast("long")
    for name, _, _, lower, upper, least in MEASURES:
        if lower:
            below = F.least(F.col("low") - spread, F.col("mid") - least)
            floor = F.when(F.col("measure") == name, below).otherwise(floor)
        if upper:
            above = F.greatest(F.col("high") + spread, F.col("mid") + least)
            ceiling = F.when(F.col("measure") == name, above).otherwise(ceiling)
    return picked.select("lang", "source", "measure", floor.alias("floor"), ceiling.alias("ceiling"))


def _named(prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in ("total", "low", "mid", "high")]


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, text_key, COUNTS, base_failed, failed (names of the measures beyond their
    fence) and kept.

    base_failed: under MIN_WORDS words, or more than MAX_REPEAT_PERCENT percent of the words lie in 8-word windows
    found twice or more. kept: not base_failed, and no measure lies beyond the fence of the document's language and
    source. Null or empty texts have no words and fail. Null languages and sources form groups of their own. Repeated
    rows count each and are judged alike; ties with a fence are kept. An empty table gives no rows. Other columns are
    not read.
    """
    counted = stage(with_base_counts(docs).select("*", *_measures()), "counted")
    wide = thresholds(counted).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == m[0], F.col(s))).alias(f"{m[0]}_{s}") for m in MEASURES for s in ("floor", "ceiling")]
    )
    fences = stage(wide, "fences")
    both = counted.alias("c").join(fences.alias("t"), F.expr("c.lang <=> t.lang and c.source <=> t.source"), "left")
    broken = [
        F.when((F.col(m[0]) < F.col(f"{m[0]}_floor")) | (F.col(m[0]) > F.col(f"{m[0]}_ceiling")), F.lit(m[0]))
        for m in MEASURES
    ]
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    rows = both.select(
        "doc_id", "c.lang", "c.source", "text_key", *COUNTS, base_failed.alias("base_failed"), F.array_compact(F.array(*broken)).alias("failed")
    )
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns. The verdict belongs to the text, language and
    source of a row, so rows that share a doc_id are told apart."""
    verdicts = judged(docs.select("doc_id", "text", "lang", "source"))
    gone = verdicts.where("not kept").select("text_key", F.col("lang").alias("l"), F.col("source").alias("s")).distinct()
    row = docs.select(F.struct("*").alias("row"))
    same = (
        (text_key("row.text") == F.col("text_key"))
        & F.col("row.lang").eqNullSafe(F.col("l"))
        & F.col("row.source").eqNullSafe(F.col("s"))
    )
    return row.join(small(stage(gone, "rejected")), same, "left_anti").select("row.*")
