"""Character features: a fixed alphabet, ids per character, and its vocabulary table."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAD_ID = 0
UNKNOWN_ID = 1
# The alphabet in id order; ids start after pad and unknown.
ALPHABET = string.ascii_lowercase + string.digits + string.punctuation + " \n\t"
DEFAULT_MAX_LENGTH = 2048


def vocabulary_size(alphabet: str = ALPHABET) -> int:
    return len(alphabet) + 2


def _ids_by_code_point(alphabet: str) -> list[int]:
    table = [UNKNOWN_ID] * (max(map(ord, alphabet)) + 1)
    for position, char in enumerate(alphabet):
        table[ord(char)] = position + 2
    return table


def encode_chars(
    text: Column, max_length: int = DEFAULT_MAX_LENGTH, alphabet: str = ALPHABET
) -> Column:
    """Lower-case, cut to ``max_length`` characters, map to ids, pad on the right.

    The id is an array access by code point, so the cost per character does not grow
    with the alphabet. An empty text yields padding only.
    """
    table = F.lit(_ids_by_code_point(alphabet))
    head = F.substring(F.lower(text), 1, max_length)
    chars = F.filter(F.split(head, ""), lambda c: c != "")
    ids = F.transform(chars, lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(UNKNOWN_ID)))
    padding = F.array_repeat(F.lit(PAD_ID), F.lit(max_length) - F.size(ids))
    return F.concat(ids, padding)


def vocabulary(spark: SparkSession, alphabet: str = ALPHABET) -> DataFrame:
    rows = [(char, position + 2) for position, char in enumerate(alphabet)]
    return spark.createDataFrame(rows, "char string, id int")


def char_counts(df: DataFrame, text: str = "text", alphabet: str = ALPHABET) -> DataFrame:
    """How often each id occurs over the whole texts, unknown characters included."""
    table = F.lit(_ids_by_code_point(alphabet))
    chars = df.select(F.explode(F.split(F.lower(F.col(text)), "")).alias("char")).where(
        F.col("char") != ""
    )
    char_id = F.coalesce(F.get(table, F.ascii("char")), F.lit(UNKNOWN_ID))
    return chars.groupBy(char_id.alias("id")).agg(F.count(F.lit(1)).alias("occurrences"))
