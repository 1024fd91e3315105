"""Column expressions for text and label clean-up. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every code point that counts as white space when text is stripped.
WHITESPACE = "".join(
    chr(c)
    for c in (
        0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
        0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Accepted spellings of the two labels, compared after strip and lower.
GENERATED_WORDS = ("1", "true", "generated", "ai", "llm", "machine")
HUMAN_WORDS = ("0", "false", "human", "student", "real")

# A decimal literal. Guards the cast: Spark also reads '1d' and 'Infinity' as doubles.
NUMBER_RE = r"^[+-]?(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?$"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends; only the ends are scanned."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    return strip(F.coalesce(text.cast("string"), F.lit("")))


def clean_metadata(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def not_blank(text: Column) -> Column:
    return F.length(text) > 0


def text_digest(text: Column) -> Column:
    return F.md5(text)


def parse_label(label: Column, data_type: T.DataType) -> Column:
    """0 / 1, or NULL where the value is no binary label. Fractions truncate toward zero."""
    if isinstance(data_type, T.StringType):
        word = F.lower(strip(label))
        number = F.when(word.rlike(NUMBER_RE), F.replace(word, F.lit("_"), F.lit(""))).try_cast(
            "double"
        )
        return (
            F.when(word.isin(*GENERATED_WORDS), F.lit(1))
            .when(word.isin(*HUMAN_WORDS), F.lit(0))
            .otherwise(_truncate_to_bit(number))
        )
    if isinstance(data_type, T.BooleanType):
        return label.cast("int")
    if isinstance(data_type, T.NumericType):
        return _truncate_to_bit(label)
    return F.lit(None).cast("int")


def _truncate_to_bit(number: Column) -> Column:
    return F.when((number > -1) & (number < 2), number.try_cast("int"))


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))
