from labelloom.functions.chars import char_counts, encode_chars, vocabulary, vocabulary_size
from labelloom.functions.text import (
    clean_metadata,
    clean_text,
    not_blank,
    parse_label,
    ratio_or_zero,
    sigmoid,
    strip,
    text_digest,
)

__all__ = [
    "char_counts",
    "clean_metadata",
    "clean_text",
    "encode_chars",
    "not_blank",
    "parse_label",
    "ratio_or_zero",
    "sigmoid",
    "strip",
    "text_digest",
    "vocabulary",
    "vocabulary_size",
]
