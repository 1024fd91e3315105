"""Which input column holds the text and which the label."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted column names, first match wins; names are case-sensitive.
TEXT_COLUMNS = ("text", "essay", "full_text", "content", "abstract")
LABEL_COLUMNS = ("generated", "label", "target", "is_generated")
# Metadata columns carried through normalisation, and the output columns.
METADATA_COLUMNS = (
    "prompt_name",
    "prompt",
    "source",
    "model",
    "source_dataset",
    "source_detail",
    "source_license",
    "upstream_url",
    "source_split",
)
STANDARD_COLUMNS = (
    "text",
    "label",
    "source_dataset",
    "source_detail",
    "source_license",
    "upstream_url",
)


def exact(name: str) -> Column:
    return F.col(f"`{name}`")


def first_present(available: Iterable[str], candidates: Sequence[str], kind: str) -> str:
    names = set(available)
    match = next((name for name in candidates if name in names), None)
    if match is None:
        raise ValueError(f"no {kind} column among {sorted(names)}; looked for {list(candidates)}")
    return match


def text_column(df: DataFrame) -> str:
    return first_present(df.columns, TEXT_COLUMNS, "text")


def label_column(df: DataFrame) -> str:
    return first_present(df.columns, LABEL_COLUMNS, "label")


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def pick_from_map(row: Column, candidates: Sequence[str]) -> Column:
    """The value under the first candidate key a row's map holds, NULL if it holds none.

    For rows whose fields differ from row to row: presence of the key decides, not its value.
    """
    picked = F.lit(None).cast("string")
    for name in reversed(candidates):
        picked = F.when(F.map_contains_key(row, name), F.try_element_at(row, F.lit(name))).otherwise(
            picked
        )
    return picked
