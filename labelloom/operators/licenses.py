"""Source licences: the permitted list, the filter and the enrichment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.columns import exact


@dataclass(frozen=True)
class PermittedSource:
    source: str
    source_dataset: str
    source_license: str
    upstream_url: str


_DATASETS = "https://www.kaggle.com/datasets/"

# Sources whose licence permits use (source, dataset, licence).
PERMITTED = tuple(
    PermittedSource(source, dataset, license_name, _DATASETS + dataset)
    for source, dataset, license_name in (
        ("chat_gpt_moth", "alejopaullier/daigt-external-dataset", "mit"),
        ("falcon_180b_v1", "nbroad/daigt-data-llama-70b-and-falcon180b", "apache-2.0"),
        ("kingki19_palm", "kingki19/llm-generated-essay-using-palm-from-google-gen-ai", "cc0-1.0"),
        ("palm-text-bison1", "kingki19/llm-generated-essay-using-palm-from-google-gen-ai", "cc0-1.0"),
        ("radek_500", "radek1/llm-generated-essays", "cc0-1.0"),
        ("radekgpt4", "radek1/llm-generated-essays", "cc0-1.0"),
    )
)

# Sources known and excluded.
EXCLUDED = (
    "persuade_corpus",
    "mistral7binstruct_v2",
    "llama2_chat",
    "mistral7binstruct_v1",
    "train_essays",
    "llama_70b_v1",
    "darragh_claude_v6",
    "darragh_claude_v7",
    "NousResearch/Llama-2-7b-chat-hf",
    "mistralai/Mistral-7B-Instruct-v0.1",
    "cohere-command",
)

ATTRIBUTES = ("source_dataset", "source_license", "upstream_url")


@dataclass(frozen=True)
class LicenseList:
    """Permitted sources with their attributes, and the names known to be excluded.

    Both are short literal lists kept by hand, which bounds the broadcast side of the
    joins below.
    """

    permitted: tuple[PermittedSource, ...] = PERMITTED
    excluded: tuple[str, ...] = EXCLUDED

    @property
    def permitted_names(self) -> list[str]:
        return [p.source for p in self.permitted]

    @property
    def mapped_names(self) -> list[str]:
        return self.permitted_names + list(self.excluded)

    def dimension(self, spark: SparkSession, source_column: str = "source") -> DataFrame:
        """The permitted sources as a table of literals."""
        rows = [
            F.struct(
                F.lit(p.source).alias(source_column),
                *[F.lit(getattr(p, name)).alias(name) for name in ATTRIBUTES],
            )
            for p in self.permitted
        ]
        return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


DEFAULT_LICENSES = LicenseList()


def _name(source_column: str) -> Column:
    """The source as a string, whatever its type."""
    return exact(source_column).cast("string")


def has_mapped_source(
    df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES, source_column: str = "source"
) -> bool:
    """Does any row name a known source? Reads one column and stops at the first hit."""
    if source_column not in df.columns:
        return False
    return not df.where(_name(source_column).isin(licenses.mapped_names)).limit(1).isEmpty()


def permitted_rows(
    df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES, source_column: str = "source"
) -> DataFrame:
    """Rows of permitted sources only; unknown and NULL sources go too."""
    return df.where(_name(source_column).isin(licenses.permitted_names))


def enrich_permitted(
    df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES, source_column: str = "source"
) -> DataFrame:
    """Filter and enrichment fused in one broadcast join with the literal dimension."""
    dimension = F.broadcast(licenses.dimension(df.sparkSession, source_column))
    plain = df.drop(*ATTRIBUTES, "source_detail").withColumn(source_column, _name(source_column))
    joined = plain.join(dimension, source_column, "inner")
    return joined.select(
        *plain.columns, F.col(source_column).cast("string").alias("source_detail"), *ATTRIBUTES
    )


def filter_permitted(
    df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES, source_column: str = "source"
) -> tuple[DataFrame, bool]:
    """Apply the licence list if the table names any known source; else pass it through."""
    if not has_mapped_source(df, licenses, source_column):
        return df, False
    return enrich_permitted(df, licenses, source_column), True


def source_counts(
    df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES, source_column: str = "source"
) -> DataFrame:
    """Rows per source and whether the source is kept; NULL sources count under ''."""
    source = F.coalesce(_name(source_column), F.lit(""))
    permitted = source.isin(licenses.permitted_names)
    return df.groupBy(source.alias(source_column), permitted.alias("permitted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def filter_totals(counts: DataFrame) -> DataFrame:
    """Rows before, after and removed in one row, from a ``source_counts`` table."""
    kept = F.when(F.col("permitted"), F.col("rows")).otherwise(0)
    total = F.coalesce(F.sum("rows"), F.lit(0))
    after = F.coalesce(F.sum(kept), F.lit(0))
    return counts.agg(
        total.alias("rows_before"), after.alias("rows_after"), (total - after).alias("rows_removed")
    )


def license_counts(df: DataFrame) -> DataFrame:
    """Rows per source detail and licence; a second licence of one detail keeps its own row."""
    return df.groupBy("source_detail", "source_license").agg(F.count(F.lit(1)).alias("rows"))

