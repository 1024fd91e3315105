"""Corpus builds, end to end: sources in, a split corpus with metadata out.

Every build stages its normalised rows once as Parquet. The passes after that (checks,
counters, quotas) read a few narrow columns of the staged table; the texts are read
again only by the final write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.text import clean_text, not_blank, parse_label
from labelloom.operators.columns import exact
from labelloom.operators.dedup import (
    dedup_counters,
    drop_duplicate_texts,
    group_texts,
    split_leakage,
    survivors,
)
from labelloom.operators.licenses import (
    DEFAULT_LICENSES,
    LicenseList,
    filter_permitted,
    filter_totals,
    license_counts,
    source_counts,
)
from labelloom.operators.normalize import (
    default_provenance,
    normalize,
    profile,
    standard_columns,
    tag_split,
    validate,
)
from labelloom.operators.ranking import DIGEST
from labelloom.operators.sampling import balanced_sample, balanced_targets, presplit_sample
from labelloom.operators.splits import split_three_way, split_two_way
from labelloom.session import path_exists, scratch, stage
from labelloom.sources.sinks import METADATA, write_corpus, write_json, write_split_table
from labelloom.sources.tabular import (
    csv_source,
    ingest,
    load_local_splits,
    load_published_splits,
    read_columns,
    read_source,
    split_files,
)
from labelloom.streaming.quota import StreamSource, balanced_quota, collect_quota

SPLITS = ("train", "val", "test")
STORED_SPLITS = ("train", "validation", "test")
ORDINAL = "_source_ordinal"


@dataclass(frozen=True)
class PublishedCorpus:
    """A corpus mirrored to a folder: Parquet, each split a sub-folder, a file, or files numbered behind its name."""

    name: str
    mirror: str
    license: str = "other"
    pre_split: bool = True
    split: str = "train"
    split_names: tuple[str, str, str] = STORED_SPLITS
    sample_rows: int | None = None
    max_files_per_batch: int = 64

    def stream(self) -> StreamSource:
        return StreamSource(split_files(self.mirror, self.split), self.max_files_per_batch)


@dataclass(frozen=True)
class LocalCorpus:
    paths: tuple[str, ...] = ()
    source_name: str | None = None
    license: str = "unverified"
    sample_rows: int | None = None
    split_paths: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class BuildConfig:
    output: str
    local: LocalCorpus = field(default_factory=LocalCorpus)
    published: PublishedCorpus | None = None
    val_fraction: float = 0.1
    test_fraction: float = 0.1
    seed: int = 42
    fmt: str = "csv"
    order_by: tuple[str, ...] = ()
    licenses: LicenseList = DEFAULT_LICENSES


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources by column name, each row tagged with its source's place in the order."""
    tagged = [df.withColumn(ORDINAL, F.lit(i)) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _named(counts: dict[int, int]) -> dict[str, int]:
    return {str(label): n for label, n in sorted(counts.items()) if n}


def _split_metadata(by_split: dict[str, dict[int, int]]) -> dict[str, Any]:
    labels = sorted({label for counts in by_split.values() for label in counts})
    total = {label: sum(c.get(label, 0) for c in by_split.values()) for label in labels}
    facts: dict[str, Any] = {"rows_total": sum(total.values()), "label_counts": _named(total)}
    for split, counts in by_split.items():
        facts[f"rows_{split}"] = sum(counts.values())
        facts[f"{split}_label_counts"] = _named(counts)
    return facts


def license_filter_facts(
    df: DataFrame, enabled: bool, licenses: LicenseList, counts_path: str
) -> dict[str, Any]:
    """What the licence filter did. The rows per source go to a table: their number is open."""
    if not enabled:
        reason = "no known source" if "source" in df.columns else "no source column"
        rows = df.count()
        counts = {"rows_before": rows, "rows_after": rows, "rows_removed": 0}
        return {"enabled": False, "reason": reason, **counts}
    source_counts(df, licenses).write.mode("overwrite").parquet(counts_path)
    totals = filter_totals(df.sparkSession.read.parquet(counts_path)).first().asDict()
    return {"enabled": True, "source_column": "source", "source_counts": counts_path, **totals}


def local_rows(
    df: DataFrame, source_name: str, config: BuildConfig, ordinal: int = 0
) -> tuple[DataFrame, dict[str, Any]]:
    """One local source: licence filter, normalise, provenance, cap."""
    filtered, enabled = filter_permitted(df, config.licenses)
    rows = normalize(filtered, config.order_by, digest=True)
    facts = profile(rows)
    validate(facts, require_binary=False)
    named = default_provenance(rows, facts, {"source_dataset": source_name})
    tagged = tag_split(named, "local")
    cap, purpose = config.local.sample_rows, f"sample-{ordinal}"
    sampled = balanced_sample(tagged, cap, config.seed, purpose)
    used = facts.label_counts
    if cap is not None and cap < facts.rows:
        used = balanced_targets(used, cap)
    counts_path = f"{config.output}/source_filter/{ordinal}"
    return sampled.drop(DIGEST), {
        "kind": "local_csv",
        "source_name": source_name,
        "declared_license": config.local.license,
        "license_filter": license_filter_facts(df, enabled, config.licenses, counts_path),
        "rows_normalized": facts.rows,
        "rows_used": sum(used.values()),
        "label_counts": _named(used),
    }


def dedupe_sources(frames: Sequence[DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """Drop conflicting texts, keep each other text from its first source; with counters."""
    combined = union_sources(frames)
    grouped = group_texts(combined, [ORDINAL])
    counters = dedup_counters(grouped).first().asDict()
    return survivors(grouped, digest=True).drop(ORDINAL), counters


def build_multi_source(spark: SparkSession, config: BuildConfig) -> dict[str, Any]:
    """A streamed sample and any number of local sources to one split corpus."""
    frames: list[DataFrame] = []
    sources: list[dict[str, Any]] = []
    corpus = config.published
    if corpus is not None:
        rows = _stream_sample(spark, corpus, config)
        facts = profile(rows)
        validate(facts)
        frames.append(rows)
        sources.append(
            {
                "kind": "published_stream",
                "dataset": corpus.name,
                "split": corpus.split,
                "declared_license": corpus.license,
                "rows_used": facts.rows,
                "label_counts": _named(facts.label_counts),
            }
        )
    for ordinal, path in enumerate(config.local.paths):
        name = config.local.source_name or path.rstrip("/").rsplit("/", 1)[-1]
        resolved = csv_source(spark, path)
        rows, facts = local_rows(ingest(spark, resolved), name, config, ordinal)
        frames.append(rows)
        sources.append({**facts, "source_csv": resolved})
    if not frames:
        raise ValueError("enable a published corpus or name at least one local source")

    deduped, counters = dedupe_sources(frames)
    assigned, by_split = split_three_way(
        deduped, config.val_fraction, config.test_fraction, config.seed
    )
    if len(_split_metadata(by_split)["label_counts"]) < 2:
        raise ValueError("both labels, human and generated, must occur")
    write_corpus(assigned, config.output, config.fmt)
    return _finish(spark, config, sources, counters, by_split)


def _stream_sample(spark: SparkSession, corpus: PublishedCorpus, config: BuildConfig) -> DataFrame:
    source = corpus.stream()
    literals = {"source_dataset": corpus.name, "source_split": corpus.split}
    quota = balanced_quota(corpus.sample_rows)
    collected = collect_quota(spark, source, quota, config.seed, literals)
    return normalize(collected)


def _finish(spark, config: BuildConfig, sources, counters, by_split) -> dict[str, Any]:
    metadata = {
        "seed": config.seed,
        "val_fraction": config.val_fraction,
        "test_fraction": config.test_fraction,
        "sources": sources,
        **counters,
        **_split_metadata(by_split),
    }
    write_json(spark, metadata, f"{config.output}/{METADATA}")
    return metadata


def _build_presplit(
    spark, config: BuildConfig, rows: DataFrame, facts, sample_rows, source
) -> dict[str, Any]:
    """Cap, write and report a table of splits.

    These builds keep copies across splits, so the number of leaked texts is reported.
    """
    sampled, allocation, by_split = presplit_sample(rows, sample_rows, config.seed, SPLITS)
    write_corpus(sampled, config.output, config.fmt)
    source = {
        **source,
        "sample_rows": sample_rows,
        "rows_used": sum(sum(c.values()) for c in by_split.values()),
        "sampled_rows_by_split": allocation,
    }
    counters = {
        "rows_before_cross_source_deduplication": sum(f.rows for f in facts.values()),
        "rows_with_conflicting_labels_removed": 0,
        "duplicate_text_rows_removed": 0,
        "split_leakage": split_leakage(sampled).first().asDict(),
    }
    return _finish(spark, config, [source], counters, by_split)


def build_local_presplit(spark: SparkSession, config: BuildConfig) -> dict[str, Any]:
    """Three local files that already are the splits."""
    local = config.local
    if local.split_paths is None or not all(local.split_paths):
        raise ValueError("a pre-split build needs a train, a val and a test path")
    missing = [p for p in local.split_paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"pre-split data files are missing: {', '.join(missing)}")
    name = local.source_name or (config.published.name if config.published else "local")
    frames = {s: read_source(spark, path) for s, path in zip(SPLITS, local.split_paths)}
    rows, facts = load_local_splits(
        frames, dict(zip(SPLITS, STORED_SPLITS)), name, local.license, config.order_by
    )
    sample_rows = local.sample_rows
    if sample_rows is None and config.published is not None:
        sample_rows = config.published.sample_rows
    source = {
        "kind": "local_presplit",
        "source_name": name,
        "declared_license": local.license,
        **{f"{s}_path": p for s, p in zip(SPLITS, local.split_paths)},
    }
    return _build_presplit(spark, config, rows, facts, sample_rows, source)


def build_published_presplit(spark: SparkSession, config: BuildConfig) -> dict[str, Any]:
    """A mirrored corpus that already has its splits."""
    corpus = config.published
    stored = dict(zip(SPLITS, corpus.split_names))
    rows, facts = load_published_splits(spark, corpus.mirror, stored, config.order_by)
    source = {
        "kind": "published_presplit",
        "dataset": corpus.name,
        "declared_license": corpus.license,
        **{f"{s}_split": name for s, name in stored.items()},
    }
    return _build_presplit(spark, config, rows, facts, corpus.sample_rows, source)


def build_corpus(spark: SparkSession, config: BuildConfig) -> dict[str, Any]:
    """Choose the build: local pre-split, then published pre-split, then multi-source."""
    published = config.published
    if config.local.split_paths is not None:
        build = build_local_presplit
    elif published is not None and published.pre_split and not config.local.paths:
        build = build_published_presplit
    else:
        build = build_multi_source
    with scratch(spark):
        return build(spark, config)


def prepare_two_way(
    spark: SparkSession,
    df: DataFrame,
    output: str,
    val_fraction: float = 0.2,
    seed: int = 42,
    licenses: LicenseList = DEFAULT_LICENSES,
    order_by: Sequence[str] = (),
) -> dict[str, Any]:
    """One source to train and val, with all of its normalised columns."""
    with scratch(spark):
        filtered, enabled = filter_permitted(df, licenses)
        rows = normalize(filtered, order_by, digest=True)
        validate(profile(rows))
        assigned, by_split = split_two_way(rows, val_fraction, seed)
        write_split_table(assigned.drop(DIGEST), output)
        metadata = {
            "license_filter": license_filter_facts(
                df, enabled, licenses, f"{output}/source_filter"
            ),
            "seed": seed,
            "val_fraction": val_fraction,
            **_split_metadata(by_split),
        }
        write_json(spark, metadata, f"{output}/{METADATA}")
        return metadata


@dataclass(frozen=True)
class PublishConfig:
    output: str
    local_path: str
    published: PublishedCorpus
    human_rows: int
    upstream_url: str = ""
    seed: int = 42
    licenses: LicenseList = DEFAULT_LICENSES


def permitted_local_rows(df: DataFrame, licenses: LicenseList = DEFAULT_LICENSES) -> DataFrame:
    """Text, label and provenance of the permitted rows of a raw local table, copies kept."""
    filtered, _ = filter_permitted(df, licenses)
    rows = filtered.withColumn("text", clean_text(exact("text"))).where(not_blank(F.col("text")))
    label = parse_label(exact("label"), df.schema["label"].dataType)
    return standard_columns(rows.withColumn("label", label))


def build_publish(spark: SparkSession, config: PublishConfig) -> dict[str, Any]:
    """Permitted local rows topped up from a stream, de-duplicated, split, as Parquet."""
    with scratch(spark):
        return _publish(spark, config)


def _publish(spark: SparkSession, config: PublishConfig) -> dict[str, Any]:
    raw = read_columns(spark, config.local_path, ["text", "label", "source"])
    local = stage(permitted_local_rows(raw, config.licenses), "permitted")
    facts = profile(local)
    validate(facts, require_binary=False)
    generated_rows = max(0, config.human_rows - facts.label_counts[1])

    corpus = config.published
    source = corpus.stream()
    literals = {
        "source_dataset": corpus.name,
        "source_detail": corpus.name,
        "source_license": corpus.license,
        "upstream_url": config.upstream_url,
    }
    quota = {0: config.human_rows, 1: generated_rows}
    streamed = collect_quota(spark, source, quota, config.seed, literals, label_first=True)

    staged = drop_duplicate_texts(union_sources([streamed, local]), [ORDINAL], digest=True).drop(ORDINAL)
    assigned, by_split = split_three_way(staged, 0.1, 0.1, config.seed)
    renamed = assigned.replace({"val": "validation"}, subset=["split"])
    write_corpus(renamed, config.output, "parquet")
    license_counts(staged).write.mode("overwrite").json(f"{config.output}/source_counts")
    metadata = {
        "seed": config.seed,
        "dataset": corpus.name,
        "human_rows": config.human_rows,
        "generated_rows": generated_rows,
        "local_rows": facts.rows,
        **_split_metadata(by_split),
    }
    write_json(spark, metadata, f"{config.output}/{METADATA}")
    return metadata
