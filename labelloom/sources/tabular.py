"""Reading corpora: CSV and Parquet files, directories of them, and split tables."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.text import clean_text, not_blank, parse_label
from labelloom.operators.columns import exact, label_column, require_columns, text_column
from labelloom.operators.normalize import (
    Profile,
    default_split_provenance,
    normalize_splits,
    profile,
    profile_splits,
    validate,
)
from labelloom.operators.ranking import DIGEST, with_digest
from labelloom.operators.sampling import balanced_sample
from labelloom.session import is_directory, list_files, path_exists, read_head, stage

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
# File names that may be preferred to others in a raw data directory (``csv_source``).
PREFERRED_CSV = (
    "train_v2_drcat_02.csv",
    "train_v2_drcat_01.csv",
    "daigt-v2-train-dataset.csv",
    "train.csv",
)


HEADER_BYTES = 1 << 16


def read_csv(spark: SparkSession, path: str, *, line_breaks: bool = True) -> DataFrame:
    """Headed CSV files as strings. Only an empty field is NULL; 'NA' or 'null' is text.

    Columns are bound by name: files with one header are read together, and the parts are united by column name. If
    headers differ, each must have a text and a label column. With line breaks inside quotes a file is one task, so a
    large corpus should come as many files, or be staged once. ``line_breaks=False`` makes files splittable.
    """
    options = {**CSV_OPTIONS, "multiLine": str(line_breaks).lower(), "enforceSchema": "false"}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in _headers(spark, path):
        by_header.setdefault(header, []).append(file)
    if not by_header:
        raise FileNotFoundError(f"no CSV files below {path}")
    frames = []
    for header, files in sorted(by_header.items()):
        df = spark.read.options(**options).csv(files)
        if len(by_header) > 1:
            try:
                text_column(df), label_column(df)
            except ValueError as error:
                raise ValueError(f"{files[0]}: {error}") from error
        frames.append(df)
    return united(frames)


def united(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames by column name. A column whose types differ is text in all of them, spelled as it was."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {c for c, kinds in types.items() if len(kinds) > 1}
    same = [df.select(*[(exact(c).cast("string") if c in mixed else exact(c)).alias(c) for c in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


def _headers(spark: SparkSession, path: str) -> list[tuple[str, tuple[str, ...]]]:
    """The CSV files of a path with their column names, from the first HEADER_BYTES of each. Empty files are left out."""

    def header(file: str) -> tuple[str, tuple[str, ...]]:
        head = read_head(spark, file, HEADER_BYTES).decode("utf-8", "replace").removeprefix("\ufeff")
        return file, tuple(next(csv.reader(io.StringIO(head, newline="")), ()))

    files = list_files(spark, path, ".csv") if is_directory(spark, path) else [path]
    with ThreadPoolExecutor(16) as pool:
        return [(file, names) for file, names in pool.map(header, files) if names]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with the columns of all of them, by name. Files that disagree on a type are read apart and united."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    try:
        return reader.option("pathGlobFilter", _name_filter(spark, path, "parquet")).parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    by_schema: dict[str, list[str]] = {}
    files = list_files(spark, path, ".parquet")
    with ThreadPoolExecutor(16) as pool:
        for file, schema in zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files), strict=True):
            by_schema.setdefault(schema.simpleString(), []).append(file)
    return united([spark.read.parquet(*group) for _, group in sorted(by_schema.items())])


def _name_filter(spark: SparkSession, path: str, suffix: str) -> str:
    """A directory contributes its files of one kind; a file named outright always counts."""
    return f"*.{suffix}" if is_directory(spark, path) else "*"


def source_formats(spark: SparkSession, path: str) -> list[str]:
    """'csv' and 'parquet', as far as present: by suffix for a file, by content for a directory."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source path does not exist: {path}")
    if not is_directory(spark, path):
        return ["parquet" if path.endswith(".parquet") else "csv"]
    if kinds := [k for k in ("csv", "parquet") if list_files(spark, path, f".{k}")]:
        return kinds
    raise FileNotFoundError(f"no CSV or Parquet files below {path}")


def source_format(spark: SparkSession, path: str) -> str:
    """The format of a path; 'csv' if a directory holds both."""
    return source_formats(spark, path)[0]


def csv_source(spark: SparkSession, path: str, preferred: Sequence[str] = ()) -> str:
    """The CSV path to read: the path itself, or the first of the ``preferred`` files inside the directory."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source path does not exist: {path}")
    if not is_directory(spark, path):
        return path
    for name in preferred:
        if path_exists(spark, f"{path}/{name}"):
            return f"{path}/{name}"
    if not list_files(spark, path, ".csv"):
        raise FileNotFoundError(f"no CSV files below {path}")
    return path


def read_source(spark: SparkSession, path: str, *, line_breaks: bool = True) -> DataFrame:
    """All CSV and Parquet files of a path, united by column name. A column of different types is text."""
    frames = [
        read_csv(spark, path, line_breaks=line_breaks) if kind == "csv" else read_parquet(spark, path)
        for kind in source_formats(spark, path)
    ]
    return united(frames)


def ingest(spark: SparkSession, path: str, *, line_breaks: bool = True) -> DataFrame:
    """A source ready for several passes: CSV is parsed once and staged as Parquet."""
    df = read_source(spark, path, line_breaks=line_breaks)
    return stage(df, "ingest") if source_format(spark, path) == "csv" else df


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A projected read; the scan is pruned to these columns."""
    df = read_source(spark, path)
    require_columns(df, columns)
    return df.select(*[exact(c) for c in columns])


def read_split(df: DataFrame, limit_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Training input: text and label, both required, blank rows dropped, optional cap."""
    require_columns(df, ["text", "label"])
    rows = df.select(
        clean_text(exact("text")).alias("text"),
        parse_label(exact("label"), df.schema["label"].dataType).alias("label"),
    ).where(not_blank(F.col("text")))
    staged = stage(with_digest(rows), "split")
    validate(profile(staged))
    return balanced_sample(staged, limit_rows, seed).drop(DIGEST)


def read_evaluation(df: DataFrame) -> DataFrame:
    """Evaluation input: every row is kept, text unstripped, a missing text is ''."""
    require_columns(df, ["text", "label"])
    label = parse_label(exact("label"), df.schema["label"].dataType)
    text = F.coalesce(exact("text").cast("string"), F.lit(""))
    return df.select(text.alias("text"), label.alias("label"))


PROVENANCE_URL = "upstream_url"


def split_files(mirror: str, name: str) -> str:
    """The folder ``name``, the file ``name.parquet`` and the files ``name-*.parquet`` of a mirror, and no others."""
    return f"{mirror}/{{{name},{name}.parquet,{name}-*.parquet}}"


def load_published_splits(
    spark: SparkSession, mirror: str, stored: Mapping[str, str], order_by: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, Profile]]:
    """All splits of a mirrored corpus as one checked table.

    ``stored`` maps a split to its name in the mirror (see ``split_files``).
    """
    reader = spark.read.option("mergeSchema", "true")
    frames = {split: reader.parquet(split_files(mirror, name)) for split, name in stored.items()}
    rows, facts = _checked(frames, order_by)
    return _tag_splits(rows, stored), facts


def load_local_splits(
    frames: Mapping[str, DataFrame],
    stored: Mapping[str, str],
    source_name: str,
    declared_license: str,
    order_by: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, Profile]]:
    """Local splits as one checked table; provenance columns blank in a split get defaults."""
    rows, facts = _checked(frames, order_by)
    defaults = {
        "source_dataset": source_name,
        "source_detail": source_name,
        "source_license": declared_license,
    }
    filled = default_split_provenance(rows, facts, defaults)
    if PROVENANCE_URL not in filled.columns:
        filled = filled.withColumn(PROVENANCE_URL, F.lit(""))
    return _tag_splits(filled, stored), facts


def load_published_split(
    spark: SparkSession, mirror: str, split: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """One split of a mirrored corpus, checked and tagged."""
    return load_published_splits(spark, mirror, {split: split}, order_by)[0].drop("split", DIGEST)


def load_local_split(
    df: DataFrame, split: str, source_name: str, declared_license: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """One local split, checked, tagged and with provenance."""
    rows, _ = load_local_splits(
        {split: df}, {split: split}, source_name, declared_license, order_by
    )
    return rows.drop("split", DIGEST)


def _checked(frames: Mapping[str, DataFrame], order_by: Sequence[str]):
    """Staged once with the digest that sampling needs, then checked split by split."""
    staged = normalize_splits(frames, order_by, digest=True)
    facts = profile_splits(staged)
    empty = Profile(0, 0, {0: 0, 1: 0}, {})
    for split in frames:
        validate(facts.get(split, empty))
    return staged, facts


def _tag_splits(df: DataFrame, stored: Mapping[str, str]) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in stored.items() for x in pair])
    return df.withColumn("source_split", names[F.col("split")])


STANDARD_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("source_dataset", T.StringType()),
        T.StructField("source_detail", T.StringType()),
        T.StructField("source_license", T.StringType()),
        T.StructField("upstream_url", T.StringType()),
    ]
)
