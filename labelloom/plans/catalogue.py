"""The queries this library answers, over the given tables.

Each takes a session and the folder of the tables, reads whole tables, and returns a
DataFrame. Inputs the tables do not hold as such (labels for every document, scores,
dirty text) are derived from them by expressions over all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.chars import char_counts, encode_chars
from labelloom.functions.text import parse_label, strip
from labelloom.operators import dedup, history, licenses, metrics, percentiles, ranking
from labelloom.operators.normalize import (
    default_provenance,
    normalize,
    profile,
    project_map_rows,
    standard_columns,
    validate,
)
from labelloom.operators.sampling import allocate_rows, balanced_sample, presplit_sample
from labelloom.operators.splits import (
    label_counts,
    split_label_counts,
    split_three_way,
    split_two_way,
)
from labelloom.plans import builds, models
from labelloom.plans.builds import (
    BuildConfig,
    LocalCorpus,
    PublishConfig,
    PublishedCorpus,
    dedupe_sources,
)
from labelloom.session import new_path, stage
from labelloom.sources import sinks, tabular
from labelloom.streaming import scoring
from labelloom.streaming.quota import StreamSource, balanced_quota, collect_quota, stream_rows

SEED = 42
PERCENTILE = 0.95

# The test documents name their sources src0 .. src19; this list plays the licence list.
TEST_LICENSES = licenses.LicenseList(
    permitted=tuple(
        licenses.PermittedSource(f"src{i}", f"set{i % 3}", "mit" if i % 2 else "cc0-1.0", f"u/{i}")
        for i in range(6)
    ),
    excluded=tuple(f"src{i}" for i in range(6, 17)),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _parity(column: str = "doc_id") -> Column:
    return (F.col(column) % 2).cast("int")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", "text", _parity().alias("label"), "source", "lang")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    toxic = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return docs.join(toxic, "doc_id")


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    pads = ["\u00a0", "\t", "\n", "\u001c", ""]
    pad = F.element_at(F.lit(pads), (F.col("doc_id") % 5 + 1).cast("int"))
    text = (
        F.when(F.col("doc_id") % 17 == 0, pad)
        .when(F.col("doc_id") % 17 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(pad, F.col("text"), pad))
    )
    raw = corpus(spark, sf)
    return raw.select("doc_id", text.alias("essay"), _spelling(GOOD).alias("label"), "source")


GOOD = (" Human ", "AI", "0.9", "1.5", "false", "llm", "1", "Student", "-0.5", "1e0")
BAD = ("2", "1d", "nan", "maybe", "", "-1", "0x1")


def _spelling(words: tuple[str, ...]) -> Column:
    return F.element_at(F.lit(list(words)), (F.col("doc_id") % len(words) + 1).cast("int"))


def conversation_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as a second source: what the assistant wrote is generated."""
    turns = table(spark, sf, "conversations")
    label = F.when(F.col("role") == "assistant", "ai").otherwise("human")
    return turns.select("text", label.alias("label"), F.col("role").alias("source"))


def presplit(spark: SparkSession, sf: str) -> DataFrame:
    place = F.col("doc_id") % 10
    split = F.when(place < 8, "train").when(place == 8, "val").otherwise("test")
    label = (F.floor(F.col("doc_id") / 10) % 2).cast("int")
    docs = table(spark, sf, "documents")
    rows = docs.select("text", label.alias("label"), split.alias("split"))
    return rows.distinct()


def scored(spark: SparkSession, sf: str) -> DataFrame:
    digits = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 6)
    noise = F.conv(digits, 16, 10).cast("bigint") % 101
    rows = labelled(spark, sf)
    score = (noise + 20 * F.col("label")).cast("double") / 120
    return rows.select("doc_id", "label", score.alias("score"), "source", "lang")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


def unique_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The de-duplicated corpus, staged with its digest as every build does."""
    rows = normalize(corpus(spark, sf), ["doc_id"])
    return dedup.drop_duplicate_texts(rows, digest=True)


# --- normalisation ---------------------------------------------------------------------


def normalize_corpus(spark, sf):
    rows = normalize(dirty(spark, sf), ["doc_id"])
    validate(profile(rows))
    return rows


def text_strip(spark, sf):
    raw = dirty(spark, sf)
    return raw.select("doc_id", strip(F.coalesce("essay", F.lit(""))).alias("text"))


def label_parse(spark, sf):
    raw = corpus(spark, sf).select("doc_id", _spelling(GOOD + BAD).alias("raw"))
    return raw.select("doc_id", "raw", parse_label(F.col("raw"), raw.schema["raw"].dataType).alias("label"))


def label_parse_numeric(spark, sf):
    raw = corpus(spark, sf).select("doc_id", ((F.col("doc_id") % 7 - 2) / 2.0).alias("raw"))
    return raw.select("doc_id", "raw", parse_label(F.col("raw"), raw.schema["raw"].dataType).alias("label"))


def map_row_keys(spark, sf):
    docs = corpus(spark, sf)
    text, label = F.col("text"), F.col("label").cast("string")
    row = (
        F.when(F.col("doc_id") % 3 == 0, F.create_map(F.lit("essay"), text, F.lit("target"), label))
        .when(F.col("doc_id") % 3 == 1, F.create_map(F.lit("text"), text, F.lit("label"), label))
        .otherwise(
            F.create_map(
                F.lit("content"), text, F.lit("label"), F.lit("0"), F.lit("generated"), F.lit("1")
            )
        )
    )
    return project_map_rows(docs.select("doc_id", row.alias("row")), "row", F.col("doc_id"))


def default_provenance_query(spark, sf):
    rows = corpus(spark, sf).select(
        "doc_id",
        "text",
        "label",
        F.lit("").alias("source_dataset"),
        F.when(F.col("doc_id") % 4 == 0, F.col("source")).otherwise("").alias("source_detail"),
    )
    defaults = {"source_dataset": "name", "source_detail": "name", "source_license": "mit"}
    return default_provenance(rows, profile(rows), defaults, url=True)


def standard_projection(spark, sf):
    return standard_columns(corpus(spark, sf).withColumn("source_detail", F.col("source")), ["doc_id"])


# --- licences --------------------------------------------------------------------------


def license_filter(spark, sf):
    return licenses.permitted_rows(corpus(spark, sf), TEST_LICENSES).select("doc_id", "source")


def license_enrich(spark, sf):
    rows, _ = licenses.filter_permitted(corpus(spark, sf), TEST_LICENSES)
    return rows.select("doc_id", "source_detail", *licenses.ATTRIBUTES)


def license_gate_off(spark, sf):
    rows, _ = licenses.filter_permitted(corpus(spark, sf), TEST_LICENSES, source_column="lang")
    return rows.select("doc_id", "label", "lang")


def license_counts(spark, sf):
    return licenses.source_counts(corpus(spark, sf), TEST_LICENSES)


def license_totals(spark, sf):
    return licenses.filter_totals(licenses.source_counts(corpus(spark, sf), TEST_LICENSES))


def source_license_counts(spark, sf):
    rows = licenses.enrich_permitted(corpus(spark, sf), TEST_LICENSES)
    return licenses.license_counts(rows)


# --- de-duplication --------------------------------------------------------------------


def _two_sources(spark, sf) -> list[DataFrame]:
    first = corpus(spark, sf).select("text", "label", F.lit("a").alias("source_dataset"), "source")
    second = labelled(spark, sf).select("text", "label", F.lit("b").alias("source_dataset"), "lang")
    return [first, second]


def union_sources(spark, sf):
    return builds.union_sources(_two_sources(spark, sf)).withColumnRenamed(builds.ORDINAL, "ordinal")


def conflict_removal(spark, sf):
    return dedup.drop_conflicts(corpus(spark, sf)).select("doc_id", "label", "text")


def cross_source_dedup(spark, sf):
    kept, _ = dedupe_sources(_two_sources(spark, sf))
    return kept.drop(ranking.DIGEST)


def dedup_counters(spark, sf):
    combined = builds.union_sources(_two_sources(spark, sf))
    return dedup.dedup_counters(dedup.group_texts(combined, [builds.ORDINAL]))


def split_leakage(spark, sf):
    return dedup.split_leakage(presplit(spark, sf))


# --- sampling and splits ---------------------------------------------------------------


def seeded_shuffle(spark, sf):
    rows = corpus(spark, sf)
    return ranking.shuffle_rows(rows, SEED).select(
        "doc_id", ranking.order_key(rows, SEED, "shuffle").alias("order_key")
    )


def balanced_sample_query(spark, sf):
    rows = unique_corpus(spark, sf)
    return balanced_sample(rows, rows.count() // 2, SEED).drop(ranking.DIGEST)


def balanced_sample_backfill(spark, sf):
    rows = normalize(labelled(spark, sf), ["doc_id"], digest=True)
    return balanced_sample(rows, rows.count() * 4 // 5, SEED).drop(ranking.DIGEST)


def balanced_sample_copies(spark, sf):
    """Copies stay in: the sample has the exact size although order keys repeat."""
    rows = corpus(spark, sf).select("text", "label")
    return balanced_sample(rows, rows.count() // 2, SEED)


def presplit_allocation(spark, sf):
    sizes = {r["split"]: r["count"] for r in presplit(spark, sf).groupBy("split").count().collect()}
    ordered = {split: sizes[split] for split in builds.SPLITS}
    shares = allocate_rows(ordered, sum(ordered.values()) // 2)
    return spark.createDataFrame(list(shares.items()), "split string, sample_rows bigint")


def presplit_sample_query(spark, sf):
    rows = stage(ranking.with_digest(presplit(spark, sf)))
    sampled, _, _ = presplit_sample(rows, rows.count() // 2, SEED)
    return sampled.drop(ranking.DIGEST)


def stratified_split_2way(spark, sf):
    return split_two_way(unique_corpus(spark, sf), 0.2, SEED)[0].drop(ranking.DIGEST)


def stratified_split_3way(spark, sf):
    return split_three_way(unique_corpus(spark, sf), 0.1, 0.1, SEED)[0].drop(ranking.DIGEST)


def split_label_counts_query(spark, sf):
    return split_label_counts(split_three_way(unique_corpus(spark, sf), 0.1, 0.1, SEED)[0])


def label_counts_query(spark, sf):
    return label_counts(labelled(spark, sf))


# --- metrics ---------------------------------------------------------------------------

REPORT_FLOATS = ("roc_auc", "pr_auc", "brier_score", "threshold", "precision", "recall", "f1")


def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf)), "roc_auc")


def pr_auc(spark, sf):
    return rounded(metrics.pr_auc(scored(spark, sf)), "pr_auc")


def precision_recall_curve(spark, sf):
    curve = metrics.precision_recall_curve(scored(spark, sf))
    return rounded(curve, "score", "precision", "recall", "recall_delta")


def mid_ranks(spark, sf):
    return rounded(metrics.mid_ranks(scored(spark, sf)), "score")


def confusion_counts(spark, sf):
    return metrics.confusion_counts(scored(spark, sf), 0.5)


def threshold_metrics(spark, sf):
    return rounded(metrics.threshold_metrics(scored(spark, sf), 0.5), "precision", "recall", "f1")


def best_threshold(spark, sf):
    best = metrics.best_threshold(scored(spark, sf))
    return rounded(best, "threshold", "f1", "precision", "recall")


def brier(spark, sf):
    return rounded(metrics.brier_score(scored(spark, sf)), "brier_score")


def classification_report(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf)), *REPORT_FLOATS)


def report_saturated_scores(spark, sf):
    """A report over scores of which nine in ten are 1."""
    score = F.when(F.col("doc_id") % 10 == 0, F.col("score")).otherwise(1.0)
    return rounded(metrics.classification_report(scored(spark, sf).withColumn("score", score)), *REPORT_FLOATS)


def report_at_threshold(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf), 0.7), *REPORT_FLOATS)


def report_by_source(spark, sf):
    report = metrics.classification_report(scored(spark, sf), by=["source"])
    return rounded(report, *REPORT_FLOATS)


def _logits(spark, sf):
    return scored(spark, sf).withColumn("logit", F.col("score") * 6 - 3)


def bce_loss(spark, sf):
    return rounded(metrics.bce_loss(_logits(spark, sf)), "bce_loss")


# --- histories -------------------------------------------------------------------------


def _epochs(df: DataFrame) -> DataFrame:
    return df.withColumn("epoch", (F.col("doc_id") % 5 + 1).cast("int"))


def epoch_losses(spark, sf) -> DataFrame:
    """Mean loss per batch (one source within an epoch), then per epoch."""
    batches = (
        _epochs(_logits(spark, sf))
        .groupBy("epoch", "source")
        .agg(
            F.avg(F.abs(F.col("score") - F.col("label"))).alias("loss"),
            F.count(F.lit(1)).alias("batch_size"),
        )
    )
    return history.epoch_loss(batches)


def training_history(spark, sf) -> DataFrame:
    rows = _epochs(_logits(spark, sf))
    report = metrics.classification_report(rows, by=["epoch"])
    train = epoch_losses(spark, sf).withColumnRenamed("loss", "train_loss")
    val = metrics.bce_loss(rows, by=["epoch"]).withColumnRenamed("bce_loss", "val_loss")
    joined = train.join(val, "epoch").join(report, "epoch")
    return rounded(joined, "train_loss", "val_loss", *REPORT_FLOATS)


def epoch_loss(spark, sf):
    return rounded(epoch_losses(spark, sf), "loss")


def best_epoch(spark, sf):
    return history.best_epoch(training_history(spark, sf), "val_roc_auc", "max")


def best_epoch_by_loss(spark, sf):
    return history.best_epoch(training_history(spark, sf), "val_loss_epoch", "min")


def training_series(spark, sf):
    return history.training_series(training_history(spark, sf))


def loggable_metrics(spark, sf):
    return history.loggable_metrics(report_by_source(spark, sf), by=["source"])


def leaderboard(spark, sf):
    report = metrics.classification_report(scored(spark, sf), by=["lang", "source"])
    runs = rounded(report, *REPORT_FLOATS)
    return history.leaderboard(runs, run="source", family="lang")


# --- percentiles -----------------------------------------------------------------------


def latency_median(spark, sf):
    return rounded(percentiles.median(table(spark, sf, "events"), "value"), "median")


def latency_p95(spark, sf):
    events = table(spark, sf, "events")
    return percentiles.nearest_rank_percentile(events, "value", PERCENTILE, name="p95")


def latency_p95_by_type(spark, sf):
    events = table(spark, sf, "events")
    return percentiles.nearest_rank_percentile(
        events, "value", PERCENTILE, by=["event_type"], name="p95"
    )


# --- characters ------------------------------------------------------------------------


def char_encode(spark, sf):
    docs = table(spark, sf, "documents")
    ids = encode_chars(F.col("text"))
    return docs.select("doc_id", F.concat_ws(",", F.transform(ids, lambda i: i.cast("string"))).alias("ids"))


def char_vocab_stats(spark, sf):
    return char_counts(table(spark, sf, "documents"))


# --- sources and sinks -----------------------------------------------------------------


def csv_roundtrip(spark, sf):
    """Written as CSV and read back: texts with quotes and line breaks survive."""
    path = new_path(spark, "csv")
    rows = corpus(spark, sf).select("doc_id", "text", "label", "source")
    rows.write.options(**sinks.CSV_WRITE).csv(path)
    return tabular.read_source(spark, path).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("label").cast("int").alias("label"), "source"
    )


def csv_mixed_headers(spark, sf):
    """Two CSV files of one folder with their columns in different orders, bound by name."""
    path = new_path(spark, "csv")
    rows = corpus(spark, sf)
    for parity, columns in enumerate((["doc_id", "text", "label", "source"], ["label", "source", "doc_id", "text"])):
        half = rows.where(F.col("label") == parity).select(*columns)
        half.write.mode("append").options(**sinks.CSV_WRITE).csv(path)
    back = tabular.read_source(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("label").cast("int").alias("label"), "source")


def parquet_mixed_schema(spark, sf):
    """Parquet files of one folder, of which some lack a column."""
    path = new_path(spark, "mixed")
    rows = corpus(spark, sf)
    rows.where("label = 0").select("doc_id", "text").write.mode("append").parquet(path)
    rows.where("label = 1").select("doc_id", "text", "source").write.mode("append").parquet(path)
    return tabular.read_source(spark, path).select("doc_id", "text", "source")


def mixed_format_folder(spark, sf):
    """A folder with CSV and Parquet files is read whole."""
    path = new_path(spark, "mixed")
    rows = corpus(spark, sf).select("doc_id", "text", "label")
    rows.where("label = 0").write.mode("append").options(**sinks.CSV_WRITE).csv(path)
    rows.where("label = 1").write.mode("append").parquet(path)
    back = tabular.read_source(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("label").cast("int").alias("label"))


def mixed_type_sources(spark, sf):
    """Files that disagree on types: labels as words in CSV and as numbers in Parquet, sources with leading zeros as
    text here and as numbers there. Spellings are kept."""
    path = new_path(spark, "mixed-types")
    rows = corpus(spark, sf).select("doc_id", "text", "label", F.lpad((F.col("doc_id") % 50).cast("string"), 3, "0").alias("source"))
    parts = [rows.where(F.col("doc_id") % 3 == k) for k in range(3)]
    word = F.when(F.col("label") == 1, "llm").otherwise("Human").alias("label")
    parts[0].select("doc_id", "text", word, "source").write.mode("append").options(**sinks.CSV_WRITE).csv(path)
    parts[1].select("doc_id", "text", "label", F.col("source").cast("int").alias("source")).write.mode("append").parquet(path)
    parts[2].select("doc_id", "text", "label", "source").write.mode("append").parquet(path)
    return normalize(tabular.read_source(spark, path).withColumn("n", F.col("doc_id").cast("long")).drop("doc_id"), ["n"])


def published_exact_split(spark, sf):
    """A split is read by its exact name, not from folders whose names begin like it."""
    path = _mirror(spark, sf)
    presplit(spark, sf).where("split = 'test'").select("text", "label").write.parquet(f"{path}/train_old")
    return tabular.load_published_split(spark, path, "train").select("text", "label")


def license_numeric_source(spark, sf):
    """A licence list over sources that are numbers."""
    permitted = tuple(licenses.PermittedSource(str(i), f"set{i}", "mit", f"u/{i}") for i in range(6))
    rows = corpus(spark, sf).withColumn("source", F.col("doc_id") % 20)
    kept = licenses.enrich_permitted(rows, licenses.LicenseList(permitted, ("6",)))
    return kept.select("doc_id", "source_detail", "source_dataset", "source_license")


def split_csv_roundtrip(spark, sf):
    path = new_path(spark, "corpus")
    assigned, _ = split_three_way(unique_corpus(spark, sf), 0.1, 0.1, SEED)
    sinks.write_corpus(assigned, path)
    return sinks.read_corpus(spark, path)


def split_parquet_one(spark, sf):
    """One split of a stored corpus: only its directory is read."""
    path = new_path(spark, "corpus")
    assigned, _ = split_three_way(unique_corpus(spark, sf), 0.1, 0.1, SEED)
    sinks.write_corpus(assigned, path, "parquet")
    return sinks.read_corpus(spark, path, "test", "parquet").select("text", "label")


def projected_scan(spark, sf):
    return tabular.read_columns(spark, f"{sf}/documents.parquet", ["text", "source"])


def training_scan(spark, sf):
    rows = dirty(spark, sf).withColumnRenamed("essay", "text")
    return tabular.read_split(rows)


def training_scan_limited(spark, sf):
    """The capped training input. Copies are not removed here, and still the size is exact."""
    rows = dirty(spark, sf).withColumnRenamed("essay", "text")
    return tabular.read_split(rows, table(spark, sf, "documents").count() // 3, SEED)


def evaluation_scan(spark, sf):
    return tabular.read_evaluation(dirty(spark, sf).withColumnRenamed("essay", "text"))


def ensured_table(spark, sf):
    path = new_path(spark, "ensured")
    for _ in range(2):  # the second call finds the table and builds nothing
        result = sinks.ensure_table(spark, path, lambda: label_counts(corpus(spark, sf)))
    return result


# --- builds ----------------------------------------------------------------------------


def _mirror(spark, sf) -> str:
    """The corpus as a published data set would lie in a folder: one sub-folder per split."""
    path = new_path(spark, "mirror")
    names = {"train": "train", "val": "validation", "test": "test"}
    rows = presplit(spark, sf)
    split = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("split")]
    named = rows.select(F.col("text").alias("content"), F.col("label").alias("generated"), split.alias("part"))
    for name in names.values():
        named.where(F.col("part") == name).drop("part").write.parquet(f"{path}/{name}")
    return path


def local_source(spark, sf):
    rows, _ = builds.local_rows(
        corpus(spark, sf),
        "local",
        BuildConfig(new_path(spark, "local"), licenses=TEST_LICENSES, order_by=("doc_id",)),
    )
    return rows


def build_presplit(spark, sf):
    """A published, pre-split corpus capped at half its rows."""
    mirror = _mirror(spark, sf)
    output = new_path(spark, "build")
    cap = presplit(spark, sf).count() // 2
    published = PublishedCorpus("published", mirror, "mit", sample_rows=cap)
    builds.build_corpus(spark, BuildConfig(output, published=published))
    return sinks.read_corpus(spark, output)


def build_local_presplit(spark, sf):
    """The same splits given as local files, with provenance defaults and no cap."""
    mirror = _mirror(spark, sf)
    output = new_path(spark, "build")
    paths = tuple(f"{mirror}/{name}" for name in ("train", "validation", "test"))
    local = LocalCorpus(source_name="local", license="mit", split_paths=paths)
    builds.build_corpus(spark, BuildConfig(output, local, fmt="parquet"))
    return sinks.read_corpus(spark, output, fmt="parquet")


def build_multi_source(spark, sf):
    """The flagship: two CSV sources to a de-duplicated, stratified corpus."""
    raw = new_path(spark, "raw")
    docs = corpus(spark, sf).select("text", "label", "source")
    docs.write.options(**sinks.CSV_WRITE).csv(f"{raw}/documents")
    turns = conversation_corpus(spark, sf)
    turns.write.options(**sinks.CSV_WRITE).csv(f"{raw}/turns")
    output = new_path(spark, "build")
    local = LocalCorpus((f"{raw}/documents", f"{raw}/turns"))
    builds.build_corpus(spark, BuildConfig(output, local, licenses=TEST_LICENSES))
    return sinks.read_corpus(spark, output)


def prepare_two_way(spark, sf):
    output = new_path(spark, "prepare")
    rows = corpus(spark, sf).select("text", "label", "source")
    builds.prepare_two_way(spark, rows, output, licenses=TEST_LICENSES)
    options = tabular.CSV_OPTIONS
    stored = spark.read.options(**options).csv(f"{output}/{sinks.DATA}")
    return stored.select("text", F.col("label").cast("int").alias("label"), "source", "split")


def publish_build(spark, sf):
    raw, mirror = new_path(spark, "raw"), new_path(spark, "mirror")
    conversation_corpus(spark, sf).write.options(**sinks.CSV_WRITE).csv(raw)
    corpus(spark, sf).select("text", "label").write.parquet(f"{mirror}/train")
    output = new_path(spark, "publish")
    human_rows = table(spark, sf, "documents").count() // 2
    published = PublishedCorpus("published", mirror, "mit")
    keep_all = licenses.LicenseList(
        permitted=tuple(
            licenses.PermittedSource(role, "turns", "mit", "") for role in ("assistant", "user", "system")
        ),
        excluded=(),
    )
    config = PublishConfig(output, raw, published, human_rows=human_rows, licenses=keep_all)
    builds.build_publish(spark, config)
    return sinks.read_corpus(spark, output, fmt="parquet")


# --- models ----------------------------------------------------------------------------


def _split_labelled(spark, sf) -> dict[str, DataFrame]:
    rows = normalize(labelled(spark, sf), digest=True)
    assigned, _ = split_three_way(rows, 0.2, 0.2, SEED)
    return {name: assigned.where(F.col("split") == name) for name in builds.SPLITS}


def _char_model(spark, sf) -> models.TrainedModel:
    parts = _split_labelled(spark, sf)
    return models.train(parts["train"], parts["val"], models.CHAR_MODEL)[0]


def train_and_score(spark, sf):
    """Every labelled row with a probability by the trained model; SQL can state that it is one, not which."""
    valid = F.col("prob_ai").between(0.0, 1.0).alias("is_probability")
    return models.score(labelled(spark, sf), _char_model(spark, sf)).select("doc_id", "label", valid, "model_version")


def evaluate_model(spark, sf):
    parts = _split_labelled(spark, sf)
    model, _ = models.train(parts["train"], parts["val"], models.CHAR_MODEL)
    path = new_path(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(spark, path)
    before, after = (
        models.score(parts["test"], m).select("text", F.col("prob_ai").alias(n))
        for m, n in ((model, "a"), (loaded, "b"))
    )
    changed = before.join(after, "text").agg(F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-12).alias("changed_by_saving"))
    report = models.evaluate(parts["test"], loaded)
    in_range = [F.col(m).between(0.0, 1.0) for m in ("roc_auc", "pr_auc", "brier_score", "threshold", "precision", "recall", "f1")]
    return report.select(
        "model_version",
        "rows",
        (F.col("true_positive") + F.col("false_negative")).alias("positives"),
        (F.col("true_negative") + F.col("false_positive")).alias("negatives"),
        reduce(lambda a, b: a & b, in_range).alias("metrics_in_range"),
    ).join(F.broadcast(changed))  # one row each


def sweep(spark, sf):
    parts = _split_labelled(spark, sf)
    runs = stage(models.sweep(parts["train"], parts["val"], parts["test"], models.sweep_grid()))
    board = models.sweep_leaderboard(runs)
    return board.groupBy("family").agg(F.count(F.lit(1)).alias("metrics"), F.count_if(F.col("value").between(0.0, 1.0)).alias("in_range"))


def length_model() -> Callable[[], models.Scorer]:
    """A stand-in for a user's Python model: longer texts score higher.

    The loader is a local function, so it is shipped to the executors by value and they
    need no copy of this module.
    """

    def load():
        import numpy

        def score(texts):
            return 1.0 / (1.0 + numpy.exp(-(texts.str.len() - 1000) / 500.0))

        return score

    return load


def python_model_score(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    result = models.score_with_python(docs, length_model(), "length-v1")
    return rounded(result.select("doc_id", "prob_ai", "model_version"), "prob_ai")


def python_model_report(spark, sf):
    """Score with a Python model and report, the scored rows passing through Spark only."""
    docs = corpus(spark, sf).select("text", "label")
    model = models.TrainedModel(None, 0.5, "length-v1", "python", {})
    report = models.evaluate(
        docs, model, scorer=lambda df: models.score_with_python(df, length_model(), "length-v1")
    )
    return rounded(report, *REPORT_FLOATS).drop("elapsed_seconds", "examples_per_second")


# --- streams ---------------------------------------------------------------------------


def _label_stream(df: DataFrame) -> DataFrame:
    return df.withColumn("label", _parity())


def stream_quota_sample(spark, sf):
    """60 % of the documents by a balanced quota from a stream, copies removed afterwards."""
    source = StreamSource(f"{sf}/documents*.parquet", prepare=_label_stream)
    quota = balanced_quota(table(spark, sf, "documents").count() * 3 // 5)
    literals = {"source_dataset": "documents", "source_split": "train"}
    return normalize(collect_quota(spark, source, quota, SEED, literals))


BATCHES = 6
#: About so many rows in a file of a batch; a batch has as many files as that takes.
ROWS_PER_FILE = 20_000


def stream_quota_batches(spark, sf):
    """A quota filled by several micro-batches, each of the files of one folder. The stream ends early, more files come, and a
    second run goes on from the checkpoint: earlier batches win, inside a batch the seeded order decides."""
    folder, output = new_path(spark, "stream-files"), new_path(spark, "stream-quota")
    docs = corpus(spark, sf).select("doc_id", "text", "label")
    rows = docs.count()
    quota = balanced_quota(rows * 3 // 5)
    files = max(1, rows // (BATCHES * ROWS_PER_FILE))  # far fewer than rows, so each gets some and no folder has fewer
    source = StreamSource(f"{folder}/*", max_files_per_batch=files)
    literals = {"source_split": "train"}
    for batch in range(BATCHES):
        part = docs.where(F.floor(F.col("doc_id") / 2) % BATCHES == batch).drop("doc_id")
        part.repartition(files).write.parquet(f"{folder}/{batch}")
        if batch == BATCHES // 3:
            try:
                collect_quota(spark, source, quota, SEED, literals, output=output)
            except RuntimeError:
                pass  # too few rows so far
    return collect_quota(spark, source, quota, SEED, literals, output=output)


def stream_uncapped(spark, sf):
    """Without a quota every row of the stream is collected; copies leave afterwards."""
    source = StreamSource(f"{sf}/documents*.parquet", prepare=_label_stream)
    return normalize(collect_quota(spark, source, balanced_quota(None), SEED, {"source_split": "train"}))


def stream_dedup(spark, sf):
    """Every labelled row collected from the stream, then de-duplicated in one batch pass."""
    source, literals = StreamSource(f"{sf}/documents*.parquet", prepare=_label_stream), {"source_split": "train"}
    wanted = stream_rows(_label_stream(table(spark, sf, "documents")), literals, label_first=True)  # blank texts don't arrive
    totals = {r["label"]: r["count"] for r in wanted.groupBy("label").count().collect()}
    collected = collect_quota(spark, source, totals, SEED, literals, label_first=True)
    return scoring.dedup_collected(collected)


def stream_score(spark, sf):
    """Documents as a request stream; every 17th request is blank and gets rejected."""
    text = F.when(F.col("doc_id") % 17 == 0, F.lit(" \t ")).otherwise(F.col("text"))
    source = StreamSource(f"{sf}/documents*.parquet")
    requests = source.open(spark).select("doc_id", text.alias("text"))
    output = new_path(spark, "answers")
    query = scoring.start_scoring(
        requests,
        lambda df: models.score_with_python(df, length_model(), "length-v1"),
        output,
        f"{output}-progress",
        available_now=True,
    )
    query.awaitTermination()
    answers = spark.read.parquet(output).select("doc_id", "prob_ai", "model_version", "status")
    return rounded(answers, "prob_ai")


def stream_score_trained(spark, sf):
    model = _char_model(spark, sf)
    requests = StreamSource(f"{sf}/documents*.parquet").open(spark).select("doc_id", "text")
    output = new_path(spark, "answers")
    query = scoring.start_scoring(
        requests, lambda df: models.score(df, model), output, f"{output}-progress", available_now=True
    )
    query.awaitTermination()
    valid = F.col("prob_ai").between(0.0, 1.0).alias("is_probability")
    return spark.read.parquet(output).select("doc_id", valid, "model_version", "status")


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "normalize_corpus": normalize_corpus,
    "text_strip": text_strip,
    "label_parse": label_parse,
    "label_parse_numeric": label_parse_numeric,
    "map_row_keys": map_row_keys,
    "default_provenance": default_provenance_query,
    "standard_projection": standard_projection,
    "license_filter": license_filter,
    "license_enrich": license_enrich,
    "license_gate_off": license_gate_off,
    "license_counts": license_counts,
    "license_totals": license_totals,
    "source_license_counts": source_license_counts,
    "union_sources": union_sources,
    "conflict_removal": conflict_removal,
    "cross_source_dedup": cross_source_dedup,
    "dedup_counters": dedup_counters,
    "split_leakage": split_leakage,
    "seeded_shuffle": seeded_shuffle,
    "balanced_sample": balanced_sample_query,
    "balanced_sample_backfill": balanced_sample_backfill,
    "balanced_sample_copies": balanced_sample_copies,
    "presplit_allocation": presplit_allocation,
    "presplit_sample": presplit_sample_query,
    "stratified_split_2way": stratified_split_2way,
    "stratified_split_3way": stratified_split_3way,
    "split_label_counts": split_label_counts_query,
    "label_counts": label_counts_query,
    "roc_auc": roc_auc,
    "pr_auc": pr_auc,
    "precision_recall_curve": precision_recall_curve,
    "mid_ranks": mid_ranks,
    "confusion_counts": confusion_counts,
    "threshold_metrics": threshold_metrics,
    "best_threshold": best_threshold,
    "brier": brier,
    "classification_report": classification_report,
    "report_at_threshold": report_at_threshold,
    "report_saturated_scores": report_saturated_scores,
    "report_by_source": report_by_source,
    "bce_loss": bce_loss,
    "epoch_loss": epoch_loss,
    "best_epoch": best_epoch,
    "best_epoch_by_loss": best_epoch_by_loss,
    "training_series": training_series,
    "loggable_metrics": loggable_metrics,
    "leaderboard": leaderboard,
    "latency_median": latency_median,
    "latency_p95": latency_p95,
    "latency_p95_by_type": latency_p95_by_type,
    "char_encode": char_encode,
    "char_vocab_stats": char_vocab_stats,
    "csv_roundtrip": csv_roundtrip,
    "csv_mixed_headers": csv_mixed_headers,
    "parquet_mixed_schema": parquet_mixed_schema,
    "mixed_format_folder": mixed_format_folder,
    "mixed_type_sources": mixed_type_sources,
    "published_exact_split": published_exact_split,
    "license_numeric_source": license_numeric_source,
    "split_csv_roundtrip": split_csv_roundtrip,
    "split_parquet_one": split_parquet_one,
    "projected_scan": projected_scan,
    "training_scan": training_scan,
    "training_scan_limited": training_scan_limited,
    "evaluation_scan": evaluation_scan,
    "ensured_table": ensured_table,
    "local_source": local_source,
    "build_presplit": build_presplit,
    "build_local_presplit": build_local_presplit,
    "build_multi_source": build_multi_source,
    "prepare_two_way": prepare_two_way,
    "publish_build": publish_build,
    "train_and_score": train_and_score,
    "evaluate_model": evaluate_model,
    "sweep": sweep,
    "python_model_score": python_model_score,
    "python_model_report": python_model_report,
    "stream_quota_batches": stream_quota_batches,
    "stream_uncapped": stream_uncapped,
    "stream_quota_sample": stream_quota_sample,
    "stream_dedup": stream_dedup,
    "stream_score": stream_score,
    "stream_score_trained": stream_score_trained,
}
