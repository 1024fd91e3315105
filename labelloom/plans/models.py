"""Text classifiers on Spark ML: train, score, evaluate, sweep, persist."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from labelloom.functions.grams import CharGrams
from labelloom.operators.history import best_epoch, leaderboard
from labelloom.operators.metrics import bce_loss, check_scored, classification_report
from labelloom.session import stage
from labelloom.sources.sinks import write_report

DEFAULT_THRESHOLD = 0.5
#: Texts that a Python model gets at once, if it names no number.
PYTHON_ROWS = 1_000


@dataclass(frozen=True)
class ModelConfig:
    """A logistic text classifier over hashed n-grams of characters or of words.

    ``iterations`` lists the optimiser budgets to try; each is one epoch record, and the
    best by ``monitor`` is kept.
    """

    name: str = "char_ngram"
    tokens: str = "chars"
    ngram: int = 3
    features: int = 1 << 16
    regularization: float = 0.01
    iterations: tuple[int, ...] = (20,)
    monitor: str = "val_roc_auc"
    mode: str = "max"
    version: str | None = None

    @property
    def model_version(self) -> str:
        return self.version or f"{self.name}-v1"


CHAR_MODEL = ModelConfig()
WORD_MODEL = ModelConfig(name="word_ngram", tokens="words", ngram=1)
ALL_MODELS = (CHAR_MODEL, WORD_MODEL)


@dataclass(frozen=True)
class TrainedModel:
    pipeline: PipelineModel
    threshold: float
    version: str
    model_type: str
    metrics: dict[str, Any]


def feature_pipeline(config: ModelConfig) -> Pipeline:
    """Whole text to a hashed count vector; characters by ``CharGrams``, words in the JVM."""
    if config.tokens == "chars":
        grams = CharGrams(inputCol="text", outputCol="features", n=config.ngram, numFeatures=config.features)
        return Pipeline(stages=[grams])
    tokenizer = RegexTokenizer(
        inputCol="text", outputCol="tokens", pattern=r"(?U)\w+", gaps=False, toLowercase=True
    )
    ngram = NGram(n=config.ngram, inputCol="tokens", outputCol="ngrams")
    hashing = HashingTF(numFeatures=config.features, inputCol="ngrams", outputCol="features")
    return Pipeline(stages=[tokenizer, ngram, hashing])


def _vectors(df: DataFrame, features: PipelineModel) -> DataFrame:
    rows = features.transform(df.select("text", F.col("label").cast("double").alias("label")))
    return stage(rows.select("label", "features"), "features")


def featurize(df: DataFrame, config: ModelConfig) -> tuple[PipelineModel, DataFrame]:
    """Features of a corpus, staged: every optimiser pass re-reads the vectors, not the texts."""
    pipeline = feature_pipeline(config).fit(df)
    return pipeline, _vectors(df, pipeline)


def _with_probability(df: DataFrame) -> DataFrame:
    return df.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "logit", vector_to_array("rawPrediction")[1]
    )


def _epoch_record(model, val: DataFrame, epoch: int) -> DataFrame:
    scored = _with_probability(model.transform(val)).select("label", "score", "logit")
    scored = stage(scored, "scored")
    train_loss = float(model.summary.objectiveHistory[-1])
    loss = bce_loss(scored).first()["bce_loss"]
    return classification_report(scored).select(
        F.lit(epoch).alias("epoch"),
        F.lit(train_loss).alias("train_loss"),
        F.lit(loss).alias("val_loss"),
        "*",
    )


def train(
    train_df: DataFrame, val_df: DataFrame, config: ModelConfig = CHAR_MODEL
) -> tuple[TrainedModel, DataFrame]:
    """Fit, validate after each budget, keep the best; its best-F1 threshold is stored.

    Returns the model and the history, one row per budget.
    """
    features, train_vectors = featurize(train_df, config)
    return fit(features, train_vectors, _vectors(val_df, features), config)


def fit(
    features: PipelineModel, train_vectors: DataFrame, val_vectors: DataFrame, config: ModelConfig
) -> tuple[TrainedModel, DataFrame]:
    """``train`` on vectors that are staged already."""
    fitted, records = {}, []
    for epoch, budget in enumerate(config.iterations, start=1):
        estimator = LogisticRegression(maxIter=budget, regParam=config.regularization)
        fitted[epoch] = estimator.fit(train_vectors)
        records.append(_epoch_record(fitted[epoch], val_vectors, epoch))
    history = stage(reduce(DataFrame.unionByName, records), "history")
    best = best_epoch(history, config.monitor, config.mode).first().asDict()
    pipeline = PipelineModel(stages=[*features.stages, fitted[best["epoch"]]])
    model = TrainedModel(pipeline, best["threshold"], config.model_version, config.name, best)
    return model, history


def train_all(
    train_df: DataFrame, val_df: DataFrame, configs: Iterable[ModelConfig] = ALL_MODELS
) -> dict[str, tuple[TrainedModel, DataFrame]]:
    return {config.name: train(train_df, val_df, config) for config in configs}


def score(df: DataFrame, model: TrainedModel) -> DataFrame:
    """Add ``prob_ai`` and ``model_version``; works on batch and streaming frames alike."""
    scored = model.pipeline.transform(df)
    return scored.select(
        *df.columns,
        vector_to_array("probability")[1].alias("prob_ai"),
        F.lit(model.version).alias("model_version"),
    )


Scorer = Callable[[pd.Series], Sequence[float]]


def score_with_python(
    df: DataFrame, load: Callable[[], Scorer], version: str, batch_size: int | None = None
) -> DataFrame:
    """Score with a Python model: loaded once per task, called on parts of Arrow batches.

    Only the text column travels to Python. ``load`` must be picklable and returns a function from a series of texts to
    probabilities; it is called with at most ``batch_size`` texts, 1,000 by default. Only these are Python strings at a
    time, so a worker holds them, an Arrow batch (which Spark bounds in rows and bytes) and the model.
    """
    step = batch_size or PYTHON_ROWS

    def score_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = load()
        for texts in batches:
            starts = range(0, len(texts), step)
            parts = [np.asarray(scorer(texts.slice(k, step).to_pandas()), "float64") for k in starts]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0))

    probability = arrow_udf(score_batches, "double")
    return df.select(
        "*", probability(F.col("text")).alias("prob_ai"), F.lit(version).alias("model_version")
    )


def predict(spark: SparkSession, texts: Sequence[str], model: TrainedModel) -> list[float]:
    """Probabilities of a few texts, in their order; a convenience for single requests."""
    if not texts:
        return []
    if any(not text.strip() for text in texts):
        raise ValueError("text must not be blank")
    df = spark.createDataFrame(list(enumerate(texts)), "position int, text string")
    rows = score(df, model).select("position", "prob_ai").collect()
    return [row["prob_ai"] for row in sorted(rows)]


def evaluate(
    df: DataFrame,
    model: TrainedModel,
    threshold: float | None = None,
    output: str | None = None,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Score a split and report all metrics at the model's stored threshold, in one row.

    The scored table (label and score only) is staged, so the model runs once, and the
    time of that write is the scoring time reported.
    """
    scored = scorer(df) if scorer else score(df, model)
    started = time.perf_counter()
    staged = stage(scored.select("label", F.col("prob_ai").alias("score")), "scored")
    elapsed = time.perf_counter() - started
    check_scored(staged)
    used = model.threshold if threshold is None else threshold
    rows = F.col("true_positive") + F.col("false_positive")
    rows = rows + F.col("true_negative") + F.col("false_negative")
    report = classification_report(staged, used).select(
        "*",
        F.lit(model.version).alias("model_version"),
        rows.alias("rows"),
        *throughput(rows, elapsed),
    )
    if output is not None:
        report = stage(report, "report")
        write_report(report, output)
    return report


def throughput(rows: Column, elapsed: float) -> list[Column]:
    per_second = F.when(F.lit(elapsed) > 0, rows / F.lit(elapsed))
    return [
        F.lit(elapsed).alias("elapsed_seconds"),
        per_second.alias("examples_per_second"),
    ]


def save_model(model: TrainedModel, path: str) -> None:
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.active()
    meta = spark.range(1, numPartitions=1).select(
        F.lit(model.model_type).alias("model_type"),
        F.lit(model.version).alias("model_version"),
        F.lit(float(model.threshold)).alias("threshold"),
    )
    meta.write.mode("overwrite").parquet(f"{path}/model_meta")
    write_report(_metrics_row(spark, model), f"{path}/metrics")


def _metrics_row(spark: SparkSession, model: TrainedModel) -> DataFrame:
    present = {k: float(v) for k, v in model.metrics.items() if v is not None}
    return spark.createDataFrame([(present,)], "metrics map<string,double>")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    meta = spark.read.parquet(f"{path}/model_meta").first()
    stored = spark.read.schema("metrics map<string,double>").json(f"{path}/metrics").first()
    threshold = DEFAULT_THRESHOLD if meta["threshold"] is None else meta["threshold"]
    return TrainedModel(
        PipelineModel.load(f"{path}/pipeline"),
        threshold,
        meta["model_version"],
        meta["model_type"],
        dict(stored["metrics"] or {}),
    )


def sweep_grid(mode: str = "full", base: Iterable[ModelConfig] = ALL_MODELS) -> list[ModelConfig]:
    """Three trials per model family, or one small trial each in smoke mode."""
    if mode not in ("full", "smoke"):
        raise ValueError("mode must be 'full' or 'smoke'")
    if mode == "smoke":
        return [replace(c, version=f"{c.name}-smoke", iterations=(5,)) for c in base]
    return [
        replace(c, version=f"{c.name}-reg{reg}", regularization=reg)
        for c in base
        for reg in (0.1, 0.01, 0.001)
    ]


def sweep(
    train_df: DataFrame, val_df: DataFrame, test_df: DataFrame, grid: Iterable[ModelConfig]
) -> DataFrame:
    """Train and evaluate every trial; one row per trial, ready for ``leaderboard``.

    Trials whose features are alike train and validate on the same staged vectors. Each is evaluated on the texts.
    """
    reports, vectors = [], {}
    for config in grid:
        alike = (config.tokens, config.ngram, config.features)
        if alike not in vectors:
            features, train_vectors = featurize(train_df, config)
            vectors[alike] = (features, train_vectors, _vectors(val_df, features))
        model, _ = fit(*vectors[alike], config)
        report = evaluate(test_df, model)
        reports.append(
            report.select(F.lit(config.name).alias("family"), F.col("model_version").alias("run"), "*")
        )
    return reduce(DataFrame.unionByName, reports)


def sweep_leaderboard(runs: DataFrame, metrics: Mapping[str, bool] | None = None) -> DataFrame:
    return leaderboard(runs, metrics=dict(metrics) if metrics else None)
