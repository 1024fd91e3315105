import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from labelloom.plans import models

QUICK = replace(models.CHAR_MODEL, features=1 << 10, iterations=(2, 6))


@pytest.fixture(scope="module")
def corpus(spark):
    label = (F.col("id") % 2).cast("int")
    text = F.when(label == 1, "zebra quiz jazz ").otherwise("plain old words ")
    return spark.range(120).select(F.concat(text, F.col("id")).alias("text"), label.alias("label"))


@pytest.fixture(scope="module")
def trained(corpus):
    return models.train(corpus, corpus, QUICK)


def length_model():
    """A loader; local functions travel to the workers by value."""
    return lambda: lambda texts: [1 / (1 + math.exp(-(len(t) - 5))) for t in texts]


def test_training_keeps_the_best_epoch_and_its_threshold(trained):
    model, history = trained
    assert [r.epoch for r in history.orderBy("epoch").collect()] == [1, 2]
    assert model.metrics["roc_auc"] == 1.0
    assert model.threshold == model.metrics["threshold"] != 0.5


def test_saved_models_score_the_same(spark, corpus, trained, folder):
    model, _ = trained
    models.save_model(model, folder)
    loaded = models.load_model(spark, folder)
    assert (loaded.threshold, loaded.version) == (model.threshold, "char_ngram-v1")
    before, after = (
        {r.text: r.prob_ai for r in models.score(corpus, m).collect()} for m in (model, loaded)
    )
    assert before == after
    texts = ["zebra quiz jazz 1", "plain old words 2"]
    assert models.predict(spark, texts, loaded) == [before[t] for t in texts]
    assert models.predict(spark, [], loaded) == []
    with pytest.raises(ValueError, match="blank"):
        models.predict(spark, [" "], loaded)


def test_evaluation_report(spark, corpus, trained, folder):
    report = models.evaluate(corpus, trained[0], output=f"{folder}/report").first()
    assert (report.rows, report.roc_auc, report.threshold) == (120, 1.0, trained[0].threshold)
    assert report.examples_per_second > 0
    assert spark.read.json(f"{folder}/report").first().rows == 120
    assert models.evaluate(corpus, trained[0], threshold=0.99).first().threshold == 0.99


def test_python_models_run_in_batches(spark, corpus):
    df = spark.createDataFrame([("abcde",), ("a" * 9,)], "text string")
    rows = models.score_with_python(df, length_model(), "len-v1", batch_size=1).collect()
    assert df.columns == ["text"]
    assert {r.text: round(r.prob_ai, 6) for r in rows} == {"abcde": 0.5, "a" * 9: 0.982014}
    assert {r.model_version for r in rows} == {"len-v1"}


def test_python_models_get_few_texts_at_once(spark):
    df = spark.range(2500, numPartitions=1).selectExpr("cast(id AS string) AS text")
    rows = models.score_with_python(df, lambda: lambda texts: [len(texts)] * len(texts), "v").collect()
    assert sorted({r.prob_ai for r in rows}) == [500, 1000]


def test_sweep_and_both_families(corpus):
    grid = [replace(c, features=1 << 10, iterations=(3,)) for c in models.sweep_grid("smoke")]
    runs = models.sweep(corpus, corpus, corpus, grid)
    board = models.sweep_leaderboard(runs).collect()
    assert {r.family for r in board} == {"char_ngram", "word_ngram"}
    assert len(models.sweep_grid("full")) == 6
    with pytest.raises(ValueError, match="mode"):
        models.sweep_grid("other")
    assert set(models.train_all(corpus, corpus, grid)) == {"char_ngram", "word_ngram"}


def test_trials_with_like_features_share_them(corpus, monkeypatch):
    made, featurize = [], models.featurize
    monkeypatch.setattr(models, "featurize", lambda df, config: made.append(config) or featurize(df, config))
    grid = [replace(QUICK, iterations=(2,), regularization=r, version=f"v{r}") for r in (0.1, 0.001)]
    grid.append(replace(grid[0], features=1 << 9, version="v"))
    shared = [r.asDict() for r in models.sweep(corpus, corpus, corpus, grid).collect()]
    assert [c.version for c in made] == ["v0.1", "v"]
    for config, run in zip(grid, shared):
        alone = models.evaluate(corpus, models.train(corpus, corpus, config)[0]).first().asDict()
        assert {k: v for k, v in alone.items() if "second" not in k} == {k: run[k] for k in alone if "second" not in k}
