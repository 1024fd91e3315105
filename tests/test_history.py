import pytest

from labelloom.operators import history

COLUMNS = "epoch int, train_loss double, val_loss double, roc_auc double, pr_auc double, precision double, recall double, f1 double, note string"


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [
            (1, 0.9, 0.8, 0.7, 0.6, 0.5, 0.5, 0.5, "a"),
            (2, 0.7, 0.5, 0.9, 0.6, 0.6, 0.5, 0.5, "b"),
            (3, 0.5, 0.6, 0.9, None, 0.7, 0.5, 0.6, "c"),
        ],
        COLUMNS,
    )


@pytest.mark.parametrize(
    ("monitor", "mode", "epoch"),
    [
        ("val_roc_auc", "max", 2),  # the first of equals
        ("val_loss", "min", 2),
        ("val_loss_epoch", "min", 2),
        ("train_loss", "min", 3),
        ("val_pr_auc", "max", 1),  # an epoch without the metric is passed over
        ("unknown", "max", 3),
        ("note", "max", 3),
    ],
)
def test_best_epoch(records, monitor, mode, epoch):
    assert [r.epoch for r in history.best_epoch(records, monitor, mode).collect()] == [epoch]


def test_best_epoch_without_values_or_rows(records):
    empty_metric = records.selectExpr("epoch", "cast(null as double) f1")
    assert history.best_epoch(empty_metric, "val_f1").first().epoch == 3
    assert history.best_epoch(records.where("false"), "val_f1").collect() == []


def test_epoch_loss_weights_batches(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 32), (1, 2.0, 8), (2, 0.5, 32)], "epoch int, loss double, batch_size int"
    )
    assert {r.epoch: r.loss for r in history.epoch_loss(df).collect()} == {1: 1.2, 2: 0.5}


def test_series_skip_missing_values(records):
    points = history.training_series(records).collect()
    assert len(points) == 3 * 7 - 1
    assert {(p.series, p.metric) for p in points if p.series == "loss"} == {
        ("loss", "train_loss"),
        ("loss", "val_loss"),
    }


def test_loggable_metrics_are_numeric_and_present(spark):
    df = spark.createDataFrame([(0.5, None, 3, "x")], "f1 double, roc_auc double, true_positive int, name string")
    logged = {r.metric: r.value for r in history.loggable_metrics(df).collect()}
    assert logged == {"val_f1": 0.5, "val_true_positive": 3.0}


def test_leaderboard_over_published_results(spark):
    """The seven published runs: per family the best of each metric, the least Brier score."""
    rows = [
        ("transformer", "a", 0.99968, 0.99968, 0.98925, 0.98194, 0.99667, 0.00868),
        ("transformer", "b", 0.99959, 0.99959, 0.98903, 0.98608, 0.99200, 0.00817),
        ("transformer", "c", 0.99958, 0.99958, 0.98838, 0.98414, 0.99267, 0.00841),
        ("transformer", "d", 0.98510, 0.98427, 0.93770, 0.90895, 0.96833, 0.04600),
        ("char", "e", 0.97542, 0.97345, 0.91775, 0.89562, 0.94100, 0.06522),
        ("char", "f", 0.97213, 0.96966, 0.91186, 0.87079, 0.95700, 0.06784),
        ("char", "g", 0.97201, 0.96997, 0.91102, 0.88056, 0.94367, 0.06495),
    ]
    columns = "family string, run string, roc_auc double, pr_auc double, f1 double, precision double, recall double, brier_score double"
    board = {
        (r.family, r.metric): (r.run, r.value)
        for r in history.leaderboard(spark.createDataFrame(rows, columns)).collect()
    }
    assert len(board) == 12
    assert board["transformer", "roc_auc"] == ("a", 0.99968)
    assert board["transformer", "brier_score"] == ("b", 0.00817)
    assert board["char", "recall"] == ("f", 0.957)
    assert board["char", "brier_score"] == ("g", 0.06495)
