"""Training by epochs: against numpy, resumed, and whatever the partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavesgrid.operators import epochs as E


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] > 0.3).astype(int) + (x[:, 1] > 0.5)
    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(400)] + [(900, None, 1), (901, [0.0, 0.0, 0.0], None)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int"), x, y


def test_full_batches_against_numpy(points, tmp_path):
    df, x, y = points
    got = E.train_by_epochs(df, "id", str(tmp_path / "a"), 3, 5, rate=lambda e: 0.5 / (e + 1), parts=40).orderBy("epoch").collect()
    a, w = np.column_stack([x, np.ones(400)]), np.zeros((3, 4))
    for row in got:
        p = E.softmax(a @ w.T)
        assert row["loss"] == pytest.approx(-np.log(p[np.arange(400), y]).mean()) and row["n"] == 400
        w = w - 0.5 / (row["epoch"] + 1) * (p - np.eye(3)[y]).T @ a / 400
        np.testing.assert_allclose(row["weights"], w.ravel(), atol=1e-12)
    losses = [r["loss"] for r in got]
    assert losses == sorted(losses, reverse=True) and [r["rate"] for r in got] == [0.5 / (e + 1) for e in range(5)]


def test_resumed_run_equals_an_unbroken_one(points, tmp_path):
    df, x, y = points
    args = dict(n_classes=3, batches=3, rate=lambda e: 0.8, parts=20)
    whole = E.train_by_epochs(df, "id", str(tmp_path / "w"), epochs=6, **args).orderBy("epoch").collect()
    E.train_by_epochs(df.repartition(7), "id", str(tmp_path / "r"), epochs=3, **args)
    resumed = E.train_by_epochs(df.orderBy(F.desc("id")), "id", str(tmp_path / "r"), epochs=6, initial_epoch=3, **args).orderBy("epoch").collect()
    assert [tuple(r) for r in whole] == [tuple(r) for r in resumed]  # to the last bit
    judged = E.predict(df.where("label is not null"), whole[-1]["weights"], 3).select("label", "probs").collect()
    right = [np.argmax(r["probs"]) == r["label"] for r in judged if r["probs"] is not None]
    assert np.mean(right) > np.bincount(y).max() / 400 + 0.1 and all(abs(sum(r["probs"]) - 1) < 1e-9 for r in judged if r["probs"])


def test_bad_input(points, spark, tmp_path):
    df, *_ = points
    with pytest.raises(ValueError, match="initial_epoch"):
        E.train_by_epochs(df, "id", str(tmp_path), 3, epochs=2, initial_epoch=3)
    with pytest.raises(ValueError, match="one length"):
        E.train_by_epochs(df.limit(0), "id", str(tmp_path), 3, epochs=2)
