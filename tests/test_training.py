"""Exact split, data-parallel training and the decision on a model."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import model, training

NAMES = ["a", "b", "c", "d"]


def normal_rows(spark, n=4000):
    rng = np.random.default_rng(1)
    z = rng.normal(size=(n, 2))
    x = np.column_stack([z[:, 0], 2 * z[:, 0] + 0.1 * rng.normal(size=n), z[:, 1], z[:, 0] - z[:, 1] + 0.1 * rng.normal(size=n)]) * [1, 3, 10, 5] + [0, 7, 100, -4]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(5)


@pytest.mark.parametrize(("n", "keys"), [(0, 1), (1, 1), (7, 7), (1000, 1000), (1000, 3), (999, 1)])
def test_sizes_are_exact(spark, n, keys):
    df = spark.range(n).select((F.col("id") % keys).alias("key"), F.col("id").alias("other"), F.lit("x").alias("_x")).repartition(3)
    got = training.exact_split(df, "key")
    counts = {r.part: r["count"] for r in got.groupBy("part").count().collect()}
    want = [int(n * 0.7), int(n * 0.85) - int(n * 0.7), n - int(n * 0.85)]
    assert [counts.get(i, 0) for i in range(3)] == want and got.columns == ["key", "other", "_x", "part"]
    assert got.select("other").distinct().count() == n


def test_values_at_ranks(spark):
    rng = np.random.default_rng(2)
    x = np.sort(rng.choice(2**60, 500).tolist() + [5] * 300 + [0, 2**60 - 1])
    df = spark.createDataFrame([(int(v),) for v in x], "v long").repartition(4)
    ranks = [0, 1, 299, 301, 400, 801]
    assert training.value_at_ranks(df, "v", ranks, 60) == [(int(x[r]), int((x < x[r]).sum())) for r in ranks]


def test_gradient_is_the_slope():
    net = training.Net([4, 3, 2, 4])
    p, x = net.start(0), np.random.default_rng(0).normal(size=(20, 4))
    _, slope = net.loss(p, x, True)
    for i in range(len(p)):
        e = np.zeros(len(p))
        e[i] = 1e-6
        assert abs((net.loss(p + e, x, False)[0] - net.loss(p - e, x, False)[0]) / 2e-6 - slope[i]) < 1e-4


def test_parallel_training_is_as_good_as_on_the_driver(spark):
    df = training.exact_split(normal_rows(spark), "id").withColumn("c", F.when(F.col("id") % 500 == 3, None).otherwise(F.col("c"))).cache()
    own, loss = training.train_parallel(df, NAMES, hidden=(3, 2, 3), steps=80)
    plain = model.train(df.na.drop(), NAMES, hidden=(3, 2, 3), epochs=60)
    check = lambda m: model.score(df.na.drop().filter("part = 1"), m, NAMES).agg(F.avg("error")).first()[0]
    assert abs(check(own) - loss) < 1e-9 * max(1, loss)
    assert loss <= 1.01 * check(plain)
    again, same = training.train_parallel(df.repartition(7), NAMES, hidden=(3, 2, 3), steps=5)
    other, loss5 = training.train_parallel(df.coalesce(1), NAMES, hidden=(3, 2, 3), steps=5)
    assert abs(same - loss5) < 1e-6 * loss5
    with pytest.raises(ValueError, match="at least"):
        training.train_parallel(df.filter("id < 50"), NAMES)


def test_decision_and_packages_of_two_files(spark, tmp_path):
    df = training.exact_split(normal_rows(spark), "id")
    own, _ = training.train_parallel(df, NAMES, hidden=(3, 2, 3), steps=40, version="v0")
    tests = df.filter("part = 2").select(*NAMES, F.lit(0).alias("label"), F.lit(None).cast("string").alias("detector"), F.lit(None).cast("string").alias("kind"))
    bad = tests.limit(60).withColumns({"b": F.col("b") + 500, "label": F.lit(1), "detector": F.lit("autoencoder"), "kind": F.lit("offset")})
    missed = tests.limit(40).withColumns({"label": F.lit(1), "detector": F.lit("other"), "kind": F.lit("")})
    found, figures = training.judged(own, tests.union(bad).union(missed), NAMES)
    assert figures["autoencoder_anomaly_recall"] == 1.0 and figures["recall_by_anomaly_type"]["offset"] == 1.0 and "unknown" in figures["recall_by_anomaly_type"]
    assert found.validated == (figures["test_normal_candidate_rate"] <= 0.02)
    assert not training.judged(own, tests, NAMES)[0].validated  # no anomalies to be found
    path = str(tmp_path / "package")
    found.save_folder(path, "2024-05-01T00:00:00+00:00", figures)
    read = model.Autoencoder.load(path, NAMES)
    assert read.package_id == "v0:2024-05-01T00:00:00+00:00" and read.validated == found.validated and read.layers == found.layers and list(read.field_thresholds) == list(found.field_thresholds)
    with pytest.raises(ValueError, match="order"):
        model.Autoencoder.load(path, NAMES[::-1])
    meta = json.loads((tmp_path / "package" / "metadata.json").read_text())
    del meta["iqr"]
    (tmp_path / "package" / "metadata.json").write_text(json.dumps(meta))
    with pytest.raises(ValueError, match="incomplete"):
        model.Autoencoder.load(path)
