"""The forest over key slots: its trees against a plain recursive one, and the
same forest whether nodes are split over all tasks or in a group of their own."""

import numpy as np
from pyspark.sql import functions as F

from aerolith.operators import forest as FO
from aerolith.operators import ml as ML


def _rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 30, n), rng.integers(0, 5, n)], axis=1).astype(np.int32)
    y = x[:, 0] * 2.0 + (x[:, 2] == 7) * 30 + (x[:, 3] == 1) * x[:, 1] + rng.normal(0, 1, n)
    return x, rng.integers(1, 4, n), y


def _plain(x, w, y, depth, numeric):
    """Value of every row by a recursive tree that tries each split."""
    out = np.full(len(y), np.average(y, weights=w))
    best = (1e-9, None)
    for f in ([*range(numeric, x.shape[1]), *range(numeric)] if depth < FO.MAX_DEPTH else ()):
        for c in np.unique(x[:, f]):
            left = x[:, f] <= c if f < numeric else x[:, f] == c
            if min(w[left].sum(), w[~left].sum()) < FO.MIN_LEAF:
                continue
            error = sum((w[k] * (y[k] - np.average(y[k], weights=w[k])) ** 2).sum() for k in (left, ~left))
            gain = (w * (y - out) ** 2).sum() - error
            if gain > best[0] + 1e-9:
                best = (gain, left)
    if best[1] is not None:
        for k in (best[1], ~best[1]):
            out[k] = _plain(x[k], w[k], y[k], depth + 1, numeric)
    return out


def test_a_tree_equals_a_plain_recursive_one():
    x, w, y = _rows()
    nodes = FO.grow(x, w, y, 0, [6, 4])
    got = nodes["value"][FO.descend(nodes, np.zeros(len(y), np.int64), x, 2)]
    assert np.allclose(got, _plain(x, w, y, 0, 2))
    assert len(nodes) > 100


def test_bootstrap_weights_are_poisson():
    w = np.concatenate([FO.draws(np.arange(20_000), t, 42) for t in range(5)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def _frame(spark, n, sensors):
    f = spark.range(n).select(
        (F.col("id") * 7 % sensors).alias("source_sensor_id"), (F.col("id") * 7 % sensors % 50).alias("source_location_id"),
        *[(F.xxhash64("id", F.lit(c)) % 97 + 97).cast("double").alias(c) for c in ML.NUMERIC])
    return f.withColumn(ML.LABEL, F.col("current_value") + (F.col("source_sensor_id") % 5) * 20 + F.col("hour") / 10)


def test_top_levels_do_not_change_the_forest(spark, monkeypatch):
    monkeypatch.setattr(FO, "LOCAL_ROWS", 300)  # scoring takes several slices
    train = _frame(spark, 1000, 40)
    prep = ML.Pipeline(stages=[s for s in ML.pipeline("random-forest").getStages()[:-2]
                               if not isinstance(s, ML.OneHotEncoder)]).fit(train)
    fit = lambda local: FO.fit(train, prep, "__num_scaled", [f"{c}__idx" for c in ML.CATEGORICAL], ML.LABEL, 42, 4, local)
    whole, split = fit(10_000), fit(300)
    assert len(whole.top) == 4 < len(split.top)
    test = train.withColumn("n", F.xxhash64(*train.columns))
    a, b = ({r.n: r.prediction for r in m.transform(test).collect()} for m in (whole, split))
    assert a.keys() == b.keys() and len(a) == 1000
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_unseen_and_null_keys_are_scored_and_files_keep_the_forest(spark, tmp_path):
    train = _frame(spark, 500, 20)
    prep = ML.Pipeline(stages=[s for s in ML.pipeline("random-forest").getStages()[:-2]
                               if not isinstance(s, ML.OneHotEncoder)]).fit(train)
    model = FO.fit(train, prep, "__num_scaled", [f"{c}__idx" for c in ML.CATEGORICAL], ML.LABEL, 42, 3)
    test = train.limit(30).withColumn("source_sensor_id", F.when(F.col("source_sensor_id") > 5, F.lit(None)).otherwise(F.lit(10 ** 9)))
    model.save(str(tmp_path / "f"))
    again = FO.Forest.load(spark, str(tmp_path / "f"))
    rows = [sorted(r.prediction for r in m.transform(test).collect()) for m in (model, again)]
    assert len(rows[0]) == 30 and rows[0] == rows[1]
    assert model.transform(test.limit(0)).count() == 0


def test_work_follows_the_rows_not_the_keys(spark):
    """3,000 sensors: Spark's forest held statistics of every key for every node."""
    train = _frame(spark, 6000, 3000)
    model = ML.fit_model("random-forest", train)
    assert isinstance(model, FO.Forest) and model.trees == FO.TREES == 200
    assert model.transform(train.limit(10)).count() == 10


def test_counting_the_smaller_part_gives_the_same_tree(monkeypatch):
    """Nodes split one by one, the larger part counted by what the smaller leaves."""
    x, w, y = _rows(3000, 5)
    w[::3] = 0
    trees = []
    for large in (10 ** 9, 100, 1):
        monkeypatch.setattr(FO, "LARGE_ROWS", large)
        nodes = FO.grow(x, w, y, 0, [6, 4])
        trees.append(nodes["value"][FO.descend(nodes, np.zeros(len(y), np.int64), x, 2)])
    assert np.allclose(trees[0], trees[1], atol=1e-9) and np.allclose(trees[0], trees[2], atol=1e-9)
    assert np.allclose(trees[0][w > 0], _plain(x[w > 0], w[w > 0], y[w > 0], 0, 2))


def test_rows_are_counted_once_while_keys_are_split_off(monkeypatch):
    """Each split takes one key's few rows away: the rest was counted anew at every level."""
    rng = np.random.default_rng(1)
    n = 40_000
    x = np.stack([rng.integers(0, 32, n), rng.integers(0, 8000, n)], axis=1).astype(np.int32)
    y = np.zeros(n)
    for key in range(20):
        y[x[:, 1] == key] = 1000.0 * (key + 1)
    counted = []
    count = FO._Large.count
    monkeypatch.setattr(FO._Large, "count", lambda self, *a: counted.append(len(self.rows)) or count(self, *a))
    nodes = FO.grow(x, np.ones(n, np.int64), y, 0, [32])
    assert len(nodes) == 41 and sum(counted) < 5 * n


def test_rows_are_sent_once_to_a_group_of_trees(spark):
    numbers = FO._spread(spark, 24)
    parts = spark.createDataFrame([(n,) for n in numbers], "grp long").repartition(24, "grp").select(F.spark_partition_id()).collect()
    assert len({r[0] for r in parts}) == 24
