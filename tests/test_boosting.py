"""Boosted trees against a plain form that splits one leaf at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgauge.catalog import learning
from landgauge.operators import boosting
from landgauge.operators.boosting import BoostedTrees


def frame(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = np.sin(2 * x[:, 0]) + x[:, 1] ** 2 + rng.normal(0, 0.1, n)
    gaps = rng.random((n, 3)) < 0.1
    y[gaps[:, 0]] += 1.5
    rows = [
        (*[None if g else float(v) for v, g in zip(r, m)], float(t), bool(w))
        for r, m, t, w in zip(x, gaps, y, rng.random(n) < 0.25)
    ]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, y double, v boolean").repartition(5)


def plain_tree(x, rest, leaves, depth, rate, least_rows):
    """(rows, value) of each leaf: the leaf of largest gain is split, one by one."""
    bins = x.max() + 1

    def gain_of(rows):
        best = (1e-12, None)
        total, n = rest[rows].sum(), len(rows)
        for f in range(x.shape[1]):
            for gap_left in (False, True):
                for b in range(1, bins):
                    v = x[rows, f]
                    left = np.where(v == 0, gap_left, v <= b)
                    k = left.sum()
                    if k >= least_rows and n - k >= least_rows:
                        s = rest[rows][left].sum()
                        gain = s**2 / k + (total - s) ** 2 / (n - k) - total**2 / n
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, left)
        return best

    first = np.arange(len(x))
    held = [(first, 0, *gain_of(first))]
    while len(held) < leaves:
        options = [i for i, h in enumerate(held) if h[3] is not None and (depth is None or h[1] < depth)]
        if not options:
            break
        rows, at, _, left = held.pop(max(options, key=lambda i: held[i][2]))
        held += [(part, at + 1, *gain_of(part)) for part in (rows[left], rows[~left])]
    return [(rows, rate * rest[rows].mean()) for rows, *_ in held]


@pytest.mark.parametrize("leaves, depth", [(2, None), (9, None), (12, 3)])
def test_trees_equal_those_grown_leaf_by_leaf(spark, leaves, depth, monkeypatch):
    monkeypatch.setattr(boosting, "RENEWED", 2)
    monkeypatch.setattr(boosting, "FAN_IN", 2)  # histograms are added up in several rounds
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    rows, df = frame(spark, 500, 1)
    model = BoostedTrees.fit(df, ["a", "b", "c"], "y", trees=5, leaves=leaves, depth=depth, rate=0.3, max_bins=16, least_rows=10)
    v = np.array([[np.nan if x is None else x for x in r[:3]] for r in rows])
    x = np.stack([np.where(np.isnan(c), 0, np.searchsorted(e, c) + 1) for c, e in zip(v.T, model.edges)], axis=1)
    y = np.array([r[3] for r in rows])
    want = np.full(len(y), y.mean())
    for _ in range(5):
        for part, value in plain_tree(x, y - want, leaves, depth, 0.3, 10):
            want[part] += value
    got = {(r.a, r.b, r.c, r.y): r.p for r in model.transform(df, "p").collect()}
    assert np.allclose([got[r[:4]] for r in rows], want)
    assert all(sum(f < 0 for f in t.feature) <= leaves for t in model.trees)
    assert sum(n for _, _, n in model.importances()) == sum(sum(f >= 0 for f in t.feature) for t in model.trees)


def test_stops_when_the_validation_rows_gain_no_more(spark, tmp_path):
    _, df = frame(spark, 600, 2)
    fitted = BoostedTrees.fit(df, ["a", "b", "c"], "y", "v", trees=200, leaves=31, rate=0.5, patience=5, least_rows=2)
    best = int(np.argmin(fitted.history))
    assert len(fitted.trees) == best and len(fitted.history) == best + 6 < 200
    scored = fitted.transform(df.where("v"), "p").selectExpr("sqrt(avg((y - p) * (y - p))) e").first().e
    assert scored == pytest.approx(min(fitted.history))
    fitted.save(spark, str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    key = lambda m: sorted(map(str, m.transform(df, "p").collect()))
    assert key(again) == key(fitted)


def test_odd_rows(spark):
    """No rows, one row, a feature without values, a constant target, rows without target."""
    kind = "a double, b double, y double"
    for rows in ([], [(1.0, None, 3.0)], [(float(i), None, 3.0) for i in range(50)], [(1.0, None, None)]):
        df = spark.createDataFrame(rows, kind)
        fitted = BoostedTrees.fit(df, ["a", "b"], "y", trees=3)
        assert fitted.trees == [] and fitted.start == (3.0 if rows and rows[0][2] else 0.0)
        assert [r.p for r in fitted.transform(df, "p").collect()] == [fitted.start] * len(rows)


def test_a_finished_tree_is_walked_once(spark):
    """The blocks hold the predictions of all trees, so that no later job walks the trees before."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 6, (3, 200)).astype(np.uint8), rng.normal(size=200)
    one = (x.tobytes(), y.tobytes(), np.ones(200, bool).tobytes(), np.zeros(200).tobytes())
    fit = boosting.Boosting(spark.createDataFrame([one], boosting.BLOCKS).persist(), 3, 7, 1)
    want = np.zeros(200)
    for _ in range(3):
        tree, _ = fit.grow(6, None, 0.5, 5)
        fit.keep(tree)
        want += tree.values_of(x.T)
        assert np.allclose(np.frombuffer(fit.blocks.first().base), want)
    assert np.square(y - want).sum() < np.square(y).sum()
    fit.close()


def test_rows_are_computed_once_for_a_fit(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counting(v):
        made.add(1)
        return v

    rows = frame(spark, 900, 3)[1]
    counted = F.udf(counting, "double").asNondeterministic()  # so that it stays where it is
    model = BoostedTrees.fit(rows.withColumn("y", counted("y")), ["a", "b", "c"], "y", trees=2, leaves=4)
    assert len(model.trees) == 2 and made.value == 900


def test_a_prediction_asks_for_its_features_only(spark):
    rows = frame(spark, 600, 3)[1]
    model = BoostedTrees.fit(rows, ["a"], "y", trees=1, leaves=3)
    wide = rows.withColumn("text", F.regexp_replace(F.col("y").cast("string"), "1", "2"))
    found = model.transform(wide, "p")
    assert found.columns == [*wide.columns, "p"]
    assert "regexp_replace" not in found.select("p")._jdf.queryExecution().executedPlan().toString()
    assert found.where("p is null").count() == 0


@pytest.mark.parametrize("watched", [None, "v"])
def test_one_task_grows_the_trees_that_jobs_grow(spark, monkeypatch, watched):
    rows = frame(spark, 800, 5)[1]
    asked = dict(trees=12, leaves=9, depth=4, rate=0.4, patience=3 if watched else None, max_bins=30, least_rows=7)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 90)
    fitted = []
    for most in (0, boosting.ONE_TASK_BYTES):
        monkeypatch.setattr(boosting, "ONE_TASK_BYTES", most)
        fitted.append(BoostedTrees.fit(rows, ["a", "b", "c"], "y", watched, **asked))
    by_jobs, alone = fitted
    assert len(by_jobs.trees) == len(alone.trees) > 3 and np.allclose(by_jobs.history, alone.history)
    for a, b in zip(by_jobs.trees, alone.trees):
        assert a.feature == b.feature and a.bin == b.bin  # a node without missing values may send them either way
        assert np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain)


def test_rows_in_one_task_need_no_jobs_for_their_trees(spark, monkeypatch):
    def none(*_):
        raise AssertionError("a job for a few rows")

    monkeypatch.setattr(boosting.Boosting, "histograms", none)
    assert len(BoostedTrees.fit(frame(spark, 300, 6)[1], ["a", "b"], "y", trees=5, leaves=4).trees) == 5


def test_valuation_asks_for_the_whole_model(spark, monkeypatch):
    """As many trees, at the rate and with the patience of the function, not a few large steps."""
    names = ["row_id", "umdNm", "houseType"]
    numbers = ["subway_dist", "parking_ratio", "buildYear", "has_elevator", "total_floors", "floor", "excluUseAr", "landAr", "Age", "land_index", "Price_per_m2_log"]
    rows = [(*[f"{c}{i % 9 if c != 'row_id' else i}" for c in names], *[float(i % 13 + 1)] * len(numbers)) for i in range(60)]
    monkeypatch.setattr(learning, "priced", lambda *_: spark.createDataFrame(rows, [*names, *numbers]).withColumn("split", F.lit("train")))
    asked = []

    def fit(*args, **params):
        asked.append(params)
        raise InterruptedError

    monkeypatch.setattr(BoostedTrees, "fit", fit)
    with pytest.raises(InterruptedError):
        learning.valuation(spark, "no tables")
    assert asked == [dict(trees=2_000, leaves=64, depth=10, rate=0.05, patience=50)]
