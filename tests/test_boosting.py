"""Boosting against a plain version, its two ways against each other, and models as tables."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotcast.operators import boosting, learners
from slotcast.operators.boosting import BINS, Inputs, Settings

WHOLE = {"columnRate": 1.0, "subsamplingRate": 1.0}


def bins_and_target(seed, rows=400, width=4):
    draw = np.random.default_rng(seed)
    bins = np.column_stack([draw.integers(0, 5, rows), *[draw.integers(0, 12, rows) for _ in range(width - 1)]])
    y = 3.0 * (bins[:, 0] % 2) + (bins[:, 1] > 5) * bins[:, 2] + draw.normal(size=rows)
    return bins.astype(np.uint8), y


def plain_splits(bins, slope, least):
    """All splits of a node's rows: (gain, feature, bins that go left)."""
    total = slope.sum() ** 2 / len(slope)
    for f in range(bins.shape[1]):
        values = np.unique(bins[:, f])
        if f == 0:
            order = sorted(values, key=lambda b: (slope[bins[:, f] == b].mean(), b))
            sides = [set(order[:k]) for k in range(1, len(order))]
        else:
            sides = [{b for b in range(t + 1)} - drop for t in range(BINS) for drop in (set(), {0})]
        for side in sides:
            left = np.isin(bins[:, f], list(side))
            if min(left.sum(), (~left).sum()) >= least:
                s = slope[left].sum(), slope[~left].sum()
                yield s[0] ** 2 / left.sum() + s[1] ** 2 / (~left).sum() - total, f, left


def plain_boost(bins, y, settings):
    """Trees that always split the leaf with the most gain, found by trying everything."""
    at = np.full(len(y), boosting.first_value(y, settings.loss))
    for _ in range(settings.rounds):
        slope = np.sign(y - at) if settings.loss == "absolute" else y - at
        leaves = [np.arange(len(y))]
        while len(leaves) < settings.leaves:
            options = [
                (gain, k, own[left], own[~left])
                for k, own in enumerate(leaves)
                for gain, _, left in plain_splits(bins[own], slope[own], settings.leastRows)
            ]
            gain, k, left, right = max(options, key=lambda o: o[0], default=(0, 0, None, None))
            if gain <= 1e-9:
                break
            leaves[k : k + 1] = [left, right]
        step = np.zeros(len(y))
        for own in leaves:
            r = y[own] - at[own]
            step[own] = np.sort(r)[(len(r) - 1) // 2] if settings.loss == "absolute" else r.mean()
        at = at + settings.stepSize * step
    return at


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_rounds_equal_a_plain_version(loss):
    bins, y = bins_and_target(1, rows=160)
    settings = Settings(rounds=4, leaves=6, stepSize=0.5, leastRows=7, loss=loss, **WHOLE)
    base = boosting.first_value(y, loss)
    rows = boosting.TaskRows(bins, y, np.arange(len(y)), np.zeros(len(y), bool), base, settings)
    model = boosting.boost(rows, Inputs("k", [], []), base, settings)
    assert len(model.trees) == 4 and all(sum(f < 0 for f in t.feature) <= 6 for t in model.trees)
    if loss == "squared":
        np.testing.assert_allclose(model.predict(bins), plain_boost(bins, y, settings), atol=1e-9)
    else:  # equal gains of signs may be settled otherwise; the error must not be worse
        plain = np.abs(y - plain_boost(bins, y, settings)).mean()
        assert np.abs(y - model.predict(bins)).mean() <= 1.05 * plain


def test_looking_ahead_gives_the_same_tree():
    bins, y = bins_and_target(2, rows=900)
    settings = Settings(leaves=31, **WHOLE)
    root = boosting._histogram(bins, y)

    def grown(ahead):
        held, tables = {0: np.arange(len(y))}, {0: root}

        def children(asked):
            out = {}
            for node, feature, mask, left, right in asked:
                own = held.pop(node)
                goes = (np.uint64(mask) >> bins[own, feature].astype(np.uint64)) & np.uint64(1) == 1
                held[left], held[right] = own[goes], own[~goes]
                out[left] = boosting._histogram(bins[held[left]], y[held[left]])
                out[right] = tables[node] - out[left]
            tables.update(out)
            return out

        return boosting.compact(boosting.grow(root, children, np.arange(bins.shape[1]), settings, ahead))

    one, all_ = grown(1), grown(63)
    assert sorted(zip(one.feature, one.mask, one.rows)) == sorted(zip(all_.feature, all_.mask, all_.rows))
    assert sum(f < 0 for f in one.feature) == 31


def test_samples_are_drawn_anew_and_hold_their_share():
    settings, draw = Settings(), np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    first, same, other = (boosting._in_sample(draw, k, settings) for k in (0, 4, 5))
    assert (first == same).all() and not (first == other).all()
    assert abs(first.mean() - 0.8) < 0.02


def test_missing_numbers_and_unknown_labels_have_a_bin():
    inputs = Inputs("k", ["a", "b"], ["x"], [[1.0, 2.0]])
    bins = inputs.bins([np.array([0.0, 1, 2, np.nan]), np.array([np.nan, 1.0, 1.5, 9])])
    assert bins.tolist() == [[0, 0], [1, 1], [2, 2], [0, 3]]
    assert boosting.edges_of(np.array([np.nan])) == []
    many = Inputs("k", [str(k) for k in range(200)], [])
    assert many.bins([np.arange(0, 201.0)]).max() < BINS


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.range(700).selectExpr(
        "IF(id % 3 = 0, 'A', 'B') AS region", "IF(id % 11 = 0, NULL, CAST(hash(id) % 50 AS DOUBLE)) AS consommation_lag_24h",
        *[f"CAST(hash(id, {k}) % 9 AS DOUBLE) AS {c}" for k, c in enumerate(learners.NUMBERS[1:])],
        "IF(id % 97 = 0, NULL, CAST(hash(id) % 50 + 20 * (hash(id, 0) % 9) + id % 3 AS DOUBLE)) AS consommation", "id",
    )
    return frame.persist()


def test_tasks_and_spark_passes_give_the_same_model(rows):
    train, val = rows.filter("id < 500"), rows.filter("id >= 500")
    one, _ = learners.fit_gbt(train, val, ["A", "B"], rounds=3, leaves=9)
    two, _ = learners.fit_gbt(train, val, ["A", "B"], rounds=3, leaves=9, task_rows=0)
    for a, b in zip(one.node_rows(), two.node_rows(), strict=True):
        assert a[2:6] == b[2:6] and a[8] == b[8]
        assert a[6] == pytest.approx(b[6]) and (a[7] or 0) == pytest.approx(b[7] or 0)


def test_a_large_histogram_takes_few_bytes_a_row_and_has_the_same_sums(monkeypatch):
    draw = np.random.default_rng(7)
    bins, slope = draw.integers(0, BINS, (100_000, 13)).astype(np.uint8), draw.normal(size=100_000)
    tracemalloc.start()
    large = boosting._histogram(bins, slope)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 40 * len(bins)
    monkeypatch.setattr(boosting, "AT_ONCE", len(bins), raising=False)
    assert np.array_equal(large, boosting._histogram(bins, slope))


def test_the_task_holds_no_column_of_doubles_beside_the_others():
    draw, n = np.random.default_rng(8), 60_000
    inputs = Inputs("region", ["A", "B"], learners.NUMBERS)
    xs = [draw.integers(0, 3, n).astype(float), *[np.where(draw.random(n) < 0.1, np.nan, draw.normal(size=n)) for _ in learners.NUMBERS]]
    y, rank, val = draw.normal(size=n) + xs[0], draw.permutation(n), draw.random(n) < 0.2
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (*xs, y, rank, val)], [*[f"x{k}" for k in range(len(xs))], "y", "draw", "val"])
    settings, order = Settings(rounds=2), np.lexsort((rank, val))
    tracemalloc.start()
    (got,) = boosting._fit_in_task(inputs, settings)(iter([batch.slice(0, 7000), batch.slice(7000)]))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 190 * n
    want = boosting.fit_arrays([c[order] for c in xs], y[order], rank[order], val[order], inputs, settings)
    assert [tuple(r.values()) for r in got.to_pylist()] == want.node_rows()


def test_metrics_of_a_model_score_each_row_once(rows):
    model, _ = learners.fit_gbt(rows, rows.limit(0), ["A", "B"], rounds=1)
    metrics = learners.validation_metrics(model, rows, "consommation")
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_absolute_loss_over_all_tasks(rows):
    train, val = rows.filter("id < 500"), rows.filter("id >= 500")
    one, _ = learners.fit_alt_learner(train, val, ["A", "B"], rounds=2, leaves=5)
    two, _ = learners.fit_alt_learner(train, val, ["A", "B"], rounds=2, leaves=5, task_rows=0)
    assert [t.value for t in one.trees] == [pytest.approx(t.value) for t in two.trees]


def test_a_model_is_a_table(spark, rows, tmp_path):
    model, best = learners.fit_gbt(rows.filter("id < 500"), rows.filter("id >= 500"), ["A", "B"], rounds=5)
    boosting.save(spark, model, f"{tmp_path}/m")
    again = boosting.load(spark, f"{tmp_path}/m")
    assert again.node_rows() == model.node_rows() and len(again.trees) == best
    kept = learners.score(model, rows).select("predicted_mw").collect()
    assert learners.score(again, rows).select("predicted_mw").collect() == kept
    gains = boosting.node_table(spark, model).filter("feature IS NOT NULL").groupBy("feature").agg(F.sum("gain")).collect()
    total = sum(g for _, g in gains)
    for name, share in learners.feature_importance(model):
        assert share == pytest.approx(dict(gains).get(name, 0.0) / total)


def test_scoring_equals_a_walk_over_the_node_table(spark, rows):
    """Each row goes from the roots down by a join with the table, level by level."""
    model, _ = learners.fit_gbt(rows.filter("id < 500"), rows.filter("id >= 500"), ["A", "B"], rounds=4, leaves=7)
    names = model.inputs.names
    bins = model.inputs.bins([np.array(c) for c in zip(*rows.select(*model.inputs.columns()).fillna(float("nan")).collect())])
    table = boosting.node_table(spark, model).filter("tree >= 0").drop("head")
    flat = spark.createDataFrame(
        [(k, names[f], int(b)) for k, row in enumerate(bins.tolist()) for f, b in enumerate(row)], "row int, feature string, bin int"
    )
    at = flat.select("row").distinct().join(table.select("tree").distinct()).withColumn("node", F.lit(0))
    for _ in range(7):
        step = at.join(table, ["tree", "node"]).join(flat, ["row", "feature"], "left")
        bit = F.expr("shiftrightunsigned(mask, bin) & 1")
        at = step.select("row", "tree", F.coalesce(F.when(bit == 1, F.col("left")).otherwise(F.col("right")), "node").alias("node"))
    sums = at.join(table, ["tree", "node"]).groupBy("row").agg(F.sum("value").alias("v")).collect()
    got = [r.predicted_mw for r in learners.score(model, rows).collect()]
    for r in sums:
        assert got[r["row"]] == pytest.approx(model.base + r.v)


def test_no_target_is_an_error_and_no_validation_keeps_all_rounds(rows):
    with pytest.raises(ValueError):
        learners.fit_gbt(rows.filter("consommation IS NULL"), rows, ["A"])
    model, best = learners.fit_gbt(rows, rows.limit(0), ["A", "B"], rounds=3)
    assert best == 3 == len(model.trees)


def test_permutation_is_one_of_the_whole_sample(spark):
    sample = spark.range(500).selectExpr("id", "CAST(id AS DOUBLE) AS a", "id % 7 AS b", "1D AS target")
    out = learners.permuted(sample, ["id"], ["a", "b"], repeats=2, seed=3)
    for trial in out.select("_trial").distinct().collect():
        part = out.filter((F.col("_trial.feature") == trial[0].feature) & (F.col("_trial.repeat") == trial[0]["repeat"])).collect()
        assert sorted(r.id for r in part) == list(range(500))
        if trial[0].feature == "a":
            assert sorted(r.a for r in part) == list(range(500)) and all(r.b == r.id % 7 for r in part)
            # One cycle through all rows: no row is reached twice before the last.
            after, at = {r.id: int(r.a) for r in part}, 0
            for steps in range(1, 501):
                at = after[at]
                if at == 0:
                    break
            assert steps == 500


def test_importance_of_any_scorer(spark):
    val = spark.range(300).selectExpr("id", "CAST(id AS DOUBLE) AS a", "1D AS b", "CAST(id AS DOUBLE) AS y")
    linear = lambda model, frame: frame.withColumn("predicted_mw", F.col("a"))
    out = learners.permutation_importance(None, val, ["id"], "y", ["a", "b"], repeats=3, fraction=1.0, score_with=linear)
    rows = {r.feature: r for r in out.collect()}
    assert rows["b"].importance == 0 and 80 < rows["a"].importance < 120
