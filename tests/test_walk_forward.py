"""Learned walk-forward: folds, ledger, going on after a break, folds beyond a task's rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.functions.ranks import ranked
from slotcast.grid import Grid
from slotcast.operators import learners, training
from slotcast.plans import backtest, walk_forward
from slotcast.sources import dimensions
from slotcast.store import Store

HOURLY = Grid(step=3600)
LABELS = ["A", "B"]
FEW = {"rounds": 4, "leaves": 7}


@pytest.fixture(scope="module")
def frame(spark):
    """25 days of two hourly series with every input."""
    inputs = [f"CAST(hash(h, region, {k}) % 40 AS DOUBLE) AS {c}" for k, c in enumerate(learners.NUMBERS)]
    return spark.sql(
        f"""SELECT timestamp'2024-01-01' + make_dt_interval(0, h) AS date_heure, region, {', '.join(inputs)},
        500D + 10 * (h % 24) + hash(h, region, 0) % 40 AS consommation
        FROM (SELECT explode(sequence(0, 599)) AS h), (SELECT explode(array('A', 'B')) AS region)"""
    ).persist()


@pytest.fixture(scope="module")
def slots(frame):
    """One day's slots for each forecast day, with the inputs of the day before."""
    return frame.drop("consommation").select(
        (F.col("date_heure") + F.expr("INTERVAL 1 DAY")).alias("forecast_horizon_dt"),
        F.to_date(F.col("date_heure") + F.expr("INTERVAL 1 DAY")).alias("forecast_date"),
        (F.date_trunc("day", "date_heure") + F.expr("INTERVAL 29 HOUR")).alias("anchor"), "region", *learners.NUMBERS,
    )


def run(spark, root, frame, slots, first, last, **options):
    store = Store(spark, str(root))
    days = walk_forward.walk_forward(
        store, frame, slots, frame, HOURLY, LABELS, first, last, name="t", **FEW, **options
    )
    return store, days


def predictions(store):
    return sorted((r.forecast_horizon_dt, r.region, r.predicted_mw, r.model_version) for r in store.read("predictions").collect())


def test_every_day_is_fitted_as_on_its_own(spark, frame, slots, tmp_path):
    store, days = run(spark, tmp_path, frame, slots, "2024-01-04", "2024-01-09")
    ledger = {str(r.forecast_date): r for r in walk_forward.read_ledger(spark, store.root).collect()}
    assert days == [f"2024-01-{d:02d}" for d in range(4, 10)]
    # 01:00 UTC is two o'clock; 24 h before it, 6 January knows 97 hours of two series, six rows too few.
    assert sorted(ledger) == [f"2024-01-{d:02d}" for d in range(7, 10)]
    day = ledger["2024-01-08"]
    own = frame.filter("date_heure < timestamp'2024-01-07 01:00:00'").persist()
    split = training.time_split(own, "date_heure")
    train, val = (split.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
    assert (day.n_train, day.n_val) == (train.count(), val.count())
    model, best = learners.fit_gbt(train, val, LABELS, subsamplingRate=1.0, **FEW)
    facts = learners.validation_metrics(model, val, "consommation").first()
    assert day.best_iteration <= 4 and abs(day.val_mae_mw - facts.mae) < 0.3 * facts.mae
    kept = walk_forward.load_model(spark, store.root, day.run_id)
    wanted = slots.filter("forecast_date = date'2024-01-08'")
    scored = {(r.forecast_horizon_dt, r.region): r.predicted_mw for r in learners.score(kept, wanted).collect()}
    got = store.read("predictions").filter("forecast_date = date'2024-01-08'").collect()
    assert len(got) == 48 and all(r.model_version == day.run_id for r in got)
    assert all(scored[r.forecast_horizon_dt, r.region] == pytest.approx(r.predicted_mw) for r in got)


def test_a_broken_run_goes_on_with_the_open_days(spark, frame, slots, tmp_path, monkeypatch):
    whole, _ = run(spark, tmp_path / "whole", frame, slots, "2024-01-07", "2024-01-11")
    keep, calls = walk_forward._keep, []

    def broken(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return keep(*args)

    monkeypatch.setattr(walk_forward, "_keep", broken)
    with pytest.raises(RuntimeError):
        run(spark, tmp_path / "part", frame, slots, "2024-01-07", "2024-01-11", days_per_job=2)
    monkeypatch.setattr(walk_forward, "_keep", keep)
    part, days = run(spark, tmp_path / "part", frame, slots, "2024-01-07", "2024-01-11", days_per_job=2)
    assert days == ["2024-01-09", "2024-01-10", "2024-01-11"]
    assert predictions(part) == predictions(whole)
    assert walk_forward.read_ledger(spark, part.root).count() == 5
    assert run(spark, tmp_path / "part", frame, slots, "2024-01-07", "2024-01-11")[1] == []


def test_folds_beyond_a_task_are_fitted_over_all_tasks(spark, frame, slots, tmp_path):
    small, _ = run(spark, tmp_path / "small", frame, slots, "2024-01-08", "2024-01-08", subsamplingRate=1.0)
    cut = walk_forward.Folds(task_rows=100)
    large, _ = run(spark, tmp_path / "large", frame, slots, "2024-01-08", "2024-01-08", subsamplingRate=1.0, cut=cut)
    one, two = predictions(small), predictions(large)
    assert [r[:2] for r in one] == [r[:2] for r in two]
    np.testing.assert_allclose([r[2] for r in one], [r[2] for r in two])
    a, b = (walk_forward.read_ledger(spark, s.root).first() for s in (small, large))
    assert (a.n_train, a.n_val, a.best_iteration) == (b.n_train, b.n_val, b.best_iteration)
    assert a.val_mae_mw == pytest.approx(b.val_mae_mw)


def test_fold_rows_are_those_of_the_summary(spark, frame):
    named = frame.withColumn("consommation_lag_24h", F.col("consommation_lag_24h"))
    summary = backtest.fold_summary(named, HOURLY, "2024-01-03", "2024-01-30", "consommation_lag_24h", lookback_days=5)
    folds = backtest.fold_days(frame, "2024-01-03", "2024-01-30", HOURLY.tz)
    counts = walk_forward.fold_rows(frame, folds, HOURLY, walk_forward.Folds(lookback_days=5)).groupBy("forecast_date").count()
    want = {r.forecast_date: r.n_rows for r in summary.collect()}
    assert {r.forecast_date: r["count"] for r in counts.collect()} == want


def test_ranks_of_many_keys(spark):
    keys = spark.range(1_000_000).selectExpr("lpad(CAST(id * 7919 % 1000000 AS STRING), 7, '0') AS k")
    out = ranked(keys, ["k"])
    assert out.filter("rank <> CAST(k AS BIGINT)").count() == 0 and out.count() == 1_000_000
    assert ranked(keys.limit(0), ["k"]).count() == 0


def test_category_index_has_no_global_window(spark):
    out = dimensions.category_index(spark.createDataFrame([("b",), ("a",), ("b",), ("é",)], "region string"), "region")
    assert sorted(out.collect()) == [("a", 0), ("b", 1), ("é", 2)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
