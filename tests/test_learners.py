from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slotcast.operators import boosting, learners, training
from slotcast.plans import training_job
from slotcast.schemas import MODEL_FEATURES

LABELS = ["A", "B"]
SMALL = {"rounds": 8, "maxDepth": 4, "stepSize": 0.3}


@pytest.fixture(scope="module")
def frame(spark):
    """Seasonal series whose value depends on the hour, the lag and the key."""
    return spark.sql(
        """SELECT timestamp'2024-01-01' + make_dt_interval(0, h) AS date_heure, region,
        100 + 10 * (h % 24) + IF(region = 'A', 50, 0) AS consommation_lag_24h,
        IF(h % 5 = 0, NULL, 100D) AS consommation_lag_48h,
        CAST(NULL AS DOUBLE) AS consommation_lag_168h,
        CAST(hash(h) % 10 AS DOUBLE) AS consommation_rolling_168h,
        CAST(NULL AS DOUBLE) AS temperature_celsius, 1D AS wind_speed_kmh, 2D AS solar_radiation_wm2,
        h % 24 AS hour_of_day, h % 7 AS day_of_week, h % 7 >= 5 AS is_weekend,
        false AS is_public_holiday_fr, 1 AS month,
        100D + 10 * (h % 24) + IF(region = 'A', 50, 0) + IF(h % 24 > 12, 40, 0) AS consommation
        FROM (SELECT explode(sequence(0, 599)) AS h), (SELECT explode(array('A', 'B')) AS region)"""
    ).withColumn("consommation_lag_24h", F.col("consommation_lag_24h").cast("double")).persist()


@pytest.fixture(scope="module")
def fitted(frame):
    split = training.time_split(frame, "date_heure")
    train, val = (split.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
    model, best = learners.fit_gbt(train, val, LABELS, **SMALL)
    return model, best, val


def test_beats_the_lag_baseline_with_missing_inputs(fitted):
    model, best, val = fitted
    mae = learners.validation_metrics(model, val, "consommation").first().mae
    naive = val.agg(F.avg(F.abs(F.expr("consommation - consommation_lag_24h")))).first()[0]
    assert 1 <= best <= 8
    assert mae < naive


def test_unknown_key_is_scored(fitted):
    model, _, val = fitted
    scored = learners.score(model, val.withColumn("region", F.lit("Atlantis")))
    assert scored.filter("predicted_mw IS NULL OR isnan(predicted_mw)").count() == 0
    assert scored.columns == [*val.columns, "predicted_mw"]


def test_importance_names_inputs_and_sums_to_one(fitted):
    gains = dict(learners.feature_importance(fitted[0]))
    assert set(gains) == set(MODEL_FEATURES)
    assert abs(sum(gains.values()) - 1) < 1e-9
    assert max(gains, key=gains.get) in {"consommation_lag_24h", "hour_of_day"}
    assert gains["temperature_celsius"] == 0


def test_permutation_keeps_values_and_finds_the_used_feature(fitted):
    model, _, val = fitted
    out = learners.permutation_importance(
        model, val, ["date_heure", "region"], features=MODEL_FEATURES, repeats=2, fraction=1.0
    )
    rows = {r.feature: r for r in out.collect()}
    assert set(rows) == set(MODEL_FEATURES)
    assert all(r.repeats == 2 for r in rows.values())
    assert rows["consommation_lag_24h"].importance > 1
    assert rows["temperature_celsius"].importance == pytest.approx(0, abs=1e-9)


def test_alternative_loss(frame, fitted):
    _, _, val = fitted
    model, _ = learners.fit_alt_learner(frame, val, LABELS, **SMALL)
    assert model.loss == "absolute"


def test_train_stores_logs_and_reloads(spark, frame, grid, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        training_job.load_latest(spark, root)
    run_id = training_job.train(frame, grid, LABELS, root, "2024-02-01T00:00:00", **SMALL)
    second = training_job.train(frame, grid, LABELS, root, "2024-02-02T00:00:00", **SMALL)
    log = training_job.read_runs(spark, f"{root}/runs").orderBy("created_at").collect()
    assert [r.run_id for r in log] == [run_id, second]
    assert log[0].n_train + log[0].n_val == frame.count()
    assert list(log[0].features) == MODEL_FEATURES
    latest, model = training_job.load_latest(spark, root)
    assert latest == second
    assert learners.score(model, frame).count() == frame.count()


def test_gate_refuses_small_frames(frame, grid, tmp_path):
    small = frame.limit(199)
    assert training_job.train(small, grid, LABELS, str(tmp_path), "2024-02-01T00:00:00") is None


def test_the_best_prefix_is_kept(frame):
    """On noise the first rounds are the best ones; the stored model has just those."""
    noise = frame.withColumn("consommation", F.abs(F.hash("date_heure", "region")) % 1000 + 0.0)
    train = noise.filter("date_heure < timestamp'2024-01-15'")
    val = noise.filter("date_heure >= timestamp'2024-01-15'")
    model, best = learners.fit_gbt(
        train, val, LABELS, rounds=12, maxDepth=6, stepSize=1.0, subsamplingRate=1.0
    )
    assert best < 12
    assert len(model.trees) == best


def test_patience_ends_at_the_best_round():
    assert learners.best_round([5, 3, 4, 4, 2], patience=2) == (2, True)
    assert learners.best_round([5, 3, 4, 2, 4], patience=2) == (4, False)
    assert learners.best_round([3, 2, 1], patience=50) == (3, False)


def test_registered_queries_use_the_operators_settings(spark, monkeypatch):
    from slotcast import queries

    seen = []
    rows = spark.range(10).selectExpr("timestamp_seconds(id) date_heure", "id")
    monkeypatch.setattr(queries, "train_rows", lambda *a, **k: rows)
    for name in ("fit_gbt", "fit_alt_learner"):
        queries.fitted(spark, "", lambda *a, **options: seen.append(options) or (None, 1))
    assert seen == [{}, {}]


def test_learners_and_lags_are_compared_on_the_same_rows(spark):
    from slotcast.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = {r.model: r for r in QUERIES["compare_learners"](spark, sf).collect()}
    assert set(rows) == {"gbt", "alt", "lag_24h", "lag_168h"}
    assert len({r.n for r in rows.values()}) == 1
    assert sum(r.best_mae for r in rows.values()) == 1
    assert min(rows["gbt"].mae, rows["alt"].mae) < rows["lag_24h"].mae
    sample = QUERIES["learned_error_sample"](spark, sf).collect()
    assert len(sample) == rows["gbt"].n
    assert sum(abs(r.residual) for r in sample) / len(sample) == pytest.approx(rows["gbt"].mae, abs=0.006)
    assert all(r.residual == pytest.approx(r.actual - r.predicted) for r in sample)
