"""Values that are no fixed-point values, and inputs that break a feed's contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slotcast import session
from slotcast.functions import numeric
from slotcast.grid import Grid
from slotcast.operators.features import history_features
from slotcast.operators.quality import key_metrics
from slotcast.operators.validate import validate
from slotcast.sources import landed

HOURLY = Grid(step=3600)


def hours(values):
    return [(f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00:00", "A", v) for i, v in enumerate(values)]


def plain_mean(values, i):
    window = [v for v in values[max(0, i - 168) : i] if v is not None and abs(v) < float("inf")]
    return sum(window) / len(window) if window else None


@pytest.mark.parametrize("spike", [1e17, float("nan"), float("inf"), None])
def test_a_spike_leaves_the_window(series, spike):
    values = [1.0] * 400
    values[20] = spike
    rows = history_features(series(hours(values)), HOURLY).orderBy("date_heure").collect()
    for i, row in enumerate(rows):
        clean = [None if v is None or v != v else v for v in values]
        expected = plain_mean(clean, i)
        got = row["consommation_rolling_168h"]
        assert got is None if expected is None else got == pytest.approx(expected, rel=1e-12)


def test_more_decimals_than_the_grid_says_are_kept(series):
    rows = history_features(series(hours([0.304] * 200)), Grid(step=3600, scale=2)).collect()
    means = {r["consommation_rolling_168h"] for r in rows} - {None}
    assert all(m == pytest.approx(0.304, rel=1e-12) for m in means)


def test_errors_of_learned_predictions_are_not_cut(spark):
    pairs = spark.createDataFrame([("A", 1.004, 1.0), ("A", 2.004, 2.0)], "region string, predicted_mw double, consommation double")
    row = key_metrics(pairs, Grid(scale=2)).first()
    assert row["mae_mw"] == pytest.approx(0.004, abs=1e-12)


def test_a_page_without_results_fails(spark):
    pages = landed.parse_record_pages(spark.createDataFrame([('{"error": "quota"}',)], "j string"), "j")
    with pytest.raises(Exception, match="no results"):
        landed.explode_records(pages).collect()


def test_unequal_arrays_fail(spark):
    text = '{"region": "A", "hourly": {"time": ["2024-06-01T00:00Z", "2024-06-01T01:00Z"], "temperature_2m": [1.0]}}'
    pages = landed.parse_hourly_pages(spark.createDataFrame([(text,)], "j string"), "j")
    with pytest.raises(Exception, match="differ in length"):
        landed.explode_hourly(pages, HOURLY, F.current_timestamp()).collect()


def test_an_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="quarantin"):
        validate(spark.range(1), {"any": F.lit(True)}, policy="quarantin")


def test_a_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError, match="shared folder"):
            session.shared_folder(spark)


def test_free_sums_do_not_depend_on_order(spark):
    values = [0.1, 1e9, 0.2, -1e9, 0.3] * 7
    sums = {
        spark.createDataFrame([(v,) for v in order], "v double").agg(numeric.free_total("v", 2)).first()[0]
        for order in (values, values[::-1], sorted(values))
    }
    assert sums == {4.2}
