from __future__ import annotations

import pytest

from slotcast.operators import validate
from slotcast.sources.dimensions import REGION_LABELS

GOOD = [("Normandie", 1.0)]
BAD = [
    ("Normandie", 0.0),
    ("Normandie", -1.0),
    ("Normandie", float("nan")),
    ("Normandie", float("inf")),
    ("Normandie", None),
    ("Atlantis", 5.0),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "region string, predicted_mw double")


def test_predictions(spark):
    rules = validate.prediction_rules("region", REGION_LABELS)
    good, bad = validate.quarantine(frame(spark, GOOD + BAD), rules)
    assert (good.count(), bad.count()) == (1, 6)
    assert bad.filter("region = 'Atlantis'").first()._reason == ["known_region"]
    with pytest.raises(validate.ContractError) as error:
        validate.validate(frame(spark, GOOD + BAD), rules)
    assert error.value.counts == {"known_region": 1, "positive_and_finite": 5}
    assert validate.validate(frame(spark, GOOD), rules).count() == 1


def test_metrics_rows_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [("A", 1.0, 2.0, 3.0), ("B", nan, 2.0, 3.0), ("C", 1.0, inf, 3.0), ("D", 1.0, 2.0, None)],
        "region string, mae_mw double, p95_error_mw double, p99_error_mw double",
    )
    kept = validate.validate(df, validate.metrics_rules(), policy="drop")
    assert [r.region for r in kept.collect()] == ["A"]


def test_time_zone_forms(spark):
    texts = {
        "2024-06-01T10:00:00Z": True,
        "2024-06-01T10:00:00+02:00": True,
        "2024-06-01T10:00:00-0230": True,
        "2024-06-01T10:00:00": False,
        "2024-06-01": False,
        None: False,
    }
    df = spark.createDataFrame([(t, "X") for t in texts], "date_heure string, libelle_region string")
    good, _ = validate.quarantine(df, validate.record_rules())
    assert {r.date_heure for r in good.collect()} == {t for t, ok in texts.items() if ok}
