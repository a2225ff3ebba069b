from __future__ import annotations

from conftest import at

from slotcast.operators import clean


def test_newer_null_wins_unless_dropped(series, grid):
    df = series(
        [
            ("2024-01-01T00:00:00", "A", 5.0, "2024-01-02T00:00:00"),
            ("2024-01-01T00:00:00", "A", None, "2024-01-03T00:00:00"),
        ]
    )
    assert [r.consommation for r in clean.dedupe_latest(df, grid).collect()] == [None]
    kept = clean.dedupe_latest(df, grid, drop_null_value=True).collect()
    assert [r.consommation for r in kept] == [5.0]


def test_equal_stamps_do_not_depend_on_row_order(series, grid):
    rows = [("2024-01-01T00:00:00", "A", float(v)) for v in (3, 9, 4)]
    for order in (rows, rows[::-1]):
        assert clean.dedupe_latest(series(order), grid).first().consommation == 9.0


def test_time_range_bounds(series, grid):
    df = series([(f"2024-01-0{d}T00:00:00", "A", 1.0) for d in (1, 2, 3)])
    closed = clean.time_range(df, "date_heure", "2024-01-01T00:00:00", "2024-01-03T00:00:00")
    opened = clean.time_range(
        df, "date_heure", "2024-01-01T00:00:00", "2024-01-03T00:00:00", True, True
    )
    assert (closed.count(), opened.count()) == (3, 1)


def test_complete_slots_counts_distinct_keys(series, grid):
    df = series(
        [
            ("2024-01-01T00:00:00", "A", 1.0),
            ("2024-01-01T00:00:00", "B", 1.0),
            ("2024-01-01T00:15:00", "A", 1.0),
            ("2024-01-01T00:15:00", "A", 2.0),
        ]
    )
    kept = clean.complete_slots(df, grid, 2).select("date_heure").distinct().collect()
    assert [r.date_heure for r in kept] == [at("2024-01-01T00:00:00")]


def test_null_gate(series):
    df = series([("2024-01-01T00:00:00", "A", None), ("2024-01-01T00:15:00", "A", 1.0)])
    assert clean.null_gate(df, ["consommation"]).count() == 1


def test_dedupe_limits_groups_before_the_shuffle(series, grid):
    """A cell with most of the rows leaves one row per map task."""
    df = series([("2024-01-01T00:00:00", "A", float(i)) for i in range(50)])
    plan = clean.dedupe_latest(df, grid)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
