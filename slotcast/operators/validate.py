"""Row contracts as named conditions: fail the whole batch, or split it.

A rule is a condition that must hold; NULL counts as broken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import is_finite
from ..schemas import HOURLY_ARRAYS
from ..sources.landed import MALFORMED, ZONED

Rules = dict[str, Column]


class ContractError(ValueError):
    """Rows broke their contract; ``counts`` has the number per rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(f"rows break their contract: {counts}")


def _broken(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """One row: how many rows break each rule."""
    return df.agg(*[F.count_if(_broken(rule)).alias(name) for name, rule in rules.items()])


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break in ``_reason``."""
    names = [F.when(_broken(rule), F.lit(name)) for name, rule in rules.items()]
    marked = df.withColumn("_reason", F.array_compact(F.array(*names)))
    good = marked.filter(F.size("_reason") == 0).drop("_reason")
    return good, marked.filter(F.size("_reason") > 0)


def validate(df: DataFrame, rules: Rules, policy: str = "fail") -> DataFrame:
    """The frame if every row is good; else raise once with all counts.

    With ``policy='drop'`` the bad rows are left out instead.
    """
    if policy not in ("drop", "fail"):
        raise ValueError(f"unknown policy {policy!r}: 'drop' or 'fail'")
    if policy == "drop":
        return quarantine(df, rules)[0]
    counts = violations(df, rules).first().asDict()
    if any(counts.values()):
        raise ContractError({name: n for name, n in counts.items() if n})
    return df


def well_formed() -> Rules:
    """A page parsed with ``keep_malformed`` was valid JSON of the declared types."""
    return {"well_formed": F.col(MALFORMED).isNull()}


def record_page_rules() -> Rules:
    """A page has results and every record names a zone and a region."""
    return {
        "results_present": F.col("results").isNotNull(),
        "time_has_zone": F.forall(
            "results", lambda r: F.coalesce(r["date_heure"].rlike(ZONED), F.lit(False))
        ),
        "time_parses": F.forall(
            "results", lambda r: F.try_to_timestamp(r["date_heure"]).isNotNull()
        ),
        "region_present": F.forall("results", lambda r: r["libelle_region"].isNotNull()),
    }


def record_rules() -> Rules:
    """The same contract for single records; the value may be NULL."""
    return {
        "time_has_zone": F.col("date_heure").rlike(ZONED),
        "time_parses": F.try_to_timestamp("date_heure").isNotNull(),
        "region_present": F.col("libelle_region").isNotNull(),
    }


def hourly_page_rules() -> Rules:
    """The arrays exist and are as long as the times; elements may be NULL."""
    size = F.size("hourly.time")
    return {
        "hourly_present": F.col("hourly").isNotNull(),
        **{
            f"{name}_length": F.size(f"hourly.{name}") == size
            for name in HOURLY_ARRAYS
        },
    }


def prediction_rules(key: str, labels: Sequence[str]) -> Rules:
    """Known key from a fixed list; a finite value above zero."""
    return {
        "known_region": F.col(key).isin(list(labels)),
        "positive_and_finite": is_finite("predicted_mw") & (F.col("predicted_mw") > 0),
    }


def metrics_rules() -> Rules:
    return {f"{c}_finite": is_finite(c) for c in ("mae_mw", "p95_error_mw", "p99_error_mw")}
