"""Operating rules: physical limits, critical zones and valid states, and who raised what."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwatch.schema import VALID_STATES


@dataclass(frozen=True)
class Rule:
    """Limits of one field (or kind). ``None`` leaves a side open."""

    key: str
    low: float | None = None
    high: float | None = None
    low_critical: float | None = None
    high_critical: float | None = None
    states: tuple[int, ...] | None = None


PUMP_STATES = tuple(VALID_STATES)


def limit_violated(key: Column, value: Column, rules: list[Rule]) -> Column:
    """Value outside the physical limits of its rule."""
    return _per_rule(key, rules, lambda r: _below(value, r.low) | _above(value, r.high), F.lit(False))


def critical_zone(key: Column, value: Column, rules: list[Rule]) -> Column:
    """CRITICAL_LOW or CRITICAL_HIGH inside the limits but past the safe zone, else null."""
    return _per_rule(
        key,
        rules,
        lambda r: F.when(_below(value, r.low) | _above(value, r.high), F.lit(None).cast("string"))
        .when(_at_most(value, r.low_critical), "CRITICAL_LOW")
        .when(_at_least(value, r.high_critical), "CRITICAL_HIGH"),
        F.lit(None).cast("string"),
    )


def state_violated(key: Column, state: Column, rules: list[Rule]) -> Column:
    """State outside the rule's valid set."""
    return _per_rule(
        key, rules, lambda r: ~state.isin(*r.states) if r.states is not None else F.lit(False), F.lit(False)
    )


def findings(readings: DataFrame, keep: list[str], checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per detector that fires on a reading.

    ``checks`` maps a detector's name to (fires, severity). All detectors look at a
    row in one pass over the readings.
    """
    fired = F.array(
        *[
            F.when(fires, F.struct(F.lit(name).alias("detector"), level.alias("severity")))
            for name, (fires, level) in checks.items()
        ]
    )
    return readings.select(*keep, F.explode(F.filter(fired, lambda x: x.isNotNull())).alias("finding")).select(
        *keep, "finding.detector", "finding.severity"
    )


def literal_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small table written in the query itself."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _per_rule(key: Column, rules: list[Rule], verdict, default: Column) -> Column:
    chosen = reduce(lambda rest, rule: rest.when(key == F.lit(rule.key), verdict(rule)), rules, F)
    return F.coalesce(chosen.otherwise(default), default)


def _below(value: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else value < bound


def _above(value: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else ~F.isnan(value) & (value > bound)


def _at_most(value: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else value <= bound


def _at_least(value: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else ~F.isnan(value) & (value >= bound)
