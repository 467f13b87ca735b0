"""Values to words: severity bands, thresholds, code texts, relabelling, messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantwatch.schema import SEVERITIES, SEVERITY_STEPS, STATE_TEXT


def severity(z: Column) -> Column:
    """Band of |z|; steps are exclusive and a missing z is NORMAL."""
    size = F.when(~F.isnan(z), F.abs(z))
    return band(size, SEVERITY_STEPS, below="NORMAL", inclusive=False)


def severity_rank(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), name).cast("int") - 1


def band(value: Column, steps: list[tuple[float, str]], below: str | None = None, inclusive: bool = True) -> Column:
    """Label of the highest step the value reaches."""
    reached = (lambda lower: value >= lower) if inclusive else (lambda lower: value > lower)
    chosen = reduce(
        lambda rest, step: rest.when(reached(F.lit(float(step[0]))), F.lit(step[1])),
        sorted(steps, reverse=True),
        F,
    )
    return chosen.otherwise(F.lit(below))


def percent_band(value: Column, low: Column, high: Column, steps: list[tuple[float, str]]) -> Column:
    """Band of the value's position between low and high, in percent."""
    return band(F.try_divide(value - low, high - low) * 100, steps, below=steps[0][1])


def code_text(code: Column, mapping: dict) -> Column:
    """Text of a code, null when the code is not in the mapping."""
    return reduce(lambda rest, kv: rest.when(code == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F)


def code_text_or(code: Column, mapping: dict, default: str) -> Column:
    return F.coalesce(code_text(code, mapping), F.lit(default))


def state_text(kind: Column, code: Column) -> Column:
    """Text of a state code for its kind of equipment; the code itself when unmapped."""
    by_kind = reduce(
        lambda rest, kv: rest.when(kind == F.lit(kv[0]), code_text(code, kv[1])), STATE_TEXT.items(), F
    )
    return F.coalesce(by_kind, code)


def relabel(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Whole text replaced by the name of the first rule it contains."""
    renamed = reduce(lambda rest, rule: rest.when(text.contains(rule[0]), F.lit(rule[1])), rules, F)
    return renamed.otherwise(text)


def direction(z: Column) -> Column:
    return F.when(z > 0, "high").otherwise("low")


def class_text(prediction: Column) -> Column:
    return F.when(prediction == 1, "Attack").otherwise("Normal")


def title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def percent_text(share: Column, digits: int = 2) -> Column:
    """Share in percent; ties go to the even digit, as the consumers of these texts expect."""
    return F.format_string(f"%.{digits}f%%", F.bround(share * 100, digits))


def sensor_kind(field: Column) -> Column:
    return F.regexp_extract(field, "^([A-Z]+)", 1)


def sensor_stage(field: Column) -> Column:
    return F.regexp_extract(field, "([0-9])", 1).try_cast("int")
