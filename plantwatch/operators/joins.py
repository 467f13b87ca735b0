"""Lookups of a fact stream in a smaller table, safe when one key holds much of the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantwatch.session import shared_folder

#: Rows up to which a counted dimension is broadcast.
BROADCAST_ROWS = 10_000


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once however often it is used, whatever executors are lost."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    how: str = "left",
    at_most: int | None = None,
    spread_by: list[str] | None = None,
    copies: int = 256,
    weight: Column | None = None,
) -> DataFrame:
    """Join facts to one dimension row per key.

    The dimension is written once and measured: up to ``at_most`` rows (BROADCAST_ROWS, if not given;
    or that sum of ``weight``, for rows of uneven size) it is broadcast and the facts stay where they
    are. Beyond, every dimension row is repeated ``copies`` times and the facts of one key are
    spread over the copies, so a hot key is shared by that many tasks (and Spark splits what is
    still too large while it runs); facts never multiply, as each meets one copy.
    """
    if not dimension.isStreaming:
        dimension = stored(dimension, "dimension")
        if (dimension.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0) <= (BROADCAST_ROWS if at_most is None else at_most):
            return facts.join(F.broadcast(dimension), on, how)
    spread = spread_by or [c for c in facts.columns if c not in on] or on
    salted_facts = facts.withColumn("_copy", _slot(spread, copies))
    salted_dimension = dimension.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted_facts.join(salted_dimension, [*on, "_copy"], how).drop("_copy")


def null_safe(column: str) -> Column:
    """A text column as a key, a null in it being a key of its own."""
    return F.coalesce(F.concat(F.lit("f"), F.col(column)), F.lit("n"))


def lookup_by(
    facts: DataFrame, dimension: DataFrame, column: str, how: str = "left", at_most: int | None = None, spread_by: list[str] | None = None
) -> DataFrame:
    """``lookup`` by one text column, a null in it being a key of its own."""
    keyed = [f.withColumn("_key", null_safe(column)) for f in (facts, dimension)]
    return lookup(keyed[0], keyed[1].drop(column), ["_key"], how, at_most, spread_by).drop("_key")


def only_fields(readings: DataFrame, fields: list[str], column: str = "field") -> DataFrame:
    """Rows of the declared fields: the filter that bounds per-field tables."""
    return readings.where(F.col(column).isin(*fields))


def _slot(columns: list[str], copies: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(copies)).cast("int")
