"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def decode(frame: DataFrame, schema: T.StructType, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Members of a JSON text as columns; text that is not JSON stays in ``error_message``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(text).cast("string"), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    members = [F.col("_message")[f.name].alias(f.name) for f in schema.fields]
    return frame.withColumn("_message", parsed).select(
        *keep, *members, F.col("_message")[CORRUPT].alias("error_message")
    )


def encode(columns: list[str | Column], keep_nulls: bool = False) -> Column:
    """One JSON object per row."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def member_or(struct: Column, name: str, default) -> Column:
    """Member of a struct, or a default where it is missing."""
    return F.coalesce(struct[name], F.lit(default))


def numeric_members(members: Column) -> Column:
    """Entries of a text map whose value is a number, as doubles."""
    numbers = F.transform_values(members, lambda _, v: v.try_cast("double"))
    return F.map_filter(numbers, lambda _, v: v.isNotNull())
