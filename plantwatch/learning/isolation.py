"""Isolation forest over single features.

A tree sees at most ``sample`` readings of one feature, so building it is small work;
Spark draws the samples and builds all trees of all features side by side. A tree over
one feature is a step function of the value, and so is the mean of many, which makes
scoring one binary search per reading.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.learning.steps import rate_cuts
from plantwatch.operators.joins import lookup_by, only_fields
from plantwatch.operators.ordered import first_rows

SPARE = 1.3  # drawn per tree beyond the sample, so that nearly every tree fills up


def fit(readings: DataFrame, fields: list[str] | None, key: str, value: str = "value_num", trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """Step functions (field, cuts, scores): a value between two cuts has the score between them.

    Without ``fields`` every field has one, readings without a field too.
    """
    chosen = readings if fields is None else only_fields(readings, fields)
    known = chosen.where(F.col(value).isNotNull() & ~F.isnan(value)).select("field", key, F.col(value).alias("x"))
    drawn = _samples(known, fields, key, trees, sample, seed)
    grown = drawn.groupBy("field", "tree").applyInPandas(
        lambda names, rows: _grow(names, rows, sample, seed), "field string, tree int, cuts array<double>, depths array<double>"
    )
    return grown.groupBy("field").applyInPandas(
        lambda rows: _average(rows, sample), "field string, cuts array<double>, scores array<double>"
    )


def score(readings: DataFrame, model: DataFrame, value: str = "value_num", name: str = "outlier_score") -> DataFrame:
    """Adds the outlier score in 0..1; the model's size is bounded by fields, trees and sample size.

    It is collected and broadcast: at most 0.4 MB a field at 100 trees of 256 readings.
    """
    steps = {r["field"]: (np.array(r["cuts"]), np.array(r["scores"])) for r in model.collect()}
    shared = readings.sparkSession.sparkContext.broadcast(steps)

    @F.pandas_udf("double")
    def scored(field: pd.Series, x: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        numbers = x.to_numpy(dtype=float)
        for f in [*field.dropna().unique(), None]:
            if f in shared.value:
                here = (field.isna() if f is None else field == f).to_numpy()
                cuts, scores = shared.value[f]
                out[here] = scores[np.searchsorted(cuts, numbers[here], side="left")]
        out[np.isnan(numbers)] = np.nan
        return pd.Series(out)

    result = readings.withColumn(name, scored(F.col("field"), F.col(value)))
    return result.withColumn(name, F.nullif(F.col(name), F.lit(float("nan"))))


def flagged(scores: DataFrame, rates: DataFrame, fields: list[str] | None = None, name: str = "outlier_score") -> DataFrame:
    """Marks the ``anomaly_rate`` share of highest scores per field, among the rows given.

    A stored model judges new rows by the cut of its training rows instead, see ``steps``. Readings
    without a score, or of a field without a rate, stay and have no mark.
    """
    cut = rate_cuts(scores, rates, name).withColumnRenamed("cut", "_cut")
    marked = lookup_by(scores, cut, "field")
    return marked.withColumn("is_outlier", (F.col(name) >= F.col("_cut")).cast("int")).drop("_cut")


def _samples(known: DataFrame, fields: list[str] | None, key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """Up to ``sample`` readings per (field, tree), without putting a field into one task.

    Each reading is copied to as many trees as the field's size calls for: to a few of
    many trees in a small field, to none mostly in a large one.
    """
    sizes = known.groupBy("field").agg(F.count("*").alias("n"))
    counted = lookup_by(known, sizes, "field", "inner")
    share = F.lit(sample * SPARE) / F.col("n")  # chance that a reading belongs to a given tree
    # Draws of a tree number that leave a reading in ``share * trees`` different trees on average.
    draws = F.log(1 - F.least(share, F.lit(0.999))) / math.log(1 - 1 / trees)
    whole = F.floor(draws)
    extra = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000 < draws - whole).cast("int")
    some = F.transform(
        F.sequence(F.lit(1), F.col("_draws")),
        lambda i: F.pmod(F.xxhash64(F.col(key), i, F.lit(seed)), F.lit(trees)).cast("int"),
    )
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    spread = (
        counted.withColumn("_all", share >= 1)
        .withColumn("_draws", (whole + extra).cast("int"))
        .where(F.col("_all") | (F.col("_draws") > 0))
        .select("field", "x", key, F.explode(F.when(F.col("_all"), every).otherwise(F.array_distinct(some))).alias("tree"))
        .select("field", "x", "tree", F.xxhash64(key, "tree", F.lit(seed)).alias("h"))
    )
    return first_rows(spread, ["field", "tree"], [F.asc("h"), F.asc("x")], sample)


def _expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a tree of n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(names: tuple, rows: pd.DataFrame, sample: int, seed: int) -> pd.DataFrame:
    field, tree = names
    random = np.random.default_rng([seed, zlib.crc32((field or "").encode()), int(tree)])
    limit = math.ceil(math.log2(max(sample, 2)))
    cuts: list[float] = []
    depths: list[float] = []

    def split(values: np.ndarray, depth: int) -> None:
        low, high = values[0], values[-1]
        if depth >= limit or len(values) <= 1 or low == high:
            depths.append(depth + _expected_depth(len(values)))
            return
        cut = random.uniform(low, high)
        at = min(max(np.searchsorted(values, cut, side="right"), 1), len(values) - 1)
        split(values[:at], depth + 1)
        cuts.append(cut)
        split(values[at:], depth + 1)

    split(np.sort(rows["x"].to_numpy(dtype=float)), 0)
    return pd.DataFrame({"field": [field], "tree": [tree], "cuts": [cuts], "depths": [depths]})


def _average(rows: pd.DataFrame, sample: int) -> pd.DataFrame:
    rows = rows.sort_values("tree")
    cuts = np.unique(np.concatenate([np.asarray(c, dtype=float) for c in rows["cuts"]]))
    total = np.zeros(len(cuts) + 1)
    for own, depths in zip(rows["cuts"], rows["depths"]):
        # The interval that ends at a cut belongs to the tree's interval that holds that cut.
        place = np.searchsorted(np.asarray(own, dtype=float), cuts, side="left")
        total += np.asarray(depths, dtype=float)[np.append(place, len(own))]
    scores = np.exp2(-(total / len(rows)) / max(_expected_depth(sample), 1.0))
    return pd.DataFrame({"field": [rows["field"].iloc[0]], "cuts": [cuts.tolist()], "scores": [scores.tolist()]})
