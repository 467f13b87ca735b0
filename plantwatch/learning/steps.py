"""Models of single features as step functions, kept in a table that batch and stream join.

A tree over one feature, a forest of them, and the bins of a histogram are all step functions of the
value. One row holds those of a field: ``functions`` is an array of (name, cuts, values, cut); a value
has as its result ``values[number of cuts below it]`` and counts as predicted from ``cut`` on.

To apply them without Python, and without a driver that knows any field, each row is cut into cells
of a share of the field's standard deviation. A reading looks up its field's mean and deviation, then
its cell, which holds the few cuts that lie in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantwatch.functions.numbers import finite
from plantwatch.operators.joins import lookup, null_safe, stored

#: Cells for each standard deviation, and deviations from the mean to which they reach; beyond, one cell on either side.
CELLS_EACH, CELLS_REACH = 64, 8
#: Cuts (and rows) of cells that are broadcast at most.
BROADCAST_CUTS = 500_000
#: Bins of a field's histogram, before those of the tails.
BINS = 256
TAILS = (0.0005, 0.001, 0.002, 0.998, 0.999, 0.9995)
FUNCTION = "struct<name: string, cuts: array<double>, values: array<double>, cut: double>"
MODEL_DDL = f"field string, mean double, deviation double, n bigint, functions array<{FUNCTION}>"


# ---- application -----------------------------------------------------------------------------------


def cell_of(value: Column) -> Column:
    """The cell of a value, by ``_mean`` and ``_deviation``: never falls as the value grows."""
    reach = float(CELLS_EACH * CELLS_REACH)
    place = (value - F.col("_mean")) / F.col("_deviation") * CELLS_EACH
    return F.floor(F.greatest(F.lit(-reach - 1), F.least(F.lit(reach), place))).cast("int")


def _cells(models: DataFrame) -> DataFrame:
    """_key, _cell, _steps: array of (name, base, cuts, values, cut) with the cuts of each function that lie in the cell.

    Every cell of the reach has a row; a cell's ``values`` are those before, between and after its cuts.
    """
    reach = CELLS_EACH * CELLS_REACH

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, mean, deviation, functions in zip(batch["_key"], batch["mean"], batch["deviation"], batch["functions"]):
                found: dict[int, list[dict]] = {c: [] for c in range(-reach - 1, reach + 1)}
                for f in functions:
                    cuts, values = np.asarray(f["cuts"], float), np.asarray(f["values"], float)
                    place = (cuts - mean) / deviation * CELLS_EACH
                    own = np.floor(np.clip(place, -reach - 1.0, float(reach))).astype(int)
                    starts, ends = np.searchsorted(own, list(found), "left"), np.searchsorted(own, list(found), "right")
                    for cell, a, b in zip(found, starts.tolist(), ends.tolist()):
                        found[cell].append({"name": f["name"], "cuts": cuts[a:b].tolist(), "values": values[a : b + 1].tolist(), "cut": f["cut"]})
                yield pd.DataFrame({"_key": key, "_cell": list(found), "_steps": list(found.values())})

    keyed = models.select(null_safe("field").alias("_key"), "mean", "deviation", "functions")
    return keyed.mapInPandas(cut, f"_key string, _cell int, _steps array<{FUNCTION}>")


def applied(readings: DataFrame, models: DataFrame, value: str = "value_num", results: str = "results") -> DataFrame:
    """Adds ``results``: array of (name, result, predicted), one for each function of the reading's field.

    Null for a field without a model; empty results for a null or NaN value. No shuffle of the readings while the
    cells are few, measured; beyond, they are spread over copies of them. ``readings`` may be a stream.
    """
    scales = models.select(null_safe("field").alias("_key"), F.col("mean").alias("_mean"), F.col("deviation").alias("_deviation"))
    keyed = readings.withColumn("_key", null_safe("field"))
    placed = lookup(keyed, scales, ["_key"])
    x = F.col(value).cast("double")
    placed = placed.withColumn("_cell", F.when(x.isNotNull() & ~F.isnan(x), cell_of(x))).drop("_mean", "_deviation")
    cells = _cells(models)
    cuts = F.lit(1) + F.aggregate("_steps", F.lit(0), lambda n, s: n + F.size(s["cuts"]))
    found = lookup(placed, cells, ["_key", "_cell"], at_most=BROADCAST_CUTS, weight=cuts)

    def result(step: Column) -> Column:
        return F.get(step["values"], F.size(F.filter(step["cuts"], lambda c: c < x)))

    made = F.transform(
        "_steps", lambda s: F.struct(s["name"].alias("name"), result(s).alias("result"), (result(s) >= s["cut"]).cast("int").alias("predicted"))
    )
    return found.withColumn(results, made).drop("_key", "_cell", "_steps")


def judged(readings: DataFrame, models: DataFrame, value: str = "value_num") -> DataFrame:
    """One row for each reading and function of its field: the columns of ``readings``, model, result and predicted.

    Readings of a field without a model, or without a value, have one row with nulls there.
    """
    columns = [F.col(f"`{c}`") for c in readings.columns]
    return applied(readings, models, value, "_results").select(*columns, F.inline_outer("_results").alias("model", "result", "predicted"))


# ---- fitting ---------------------------------------------------------------------------------------


def scales_of(training: DataFrame, value: str = "value_num") -> DataFrame:
    """field, mean, deviation (1 for a constant field), n and cuts at equal shares of the readings, finer at the tails."""
    shares = sorted({i / BINS for i in range(1, BINS)} | set(TAILS))
    x = finite(F.col(value).cast("double"))
    measured = training.where(x.isNotNull()).groupBy("field").agg(
        F.avg(x).alias("mean"), F.coalesce(F.nullif(F.stddev_pop(x), F.lit(0.0)), F.lit(1.0)).alias("deviation"),
        F.count(x).alias("n"), F.percentile_approx(x, shares, 10_000).alias("cuts"),
    )
    return measured.withColumn("cuts", F.array_sort(F.array_distinct("cuts")))


def histograms(training: DataFrame, scales: DataFrame, label: str = "y", value: str = "value_num") -> DataFrame:
    """field, bins: array of (bin, label, n), from one aggregation over all fields. A bin reaches up to its cut."""
    numbers = F.transform(F.sequence(F.lit(0), F.size("cuts")), lambda i: i.cast("double"))
    function = F.struct(F.lit("bin").alias("name"), F.col("cuts").alias("cuts"), numbers.alias("values"), F.lit(0.0).alias("cut"))
    binned = applied(training, scales.select("field", "mean", "deviation", "n", F.array(function).alias("functions")), value)
    counted = binned.where(F.col("results").isNotNull() & F.col(label).isNotNull()).groupBy(
        "field", F.col("results")[0]["result"].cast("int").alias("bin"), F.col(label).cast("int").alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("field").agg(F.collect_list(F.struct("bin", "label", "n")).alias("bins"))  # at most two for each bin


def grown(histogram: np.ndarray, depth: int, least: int) -> np.ndarray:
    """Probability of label 1 by bin, of a tree over weighted counts (bins x 2), cut where Gini impurity falls most."""
    out = np.empty(len(histogram))
    upto = np.vstack([np.zeros(2), np.cumsum(histogram, 0)])

    def impurity(parts: np.ndarray) -> np.ndarray:
        size = parts.sum(-1)
        return size - (parts**2).sum(-1) / np.maximum(size, 1e-300)

    def split(a: int, b: int, left: int) -> None:
        whole = upto[b] - upto[a]
        at = np.arange(a + 1, b)
        low, high = upto[at] - upto[a], upto[b] - upto[at]
        gain = impurity(whole) - impurity(low) - impurity(high)
        gain[np.minimum(low.sum(-1), high.sum(-1)) < least] = -1.0
        if not left or not len(at) or gain.max() <= 1e-12 * max(1.0, whole.sum()):
            out[a:b] = whole[1] / whole.sum() if whole.sum() else 0.0
            return
        best = np.flatnonzero(gain >= gain.max() * (1 - 1e-12))  # in the middle of a stretch of equal ones
        cut = int(at[best[(len(best) - 1) // 2]])
        split(a, cut, left - 1)
        split(cut, b, left - 1)

    split(0, len(histogram), depth)
    return out


def grow_forest(counts: np.ndarray, trees: int, depth: int, least: int, seed: int) -> np.ndarray:
    """Mean probability by bin of trees, each over rows drawn with replacement, in class weights that balance.

    Rows of one bin and label are alike, so drawing rows is drawing counts: no row is read again.
    """
    rng = np.random.default_rng(seed)
    n = int(counts.sum())
    total = np.zeros(len(counts))
    sizes = counts.sum(0)
    weights = n / (2.0 * np.maximum(sizes, 1))
    for _ in range(trees):
        drawn = rng.multinomial(n, (counts / n).ravel()).reshape(counts.shape) if n < 2**62 else counts
        total += grown(drawn * weights, depth, least)
    return total / trees


def forests(training: DataFrame, scales: DataFrame, label: str = "y", trees: int = 50, depth: int = 5, least: int = 1, seed: int = 42, value: str = "value_num") -> DataFrame:
    """field and function of a forest for every field, all from one aggregation; the plan does not grow with fields."""
    joined = scales.withColumn("_key", null_safe("field")).join(
        histograms(training, scales, label, value).select(null_safe("field").alias("_key"), "bins"), "_key"
    )

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for field, cuts, bins in zip(batch["field"], batch["cuts"], batch["bins"]):
                counts = np.zeros((len(cuts) + 1, 2), np.int64)
                for b in bins:
                    counts[b["bin"], b["label"]] += b["n"]
                mean = grow_forest(counts, trees, depth, least, seed)
                kept = np.flatnonzero(np.diff(mean) != 0)
                function = {"name": "random_forest", "cuts": np.asarray(cuts)[kept].tolist(), "values": mean[np.append(kept, len(mean) - 1)].tolist()}
                yield pd.DataFrame({"field": [field], "function": [function | {"cut": math.nextafter(0.5, 1.0)}]})

    return joined.select("field", "cuts", "bins").mapInPandas(grow, f"field string, function {FUNCTION}")


def rate_cuts(scores: DataFrame, rates: DataFrame, name: str = "result") -> DataFrame:
    """field and cut: from which score on the field's ``anomaly_rate`` share of its rows lies, or its highest score.

    A step function takes few distinct values, so the cut is exact, on counts by value that add up over partitions.
    """
    counts = scores.where(F.col(name).isNotNull()).groupBy("field", F.col(name).alias("s")).agg(F.count("*").alias("n"))
    falling = Window.partitionBy("_key").orderBy(F.desc("s"))
    within = Window.partitionBy("_key")
    rated = lookup(counts.withColumn("_key", null_safe("field")), rates.select(null_safe("field").alias("_key"), "anomaly_rate"), ["_key"], "inner")
    return (
        rated.withColumn("_upto", F.sum("n").over(falling))
        .withColumn("_allowed", F.ceil(F.col("anomaly_rate") * F.sum("n").over(within)))
        .groupBy("field")
        .agg(F.coalesce(F.min(F.when(F.col("_upto") <= F.col("_allowed"), F.col("s"))), F.max("s")).alias("cut"))
    )


def outlier_functions(training: DataFrame, scales: DataFrame, steps: DataFrame, rates: DataFrame, value: str = "value_num") -> DataFrame:
    """field and function of isolation step functions (field, cuts, scores), with the cut that the training rows give."""
    named = steps.select("field", F.struct(
        F.lit("isolation_forest").alias("name"), F.col("cuts").alias("cuts"), F.col("scores").alias("values"), F.lit(float("inf")).alias("cut")
    ).alias("function"))
    named = stored(named, "isolation")
    scores = judged(training.select("field", value), with_functions(scales, named), value)
    cuts = rate_cuts(scores, rates).select(null_safe("field").alias("_key"), F.col("cut").alias("_cut"))
    joined = named.withColumn("_key", null_safe("field")).join(cuts, "_key", "left")
    cut = F.coalesce("_cut", F.lit(float("inf")))  # a field without a rate has scores, and flags nothing
    return joined.select("field", F.col("function").withField("cut", cut).alias("function"))


def with_functions(scales: DataFrame, *functions: DataFrame) -> DataFrame:
    """The models: one row for each field that has a function, with all its functions by name."""
    every = functions[0]
    for more in functions[1:]:
        every = every.unionByName(more)
    grouped = every.groupBy(null_safe("field").alias("_key")).agg(F.array_sort(F.collect_list("function")).alias("functions"))
    return scales.withColumn("_key", null_safe("field")).join(grouped, "_key").select("field", "mean", "deviation", "n", "functions")


# ---- storage ---------------------------------------------------------------------------------------


def save(models: DataFrame, path: str, version: int) -> None:
    """Writes the models as one version of the table; written again, a version is replaced, others stay."""
    out = models.withColumn("version", F.lit(version).cast("bigint")).write.partitionBy("version")
    out.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The models of a version, or of the latest."""
    table = spark.read.schema(f"{MODEL_DDL}, version bigint").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == F.lit(version)).drop("version")
