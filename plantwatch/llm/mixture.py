"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import in_order, read_table, saved, set_aside, small_or_plain, text_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix"
SLICE_ROWS = 100_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per source: words, weight, target and how many hash digits slice its documents.

    Sources by code point, null last, weigh ``weights`` in turn and share all words; no target
    passes ``max_repeats`` times its source, and the rest shares what is cut off by weight. The
    water level is the largest of the levels reached when sources are capped one by one in the
    order of cap / weight. One task orders the sources, one row each.
    """
    per_source = sized.groupBy("_source", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = per_source.withColumn("_turn", turn).withColumn(
        "_w", F.element_at(cycle, (F.col("_turn") % len(weights) + 1).cast("int"))
    ).withColumn("_cap", F.lit(max_repeats) * F.col("source_size"))
    every = Window.partitionBy()
    ordered = Window.orderBy(F.col("_cap") / F.col("_w"), "_turn").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(ordered), F.lit(0))
    open_weight = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(ordered), F.lit(0))
    level = F.max("_level").over(every)
    digits = F.greatest(F.lit(0.0), F.ceil(F.ln(F.col("_n") / F.lit(float(slice_rows))) / F.ln(F.lit(16.0)))).cast("int")
    return (
        weighed.withColumn("_level", left / open_weight)
        .withColumn("target", F.least(F.col("_cap").cast("double"), level * F.col("_w")))
        .select("_source", "source_size", "target", digits.alias("_digits"))
    )


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights=WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    slice_rows: int = SLICE_ROWS,
    ties: str | None = None,
) -> DataFrame:
    """Adds to each row: size, source_size, target, copies, taken.

    Every document of a source is expected target / source_size times. Within a source the
    documents stand by size class, slice, size and doc_id; their expected copies are summed in
    that order, shifted by one random offset per source, and a copy is taken for each whole
    number passed. Neighbours are of like size, so the words taken stay near the target. As the
    expectation is the same for all documents of a source, the sum up to place k is k times it.

    Null text: size 0. Null source: a source of its own, last. Null doc_id: first in its slice.
    Repeated rows: each counts. Empty table: empty. A source without words has target 0 and takes
    nothing. Other columns pass through; input columns named like the added ones are replaced. ``ties``
    names a column that orders rows of one size and doc_id.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    sized = docs.drop(*[c for c in added if c in docs.columns]).withColumn(
        "size", words_in(F.col("text")) if size is None else size
    ).withColumn("_source", text_key("source"))
    goals = small_or_plain(saved(targets(sized.select("source", "_source", "size"), weights, max_repeats, slice_rows), "targets"))
    sliced = sized.join(goals, "_source").withColumns({
        "_class": F.length(F.bin("size")) * 8 + F.expr("cast(size * 8 div shiftleft(1L, length(bin(size)) - 1) as int)"),
        "_slice": F.expr("substring(md5(coalesce(cast(doc_id as string), '')), 1, _digits)"),
    })
    placed = in_order(sliced, ["_source"], ["_class", "_slice"], [F.col("size"), F.col("doc_id"), *([F.col(ties)] if ties else [])], "_place")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("_source"))), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    passed = F.floor(rate * F.col("_place") + offset) - F.floor(rate * (F.col("_place") - 1) + offset)
    return (
        placed.withColumn("copies", F.least(passed, F.lit(max_repeats)).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_source", "_digits", "_class", "_slice", "_place")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs and their values.

    Columns named like those of ``mix``, or like its working columns, stay as they are. Ties of size and
    doc_id are taken in the order of their texts' digests. Null and empty texts have no words: they are
    copied like the others of their source; a source without words takes nothing.
    """
    own, back = set_aside(docs, ["doc_id", "source", "text"])
    ties = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    taken = mix(own.withColumn("_tie", ties), **options, ties="_tie").where("copies > 0")
    return back(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def op1_mixture(spark, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS skey FROM documents),
s AS (
  SELECT skey, source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY skey, source),
w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS turn FROM s),
c AS (
  SELECT *, (turn % 3 + 1)::BIGINT AS w, 3 * source_size AS cap FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE)
          / ((sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE) AS level
  FROM c WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT skey, source_size, least(cap::DOUBLE, max(level) OVER () * w) AS target,
         greatest(0, ceil(ln(n / 100000.0) / ln(16.0)))::INT AS digits,
         ('0x' || substr(md5('mix' || skey), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.skey ORDER BY
           length(bin(d.size)) * 8 + (d.size * 8) // (1 << (length(bin(d.size)) - 1)),
           substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, t.digits), d.size, d.doc_id NULLS FIRST) AS place
  FROM d JOIN t USING (skey))
SELECT doc_id, size::BIGINT AS size, source_size, target,
       least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3)::BIGINT AS copies,
       (least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3) * size)::BIGINT AS taken
FROM p
"""
