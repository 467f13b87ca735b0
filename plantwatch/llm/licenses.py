"""License notices in texts by diagonal voting of word k-grams. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import read_table

#: Words to a k-gram.
GRAM = 3
#: Diagonals this near, and runs this many words apart, are one span.
SHIFT = 2
GAP = 8
#: Share of a template's k-grams that a span must have.
LEAST_SHARE = 0.6

# Phrases whose places are counted, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening words of public license notices.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
]
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def template_grams(spark, phrases: dict[str, str], templates: list[tuple[str, str]], gram: int) -> DataFrame:
    """hash, gram, template, place, grams, label, base for each k-gram of each template."""
    texts = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for t, label in templates]
    rows = []
    for number, (text, label, base) in enumerate(texts):
        parts = text.split()
        count = len(parts) - gram + 1
        rows += [(" ".join(parts[i : i + gram]), number, i, count, label, base) for i in range(count)]
    table = spark.createDataFrame(rows, "gram string, template int, place int, grams int, label string, base boolean")
    return table.withColumn("hash", F.xxhash64("gram"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of each row.

    Every rolling k-gram of every text is joined to the template positions (a fixed, broadcast
    table). The hits of one offset between text and template are a diagonal's votes; near diagonals
    whose hits are near merge into a span, which stands if it has ``LEAST_SHARE`` of the template's
    k-grams. A phrase stands where all its k-grams are on one diagonal, which is an exact match, as
    k-grams are compared as text after their hashes. ``score`` is the best span's share, at most 1.

    Null text: empty, 0 words. Null doc_id: kept. Repeated rows: counted as one, returned as often as
    they occur. Empty table: empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_w") - gram, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get("_w", i + j) for j in range(gram)])
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    split = rows.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_key"), words(F.col("text")).alias("_w"))
    # the closing element stands for the document itself and meets a row of its own
    end = F.concat(F.lit("#"), F.size("_w").cast("string"))
    rolled = split.select("doc_id", "_key", F.posexplode(F.concat(F.when(F.size("_w") >= gram, grams).otherwise(F.array().cast("array<string>")), F.array(end))).alias("_at", "_gram"))
    known = template_grams(spark, phrases, templates, gram)
    document = spark.createDataFrame([("#", -1, 0, 0, "", False)], "gram string, template int, place int, grams int, label string, base boolean").withColumn("hash", F.lit(0).cast("long"))
    lookup = F.broadcast(known.unionByName(document).withColumnRenamed("gram", "_known"))
    is_end = F.col("_gram").startswith("#")
    hashed = rolled.select("doc_id", "_key", "_at", "_gram", F.when(is_end, F.lit(0).cast("long")).otherwise(F.xxhash64("_gram")).alias("hash"))
    hits = hashed.join(lookup, "hash").where((F.col("_known") == F.col("_gram")) | (F.col("_known") == "#") & is_end)
    once = hits.groupBy("doc_id", "_key", "template", "_at", "place", "grams", "label", "base", F.when(is_end, F.expr("int(substring(_gram, 2))")).alias("_n_words")).agg(F.count(F.lit(1)).alias("_rows"))

    by = ["doc_id", "_key", "template", "grams", "label", "base"]
    diagonal = once.groupBy(*by, (F.col("_at") - F.col("place")).alias("diagonal"), F.col("_n_words")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("_at").alias("start"), F.max("_at").alias("end"), F.max("_rows").alias("_rows"), F.max("_n_words").alias("n_words")
    )
    along = Window.partitionBy("doc_id", "_key", "template").orderBy("start", "diagonal")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > SHIFT) | (F.col("start") - F.max("end").over(earlier) > GAP)
    spans = (
        diagonal.withColumn("_span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(along))
        .groupBy(*by, "_span")
        .agg(
            F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("_rows").alias("_rows"), F.max("n_words").alias("n_words"),
            F.sum((F.col("base") & (F.col("votes") == F.col("grams"))).cast("long")).alias("places"),
            F.min(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("first"), F.max(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("last"),
        )
    )
    placed = F.col("base") & (F.col("places") > 0)
    share = F.when(F.col("grams") > 0, F.least(F.lit(1.0), F.col("votes") / F.col("grams")))
    found = placed | (~F.col("base") & (share >= LEAST_SHARE))
    span = F.struct((F.col("start")).cast("long").alias("start"), (F.col("end") + gram).cast("long").alias("end"), "label", share.alias("share"))
    text = lambda kept: F.concat_ws(",", F.array_sort(F.collect_set(F.when(kept, F.col("label")))))
    per_doc = spans.groupBy("doc_id", "_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.max(F.when(F.col("template") == -1, F.col("_rows"))).alias("_rows"),
        F.coalesce(F.sum(F.when(placed, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(placed, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(placed, F.col("last"))).cast("long").alias("last_word"),
        text(placed).alias("base_labels"), text(found).alias("labels"),
        F.coalesce(F.max(F.when(placed, F.lit(1.0)).when(found, share)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, span))).alias("spans"),
    )
    return per_doc.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))).drop("_copy", "_rows", "_key")


def op9_licenses(spark, folder: str) -> DataFrame:
    found = scan(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
