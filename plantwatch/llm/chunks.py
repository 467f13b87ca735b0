"""Substring deduplication by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from plantwatch.llm.common import cuts, joined_bytes, mixed, read_table, set_aside, text_key

#: A chunk ends where these bits of the rolling hash are zero: one byte in 32.
CUT_BITS = np.uint16(0b11111 << 11)
#: The hash's 16 bits depend on the last 16 bytes only.
WINDOW = 16
#: Least characters of a run of repeated chunks that counts as a repeated passage.
LEAST_RUN = 96
_GEAR = np.append(np.uint16(0), (mixed(np.arange(1, 256, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16))


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash (shift left, add the byte's number) modulo 2**16 at each byte."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint16(step)
    return h


def cut_points(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, and each chunk's text, start and end in it."""
    data, starts, ends = joined_bytes([b"", *texts], WINDOW)
    starts, ends = starts[1:], ends[1:]
    cut = np.flatnonzero((gear(data) & CUT_BITS) == 0) + 1
    doc = np.searchsorted(ends, cut - 1, side="right")
    inside = doc < len(ends)
    inside[inside] = (cut[inside] > starts[doc[inside]]) & (cut[inside] < ends[doc[inside]])
    begins = np.union1d(starts[starts < ends], cut[inside])
    of = np.searchsorted(ends, begins, side="right")
    stops = np.minimum(np.append(begins[1:], len(data)), ends[of]) if len(begins) else begins
    return data, of, begins, stops


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (digest of the whole text), digest, start and end (code points) of each chunk.

    Boundaries depend on the last 16 bytes alone, so a passage is cut alike wherever it stands.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in cuts(batch):
                part = batch.slice(i, j - i)
                texts = pc.fill_null(part.column("text").cast(pa.binary()), b"").to_pylist()
                data, of, begins, stops = cut_points(texts)
                raw = memoryview(data)
                digest = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begins.tolist(), stops.tolist())]
                keys = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
                before = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points up to each byte
                base = before[np.cumsum([WINDOW] + [len(t) + WINDOW for t in texts[:-1]])]
                ids = part.column("doc_id").take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(keys[of]), pa.array(np.array(digest, np.uint64).view(np.int64)),
                     pa.array((before[begins] - base[of]).astype(np.int32)), pa.array((before[stops] - base[of]).astype(np.int32))],
                    schema=schema,
                )

    wanted = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return wanted.mapInArrow(run, "doc_id bigint, text_key bigint, digest bigint, start int, end int")


def repeated_passages(docs: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """Stretches of at least ``least`` characters whose chunks all stand elsewhere as well.

    One row per stretch of each document: doc_id, start, end (code points, end exclusive), n_chunks,
    first_doc_id (the smallest doc_id that has one of its chunks; this document's, if kept) and kept
    (this document is the first that has its chunks, so a deduplication leaves the stretch there and
    cuts it from the others). A stretch of which a document is first in parts gives one row for each
    part of at least ``least`` characters. A shorter part that is first here is left without a row; one
    that stands first elsewhere goes with the kept part beside it, so chance repeats of single chunks
    cut no hole into a passage.

    Digests are counted with partial aggregation and joined back to the chunks; a very common chunk
    is split by Spark's skew handling. Only repeated chunks are ordered within their document.
    Null or empty text: no rows. Null doc_id: no first_doc_id of its own. Equal texts under different
    doc_ids, one of them null or not, are different documents. Repeated rows of one doc_id and text
    count as one document. Empty table: empty. Other columns are ignored.
    """
    return _passages(docs, least).drop("text_key")


def _passages(docs: DataFrame, least: int) -> DataFrame:
    """``repeated_passages`` with the text_key of the text that each stretch is in."""
    found = chunks(docs)
    several = "min(doc_id) != max(doc_id) or count(doc_id) between 1 and count(*) - 1"
    counted = (
        found.groupBy("digest").agg(
            F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_first"),
            F.coalesce(F.expr(several), F.lit(False)).alias("_several"), F.min("text_key").alias("_a"), F.max("text_key").alias("_b"), F.min("start").alias("_c"), F.max("start").alias("_d"),
        )
        .where("_n > 1 and (_several or _a != _b or _c != _d)").select("digest", "_first")
    )
    again = found.join(counted, "digest").select("doc_id", "text_key", "start", "end", "_first").distinct()
    own = Window.partitionBy("doc_id", "text_key").orderBy("start")
    whole = Window.partitionBy("doc_id", "text_key", "_run")
    run = F.sum(F.when(F.lag("end").over(own) == F.col("start"), 0).otherwise(1)).over(own)
    chars = F.col("end") - F.col("start")
    pieces = (
        again.withColumn("_run", run).withColumn("_mine", F.coalesce(F.col("_first") == F.col("doc_id"), F.lit(False)))
        .withColumn("_piece", _stretch(own, "_mine"))
        .groupBy("doc_id", "text_key", "_run", "_piece", "_mine")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_chunks"), F.min("_first").alias("_first"))
    )
    return (
        pieces.withColumn("_chars", F.max("end").over(whole) - F.min("start").over(whole)).where(F.col("_chars") >= least)
        .withColumn("kept", F.col("_mine") | ((chars < least) & F.max("_mine").over(whole)))
        .withColumn("_piece", _stretch(own, "kept"))
        .groupBy("doc_id", "text_key", "_piece", "kept")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_chunks").alias("n_chunks"),
             F.min(F.when(F.col("_mine") | ~F.col("kept"), F.col("_first"))).alias("first_doc_id"))
        .where(chars >= least)
        .select("doc_id", "text_key", F.col("start").cast("long"), F.col("end").cast("long"), "n_chunks", "first_doc_id", "kept")
    )


def _stretch(own: Window, state: str) -> Column:
    """Numbers rows of one ``_run`` and one state that follow each other."""
    same = (F.lag("_run").over(own) == F.col("_run")) & (F.lag(state).over(own) == F.col(state))
    return F.sum(F.when(same, 0).otherwise(1)).over(own)


def without_repeats(docs: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """The rows of docs, each repeated stretch cut from all documents but the first that has it.

    A document is a doc_id and its text, so another text under the same doc_id is cut by its own
    stretches only. Null doc_id: not cut. Null or empty text:
    as it is. Repeated rows: each is returned, cut alike. Empty table: empty. Other columns, whatever
    their names, come back as they are.
    """
    inner, back = set_aside(docs, ["doc_id", "text"])
    cut = (
        _passages(docs, least).where("not kept and doc_id is not null").groupBy(text_key("doc_id").alias("_own"), F.col("text_key").alias("_key"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    )
    parts = F.expr(
        "concat(aggregate(_cuts, named_struct('t', '', 'at', 0L), (acc, c) -> named_struct('t', "
        "concat(acc.t, substring(text, int(acc.at + 1), int(c.start - acc.at))), 'at', c.end), acc -> acc.t), "
        "substring(text, int(array_max(_cuts).end + 1), char_length(text)))"
    )
    keyed = inner.withColumns({"_own": text_key(F.col("doc_id").cast("bigint")), "_key": text_digests("text")})
    whole = keyed.join(cut, ["_own", "_key"], "left")
    return back(whole.withColumn("text", F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(parts)))


@F.pandas_udf(LongType())
def text_digests(texts: pd.Series) -> pd.Series:
    """The text_key of each text, as ``chunks`` gives it."""
    keys = [xxhash.xxh3_64_intdigest(t.encode()) if t is not None else xxhash.xxh3_64_intdigest(b"") for t in texts]
    return pd.Series(np.array(keys, np.uint64).view(np.int64))


def op6_substrings(spark, folder: str) -> DataFrame:
    return repeated_passages(read_table(spark, folder, "documents"))
