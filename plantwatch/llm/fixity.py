"""Merkle fixity audit of web archive replicas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import read_table, saved

#: Pages to an archive file, bytes to an offset range of the lowest level, ranges to one of the next.
FILE_PAGES = 1000
RANGE_BYTES = 1 << 16
FANOUT = 16
KEY = ["file", "offset"]


def responses(pages: DataFrame, file_pages: int = FILE_PAGES) -> DataFrame:
    """page_id, file, length and record (bytes) of each page as a WARC response record.

    A file holds ``file_pages`` consecutive ids; a null id is in file -1.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col("url").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    record = F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "utf-8")
    file = F.coalesce(F.floor(F.col("page_id") / F.lit(file_pages)), F.lit(-1)).cast("long")
    rows = pages.select(F.col("page_id").cast("long"), file.alias("file"), record.alias("record"))
    return rows.withColumn("length", F.octet_length("record").cast("long"))


def in_files(rows: DataFrame, tie: str) -> DataFrame:
    """Adds the offset of each row in its file, where rows stand by page_id and then ``tie``."""
    earlier = Window.partitionBy("file").orderBy("page_id", tie).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))


def archive_records(pages: DataFrame, file_pages: int = FILE_PAGES) -> DataFrame:
    """page_id, file, offset, length and record of each page, in files by their ids."""
    return in_files(responses(pages, file_pages), "record")


def leaves(records: DataFrame) -> DataFrame:
    """Each record's place and digest: the leaves of the tree. Digests that are there are taken."""
    kept = [c for c in ("page_id",) if c in records.columns]
    digest = F.col("digest") if "digest" in records.columns else F.sha2(F.coalesce("record", F.lit(b"")), 256)
    places = [F.coalesce(c, F.lit(-1)).alias(c) for c in KEY]
    return records.select(*places, "length", *kept, digest.alias("digest"))


def ranges(below: DataFrame, width: int) -> DataFrame:
    """Nodes over the offset ranges of ``width`` bytes: the digest of what stands below, in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "digest")))
    text = F.concat_ws(",", F.transform(parts, lambda p: F.concat_ws(":", p["offset"], p["length"], p["digest"])))
    place = (F.floor(F.col("offset") / F.lit(width)) * width).cast("long")
    return below.groupBy("file", place.alias("offset")).agg(F.sum("length").alias("length"), F.sha2(text, 256).alias("digest"))


def tree(lowest: DataFrame, widest: int, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the leaves up to one root per file; a node's children are its range's nodes below.

    Every level is ``fanout`` times smaller than the one below.
    """
    levels, width = [lowest], range_bytes
    levels.append(ranges(levels[0], width))
    while width <= widest:
        width *= fanout
        levels.append(ranges(levels[-1], width))
    return levels


def audit(ours: DataFrame, theirs: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file, offset, length, page_id (where records have one) and status of each record that differs.

    Roots are compared first; below them only the children of nodes that differ are compared, level
    by level, so an intact file costs one comparison. A replica that has a ``digest`` column (SHA-256
    of the bytes, made where they are) need not hold ``record``: leaves are all that is moved. Status: ``changed`` (another digest or length
    at this offset), ``missing`` or ``extra`` (there for one replica only). A record whose length
    changed moves all later ones of its file, which are then reported too.

    Records with null bytes hash as empty. Repeated rows count: twice the same record is not once.
    Null file or offset: compared as equal values. Empty replicas: all of the other is missing or
    extra; two empty ones agree. Other columns are ignored.
    """
    ours, theirs = (saved(leaves(f), "fixity") for f in (ours, theirs))
    widest = max(f.agg(F.max("offset")).first()[0] or 0 for f in (ours, theirs))
    a, b = (tree(f, widest, range_bytes, fanout) for f in (ours, theirs))
    width = range_bytes * fanout ** (len(a) - 2)
    suspects = None
    for level in range(len(a) - 1, 0, -1):
        pair = [f[level] for f in (a, b)]
        if suspects is not None:
            parent = (F.floor(F.col("offset") / F.lit(width * fanout)) * (width * fanout)).cast("long")
            pair = [f.withColumn("_up", parent).join(suspects, ["file", "_up"], "left_semi").drop("_up") for f in pair]
        suspects = _unlike(*pair).select("file", F.col("offset").alias("_up")).distinct()
        width //= fanout
    up = (F.floor(F.col("offset") / F.lit(range_bytes)) * range_bytes).cast("long")
    below = [f[0].withColumn("_up", up).join(suspects, ["file", "_up"], "left_semi").drop("_up") for f in (a, b)]
    return _unlike(*below)


def _unlike(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places where the two sides have not the same digests equally often."""
    kept = [c for c in ("page_id",) if c in left.columns]
    sides = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(-1)))
    same = sides.groupBy(*KEY, "length", "digest").agg(F.sum("_s").alias("_s"), *[F.min(c).alias(c) for c in kept])
    odd = same.where("_s != 0").groupBy(*KEY).agg(
        F.max(F.when(F.col("_s") > 0, F.col("length"))).alias("_l"), F.max(F.when(F.col("_s") < 0, F.col("length"))).alias("_r"),
        *[F.min(c).alias(c) for c in kept],
    )
    status = F.when(F.col("_l").isNull(), "extra").when(F.col("_r").isNull(), "missing").otherwise("changed")
    return odd.select(*KEY, F.coalesce("_l", "_r").alias("length"), *kept, status.alias("status"))


def damaged(record: Column, page_id: Column) -> Column:
    """The record, of which one byte is lost to ``#`` for some page ids."""
    hit = F.substring(F.md5(page_id.cast("string")), 1, 2) == "07"
    return F.when(hit, F.encode(F.overlay(F.decode(record, "utf-8"), F.lit("#"), F.lit(1)), "utf-8")).otherwise(record)


def without_tails(placed: DataFrame) -> DataFrame:
    """The rows without the last of every fourth file."""
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.col("offset").desc())) == 1
    return placed.withColumn("_cut", last & (F.pmod("file", F.lit(4)) == 3)).where("not _cut").drop("_cut")


def op2_fixity(spark, folder: str) -> DataFrame:
    """Two replicas of the archive of ``pages``, one with stated damage, each hashed record by record where its bytes are read."""
    rows = responses(read_table(spark, folder, "pages"))
    hurt = damaged(F.col("record"), F.col("page_id"))
    hashed = rows.select("page_id", "file", "length", F.sha2("record", 256).alias("digest"), F.sha2(hurt, 256).alias("_hurt"))
    placed = saved(in_files(hashed, "digest"), "archive")
    return audit(placed.drop("_hurt"), without_tails(placed).drop("digest").withColumnRenamed("_hurt", "digest"))


OP2_SQL = r"""
WITH r AS (
  SELECT page_id, page_id // 1000 AS file,
         octet_length(encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
           || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))
           || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)))::BIGINT AS length
  FROM pages),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
         row_number() OVER (PARTITION BY file ORDER BY page_id DESC) = 1 AND file % 4 = 3 AS cut,
         substr(md5(page_id::VARCHAR), 1, 2) = '07' AS hit FROM r)
SELECT file, "offset", length, page_id, CASE WHEN cut THEN 'missing' ELSE 'changed' END AS status FROM o WHERE cut OR hit
"""
