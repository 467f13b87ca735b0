"""Context-triggered piecewise fingerprints of texts, and how alike two of them are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.llm.common import SLAB_BYTES, joined_bytes, mixed, read_table, saved

#: Most chunks in the finer signature, and the least power of two of mean chunk bytes.
CHUNKS = 64
LEAST_LEVEL = 2
#: Two signatures this long are alike only if they share as long a run.
SHARED_RUN = 4
_WINDOW = 8
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BYTE_VALUES = np.append(np.uint64(0), mixed(np.arange(1, 256, dtype=np.uint64)))


def rolling(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the 8 bytes that end at each place."""
    h = _BYTE_VALUES[data]
    for step in (1, 2, 4):
        h[step:] += h[:-step] * np.uint64(pow(_BASE, step, 1 << 64))
    return mixed(h)


def fingerprints(texts: list[bytes]) -> list[str]:
    """``level:signature:coarser signature`` for each text.

    A chunk ends where the rolling hash starts with ``level`` zero bits, so chunks have about
    2**level bytes and a local edit changes few of them; each gives one letter. The level is the
    least that gives at most 64 chunks; the second signature is of the next level.
    """
    data, starts, ends = joined_bytes([b"", *texts], _WINDOW)
    starts, ends = starts[1:], ends[1:]
    h = rolling(data)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    h[np.cumsum(inside[:-1]) == 0] = 0
    hits = np.flatnonzero((h < np.uint64(1 << (64 - LEAST_LEVEL))) & (h > 0))
    level = (64 - np.frexp(h[hits].astype(np.float64))[1]).astype(np.int64)
    doc = np.searchsorted(ends, hits, side="right")
    per_level = np.bincount(doc * 66 + level, minlength=66 * len(texts)).reshape(len(texts), 66)
    reached = per_level[:, ::-1].cumsum(1)[:, ::-1]
    fits = reached < CHUNKS
    fits[:, :LEAST_LEVEL] = False
    own = fits.argmax(1)
    signed = [_signatures(h, hits[level >= own[doc] + up] + 1, starts, ends) for up in (0, 1)]
    return [f"{e if len(t) else 0}:{a}:{b}" for e, t, a, b in zip(own.tolist(), texts, *signed)]


def _signatures(h: np.ndarray, cuts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    filled = starts[starts < ends]
    begins = np.union1d(filled, cuts[~np.isin(cuts, ends)])
    if not len(begins):
        return [""] * len(starts)
    letters = _LETTERS[(mixed(np.add.reduceat(h, begins)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()
    return [letters[a:b] for a, b in zip(np.searchsorted(begins, starts).tolist(), np.searchsorted(begins, ends).tolist())]


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for letter in b:
        met = row & places.get(letter, 0)
        row = ((row + met) | (row - met)) & every
    return len(a) - row.bit_count()


def _close(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if min(len(a), len(b)) >= SHARED_RUN:
        runs = {a[i : i + SHARED_RUN] for i in range(len(a) - SHARED_RUN + 1)}
        if not any(b[i : i + SHARED_RUN] in runs for i in range(len(b) - SHARED_RUN + 1)):
            return 0.0
    return 2 * common_letters(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: one minus the edits (insert, delete) per letter, of signatures of the same level."""
    if a == b:
        return 1.0
    (la, a1, a2), (lb, b1, b2) = a.split(":"), b.split(":")
    if la == lb:
        return max(_close(a1, b1), _close(a2, b2))
    if int(la) == int(lb) + 1:
        return _close(a1, b2)
    return _close(a2, b1) if int(lb) == int(la) + 1 else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the start of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _in_slabs(texts: list[bytes]) -> list[str]:
    out, start, size = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if text is None or (i > start and size + len(text) > SLAB_BYTES):
            out += fingerprints(texts[start:i]) if i > start else []
            start, size = i, 0
        size += len(text or b"")
    return out


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_ENDS = pa.schema([*_OUT, ("part", pa.int32()), ("end", pa.string()), ("text", pa.string())])
_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _rows(pairs: list[tuple]) -> list[tuple]:
    """pairs: (doc_id, text, fingerprint, next text, next fingerprint)."""
    changed = [edited(text, following) for _, text, _, following, _ in pairs]
    data = [t.encode() for t in changed]
    prints = _in_slabs(data)
    return [
        (doc, len(text), hashlib.sha256(raw).hexdigest(), own, new, likeness(own, new), likeness(own, after))
        for (doc, text, own, _, after), raw, new in zip(pairs, data, prints)
    ]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents of a sorted part but its last; its first and last documents as ends."""
    part = TaskContext.get().partitionId()
    first = last = None
    for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        prints = _in_slabs([t.encode() for t in texts])
        own = list(zip(batch.column("doc_id").to_pylist(), texts, prints))
        first = first or own[0]
        chain = ([last] if last else []) + own
        yield _batch([(*r, None, None, None) for r in _rows([(*a, *b[1:]) for a, b in zip(chain, chain[1:])])], _ENDS)
        last = own[-1]
    if last:
        ends = [("first", first), ("last", last)]
        yield _batch([(doc, None, None, fp, None, None, None, part, end, text) for end, (doc, text, fp) in ends], _ENDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the last document of each part to the first of the next, the very last to the very first."""
    opening = waiting = None
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["doc_id"], row["text"], row["fingerprint"])
            if row["end"] == "last":
                waiting = own
                continue
            opening = opening or own
            if waiting:
                yield _batch(_rows([(*waiting, *own[1:])]), _OUT)
    if waiting:
        yield _batch(_rows([(*waiting, *opening[1:])]), _OUT)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit by the next document's start, and their likenesses.

    Documents are dealt once by range of doc_id and sorted within their part; each meets the next
    in a stream. Only the first and last document of each part go on to a second step, which is two
    documents a part however many there are.

    Null text: empty. Null doc_id: before all others. Rows with the same doc_id: by text, then each
    is the next of the one before. One row: it is its own next. Empty table: empty. Other columns
    are ignored.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    dealt = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").repartitionByRange(order[0]).sortWithinPartitions(*order)
    found = saved(dealt.mapInArrow(_pairs, _DDL + ", part int, end string, text string"), "fingerprints")
    ends = found.where("end is not null").repartition(1).sortWithinPartitions("part", "end")
    return found.where("end is null").select(*_OUT.names).unionByName(ends.mapInArrow(_last_rows, _DDL))


def op4_fingerprints(spark, folder: str) -> DataFrame:
    return fingerprint(read_table(spark, folder, "documents"))
