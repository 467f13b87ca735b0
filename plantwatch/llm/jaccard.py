"""Exact join of documents whose word n-gram sets are alike, in the metric space of Jaccard distance.

One minus the Jaccard similarity is a metric. With similarity 0.75 wanted, linked documents are at
most 0.25 apart, and their sets differ in at most (n + m) / 7 shingles.

Level one: every shingle is a pivot, a set of one. A document is as near to each shingle it has and
at distance one from all others; ties go by the order rare before common, then by hash. Its region
is that of its nearest pivot, and its window reaches over the n - ceil(0.75 n) + 1 nearest: a linked
document lacks too few of them to be in none. (Documents as first pivots cannot separate others: a
text shares no shingle with most texts, so it is at distance one from all pivots and in every window.)

Level two: in a region, documents are points whose coordinates are counts of shingles by hash bucket.
The sum of coordinate differences never exceeds the number of shingles in which two sets differ, so
pairs further apart than (n + m) / 7 are cut off by the triangle inequality. The document nearest to
the region's centre is its pivot; the documents inside its radius are compared with it exactly, and
those that link form one component, inside which nothing more needs comparing. What is left of the
regions, with large ones split again into cells, is joined exactly across components. Before two
texts are read, finer coordinates of the same kind (parities of shingle counts) must allow the pair.
Near copies share very many pivots: regions with the same members are one region from level two on.
In a region this recurses: what is outside the ball of one pivot gets a pivot of its own, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import BROADCAST_ROWS, SLAB_BYTES, cuts, freed, joined_bytes, keeps, mixed, read_table, saved, scratch, set_aside, small_or_plain, text_key
from plantwatch.llm.components import components

SHINGLE = 5
#: A shingle whose upper half is that of more windows' shingles than this is common: it comes last in
#: the order. At most so many halves are kept.
COMMON = 100
COMMON_KEPT = 1_000_000
BUCKETS = 64
#: Bits of a set's parity sketch for each of its shingles, up to the next power of two. Two sets
#: differ in at least as many shingles as their sketches in bits; the longer one is folded first.
BITS_EACH = 2
#: Postings after which a task passes on what it has gathered.
FLUSH = 1_000_000
#: Documents of a region (or compared with one pivot) that one task joins; regions up to so many travel as one row.
CELL_ROWS = 4096
PIVOTS_TRIED = 2
#: In a region, sets of up to FOLDED_SIZE shingles are compared by sketches folded to so many bits too.
FOLDED_BITS = 1024
FOLDED_SIZE = 1334

_BASE = 0x9E3779B97F4A7C15
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[int, np.ndarray] = {}
keeps(_POWERS.clear)


def _powers(base: int, count: int) -> np.ndarray:
    """Powers of the base from 0; those that a slab needs are kept, longer texts have their own."""
    if base not in _POWERS or len(_POWERS[base]) < count:
        steps = np.full(max(count, SLAB_BYTES + (SLAB_BYTES >> 3)), np.uint64(base))
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        if base in _POWERS:
            return powers[:count]
        _POWERS[base] = powers[: SLAB_BYTES + (SLAB_BYTES >> 3)].copy()
        return powers[:count]
    return _POWERS[base][:count]


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles; a shorter text is one shingle."""
    data, starts, ends = joined_bytes(texts, 1)
    data = _FOLD[data]
    black = ~_SPACE[data]
    black[ends] = False
    edge = np.flatnonzero(np.diff(np.concatenate([[False], black, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    low = np.cumsum(_BYTES[data] * _powers(pow(_BASE, -1, 1 << 64), len(data)))
    sums = low[stop - 1] - np.where(begin > 0, low[begin - 1], np.uint64(0))
    word = mixed(sums * _powers(_BASE, len(data))[stop - 1] + (stop - begin).astype(np.uint64))
    first = np.searchsorted(begin, starts).tolist()
    last = np.searchsorted(begin, ends).tolist()
    count = len(word) - size + 1
    rolled = np.zeros(max(count, 0), np.uint64)
    for j in range(size if count > 0 else 0):
        rolled = rolled * np.uint64(_BASE) + word[j : j + count]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(first, last):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int:
    """64-bit id of a set; equal sets are one class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def coordinates(shingles: np.ndarray) -> bytes:
    """Counts by hash bucket (a byte each, at most 255), then parities of finer counts, folded and in full."""
    counts = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    bits = 1 << max(10, (BITS_EACH * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(8)).astype(np.int64) % bits, minlength=bits) & 1
    packed = np.packbits(odd.astype(np.uint8)).tobytes()
    short = _folded(packed, len(packed), FOLDED_BITS // 8) if len(shingles) <= FOLDED_SIZE else np.zeros(FOLDED_BITS // 64, np.uint64)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + short.tobytes() + packed


def upper(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


def windows(sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, shingle) of each set's nearest pivots: the first n - ceil(0.75 n) + 1, those with common upper halves last."""
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    every, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), counts)
    last = _among(common, every)
    starts = np.cumsum(counts) - counts
    before = np.append(0, np.cumsum(~last))
    rare = before[starts + counts] - before[starts]
    ahead = before[:-1] - before[starts][of]
    rank = np.where(last, rare[of] + (np.arange(len(every)) - starts[of] - ahead), ahead)
    kept = rank < (counts // 4 + 1)[of]
    return of[kept], every[kept]


def _among(common: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(shingles), bool)
    halves = upper(shingles)
    return common[np.minimum(np.searchsorted(common, halves), len(common) - 1)] == halves


_SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("raw", pa.binary()), ("doc_id", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("key", pa.int64())])
_SENT_DDL = "bucket int, kind tinyint, raw binary, doc_id bigint, class bigint, n int, key bigint"
_MET_DDL = _SENT_DDL.replace("bucket int, ", "") + ", members array<bigint>"


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[np.ndarray]]]:
    for batch in batches:
        for i, j in cuts(batch):
            part = batch.slice(i, j - i)
            texts = pc.fill_null(part.column("text").cast(pa.binary()), b"").to_pylist()
            yield part.column("doc_id").to_pylist(), part.column("key").to_pylist(), shingle_sets(texts)


def _own_id(doc_id: str = "doc_id", key: str = "key") -> Column:
    """Names a row by its doc_id, null or not, and its text: rows without an id, or with one id, stay apart."""
    return F.concat_ws(":", text_key(doc_id), F.col(key))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _common_shingles(rows: DataFrame, buckets: int, least: int, most: int) -> np.ndarray:
    """Upper halves of the shingles in more than ``least`` windows, the ``most`` frequent of them, sorted.

    Counted over all documents. Halves that meet by chance only put a rare shingle late in the order.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            shingles, counts = np.unique(np.concatenate(held), return_counts=True)
            place = (shingles % np.uint32(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(buckets + 1))
            raws = []
            for a, b in zip(edges, edges[1:]):
                one, many = (order[a:b][m] for m in (counts[order[a:b]] == 1, counts[order[a:b]] > 1))
                head = np.array([len(one)], np.uint32)
                raws.append(np.concatenate([head, shingles[one], shingles[many], counts[many].astype(np.uint32)]).tobytes())
            return pa.RecordBatch.from_pydict({"bucket": np.arange(buckets, dtype=np.int32), "raw": raws})

        for _, _, sets in _sets_of(batches):
            distinct = list({s.tobytes(): s for s in sets}.values())
            held.append(upper(windows(distinct, np.zeros(0, np.uint32))[1]))
            size += len(held[-1])
            if size > FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = [], []
        for batch in batches:
            for raw in batch.column("raw").to_pylist():
                row = np.frombuffer(raw, np.uint32)
                single = int(row[0])
                many = (len(row) - 1 - single) // 2
                shingles.append(row[1 : 1 + single + many])
                counts.append(np.append(np.ones(single, np.uint32), row[1 + single + many :]))
        if shingles:
            every, size = np.concatenate(shingles), np.concatenate(counts).astype(np.int64)
            order = np.argsort(every, kind="stable")
            every, size = every[order], size[order]
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            total = np.add.reduceat(size, first) if len(first) else size
            hit = total > least
            yield pa.RecordBatch.from_pydict({"shingle": every[first][hit].astype(np.int64), "n": total[hit].astype(np.int64)})

    counted = rows.mapInArrow(freed(send), "bucket int, raw binary").repartition("bucket").mapInArrow(freed(count), "shingle bigint, n bigint")
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    return np.sort(top["shingle"].to_numpy().astype(np.uint32)) if top.num_rows else np.zeros(0, np.uint32)


def _regions(rows: DataFrame, buckets: int, common: np.ndarray) -> DataFrame:
    """kind 0: doc_id, key, class, n, raw (coordinates) of each document; kind 1: doc_id (a shingle) and class of
    each posting in a large region; kind 2: doc_id (a shingle) and members of each other region of two classes at least.

    Postings travel as arrays, one row for each bucket of shingles; those of common shingles, whose
    regions are large, are not gathered but passed on one by one.
    """
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            shingles, classes = (np.concatenate(x) for x in zip(*held))
            place = (shingles % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(buckets + 1))
            raws = []
            for a, b in zip(edges, edges[1:]):
                own, back = np.unique(classes[order[a:b]], return_inverse=True)
                regroup = np.argsort(back, kind="stable")
                head = np.array([len(own)], np.int64)
                raws.append(np.concatenate([head, own, np.bincount(back, minlength=len(own)), shingles[order[a:b]][regroup].view(np.int64)]).tobytes())
            none = [None] * buckets
            return _sent(np.arange(buckets, dtype=np.int32), np.full(buckets, 2), raws, none, none, none, none)

        for ids, keys, sets in _sets_of(batches):
            classes = np.array([class_of(s) for s in sets], np.int64)
            sizes = [len(s) for s in sets]
            marks = [coordinates(x) for x in sets]
            place = ((classes >> 8) % buckets).astype(np.int32)
            yield _sent(place, np.zeros(len(ids)), marks, ids, classes, sizes, keys)
            alone = np.unique(classes, return_index=True)[1]
            of, shingles = windows([sets[i] for i in alone], hot)
            own = classes[alone][of]
            if len(hot):
                big = _among(hot, shingles)
                if big.any():
                    k = int(big.sum())
                    yield _sent(((own[big] >> 8) % buckets).astype(np.int32), np.ones(k), [None] * k, shingles[big].view(np.int64), own[big], [None] * k, [None] * k)
                    shingles, own = shingles[~big], own[~big]
            held.append((shingles, own))
            size += len(own)
            if size > FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, classes = [], []
        for batch in batches:
            gathered = pc.equal(batch.column("kind"), 2)
            yield _met(batch.filter(pc.invert(gathered)))
            for raw in batch.column("raw").filter(gathered).to_pylist():
                row = np.frombuffer(raw, np.int64)
                k = int(row[0])
                classes.append(np.repeat(row[1 : 1 + k], row[1 + k : 1 + 2 * k]))
                shingles.append(row[1 + 2 * k :])
        if shingles:
            every, own = np.concatenate(shingles), np.concatenate(classes)
            order = np.lexsort((own, every))
            every, own = every[order], own[order]
            new = np.append(True, (every[1:] != every[:-1]) | (own[1:] != own[:-1]))
            every, own = every[new], own[new]
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            counts = np.diff(np.append(first, len(every)))
            large = np.repeat(counts > CELL_ROWS, counts)
            for i in range(0, int(large.sum()), 100_000):
                part = every[large][i : i + 100_000]
                k = len(part)
                yield _met(_sent(np.zeros(k), np.ones(k), [None] * k, part, own[large][i : i + 100_000], [None] * k, [None] * k))
            shared = (counts > 1) & (counts <= CELL_ROWS)
            first, counts = first[shared], counts[shared]
            for i, j in _ranges(counts, 100_000):
                k = j - i
                members = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts[i:j])).astype(np.int32), _stretches(own, first[i:j], counts[i:j]))
                yield _met(_sent(np.zeros(k), np.full(k, 2), [None] * k, every[first[i:j]], [None] * k, [None] * k, [None] * k), members)

    sent = rows.mapInArrow(freed(send), _SENT_DDL).repartition("bucket")
    return saved(sent.mapInArrow(freed(meet), _MET_DDL), "regions")


def _met(batch: pa.RecordBatch, members: pa.Array | None = None) -> pa.RecordBatch:
    without = batch.drop_columns(["bucket"])
    return without.append_column("members", pa.nulls(len(batch), pa.list_(pa.int64())) if members is None else members)


def _ranges(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of regions that hold about ``limit`` members together."""
    piece = np.cumsum(counts) // limit
    edges = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(counts) else np.zeros(0, np.int64)
    yield from zip(edges.tolist(), np.append(edges[1:], len(counts)).tolist())


def _stretches(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[first[i] : first[i] + counts[i]] for each i, end to end."""
    return values[np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)]


def _sent(*columns) -> pa.RecordBatch:
    arrays = [pa.array(c.astype(f.type.to_pandas_dtype()) if isinstance(c, np.ndarray) else c, f.type) for c, f in zip(columns, _SENT)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SENT)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Whole cells, many at a time, from batches sorted by cell: their columns and where each cell starts."""
    held: list[pa.RecordBatch] = []

    def whole(last: bool) -> tuple[dict[str, np.ndarray], np.ndarray]:
        nonlocal held
        table = pa.Table.from_batches(held).combine_chunks()
        keys = np.stack([table[c].to_numpy() for c in ("shingle", "i", "j")])
        edge = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
        done = len(table) if last else int(edge[-1])
        held = table.slice(done).to_batches()
        part = table.slice(0, done)
        columns = {c: part[c].to_numpy() for c in part.column_names if c not in ("raw", "odd")}
        if "odd" in part.column_names:
            columns["odd"] = np.frombuffer(b"".join(part["odd"].to_pylist()), np.uint64).reshape(-1, FOLDED_BITS // 64)
        columns["raw"] = np.frombuffer(b"".join(part["raw"].to_pylist()), np.uint8).reshape(-1, BUCKETS)
        return columns, edge[edge < done]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            found = whole(last=False)
            if len(found[1]):
                yield found
    if held:
        yield whole(last=True)


def _pivot_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each region, the documents that may link with the one nearest to its centre, its pivot.

    What the pivot's ball leaves has a pivot of its own, and so on while balls hold one document
    besides their pivot on average; then the region has no more dense groups to find.
    """
    for cell, first in _cells(batches):
        n, raw = cell["n"].astype(np.int64), cell["raw"]
        shape = raw.astype(np.float32) / n[:, None].astype(np.float32)
        region = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(n))))
        left, caught, rounds = np.arange(len(n)), np.zeros(len(first), np.int64), 0
        found = [np.zeros((2, 0), np.int64)]
        while len(left):
            own = region[left]
            start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            counts = np.diff(np.append(start, len(own)))
            centre = np.add.reduceat(shape[left], start, axis=0) / counts[:, None]
            off = np.abs(shape[left] - np.repeat(centre, counts, axis=0)).sum(1)
            pivot = np.repeat(left[np.lexsort((cell["class"][left], off, own))[start]], counts)
            fits = (pivot != left) & (4 * n[left] >= 3 * n[pivot]) & (4 * n[pivot] >= 3 * n[left])
            rows = np.flatnonzero(fits)
            near = 7 * np.abs(raw[left[rows]].astype(np.int16) - raw[pivot[rows]]).sum(1) <= n[left[rows]] + n[pivot[rows]]
            rows = rows[near]
            found.append(np.stack([cell["class"][left[rows]], cell["class"][pivot[rows]]]))
            caught += np.bincount(own[rows], minlength=len(first))
            rounds += 1
            outside = pivot != left
            outside[rows] = False
            outside &= (caught >= rounds)[own]
            left = left[outside]
        pairs = np.unique(np.concatenate(found, 1), axis=1)
        yield pa.RecordBatch.from_pydict({"a": pairs[0], "b": pairs[1]})


def _cross_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each cell, the pairs of different components that may link."""
    for cell, first in _cells(batches):
        counts = np.diff(np.append(first, len(cell["n"])))
        group = cell["component"]
        open_ = np.minimum.reduceat(group, first) != np.maximum.reduceat(group, first)
        found = [np.zeros((2, 0), np.int64)]
        whole = open_ & (cell["i"][first] == cell["j"][first])
        for size in np.unique(counts[whole]).tolist():
            starts = first[whole & (counts == size)]
            left, right = np.triu_indices(size, 1)
            step = max(1, 400_000 // len(left))
            for k in range(0, len(starts) if size <= 256 else 0, step):
                a, b = ((starts[k : k + step, None] + side).ravel() for side in (left, right))
                found.append(_may_link(cell, a, b))
        for start, size in zip(first[open_].tolist(), counts[open_].tolist()):
            if size > 256 or cell["i"][start] != cell["j"][start]:
                own = cell["own"][start : start + size]
                left, right = (start + np.flatnonzero(own == cell[c][start]) for c in ("i", "j"))
                for k in range(0, len(left), 64):
                    a, b = (x.ravel() for x in np.meshgrid(left[k : k + 64], right, indexing="ij"))
                    found.append(_may_link(cell, a, b))
        pairs = np.concatenate(found, 1)
        if pairs.shape[1]:
            pairs = np.unique(np.sort(pairs, 0), axis=1)
            yield pa.RecordBatch.from_pydict({"a": pairs[0], "b": pairs[1]})


def _may_link(cell: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the pairs of rows, the classes of those that components, sizes and coordinates allow to link."""
    n, group = cell["n"].astype(np.int64), cell["component"]
    ok = (group[a] != group[b]) & (4 * n[a] >= 3 * n[b]) & (4 * n[b] >= 3 * n[a])
    a, b = a[ok], b[ok]
    ok = 7 * np.abs(cell["raw"][a].astype(np.int16) - cell["raw"][b]).sum(1) <= n[a] + n[b]
    a, b = a[ok], b[ok]
    small = (n[a] <= FOLDED_SIZE) & (n[b] <= FOLDED_SIZE)
    ok = ~small | (7 * np.bitwise_count(cell["odd"][a] ^ cell["odd"][b]).sum(1, dtype=np.int64) <= n[a] + n[b])
    return np.stack([cell["class"][a[ok]], cell["class"][b[ok]]])


def _folded(raw: bytes, size: int, to: int) -> np.ndarray:
    """Sketches of ``size`` bytes each as rows of 64-bit words, folded to ``to`` bytes."""
    rows = np.frombuffer(raw, np.uint64).reshape(-1, size // to, to // 8)
    return np.bitwise_xor.reduce(rows, axis=1)


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose parity sketches allow a link, with the share of bits in which they differ."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("_x").to_pylist(), batch.column("_y").to_pylist()
            lengths = np.array([(len(p), len(q)) for p, q in zip(x, y)], np.int64).reshape(-1, 2)
            apart = np.zeros(len(x), np.int64)
            for p, q in np.unique(lengths, axis=0).tolist():
                rows = np.flatnonzero((lengths == (p, q)).all(1))
                left, right = (_folded(b"".join(side[i] for i in rows), size, min(p, q)) for side, size in ((x, p), (y, q)))
                apart[rows] = np.bitwise_count(left ^ right).sum(1)
            sizes = batch.column("_sizes").to_numpy()
            ok = 7 * apart <= sizes
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").to_numpy()[ok], "b": batch.column("b").to_numpy()[ok], "apart": apart[ok] / sizes[ok]})

    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    classes = classes.join(small_or_plain(saved(ends.distinct(), "ends")), "class", "left_semi")
    sides = [classes.select(F.col("class").alias(c), F.col("n").alias(f"_n{c}"), F.col("bits").alias(f)) for c, f in (("a", "_x"), ("b", "_y"))]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "_x", "_y", (F.col("_na") + F.col("_nb")).cast("long").alias("_sizes"))
    return saved(both.mapInArrow(freed(keep), "a bigint, b bigint, apart double"), "possible")


def _linked(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link, compared exactly on the texts of one document each.

    The text of b is read once per slice of its partners, theirs stream past it.
    """
    degrees = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL_ROWS)).cast("int").alias("_slices"))
    dealt = saved(
        pairs.join(degrees, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("_slices")).cast("int").alias("slice")), "pairs"
    )
    roles = dealt.select("a", "b", "slice", F.lit(1).alias("role"), F.col("a").alias("class")).unionByName(
        dealt.select("b", "slice").distinct().select(F.lit(None).cast("long").alias("a"), "b", "slice", F.lit(0).alias("role"), F.col("b").alias("class"))
    )
    wanted = roles.select("class").distinct().join(classes.select("class", "_id"), "class")
    texts = rows.withColumn("_id", _own_id()).join(small_or_plain(saved(wanted, "wanted")), "_id").select("class", "text")
    meeting = roles.join(texts, "class").select("b", "slice", "role", "class", "text").repartition("b", "slice").sortWithinPartitions("b", "slice", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base = None, None
        for batch in batches:
            for i, j in cuts(batch):
                part = batch.slice(i, j - i)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                found = []
                meta = zip(part.column("b").to_pylist(), part.column("slice").to_pylist(), part.column("role").to_pylist(), part.column("class").to_pylist())
                for (b, piece, role, own), shingles in zip(meta, shingle_sets(texts)):
                    if class_of(shingles) != own:
                        continue  # another text with the same doc_id and hash
                    if role == 0:
                        key, base = (b, piece), shingles
                    elif key == (b, piece):
                        both = len(np.intersect1d(base, shingles, assume_unique=True))
                        if 100 * both >= 75 * (len(base) + len(shingles) - both):
                            found.append((own, b))
                if found:
                    a, b = zip(*found)
                    yield pa.RecordBatch.from_pydict({"a": list(a), "b": list(b)})

    return saved(meeting.mapInArrow(freed(compare), "a bigint, b bigint").distinct(), "links")


def near_groups(docs: DataFrame, common: int = COMMON, common_kept: int = COMMON_KEPT, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row: the smallest doc_id it is linked with, over any number of links.

    Exact: see the module's text. Equal sets are one class and are compared once. Shingles are 64-bit
    hashes; a pair's verdict would change only if two of its shingles collided.

    Null or empty text, or one without words: no shingles, its own component. Null doc_id: in its
    group but never its name; a group of such rows only has a null name. Repeated rows: each is
    returned. Empty table: empty. Other columns are ignored.
    """
    return _named(docs, common, common_kept, cell_rows).select("doc_id", "n_shingles", "component_id")


def _named(docs: DataFrame, common: int = COMMON, common_kept: int = COMMON_KEPT, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``near_groups`` with the hash of each row's text as ``key``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("key"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _regions(rows, buckets, _common_shingles(rows, buckets, common, common_kept))
    members = found.where("kind = 0").select("doc_id", "key", "class", "n", "raw")
    classes = saved(
        members.where("n > 0").groupBy("class").agg(F.min(F.struct("doc_id", "key", "n", "raw")).alias("_r"))
        .select("class", _own_id("_r.doc_id", "_r.key").alias("_id"), F.col("_r.n").alias("n"), F.expr(f"substring(_r.raw, 1, {BUCKETS})").alias("raw"),
                F.expr(f"substring(_r.raw, {BUCKETS + 1}, {FOLDED_BITS // 8})").alias("odd"),
                F.expr(f"substring(_r.raw, {BUCKETS + FOLDED_BITS // 8 + 1}, octet_length(_r.raw))").alias("bits")), "classes"
    )
    regions = found.where("kind = 2").groupBy("members").agg(F.min("doc_id").alias("shingle"))
    large = found.where("kind = 1").select(F.col("doc_id").alias("shingle"), "class")
    postings = saved(large.unionByName(regions.select("shingle", F.explode("members").alias("class"))), "postings")
    sizes = postings.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("int").alias("parts"))
    split = small_or_plain(saved(sizes.where("parts > 1"), "split"))
    placed = (
        postings.join(split, "shingle", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    )
    own_cell = placed.join(classes.select("class", "n", "raw"), "class").withColumns({"i": F.col("own"), "j": F.col("own")})
    order = ["shingle", "i", "j"]
    to_pivots = own_cell.select(*order, "class", "n", "raw").repartition(*order).sortWithinPartitions(*order)
    tried = Window.partitionBy("a").orderBy("apart", "b")
    stars = _possible(saved(to_pivots.mapInArrow(freed(_pivot_pairs), "a bigint, b bigint").distinct(), "near-pivots"), classes)
    stars = stars.withColumn("_nth", F.row_number().over(tried)).where(F.col("_nth") <= PIVOTS_TRIED).select("a", "b")
    links = _linked(stars, classes, rows)
    first = components(links)
    state = classes.join(first.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    grouped = placed.join(saved(state.select("class", "n", "raw", "odd", "component"), "state"), "class")
    every = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    cells = grouped.withColumn("_cell", F.explode(every)).select("shingle", "_cell.i", "_cell.j", "own", "class", "n", "raw", "odd", "component")
    crossing = cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(freed(_cross_pairs), "a bigint, b bigint").distinct()
    more = _linked(_possible(saved(crossing, "crossing"), classes).select("a", "b"), classes, rows)
    joined = components(links.unionByName(more)).withColumnRenamed("node", "class")
    named = members.where("n > 0").select("doc_id", "class").join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    per_class = saved(named.groupBy("class", "component").agg(F.min("doc_id").alias("_least")), "named")
    names = per_class.groupBy("component").agg(F.min("_least").alias("component_id"))
    by_class = per_class.join(names, "component").select("class", "component_id")
    return (
        members.select("doc_id", "key", "class", F.col("n").cast("long").alias("n_shingles")).join(by_class, "class", "left")
        .select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def one_per_group(docs: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of docs that name their group; of several with one doc_id and text, one. Rows without
    doc_id stay unless their group has a row with one; of equal ones, one.

    Texts are not shuffled to be kept: only rows that go or repeat are looked up, and those that share one
    of their 64 * ``rows`` marks, which are broadcast. Up to ``rows`` looked-up keys are broadcast as well;
    beyond, the texts of these rows alone meet them in a shuffle.
    """
    with scratch(docs.sparkSession):
        verdict = _named(docs).select(_own_id().alias("_own"), F.expr("doc_id <=> component_id").alias("_stays"))
        per_key = verdict.groupBy("_own").agg(F.max("_stays").alias("_stays"), F.min("_stays").alias("_all"), F.count(F.lit(1)).alias("_rows"))
        asked = saved(per_key.where("not _all or _rows > 1").select("_own", "_stays", "_rows"), "asked", stays=True)
    mark = F.pmod(F.xxhash64("_own"), F.lit(64 * rows))
    word, bit = F.expr("_mark div 64").alias("_word"), F.expr("shiftleft(1L, cast(_mark % 64 as int))")
    marks = saved(asked.select(mark.alias("_mark")).groupBy(word).agg(F.bit_or(bit).alias("_bits")), "marks")
    inner, back = set_aside(docs, ["doc_id", "text"])
    named = inner.withColumn("_own", F.concat_ws(":", text_key(F.col("doc_id").cast("long")), _text_hash())).withColumn("_mark", mark)
    marked = named.join(F.broadcast(marks), F.expr("_mark div 64") == F.col("_word"), "left")
    seen = F.coalesce(F.col("_bits").bitwiseAND(bit), F.lit(0)) != 0
    found = marked.where(seen).join(small_or_plain(asked.select("_own", "_stays"), rows), "_own", "left").where("coalesce(_stays, true)")
    if not asked.where("_rows > 1").isEmpty():
        found = found.dropDuplicates(["doc_id", "text"])
    return back(marked.where(~seen)).unionByName(back(found))


def op8_jaccard(spark, folder: str) -> DataFrame:
    return near_groups(read_table(spark, folder, "documents"))
