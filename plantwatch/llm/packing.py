"""Best-fit-decreasing packing of token sequences into bins of fixed length."""

from __future__ import annotations

import functools
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.llm.common import cuts, freed, in_order, keeps, read_table, saved

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
SLICE_ROWS = 100_000
#: Bytes of words and their ids that a worker keeps, objects included; when half of it is new, what was not used since the half before goes.
KEPT_BYTES = 256 << 20
_OBJECT_BYTES = 200
#: Bytes of text encoded at once.
ENCODE_BYTES = 8 << 20
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ENDS = ".,;:!?"
_BLACK = re.compile(r" ?\S+(\n\S+)*\Z")
_SPACE_THEN_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


def _byte_signs() -> np.ndarray:
    """The 16-bit sign that a byte-level vocabulary writes for each byte: the byte's own, if it is printed, else one from 256 on."""
    signs = np.arange(256, dtype="<u2")
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
    signs[hidden] = 256 + np.arange(len(hidden))
    return signs


class WordEncoder:
    """Token ids of texts, each distinct word given to the tokenizer once.

    A blank that follows a non-space always begins a token of this vocabulary's pattern, so texts
    are cut there; those with other space before a blank are cut only between two non-spaces. Words that
    hold one of the vocabulary's special strings are encoded by themselves; with special strings that
    hold or take in space, whole texts are. Words of letters only, without the signs that end them, go
    to the tokenizer's merges directly where its pattern is the plain byte-level one; all others through all of it.
    """

    def __init__(self, path: str | None, kept_bytes: int | None = None):
        self.kept_bytes = kept_bytes
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.special = [t.content for t in added]
        self.cut_at_blanks = not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = self.kept_older = 0
        line = self._ids("\n")
        self.line = line[0] if len(line) == 1 else None
        pattern = self.tokenizer.pre_tokenizer
        plain = self.tokenizer.normalizer is None and isinstance(pattern, ByteLevel) and pattern.use_regex and not pattern.add_prefix_space
        self.written = _byte_signs() if plain else None
        self.met: set[str] = set()
        self.strange: set[str] = set()

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: of those kept in this or the older half of the bound, else learned."""
        found = list(map(self.known.get, words))
        lacking = dict.fromkeys(w for w, ids in zip(words, found) if ids is None)
        if lacking:
            own = {w: ids for w, ids in zip(lacking, map(self.older.get, lacking)) if ids is not None}
            self._keep(own)
            own |= self._learned([w for w in lacking if w not in own])
            found = [own[w] if ids is None else ids for w, ids in zip(words, found)]
        return found

    def _keep(self, own: dict[str, bytes]) -> None:
        self.known |= own
        self.kept += sum(map(len, own.values())) + len(own) * _OBJECT_BYTES
        if self.kept - self.kept_older > (self.kept_bytes or KEPT_BYTES) // 2:
            self.older, self.known = self.known, {}
            self.kept = self.kept_older = self.kept - self.kept_older

    def _learned(self, new: list[str]) -> dict[str, bytes]:
        own: dict[str, bytes] = {"": b""}
        together = "".join(new)
        if any(s in together for s in self.special):  # one search for all words: there is seldom any
            own |= {w: self._ids(w).tobytes() for w in new if any(s in w for s in self.special)}
            new = [w for w in new if w not in own]
        stems, lettered = self._lettered(new, together)
        own |= self._merged([w for w, stem, yes in zip(new, stems, lettered) if yes and stem == w])
        parted, whole = {}, []
        for word, stem, yes in zip(new, stems, lettered):
            if yes:
                if stem != word:  # the pattern never takes letters and the signs that end a word together
                    parted[word] = [stem, word[len(stem) :]]
            elif len(black := word.split()) == 1 and len(black[0]) == len(word) - (word[0] == " "):
                whole.append(word)
            elif word and self.line is not None and _BLACK.match(word):  # a line end between non-spaces is a token of its own
                parted[word] = word.split("\n")
            elif word:
                own[word] = self._ids(word).tobytes()
        if self.line is None:
            own |= {w: self._ids(w).tobytes() for w in whole}
            whole = []
        for i in range(0, len(whole), 20_000):  # in one call, joined by line ends
            part = whole[i : i + 20_000]
            ids = self._ids("\n".join(part))
            ends = np.flatnonzero(ids == self.line).tolist()
            data = ids.tobytes()
            for word, start, end in zip(part, [0, *(e + 1 for e in ends)], [*ends, len(ids)]):
                own[word] = data[4 * start : 4 * end]
        self._keep(own)
        if parted:
            parts = list(dict.fromkeys(p for some in parted.values() for p in some))
            known = dict(zip(parts, self.words(parts)))
            line = np.asarray([self.line or 0], "<u4").tobytes()
            joined = {w: (line if "\n" in w else b"").join([known[p] for p in some]) for w, some in parted.items()}
            self._keep(joined)
            own |= joined
        return own

    def _lettered(self, words: list[str], together: str) -> tuple[list[str], list[bool]]:
        """Each word without the signs that end it, and whether that is letters only, after a blank or nothing."""
        if self.written is None:
            return words, [False] * len(words)
        for c in set(together) - self.met:
            self.met.add(c)
            if pc.utf8_is_alpha(c).as_py() and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}a")) > 1:
                self.strange.add(c)  # a letter here, but not to the vocabulary's pattern
        stems = pc.utf8_rtrim(pa.array(words, pa.string()), characters=_ENDS)
        yes = pc.utf8_is_alpha(pc.replace_substring(stems, " ", "", max_replacements=1)).to_pylist()
        stems = stems.to_numpy(zero_copy_only=False).tolist()
        if not self.strange.isdisjoint(together):
            yes = [y and self.strange.isdisjoint(s) for y, s in zip(yes, stems)]
        return stems, yes

    def _merged(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters are one word of the vocabulary's pattern, so the merges alone decide."""
        if not words:
            return {}
        raw = np.frombuffer("\n".join(words).encode(), np.uint8)
        written = self.written[raw].tobytes().decode("utf-16-le").split(chr(self.written[10]))
        ids = [[t.id for t in tokens] for tokens in map(self.tokenizer.model.tokenize, written)]
        return {w: struct.pack(f"<{len(own)}I", *own) for w, own in zip(words, ids)}

    def one(self, text: str) -> bytes:
        if not self.cut_at_blanks:
            return self._ids(text).tobytes()
        first, *rest = _INNER_SPACE.split(text)
        return b"".join(self.words([first, *(" " + w for w in rest)]))

    def many(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text; null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _SPACE_THEN_BLANK).to_numpy(zero_copy_only=False)
        odd |= pc.match_substring_regex(texts, "^ | $").to_numpy(zero_copy_only=False) | (not self.cut_at_blanks)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        flat, firsts = lists.flatten(), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = self.words([" " + w for w in distinct]) + self.words(flat.take(pa.array(firsts)).to_pylist())
        place = coded.indices.to_numpy().copy()
        place[firsts] = len(distinct) + np.arange(len(firsts), dtype=place.dtype)
        ids = pa.array(parts, pa.large_binary()).take(pa.array(place))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset + 1 :]
        stops = ends[np.append(firsts[1:], len(place)) - 1]
        data, out, at = ids.buffers()[2], [], 0
        for i, stop in enumerate(stops.tolist()):
            out.append(self.one(texts[i].as_py()) if odd[i] else data[at:stop].to_pybytes())
            at = stop
        return out


@functools.cache
def word_encoder(path: str | None, kept_bytes: int | None = None) -> WordEncoder:
    return WordEncoder(path, kept_bytes)


keeps(word_encoder.cache_clear)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False,
           kept_bytes: int | None = None, encode_bytes: int = ENCODE_BYTES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of each document's pieces.

    A document is its token ids and one end id. One longer than ``capacity`` is cut into pieces of
    ``capacity`` ids of which the first may be shorter. ``kept_bytes`` bounds what a worker keeps of
    words between texts (``KEPT_BYTES``, if not given), ``encode_bytes`` the texts it encodes at once; ids do not depend on them.
    """
    names = _PIECES.names if with_ids else _PIECES.names[:-1]
    schema = pa.schema([_PIECES.field(n) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, kept_bytes)
        end = np.asarray([END_ID], "<u4").tobytes()
        for part in (b.slice(i, j - i) for b in batches for i, j in cuts(b, encode_bytes)):
            rows: list[tuple] = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), encoder.many(part.column("text"))):
                ids += end
                total = len(ids) // 4
                start, k = 0, 0
                while start < total:
                    stop = start + capacity if start else (total % capacity or min(total, capacity))
                    own = ids[4 * start : 4 * stop]
                    row = (doc, k, start, stop - start, zlib.crc32(own))
                    rows.append((*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row)
                    start, k = stop, k + 1
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    kinds = {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "ids": "array<int>"}
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(freed(run), ", ".join(f"{n} {kinds[n]}" for n in names))


class OpenBins:
    """Segment tree over remaining capacities; each leaf holds groups (first bin, bins) alike so far."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.width)
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def put(self, room: int, first: int, bins: int) -> None:
        if bins and room:
            self.groups.setdefault(room, []).append((first, bins))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.groups[room].pop()

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` that some open bin has."""
        node = least + self.width
        if self.filled[node]:
            return least
        while node > 1 and (node & 1 or not self.filled[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.width:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.width

    def _add(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.filled[node] += by
            node >>= 1


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths: blocks (length, from, to, bin, per_bin, offset).

    Pieces of one length are alike, so bins that are alike are filled as a group: the pieces of
    ``length`` with places from ``from`` (to below ``to``) go, ``per_bin`` to a bin, into the bins from ``bin``
    on, from ``offset`` on. Work and blocks depend on the number of lengths, not of pieces.
    """
    blocks, bins, opened = [], OpenBins(capacity), 0
    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room, first, alike = capacity, opened, -(-left // (capacity // length))
                opened += alike
            else:
                first, alike = bins.take(room)
            per = min(room // length, left)
            full = min(alike, left // per)
            blocks.append((length, done, done + full * per, first, per, capacity - room))
            bins.put(room - per * length, first, full)
            done, left = done + full * per, left - full * per
            first, alike = first + full, alike - full
            if room == capacity and alike:
                if left:
                    blocks.append((length, done, done + left, first, left, 0))
                    bins.put(capacity - left * length, first, 1)
                    left = 0
            else:
                bins.put(room, first, alike)
    return blocks


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False,
         slice_rows: int = SLICE_ROWS, kept_bytes: int | None = None, encode_bytes: int = ENCODE_BYTES) -> DataFrame:
    """Pieces of all documents with the sequence each is in and its offset there.

    Every piece takes the tightest open sequence, longest pieces first, over the whole table. The
    driver sees only how many pieces have each length (at most ``capacity`` numbers) and plans
    groups of like sequences; a piece finds its block by its length and its place among the pieces
    of that length. Sequences have no gaps and none passes ``capacity``.

    Null or empty text: the end id alone. Null doc_id: kept. Repeated rows: each is packed. Empty
    table: empty. Other columns are ignored.
    """
    cut = saved(pieces(docs, tokenizer, capacity, with_ids, kept_bytes, encode_bytes), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    digits = max(0, math.ceil(math.log(max([1, *counts.values()]) / slice_rows, 16)))
    slice_of = F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "piece")), 1, digits)
    placed = in_order(cut.withColumn("_slice", slice_of), ["length"], ["_slice"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_place")
    fields = ["length", "_from", "_to", "_bin", "_per", "_offset"]
    # an Arrow table, for rows would start Python workers of another kind, which executors keep beside those of ``pieces``
    plan = np.asarray(best_fit(counts, capacity), np.int64).reshape(-1, len(fields))
    blocks = docs.sparkSession.createDataFrame(pa.table(list(plan.T), names=fields))
    nth = F.col("_place") - 1 - F.col("_from")
    inside = (F.col("_place") > F.col("_from")) & (F.col("_place") <= F.col("_to"))
    return (
        placed.join(F.broadcast(blocks.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & inside)
        .withColumn("sequence_id", F.col("_bin") + F.floor(nth / F.col("_per")).cast("long"))
        .withColumn("offset", F.col("_offset") + F.pmod(nth, F.col("_per")) * F.col("length"))
        .drop("_slice", "_place", "_length", *fields[1:])
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from ``pack(..., with_ids=True)``; a sequence is bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op10_packing(spark, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"))
