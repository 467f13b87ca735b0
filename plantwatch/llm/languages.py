"""Language of texts by the order of their most frequent letter n-grams."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import cuts, freed, read_table, saved, set_aside, small_or_plain

#: Labelled documents that a language's profile is counted on (expected number, chosen by digest).
PROFILE_DOCS = 500
#: n-grams of a profile, and of a document, that are ranked.
RANKED = 300
#: Bits of a letter's code at least; more, if the profiles have more letters. Letters in no profile share a code.
LETTER_BITS = 10
UNKNOWN = "und"
#: Documents whose score is below are rejected by the pipeline, as are those without a letter.
LEAST_SCORE = 0.05
#: Bytes and rows of texts ranked in one pass; a longer text is a pass of its own.
_SLAB_BYTES, _SLAB_ROWS = 1 << 18, 1000


@functools.cache
def letter_table() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def grams_of(text: str) -> Counter:
    """1- to 3-grams of the text's letters, words set off by ``_``; no gram spans two words."""
    points = code_points(text)
    letters = "".join(chr(p) if ok else " " for p, ok in zip(points.tolist(), letter_table()[points].tolist()))
    found: Counter = Counter()
    for word in letters.split():
        padded = f"_{word}_"
        found.update(word)
        found.update([padded[i : i + 2] for i in range(len(padded) - 1)])
        found.update([padded[i : i + 3] for i in range(len(padded) - 2)])
    return found


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def profiles(docs: DataFrame, per_language: int = PROFILE_DOCS, ranked: int = RANKED) -> dict[str, list[str]]:
    """The ``ranked`` most frequent n-grams of each language, most frequent first.

    Learned from text and lang of labelled documents that are not held out: of each language about
    ``per_language`` of them, those with the smallest digest of doc_id (all, if fewer).
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rates = saved(labelled.groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("_rate")), "rates")
    share = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    chosen = labelled.select("lang", "text", share.alias("_share")).join(small_or_plain(rates), "lang").where("_share < _rate")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                totals.setdefault(lang, Counter()).update(grams_of(text))
        for lang, grams in totals.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": list(grams), "n": list(grams.values())})

    counted = chosen.select("lang", "text").mapInArrow(freed(count), "lang string, gram string, n bigint")
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (
        counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= ranked)
    )
    found: dict[str, list[str]] = {}
    for row in sorted(top.select("lang", "place", "gram").collect()):
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Ranker:
    """Scores texts against the profiles, many texts in one numpy pass."""

    def __init__(self, found: dict[str, list[str]], ranked: int = RANKED):
        self.names, self.ranked = sorted(found), ranked
        used = Counter(c for grams in found.values() for g in grams for c in g if c != "_")
        letters = sorted(used)
        self.bits = max(LETTER_BITS, (len(letters) + 1).bit_length())
        self.codes = np.where(letter_table(), np.uint32(len(letters) + 1), np.uint32(0))
        for i, c in enumerate(letters):
            self.codes[ord(c)] = i + 1
        known = {c: i + 1 for i, c in enumerate(letters)} | {"_": 0}
        ranks: dict[int, dict[int, int]] = {}
        for j, name in enumerate(self.names):
            for place, gram in enumerate(found[name]):
                code = functools.reduce(lambda high, c: (high << self.bits) + known[c], gram, 0) + ((len(gram) - 1) << 3 * self.bits)
                ranks.setdefault(code, {})[j] = place
        self.grams = np.array(sorted(ranks), np.int64)
        self.places = np.full((len(ranks) + 1, len(self.names)), -1, np.int64)
        for i, code in enumerate(self.grams.tolist()):
            for j, place in ranks[code].items():
                self.places[i, j] = place

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language with the least out-of-place distance, ties to the first by name, and 1 - distance / worst."""
        best, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        points = [code_points(t or "") for t in texts]
        if not self.names or not points:
            return best, score
        doc = np.repeat(np.arange(len(points)), [len(p) + 1 for p in points])
        codes = np.zeros(len(doc), np.int64)
        at = np.cumsum([0] + [len(p) + 1 for p in points[:-1]])
        for start, p in zip(at.tolist(), points):
            codes[start : start + len(p)] = self.codes[p]
        keep = np.flatnonzero((codes > 0) | np.append(False, codes[:-1] > 0))
        c, d = np.append(0, codes[keep]), np.append(-1, doc[keep])
        if len(keep) == 0:
            return best, score
        bits, width = self.bits, 3 * self.bits + 2  # of a letter and of a gram with its length; 63 hold 1000 rows of 17 bits a letter
        one, two, three = c[1:], (c[:-1] << bits) + c[1:], (c[:-2] << 2 * bits) + (c[1:-1] << bits) + c[2:]
        own = d[1:] << width
        two_own = np.where(c[1:] > 0, own, np.append(-1, own[:-1]))  # a closing gap belongs to the word before
        keys = np.concatenate([
            (own | one)[one > 0],
            (two_own | (1 << 3 * bits) | two)[(c[1:] > 0) | (c[:-1] > 0)],
            ((d[1:-1] << width) | (2 << 3 * bits) | three)[c[1:-1] > 0],
        ])
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        count = np.diff(np.append(first, len(keys)))
        of, gram = keys[first] >> width, keys[first] & ((1 << width) - 1)
        if count.max() < 1 << 19 and width == 32:  # one sort by row, falling count and gram
            order = np.sort((of << 51) | ((((1 << 19) - 1) - count) << 32) | gram)
            of, gram = order >> 51, order & ((1 << 32) - 1)
        else:
            order = np.lexsort((gram, -count, of))
            of, gram = of[order], gram[order]
        begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        place = np.arange(len(of)) - np.repeat(begins, np.diff(np.append(begins, len(of))))
        top = place < self.ranked
        of, gram, place = of[top], gram[top], place[top]
        found = np.minimum(np.searchsorted(self.grams, gram), max(0, len(self.grams) - 1))
        row = np.where(self.grams[found] == gram, found, len(self.grams)) if len(self.grams) else np.zeros(len(gram), np.int64)
        there = self.places[row]
        apart = np.where(there < 0, self.ranked, np.abs(there - place[:, None]))
        begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        total = np.add.reduceat(apart, begins, axis=0)
        worst = np.diff(np.append(begins, len(of))) * self.ranked
        least = total.argmin(1)
        for i, j, t, w in zip(of[begins].tolist(), least.tolist(), total.min(1).tolist(), worst.tolist()):
            best[i], score[i] = self.names[j], 1 - t / w
        return best, score


def predicted(docs: DataFrame, found: dict[str, list[str]], ranked: int = RANKED) -> DataFrame:
    """All rows and columns of docs, and lang_pred and score.

    Null text or a text without a letter: ``und``, 0. No profiles: ``und`` for all. The letters
    outside the profiles' alphabet count as one letter. Rows are independent: no shuffle; repeated
    rows, null ids and an empty table pass through. Input columns named like the added ones are
    replaced.
    """
    plain = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(found, ranked)
        for batch in batches:
            for start, end in cuts(batch, _SLAB_BYTES):
                for i in range(start, end, _SLAB_ROWS):
                    part = batch.slice(i, min(end - i, _SLAB_ROWS))
                    langs, scores = ranker.predict(part.column("text").to_pylist())
                    part = part.append_column("lang_pred", pa.array(langs, pa.string()))
                    yield part.append_column("score", pa.array(scores, pa.float64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(freed(run), schema + ", lang_pred string, score double")


def accepted(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs with a recognised language, in the columns of docs and with their values.

    Null texts and those without a letter go; null ids, repeated rows and columns named like those of
    ``predicted`` stay as they are. Without any labelled text nothing is recognised, and all rows go.
    """
    own, back = set_aside(docs, ["doc_id", "text", "lang"])
    kept = predicted(own, profiles(own)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return back(kept)


def op7_languages(spark, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    flagged = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predicted(flagged, profiles(docs)).select("doc_id", "held_out", "lang_pred", "score")
