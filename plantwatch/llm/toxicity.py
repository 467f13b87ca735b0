"""Toxicity of documents from the toxicity of their sentences (multiple-instance learning).

Only documents have labels. A sentence's score is a logistic function of the features of its words,
and a document is toxic if at least one of its sentences is: its score is the noisy-or of theirs,
1 - prod(1 - p). The weights are those under which the document scores fit the document labels best;
the sentence scores that come with them tell which sentences offend.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.llm.common import read_table, saved
from plantwatch.llm.languages import held_out

#: Distinct texts of each label that the model is fitted on, at most: those with the smallest digest.
TRAIN_TEXTS = 3000
#: Features kept: those in so many toxic training texts and so many times as common there as in the others.
LEAST_TEXTS, LEAST_RATIO = 4, 4.0
FEATURES = 20_000
THRESHOLD = 0.3
STARTS, ENDING = (3, 4, 5, 6), 4
STEPS, RATE, SHRINK = 300, 0.1, 1e-3
LONG_WORD = 40
#: Characters that are searched for words at once, and characters of words whose sums a task keeps.
PIECE, KEPT = 1 << 20, 1 << 22
_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n。！？]+")
_NO_LETTER = re.compile(r"[\W\d_]")


def features(word: str) -> set[str]:
    """The word (its digest, if long), its beginnings and its ending, in lower case."""
    word = word.lower()
    whole = word if len(word) <= LONG_WORD else hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
    return {f"={whole}", *(f"^{word[:n]}" for n in STARTS if len(word) > n), *([f"${word[-ENDING:]}"] if len(word) > ENDING else [])}


def is_word(token: str) -> bool:
    return token[0].isalpha()


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of about ``size`` characters, none of which ends inside a word."""
    start = 0
    while start < len(text):
        found = _NO_LETTER.search(text, start + size) if start + size < len(text) else None
        end = found.start() if found else len(text)
        yield start, end
        start = end


@dataclass
class Model:
    """Weights of features and the weight that every sentence starts from; no weights: nothing is toxic."""

    start: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)


class Sums(dict):
    """Sum of the weights of a word's features, kept for words seen; infinite for what ends a sentence."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.kept = model, 0

    def __missing__(self, token: str) -> float:
        value = sum(self.model.weights.get(f, 0.0) for f in features(token)) if is_word(token) else np.inf
        self.kept += len(token) + 60
        self[token] = value
        return value

    def shrink(self) -> None:
        if self.kept > KEPT:
            self.clear()
            self.kept = 0


def sentence_logits(text: str, sums: Sums) -> np.ndarray:
    """One number for each sentence that has a word, in order."""
    found, open_sum, open_words = [], 0.0, 0
    for start, end in pieces(text):
        tokens = _TOKEN.findall(text, start, end)
        values = np.fromiter(map(sums.__getitem__, tokens), np.float64, len(tokens))
        sums.shrink()
        stops = np.isinf(values)
        of = np.cumsum(stops)
        total = np.bincount(of, np.where(stops, 0.0, values), minlength=1)
        words = np.bincount(of, ~stops, minlength=1)
        total[0] += open_sum
        words[0] += open_words
        found.append(total[:-1][words[:-1] > 0])
        open_sum, open_words = total[-1], words[-1]
    if open_words:
        found.append(np.array([open_sum]))
    return sums.model.start + np.concatenate(found) if found else np.zeros(0)


def noisy_or(logits: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum()))


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Start and end (code points) of each sentence that has a word, as ``sentence_logits`` numbers them."""
    spans, begin, last = [], None, 0
    for found in _TOKEN.finditer(text):
        if is_word(found[0]):
            begin, last = found.start() if begin is None else begin, found.end()
        elif begin is not None:
            spans.append((begin, found.end()))
            begin = None
    return spans + ([(begin, last)] if begin is not None else [])


# ---- learning --------------------------------------------------------------------------------------


def training_texts(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_TEXTS) -> DataFrame:
    """text and toxic (0 or 1) of at most ``per_label`` distinct texts of each label, none of a held-out document.

    A document with several labels counts as toxic if one of them says so.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_hash")
    )
    pairs = rows.select("doc_id", "_hash").join(known, "doc_id").groupBy("_hash", F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic"))
    pairs = saved(pairs.agg(F.min("doc_id").alias("doc_id")), "labelled")
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("_hash")]
    chosen = pairs.where("toxic = 1").orderBy(*order).limit(per_label).unionByName(pairs.where("toxic = 0").orderBy(*order).limit(per_label))
    return rows.join(F.broadcast(chosen), ["doc_id", "_hash"]).dropDuplicates(["doc_id", "_hash", "toxic"]).select("text", "toxic")


def sentence_words(text: str) -> Iterator[list[str]]:
    """The words of each sentence that has one."""
    words: list[str] = []
    for start, end in pieces(text):
        for token in _TOKEN.findall(text, start, end):
            if is_word(token):
                words.append(token)
            elif words:
                yield words
                words = []
    if words:
        yield words


def vocabulary(texts: DataFrame, most: int = FEATURES) -> dict[str, float]:
    """Features that toxic texts have more often than others, with the logarithm of how much more often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = {w for a, b in pieces(text) for w in _TOKEN.findall(text, a, b) if is_word(w)}
                counts[toxic].update(set().union(*map(features, words)))
        for toxic, found in enumerate(counts):
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(list(found), pa.string()), "toxic": pa.array([toxic] * len(found), pa.int32()), "n": pa.array(list(found.values()), pa.int64()),
            })

    def times(toxic: int):
        return F.sum(F.when(F.col("toxic") == toxic, F.col("n")).otherwise(0))

    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    counted = texts.mapInArrow(count, "feature string, toxic int, n bigint").groupBy("feature").agg(times(1).alias("n1"), times(0).alias("n0"))
    ratio = ((F.col("n1") + 0.5) / (sizes.get(1, 0) + 1)) / ((F.col("n0") + 0.5) / (sizes.get(0, 0) + 1))
    kept = counted.where(F.col("n1") >= LEAST_TEXTS).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    best = kept.orderBy((F.log("ratio") * F.sqrt("n1")).desc(), "feature").limit(most)
    return {r["feature"]: float(np.log(r["ratio"])) for r in best.collect()}


def fit_noisy_or(toxic: np.ndarray, plain: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, first: np.ndarray) -> tuple[float, np.ndarray]:
    """Start weight and feature weights that fit document labels.

    ``plain``: each document's sentences without a feature. ``doc``: the document of each other
    sentence. ``sentence``, ``feature``: the features that sentences have. ``first``: weights to begin with.
    """
    w = np.append(first / 2, np.log(max(1.0, toxic.sum()) / max(1.0, plain.sum() + len(doc))) - 2)
    mean, spread = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = w[-1] + np.bincount(sentence, w[feature], minlength=len(doc))
        softly = np.logaddexp(0.0, z)
        q = np.bincount(doc, softly, minlength=len(toxic)) + plain * np.logaddexp(0.0, w[-1])
        per_doc = np.where(toxic == 1, -1 / np.maximum(np.expm1(np.minimum(q, 500)), 1e-12), 1.0)
        per_sentence = per_doc[doc] * np.exp(z - softly)
        slope = np.append(np.bincount(feature, per_sentence[sentence], minlength=len(first)), 0.0)
        slope[-1] = per_sentence.sum() + (per_doc * plain).sum() * np.exp(w[-1] - np.logaddexp(0.0, w[-1]))
        slope = slope / len(toxic) + SHRINK * np.append(w[:-1], 0.0) / len(first)
        mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        size = RATE * min(1.0, 2 * (1 - (step - 1) / STEPS))
        w = w - size * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-10)
    return float(w[-1]), w[:-1]


def fitted(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_TEXTS) -> Model:
    """The model of a bounded sample of labelled texts. Words are read in parallel; one task fits the weights."""
    texts = saved(training_texts(docs, labels, per_label), "training")
    known = vocabulary(texts)
    if not known:
        return Model()
    names = list(known)
    place = {f: i for i, f in enumerate(names)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, ends, ids = [], [], []
            for text in batch.column("text").to_pylist():
                own = [[place[f] for w in words for f in features(w) if f in place] for words in sentence_words(text)]
                plain.append(sum(not has for has in own))
                ends.append([len(has) for has in own if has])
                ids.append([i for has in own for i in has])
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "plain": pa.array(plain, pa.int64()),
                "sizes": pa.array(ends, pa.list_(pa.int32())), "ids": pa.array(ids, pa.list_(pa.int32())),
            })

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["toxic", "plain"], kind="stable")
        sizes = [np.asarray(s, np.int64) for s in rows["sizes"]]
        per = np.concatenate(sizes)
        doc = np.repeat(np.arange(len(rows)), [len(s) for s in sizes])
        ids = np.concatenate([np.asarray(i, np.int64) for i in rows["ids"]])
        start, weights = fit_noisy_or(
            rows["toxic"].to_numpy(), rows["plain"].to_numpy().astype(float), doc, np.repeat(np.arange(len(per)), per), ids, np.array(list(known.values()))
        )
        return pd.DataFrame({"place": [-1, *range(len(weights))], "weight": [start, *weights]})

    rows = texts.mapInArrow(read, "toxic int, plain bigint, sizes array<int>, ids array<int>")
    found = {r["place"]: r["weight"] for r in rows.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(fit, "place int, weight double").collect()}
    return Model(found.pop(-1), {names[i]: w for i, w in found.items()})


# ---- use -------------------------------------------------------------------------------------------


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, and start, end, score of the worst sentence of a toxic document.

    Null or empty text, or one without a word: no sentence, score 0. Null doc_id: kept, not held out. Rows are
    independent: no shuffle, repeated rows get equal scores, an empty table gives an empty one.
    Other columns are ignored. Equal sentence scores: the first is the worst.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out().alias("held_out"))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_sentences", pa.int64()),
        ("worst_start", pa.int64()), ("worst_end", pa.int64()), ("worst_score", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(model)
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                logits = sentence_logits(text, sums)
                score = noisy_or(logits) if model.weights else 0.0
                worst = (None, None, None)
                if score >= threshold:
                    i = int(logits.argmax())
                    worst = (*sentence_spans(text)[i], noisy_or(logits[i : i + 1]))
                out.append((score, int(score >= threshold), len(logits), *worst))
            made = [pa.array(list(c), f.type) for c, f in zip(zip(*out), list(schema)[2:])] if out else [pa.array([], f.type) for f in list(schema)[2:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *made], schema=schema)

    ddl = "doc_id bigint, held_out boolean, score double, predicted int, n_sentences bigint, worst_start bigint, worst_end bigint, worst_score double"
    return rows.mapInArrow(run, ddl)


def offending(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end (code points), score and text of every sentence that scores at least ``least`` by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(model)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                scores = -np.expm1(-np.logaddexp(0.0, sentence_logits(text or "", sums)))
                if model.weights and scores.max(initial=0.0) >= least:
                    out += [(doc, a, b, float(p), text[a:b]) for (a, b), p in zip(sentence_spans(text), scores) if p >= least]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["doc_id", "start", "end", "score", "sentence"])

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id bigint, start bigint, end bigint, score double, sentence string")


def op11_toxicity(spark, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return scored(docs, fitted(docs, read_table(spark, folder, "labels")))
