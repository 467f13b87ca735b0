"""Toxicity, prefix trie and whitening against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantwatch.llm import prefix_trie, toxicity, whitening
from plantwatch.llm.queries import QUERIES

TURNS = "conv_id bigint, turn bigint, role string, text string, node string, depth string, pos int"


def trie_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes[tuple(rebuilt[c][:d])].append(c)
    out = set()
    for key, found in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        children = lambda k: sum(len(x) == len(k) + 1 and x[: len(k)] == k for x in nodes)
        ends = ",".join(str(c) for c in found if len(rebuilt[c]) == len(key))
        out.add((
            found[0], len(key), nodes[key[:-1]][0] if key else None, len(found), children(key), sum(children(k) == 0 for k in below),
            sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = []
    for conv in [0, 1, 2, 3, 4, 5, 100, 101, 102, 205, 206, 300, 301, 302, 303]:
        size = 13 if conv in (100, 301) else rng.randint(1, 7)
        rows += [(conv, t, rng.choice("us"), rng.choice(["a", "bb", "ä", ""])) for t in range(size)]
    copied = [(800 + i, t, r, x) for i in range(9) for c, t, r, x in rows if c == 3]
    odd = [(7, None, "s", "first"), (7, None, "s", "also first"), (7, 0, None, None), (7, 0, None, None), (None, 1, "u", "nobody's"), (8, 5, "u", "x" * 9000), rows[0]]
    return [(*r, "n", "d", 1) for r in rows + copied + odd]


@pytest.mark.parametrize("slice_size", [4096, 3])
def test_trie_equals_brute_force(spark, talks, monkeypatch, slice_size):
    monkeypatch.setattr(prefix_trie, "SLICE", slice_size)
    frame = spark.createDataFrame(talks, TURNS).repartition(3)
    got = prefix_trie.trie(frame, prefix_trie.recipes_by_hundred(frame)).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == trie_by_hand(talks)


def test_trie_finds_collisions_and_tries_again(spark, talks, monkeypatch):
    real = prefix_trie.bases
    monkeypatch.setattr(prefix_trie, "bases", lambda attempt: (0, 0) if attempt == 0 else real(attempt))
    monkeypatch.setattr(prefix_trie, "pow", lambda base, n, prime: 0 if base == 0 else pow(base, n, prime), raising=False)
    frame = spark.createDataFrame(talks, TURNS)
    got = prefix_trie.trie(frame, prefix_trie.recipes_by_hundred(frame))
    assert {tuple(r) for r in got.collect()} == trie_by_hand(talks)


def test_trie_of_nothing(spark):
    frame = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(frame, prefix_trie.recipes_by_hundred(frame)).count() == 0


def test_hashed_lists_of_a_hot_key(spark):
    rows = spark.range(50_000).select(F.lit(1).cast("bigint").alias("k"), (F.col("id") - 100).alias("v")).unionByName(spark.createDataFrame([(2, 5)], "k bigint, v bigint"))
    got = {r["k"]: r["sha256"] for r in prefix_trie.hashed_lists(rows.repartition(5), ["k"], "v").collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(-100, 49_900))).encode()).hexdigest(), 2: hashlib.sha256(b"5").hexdigest()}


# ---- whitening ----


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int, n string, x int")


def whitened_by_hand(rows):
    """vec_id -> (n, deviation) and the x matrix of the fit, of rows of one length."""
    whole = [(i, tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v)) for i, v in rows]
    fit = np.array(sorted({x for _, x in whole}), dtype=object)
    total, n = fit.sum(0), len(fit)
    return {i: (n, int(sum((n * a - s) ** 2 for a, s in zip(x, total)))) for i, x in whole}, fit.astype(float), dict(whole)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(20) * np.linspace(0.3, 4, 20)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a hot vector counts once in the fit
    odd = [(1, None), (2, [1.0] * 19 + [None]), (3, [float("nan")] * 20), (4, [float("inf")] + [0.0] * 19)]
    frame = vectors(spark, [(i, v, 1, "n", 2) for i, v in rows + odd]).repartition(4)
    got = whitening.whitened(frame).collect()
    exact, fit, x = whitened_by_hand(rows)
    mean = fit.mean(0)
    values, turned = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    values, turned = values[::-1][:16], turned[:, ::-1][:, :16]
    assert len(got) == len(rows) * 16
    found = {(r["vec_id"], r["component"]): r for r in got}
    signs = {k: np.sign(found[0, k + 1]["whitened"] * ((np.array(x[0]) - mean) @ turned[:, k])) for k in range(16)}
    for (i, k), r in found.items():
        assert (r["n"], r["deviation"]) == exact[i]
        assert r["whitened"] == pytest.approx(signs[k - 1] * ((np.array(x[i]) - mean) @ turned[:, k - 1]) / values[k - 1] ** 0.5, abs=1e-9)
        assert r["explained"] == pytest.approx(values[k - 1] / np.trace((fit - mean).T @ (fit - mean) / len(fit)), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_whitening_of_odd_tables(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0], 0, "", 0), (None, [], 0, "", 0)])).count() == 0  # nothing varies
    rows = [(i, [float(i), 2.0 * i, 5.0], 0, "", 0) for i in range(5)] + [(i, [float(i % 2), float(i)], 0, "", 0) for i in range(6)]
    rows += [(None, [3.0e38, 1.0, 2.0, 4.0], 0, "", 0), (9, [-3.0e38, 1.0, 2.0, 4.0], 0, "", 0)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 5 * 1 + 6 * 2 + 2 * 1  # rank one, rank two, rank one: each length is a space of its own
    assert {r["deviation"] for r in got if r["n"] == 2} == {None}  # no long holds it


@pytest.mark.parametrize("v", [
    np.eye(64), np.diag([5.0] * 20 + [1.0] * 44), np.zeros((4, 4)), np.array([[3.0]]), np.diag([1.0] * 3 + [0.0] * 30),
    np.cov(np.random.default_rng(0).standard_normal((200, 100)).T), np.cov(np.random.default_rng(1).standard_normal((9, 40)).T),
])
def test_contour_integration_finds_all_pairs(v):
    values, found = whitening.leading(v)
    want = [x for x in np.linalg.eigvalsh(v)[::-1] if x > 1e-12 * np.trace(v)][:16]
    assert values == pytest.approx(want, rel=1e-10) and len(values) == len(want)
    assert np.abs(v @ found - found * values).max(initial=0) <= 1e-12 * max(1, np.trace(v))
    assert np.abs(found.T @ found - np.eye(len(values))).max(initial=0) < 1e-12


def test_inertia_counts():
    v = np.cov(np.random.default_rng(4).standard_normal((50, 30)).T)
    at = np.linspace(-1, 4, 41)
    assert whitening.counts_above(whitening.tridiagonal(v), at).tolist() == [int((np.linalg.eigvalsh(v) > a).sum()) for a in at]


# ---- toxicity ----


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "er", "in", "th", "ou", "re"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(700):
        sentences = [" ".join(word() for _ in range(rng.randint(3, 12))).capitalize() + "." for _ in range(rng.randint(1, 12))]
        if i % 3 == 0:
            sentences.insert(rng.randrange(len(sentences) + 1), f"Than {rng.choice(['nitwit', 'zounds' + word()])} er.")
        rows.append((i, " ".join(sentences), "en", "x", 1.0))
        labels.append((i, int(i % 3 == 0), "z"))
    rows += [(None, "nitwit.", None, None, None), (5000, None, None, None, None), (5001, "", None, None, None), (5002, "12 ... !", None, None, None), rows[0]]
    labels += [(0, 0, "z"), (None, 1, "z"), (3, None, "z"), (9999, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic string, score double").repartition(3).cache()
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int, text string")


def test_toxic_documents_and_sentences_are_found(spoken):
    docs, labels = spoken
    model = toxicity.fitted(docs, labels)
    got = toxicity.scored(docs, model).collect()
    assert len(got) == 705
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 5000:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
            assert r["predicted"] == (r["score"] >= 0.3) == (r["doc_id"] % 3 == 0)
        elif r["doc_id"] is not None:
            assert (r["score"], r["predicted"], r["n_sentences"]) == (0.0, 0, 0)
        else:
            assert not r["held_out"] and r["predicted"] == 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if r["predicted"]:
            assert any(w in texts[r["doc_id"]][r["worst_start"] : r["worst_end"]] for w in ("nitwit", "zounds"))
    spans = toxicity.offending(docs.where("doc_id < 700"), model).collect()
    assert spans and all(("nitwit" in s["sentence"] or "zounds" in s["sentence"]) and texts[s["doc_id"]][s["start"] : s["end"]] == s["sentence"] for s in spans)


def test_scores_are_noisy_or_of_sentences(spoken):
    model = toxicity.Model(-2.0, {"=bad": 1.5, "^ba": 9.0, "^bad": 0.5, "$ness": 0.25})
    sums = toxicity.Sums(model)
    text = "Bad bad. fine!\n... Badness"
    logits = toxicity.sentence_logits(text, sums)
    assert logits.tolist() == [-2 + 2 * 1.5, -2.0, -2 + 0.5 + 0.25]
    clear = np.prod([1 - 1 / (1 + np.exp(-z)) for z in logits])
    assert toxicity.noisy_or(logits) == pytest.approx(1 - clear)
    assert [text[a:b] for a, b in toxicity.sentence_spans(text)] == ["Bad bad.", "fine!\n...", "Badness"] or len(toxicity.sentence_spans(text)) == len(logits)


def test_long_texts_are_scored_whole(monkeypatch):
    model = toxicity.Model(-3.0, {"=bad": 4.0})
    text = ("word " * 50 + "bad. ") * 40 + "bad " * 300
    whole = toxicity.sentence_logits(text, toxicity.Sums(model))
    monkeypatch.setattr(toxicity, "PIECE", 64)
    monkeypatch.setattr(toxicity.pieces, "__defaults__", (64,))
    monkeypatch.setattr(toxicity, "KEPT", 10)
    assert toxicity.sentence_logits(text, toxicity.Sums(model)).tolist() == whole.tolist()
    assert len(whole) == len(toxicity.sentence_spans(text)) == 41


def test_nothing_to_learn_from(spark, spoken):
    docs, labels = spoken
    for known in (labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.scored(docs, toxicity.fitted(docs, known)).agg(F.max("score"), F.count("*")).first()
        assert tuple(got) == (0.0, 705)
    empty = docs.limit(0)
    assert toxicity.scored(empty, toxicity.fitted(empty, labels)).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op11_toxicity"](spark, folder).join(labels, "doc_id").where("held_out")
    right = got.groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("share"))
    shares = {r["toxic"]: r["share"] for r in right.collect()}
    assert shares[0] > 0.98 and shares[1] > 0.85
