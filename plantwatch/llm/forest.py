"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.llm.common import read_table, saved

TREES = 8
#: Vectors, chosen by digest of vec_id, that the trees are fitted on (expected number).
SAMPLE_ROWS = 100_000
#: Sample vectors to a leaf at most (fewer, where a tree would have under 64 leaves), and indexed
#: vectors of a leaf that one task compares at once.
LEAF_ROWS = 512
LEAST_LEAVES = 64
CHUNK_ROWS = 8192
#: A search ends when the leaves taken, over all trees, hold this share of the vectors.
SEARCH_SHARE = 1.2
NEIGHBOURS = 10
QUERY_STEP = 100
SEED = 17


@dataclass
class Tree:
    """Hyperplanes with thresholds; a child below zero is leaf ``-child - 1``."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.full(len(vectors), 0 if len(self.cuts) else -1)
        while (open_ := np.flatnonzero(at >= 0)).size:
            node = at[open_]
            right = np.einsum("ij,ij->i", vectors[open_], self.normals[node]) > self.cuts[node]
            at[open_] = self.children[node, right.astype(int)]
        return -at - 1


def grow(sample: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """Splits at the median along random directions until leaves hold at most ``leaf_rows``."""
    normals, cuts, children, leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        normal = rng.standard_normal(sample.shape[1])
        along = sample[rows] @ normal
        cut = np.median(along) if len(rows) else 0.0
        if len(rows) <= leaf_rows or (along > cut).sum() == 0:
            leaves += 1
            own = -leaves
        else:
            own = len(cuts)
            normals.append(normal), cuts.append(cut), children.append([0, 0])
            todo += [(rows[along <= cut], own, 0), (rows[along > cut], own, 1)]
        if parent is not None:
            children[parent][side] = own
    dims = sample.shape[1]
    return Tree(np.array(normals).reshape(-1, dims), np.array(cuts), np.array(children).reshape(-1, 2), leaves)


def probes(forest: list[Tree], vector: np.ndarray, sizes: list[np.ndarray], wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one queue shared by all trees, until the leaves hold ``wanted`` vectors.

    A branch not taken waits with the widest margin of the hyperplanes on its way.
    """
    queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(forest)]
    found, total = [], 0.0
    along = [tree.normals @ vector - tree.cuts for tree in forest]
    while queue and total < wanted:
        margin, t, node = heapq.heappop(queue)
        while node >= 0:
            side = int(along[t][node] > 0)
            heapq.heappush(queue, (max(margin, abs(along[t][node])), t, int(forest[t].children[node, 1 - side])))
            node = int(forest[t].children[node, side])
        leaf = -node - 1
        if sizes[t][leaf]:
            found.append((t, leaf))
            total += sizes[t][leaf]
    return found


def usable(table: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part: see ``nearest``."""
    flat = table.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), "embedding")
    fine = flat.where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    )
    one = saved(fine.groupBy("vec_id").agg(F.min("embedding").alias("vector")), "vectors")
    common = one.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return one.where(F.size("vector") == (common["dims"] if common else 0))


def nearest(
    table: DataFrame, k: int = NEIGHBOURS, step: int = QUERY_STEP, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS, share: float = SEARCH_SHARE, chunk_rows: int = CHUNK_ROWS, seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors found for each vec_id divisible by ``step``.

    The trees are fitted on a bounded sample and broadcast; every vector is indexed in each. A query
    takes leaves from one queue over all trees and is compared exactly with all they hold; each task
    compares at most ``chunk_rows`` vectors of a leaf with its queries and passes on k + 1 for each.
    Equal vectors are indexed once, with their k + 1 smallest ids, so copies cannot fill a leaf.

    Euclidean distance in double precision on the original components, ties to the smaller vec_id.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    null ids and vectors not of the most common length (ties: the shortest). Of rows with one vec_id
    the smallest vector counts. Fewer candidates than k: all. Empty table: empty. Other columns are
    ignored.
    """
    spark = table.sparkSession
    rows = usable(table)
    kind = "<f4" if "float" in table.schema["embedding"].dataType.simpleString() else "<f8"
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_nth", F.row_number().over(same)).where(F.col("_nth") <= k + 1)
    distinct = saved(few.groupBy("vector").agg(F.min("vec_id").alias("key"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct")
    queries = saved(
        rows.where(F.col("vec_id") % step == 0).join(distinct.select("vector", "key"), "vector").select(F.col("vec_id").alias("query_id"), "key"), "queries"
    )
    number = distinct.count()
    share_of = F.conv(F.substring(F.md5(F.col("key").cast("string")), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    sample = distinct.where(share_of < min(1.0, sample_rows / max(1, number))).select("key", "vector").toArrow().sort_by("key")
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    matrix = np.array(sample["vector"].to_pylist(), np.float64)
    rng = np.random.default_rng(seed)
    fine_rows = max(1, min(leaf_rows, len(matrix) // LEAST_LEAVES))
    forest = [grow(matrix, fine_rows, rng) for _ in range(trees)]

    def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
        lists = batch.column("vector")
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = vectors_of(batch)
                raw = pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())
                for t, tree in enumerate(forest):
                    leaf = tree.leaf_of(vectors.astype(np.float64))
                    yield pa.RecordBatch.from_pydict({"tree": np.full(len(leaf), t, np.int32), "leaf": leaf.astype(np.int32), "key": batch.column("key"), "raw": raw})

    indexed = distinct.select("key", "vector").mapInArrow(index, "tree int, leaf int, key bigint, raw binary")
    sizes = [np.zeros(tree.leaves, np.int64) for tree in forest]
    for row in indexed.groupBy("tree", "leaf").count().collect():
        sizes[row["tree"]][row["leaf"]] = row["count"]
    pieces = [-(-s // chunk_rows) for s in sizes]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for key, vector in zip(batch.column("key").to_pylist(), vectors_of(batch)):
                    taken = probes(forest, vector.astype(np.float64), sizes, max(share * number, trees * (k + 1)))
                    cells = [(t, leaf, c) for t, leaf in taken for c in range(pieces[t][leaf])]
                    tree, leaf, chunk = (np.array(x, np.int32) for x in zip(*cells))
                    raw = vector.astype(kind).tobytes()
                    yield pa.RecordBatch.from_pydict({"tree": tree, "leaf": leaf, "chunk": chunk, "query": np.full(len(cells), key), "raw": [raw] * len(cells)})

    asked = distinct.join(queries.select("key").distinct(), "key").select("key", "vector")
    probing = asked.mapInArrow(search, "tree int, leaf int, chunk int, query bigint, raw binary")
    piece_rows = [(t, leaf, int(n)) for t, own in enumerate(pieces) for leaf, n in enumerate(own)]
    piece_table = F.broadcast(spark.createDataFrame(piece_rows, "tree int, leaf int, _pieces int"))
    dealt = indexed.join(piece_table, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("key"), F.col("_pieces")).cast("int").alias("chunk"), "key", "raw"
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": np.array([], np.int64), "key": np.array([], np.int64), "score": np.array([], np.float64)})
        keys = right["key"].to_numpy()
        found = np.frombuffer(b"".join(right["raw"]), kind).reshape(len(right), -1).astype(np.float64)
        out = []
        for query, raw in zip(left["query"], left["raw"]):
            score = np.sqrt(((found - np.frombuffer(raw, kind).astype(np.float64)) ** 2).sum(1))
            best = np.lexsort((keys, score))[: k + 1]
            out.append((np.full(len(best), query), keys[best], score[best]))
        query, key, score = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"query": query, "key": key, "score": score})

    cell = ["tree", "leaf", "chunk"]
    near = probing.groupBy(*cell).cogroup(dealt.groupBy(*cell)).applyInPandas(compare, "query bigint, key bigint, score double")
    once = near.groupBy("query", "key").agg(F.min("score").alias("score"))
    ranked = Window.partitionBy("query").orderBy("score", "key")
    best = once.withColumn("_nth", F.row_number().over(ranked)).where(F.col("_nth") <= k + 1).drop("_nth")
    with_ids = best.join(distinct.select("key", "ids"), "key").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("_found"))
    pairs = queries.join(with_ids, queries["key"] == with_ids["query"]).select("query_id", F.explode("_found").alias("_f"))
    pairs = pairs.select("query_id", F.col("_f.score").alias("score"), F.explode("_f.ids").alias("vec_id")).where("vec_id != query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark, folder: str) -> DataFrame:
    return nearest(read_table(spark, folder, "embeddings"))
