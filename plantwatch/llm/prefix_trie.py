"""Trie of conversation prefixes, by fingerprints that are combined instead of texts that are rebuilt.

A rebuilt conversation is a head (the first turns of a base conversation) and a tail (its own turns
after a number of them). Fingerprints of turn sequences form a monoid: (f, n) * (g, m) =
(f + B^n g, n + m) modulo a prime. With the running fingerprints of every original conversation,
the fingerprint of each rebuilt prefix is a product of a prefix of the base and a stretch of the own
turns, so no rebuilt text is ever made. Prefixes with one depth and fingerprint are one node; that
they are equal is then verified through the digests of the turns they refer to and through their
parents, and a collision leads to another base.

A node is named by its smallest member. Members only get fewer on the way down, so the nodes named
by one conversation form one stretch of its path. Subtree sums are sums over such stretches: each is
added where it hangs on the stretches above it, and one running sum per stretch gives all nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plantwatch.llm.common import in_order, read_table, saved, small_or_plain

PRIME = (1 << 61) - 1
#: Turn numbers, and places in a conversation, that one slice of a long conversation holds.
SLICE = 4096
ATTEMPTS = 8
_DIGESTS = ["d1", "d2", "d3", "d4"]


def bases(attempt: int) -> tuple[int, int]:
    """Two multipliers below the prime, others for every attempt."""
    raw = hashlib.sha256(f"prefix trie {attempt}".encode()).digest()
    return tuple(int.from_bytes(raw[i : i + 8], "big") % (PRIME - 3) + 2 for i in (0, 8))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), chars and the digest (240 bits in four longs) of each turn's role and text.

    Order: turn, null first, then role, then digest. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    plain = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.length(text).cast("bigint").alias("chars"), digest.alias("digest"),
        F.when(F.col("turn").isNull(), 0).otherwise(1).alias("_known"),
        F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(0)).alias("_slice"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = in_order(plain, ["conv_id"], ["_known", "_slice"], order, "pos")
    parts = [F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("bigint").alias(d) for i, d in enumerate(_DIGESTS)]
    return placed.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "chars", *parts)


def running(rows: DataFrame, key: str, at: str, columns: dict[str, Column], after: bool = False) -> DataFrame:
    """Adds, for each name, the sum of its column over the key's rows up to ``at`` (from it on, if ``after``).

    Keys with places beyond one slice are summed by slice first; no task sorts more than a slice of a key.
    ``rows`` should be saved; ``at`` is a number from 0, unique within its key.
    """
    cut = rows.withColumns({"_part": F.floor(F.col(at) / SLICE), **{f"_{n}": c for n, c in columns.items()}})
    own = Window.partitionBy(key, "_part").orderBy(F.col(at).desc() if after else F.col(at)).rowsBetween(Window.unboundedPreceding, 0)
    long = saved(rows.where(F.col(at) >= SLICE).select(key).distinct(), "long")
    summed = {n: F.sum(f"_{n}").over(own) for n in columns}
    if long.isEmpty():
        return cut.withColumns(summed).drop("_part", *(f"_{n}" for n in columns))
    parts = cut.join(small_or_plain(long), key, "leftsemi").groupBy(key, "_part").agg(*(F.sum(f"_{n}").alias(f"_{n}") for n in columns))
    others = Window.partitionBy(key).orderBy(F.col("_part").desc() if after else F.col("_part")).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(key, "_part", *(F.sum(f"_{n}").over(others).alias(f"_{n}_before") for n in columns))
    joined = cut.join(small_or_plain(saved(before, "parts")), [key, "_part"], "left")
    summed = {n: c + F.coalesce(F.col(f"_{n}_before"), F.lit(0)) for n, c in summed.items()}
    return joined.withColumns(summed).drop("_part", *(f"_{n}" for n in columns), *(f"_{n}_before" for n in columns))


def fingerprinted(turns: DataFrame, attempt: int = 0) -> DataFrame:
    """The (saved) turns with f1 and f2: the fingerprints of their conversation up to them."""
    first, second = bases(attempt)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos = batch.column("pos").to_pylist()
            powers = {p: (pow(first, p, PRIME), pow(second, p, PRIME)) for p in set(pos)}
            for i, name in enumerate(("t1", "t2")):
                made = [d * powers[p][i] % PRIME for d, p in zip(batch.column(_DIGESTS[i]).to_pylist(), pos)]
                batch = batch.append_column(name, pa.array(made, pa.int64()))
            yield batch

    ddl = ", ".join(f"{f.name} bigint" for f in turns.schema)
    with_terms = saved(turns.mapInArrow(terms, ddl + ", t1 bigint, t2 bigint"), "terms")
    wide = {f"f{i}": F.col(f"t{i}").cast("decimal(20,0)") for i in (1, 2)}
    summed = running(with_terms, "conv_id", "pos", wide)
    return summed.withColumns({f: (F.col(f) % F.lit(PRIME)).cast("bigint") for f in wide}).drop("t1", "t2")


def recipes_by_hundred(conversations: DataFrame) -> DataFrame:
    """conv_id, base, head: the base is the first conversation of the hundred, the head crc32(decimal conv_id) % 6 turns."""
    ids = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), head.cast("bigint").alias("head"))


def _plans(turns: DataFrame, recipes: DataFrame, attempt: int) -> DataFrame:
    """For each conversation: base, head, taken (turns that the base gives), length, and g, a per fingerprint, with
    which the fingerprint F of the own turns so far becomes that of the rebuilt ones: F g + a."""
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    given = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("head", F.coalesce("n_base", F.lit(0)))
    length = taken + F.greatest(F.coalesce("n", F.lit(0)) - F.col("head"), F.lit(0))
    plan = recipes.join(sizes, "conv_id", "left").join(given, "base", "left").withColumns({"taken": taken, "length": length})
    of_base = turns.select(F.col("conv_id").alias("base"), F.col("pos").alias("taken"), F.col("f1").alias("b1"), F.col("f2").alias("b2"))
    of_own = turns.select("conv_id", F.col("pos").alias("head"), F.col("f1").alias("c1"), F.col("f2").alias("c2"))
    plan = plan.join(of_base, ["base", "taken"], "left").join(of_own, ["conv_id", "head"], "left")
    numbers = bases(attempt)

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            shifts = [t - h for t, h in zip(rows["taken"], rows["head"])]
            out = {n: rows[n] for n in ("conv_id", "base", "head", "taken", "length")}
            for i, number in enumerate(numbers, 1):
                power = {s: pow(number, s, PRIME) for s in set(shifts)}
                out[f"g{i}"] = [power[s] for s in shifts]
                out[f"a{i}"] = [((b or 0) - (c or 0) * power[s]) % PRIME for b, c, s in zip(rows[f"b{i}"], rows[f"c{i}"], shifts)]
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    names = ["conv_id", "base", "head", "taken", "length", "g1", "a1", "g2", "a2"]
    return plan.select("conv_id", "base", "head", "taken", "length", "b1", "b2", "c1", "c2").mapInArrow(factors, ", ".join(f"{n} bigint" for n in names))


def _rebuilt(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, depth, f1, f2, the digest and chars of the last turn, and whether it ends the conversation."""
    heads = (
        plans.where("taken > 0").select("conv_id", "base", "taken", "length")
        .join(turns.withColumnRenamed("conv_id", "base"), "base").where("pos <= taken")
        .select("conv_id", "length", F.col("pos").alias("depth"), "f1", "f2", "chars", *_DIGESTS)
    )
    joined = turns.join(small_or_plain(plans), "conv_id").where("pos > head")

    def moved(i: int) -> Column:
        product = F.col(f"f{i}").cast("decimal(19,0)") * F.col(f"g{i}").cast("decimal(19,0)")
        return ((product % F.lit(PRIME) + F.col(f"a{i}")) % F.lit(PRIME)).cast("bigint").alias(f"f{i}")

    tails = joined.select("conv_id", "length", (F.col("taken") + F.col("pos") - F.col("head")).alias("depth"), moved(1), moved(2), "chars", *_DIGESTS)
    both = heads.unionByName(tails)
    return both.withColumn("ends", F.col("depth") == F.col("length")).drop("length")


def members(conversations: DataFrame, recipes: DataFrame, attempt: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The plans (one a conversation), and per rebuilt prefix, from depth 1: its node and its parent's.

    Returns (plans, prefixes, nodes). prefixes: conv_id, depth, node (smallest member), ends. nodes: node,
    depth, parent, n_convs, chars. A prefix is in a node by its fingerprint; every node is then checked: all its
    members have one last turn, by the digests of the turns referred to, and one parent. If
    any node fails, all is done again with other multipliers.
    """
    turns = saved(numbered_turns(conversations), "turns")
    while True:
        marked = saved(fingerprinted(turns, attempt), "marked")
        plans = saved(_plans(marked, recipes, attempt), "plans")
        rows = saved(_rebuilt(marked, plans), "prefixes")
        keys = ["depth", "f1", "f2"]
        bounds = [f(d).alias(f"{n}_{d}") for d in _DIGESTS for n, f in (("lo", F.min), ("hi", F.max))]
        groups = saved(rows.groupBy(*keys).agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n"), *bounds), "groups")
        differ = groups.where(" or ".join(f"lo_{d} != hi_{d}" for d in _DIGESTS))
        shared = groups.where("n > 1").select(*keys, "node")
        named = rows.join(small_or_plain(shared), keys, "left").select("conv_id", "depth", F.coalesce("node", "conv_id").alias("node"), "chars", "ends")
        named = saved(named, "named")
        above = named.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
        nodes = named.join(above, ["conv_id", "depth"], "left").groupBy("node", "depth").agg(
            F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.min("parent").alias("parent"), F.max("parent").alias("other")
        )
        nodes = saved(nodes, "nodes")
        if differ.isEmpty() and nodes.where("parent != other").isEmpty():
            return plans, named.drop("chars"), nodes.drop("other")
        attempt += 1
        if attempt == ATTEMPTS:
            raise RuntimeError("fingerprints of different prefixes collide under every multiplier tried")


def hashed_lists(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, sha256: of each key's values (longs) in decimal, ascending, joined by commas.

    Values are sorted and written out in slices by range, whatever the key; one task then only runs
    the hash over a key's slices, as they come, and holds one of them.
    """
    ordered = rows.repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    names = [*keys, value]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [batch.column(n).to_numpy() for n in names]
            new = np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)
            starts = np.append(0, np.flatnonzero(new) + 1)
            ids = columns[-1].tolist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)])]
            yield pa.RecordBatch.from_pydict({n: pa.array(c[starts], pa.int64()) for n, c in zip(names, columns)} | {"_ids": texts})

    ddl = ", ".join(f"{n} bigint" for n in names)
    texts = ordered.select(*names).mapInArrow(written, ddl + ", _ids string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        schema = pa.schema([(k, pa.int64()) for k in keys] + [("sha256", pa.string())])
        for batch in batches:
            done = []
            for *here, ids in zip(*(batch.column(k).to_pylist() for k in keys), batch.column("_ids").to_pylist()):
                if here == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = here, hashlib.sha256()
                state.update(ids.encode())
            yield _batch(done, schema)
        if key is not None:
            yield _batch([(*key, state.hexdigest())], schema)

    by_key = texts.repartition(*keys).sortWithinPartitions(*keys, value)
    return by_key.mapInArrow(hashed, ", ".join(f"{k} bigint" for k in keys) + ", sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def trie(conversations: DataFrame, recipes: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    ``recipes``: conv_id, base and head, one row for each conversation to rebuild: the first ``head``
    turns of conversation ``base`` (all if fewer, none if it is absent), then the own turns after the
    first ``head``. Columns and their meaning: ``op12_prefixes``.

    Null role or text: empty. Null turn: before the others. Ties of turn: by role, then digest. A
    repeated row is a further turn. Rows without conv_id belong to no conversation. No conversation:
    no row, not even the root. Other columns are ignored. Long conversations, and nodes with
    very many members, are worked on in slices.
    """
    plans, prefixes, nodes = members(conversations, recipes)
    first, count = plans.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    ddl = "node bigint, depth bigint, n_convs bigint, chars bigint, parent bigint"
    root = conversations.sparkSession.createDataFrame([(first, 0, count, 0, None)] if count else [], ddl)
    top = F.lit(first).cast("bigint")
    every = nodes.withColumn("parent", F.when(F.col("depth") == 1, top).otherwise(F.col("parent"))).unionByName(root)
    children = every.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    weighed = every.join(children, ["node", "depth"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"),
        "cost": (F.col("n_convs") - 1) * F.col("chars"),
    })
    weighed = saved(weighed, "weighed")

    totals = weighed.groupBy(F.col("node").alias("conv_id")).agg(F.sum("leaf").alias("leaf"), F.sum("cost").alias("cost"))
    above = prefixes.where("node != conv_id").select("conv_id", "node", "depth")
    at_root = plans.where(F.col("conv_id") != top).select("conv_id", top.alias("node"), F.lit(0).cast("bigint").alias("depth"))
    hung = above.unionByName(at_root).groupBy("conv_id", "node").agg(F.max("depth").alias("depth")).join(totals, "conv_id")
    hung = hung.groupBy("node", "depth").agg(F.sum("leaf").alias("leaf_below"), F.sum("cost").alias("cost_below"))
    own = saved(weighed.join(hung, ["node", "depth"], "left"), "hung")
    sums = {
        "n_leaves": F.col("leaf") + F.coalesce("leaf_below", F.lit(0)),
        "saved_tokens": F.col("cost") + F.coalesce("cost_below", F.lit(0)),
    }
    summed = running(own, "node", "depth", sums, after=True)

    ends = prefixes.where("ends").select("node", "depth", "conv_id")
    ends = ends.unionByName(plans.where("length = 0").select(top.alias("node"), F.col("length").alias("depth"), "conv_id"))
    lists = hashed_lists(saved(ends, "ends"), ["node", "depth"], "conv_id")
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(lists, ["node", "depth"], "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.lit(none)).alias("ends_sha256"),
    )


def op12_prefixes(spark, folder: str) -> DataFrame:
    """Per node of the trie: conv_id (its smallest member), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, members but one times the
    code points of the last text) and ends_sha256 (of the ids of the conversations that end there)."""
    conversations = read_table(spark, folder, "conversations")
    return trie(conversations, recipes_by_hundred(conversations))


OP12_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))
  ), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT k.c, t.pos AS place, t.role, t.said FROM convs k JOIN turns t ON t.c = k.base AND t.pos <= k.h
  UNION ALL
  SELECT k.c, t.pos + 10 AS place, t.role, t.said FROM convs k JOIN turns t ON t.c = k.c AND t.pos > k.h
), prefixes AS (
  SELECT c, row_number() OVER own AS depth, length(said) AS chars,
         sha256(string_agg(length(role)::VARCHAR || ':' || role || length(said)::VARCHAR || ':' || said, '') OVER own) AS k
  FROM rebuilt WINDOW own AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, 0, '' FROM convs
), paths AS (
  SELECT c, depth, k, chars, lag(k) OVER (PARTITION BY c ORDER BY depth) AS above,
         lead(k) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends
  FROM prefixes
), nodes AS (
  SELECT k, depth, min(c) AS c, min(above) AS above, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY k, depth
), children AS (
  SELECT above, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), weights AS (
  SELECT v.*, coalesce(x.n, 0) AS n_children, (v.n - 1) * v.chars AS cost
  FROM nodes v LEFT JOIN children x ON x.above = v.k AND x.depth = v.depth
), below AS (
  SELECT p.k, p.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.cost) AS saved_tokens
  FROM weights v JOIN paths p ON p.c = v.c AND p.depth <= v.depth GROUP BY ALL
)
SELECT v.c AS conv_id, v.depth, u.c AS parent_conv_id, v.n AS n_convs, v.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM weights v JOIN below b ON b.k = v.k AND b.depth = v.depth
LEFT JOIN nodes u ON u.k = v.above AND u.depth = v.depth - 1
"""
