"""A prefix trie of conversations by whole-sequence collapse.

Every conversation is rebuilt (``rebuilt``: its first turns come from the first conversation of its block of ``every``) and
becomes one row per prefix, named by a 128-bit code of the turns so far. The code adds up a hash of place and turn, so a
running sum over a conversation's slim rows gives it and texts never leave the first scan.

1. Identical conversations collapse to one sequence with its weight, its least conv_id and its list of ends.
2. Sequences that are a proper prefix of another one go by an anti-join; what stays are the leaves of the trie.
3. A node is a prefix of some leaf. Weights of sequences, and later what a node saves, are put on one leaf path each (the
   least leaf below) and summed from the leaf upwards; the sum over all leaves of a node is then its whole subtree's. Work
   grows with the turns of distinct sequences, not with pairs of nodes and ancestors.

Rows with a null id take no part. Null roles and texts are empty. Turns with equal numbers, a null number first, follow
by a hash of role and text; repeated rows are turns of their own. Ids are compared as numbers. A conversation without
turns after rebuilding ends at the root; an empty table gives no row, not even a root. Extra columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.operators.skew import salted_join
from tallycart.session import staged

WORD = r"[^\x20\x09-\x0D]+"
ROOT = "0" * 32
NO_END = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    every: int = 20  # conversations whose first turns come from the first of them
    most: int = 4  # turns taken from there: crc32(id) modulo this
    chunk_bits: int = 8  # ends are listed in chunks of so many bits of the id


def borrowed_turns(conv: Column, s: Settings) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % s.most


def running(rows: DataFrame, key: str, order: list[Column], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with running sums or minima (name: ("sum" or "min", column)) along the rows of a key. Rows are ranged by key
    and order, so a key with very many rows runs through many tasks; what a key brings from earlier ranges is one row per
    range at most, which bounds the broadcast. ``order`` leaves only equal rows undecided."""
    made = {"sum": F.sum, "min": F.min}
    given = rows.select("*", *(c.alias(f"_{name}") for name, (_, c) in values.items()))
    placed = staged(given.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy(key, "_range").agg(*(made[how](f"_{name}").alias(f"_{name}") for name, (how, _) in values.items()))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "_range", F.count("*").over(earlier).alias("_ranges"), *(made[how](f"_{name}").over(earlier).alias(f"_{name}_before") for name, (how, _) in values.items()))
    out = placed.select(*rows.columns, "_range", *(made[how](f"_{name}").over(inside).alias(name) for name, (how, _) in values.items()))
    out = out.join(F.broadcast(before.where("_ranges > 0").drop("_ranges")), [key, "_range"], "left")
    both = {"sum": lambda x, y: F.when(y.isNull(), x).otherwise(F.coalesce(x, F.lit(0)) + y), "min": F.least}
    return out.select(*rows.columns, *(both[how](F.col(name), F.col(f"_{name}_before")).alias(name) for name, (how, _) in values.items()))


def numbered(table: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Slim rows: conversation, place from 1, code of the turn, words of its text."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = table.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).where("conv is not null")
    order = [F.col("turn").asc_nulls_first(), F.col("code")]
    return running(staged(rows, "slim-turns"), "conv", order, {"place": ("sum", F.lit(1).cast("long"))}).select("conv", "place", "code", "words")


def rebuilt(turns: DataFrame, s: Settings) -> DataFrame:
    """Turns of the rebuilt conversations: conv, source (0 borrowed, 1 own), place there, code, words."""
    h = borrowed_turns(F.col("conv"), s)
    own = turns.where(F.col("place") > h).select("conv", F.lit(1).alias("source"), "place", "code", "words")
    heads = turns.where((F.col("conv") % s.every == 0) & (F.col("place") < s.most))
    heads = heads.select(F.col("conv").alias("base"), "place", "code", "words")
    takers = turns.where("place = 1").select("conv", (F.col("conv") - F.col("conv") % s.every).alias("base"), h.alias("h"))
    taken = takers.join(heads, "base").where("place <= h").select("conv", F.lit(0).alias("source"), "place", "code", "words")
    return own.unionByName(taken)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per prefix with a turn: conv, depth, node (its code), parent (that of the prefix before), words of the last
    text."""
    order = [F.col("source"), F.col("place")]
    rows = running(turns, "conv", order, {"depth": ("sum", F.lit(1).cast("long"))})
    hashed = [F.xxhash64(F.lit(seed), "depth", "code") for seed in (11, 29)]
    halves = [x for h in hashed for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(0xFFFFFFFF))]
    names = [f"h{k}" for k in range(len(halves))]
    rows = rows.select("conv", "depth", "words", *(x.alias(name) for name, x in zip(names, halves, strict=True)))
    rows = running(rows, "conv", [F.col("depth")], {f"{name}_sum": ("sum", F.col(name)) for name in names})

    def code(depth: Column, sums: list[Column]) -> Column:
        return F.md5(F.concat_ws(",", depth.cast("string"), *(x.cast("string") for x in sums)).cast("binary"))

    node = code(F.col("depth"), [F.col(f"{name}_sum") for name in names])
    parent = code(F.col("depth") - 1, [F.col(f"{name}_sum") - F.col(name) for name in names])
    return rows.select("conv", "depth", node.alias("node"), F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(parent).alias("parent"), "words")


def end_hashes(tails: DataFrame, s: Settings) -> DataFrame:
    """node, sha256 of the ascending ids that end there. Ids are joined in chunks first; a node's chunks stream through
    one running hash, so a node with very many ends needs no long list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            names, hashes = [], []
            for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        names.append(node)
                        hashes.append(state.hexdigest())
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string"))
    chunks = tails.groupBy("node", F.shiftright("conv", s.chunk_bits).alias("chunk")).agg(F.concat_ws(",", ids).alias("ids"))
    placed = chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids")
    return placed.mapInArrow(run, "node string, ends_sha256 string")


def upwards(paths: DataFrame, put: DataFrame, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """What ``put`` (leaf, depth and values) places on each path, run from the leaf towards the root: a row per path and
    node, to be aggregated by node."""
    return running(paths.join(put, ["leaf", "depth"], "left"), "leaf", [F.col("depth").desc()], values)


def prefix_trie(
    table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the root included: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    s = settings or Settings()
    turns = staged(numbered(table, conv_col, turn_col, role_col, text_col), "turns")
    rows = staged(prefixes(rebuilt(turns, s)), "prefixes")

    empty = turns.where("place = 1").select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"))
    tails = rows.select("conv", "depth", "node").unionByName(empty).groupBy("conv").agg(F.max("depth").alias("depth"), F.max_by("node", "depth").alias("node"))
    tails = staged(tails, "whole-sequences")
    sequences = staged(tails.groupBy("node", "depth").agg(F.min("conv").alias("first"), F.count("*").alias("weight")), "sequences")
    ends = end_hashes(tails, s)

    # of each sequence, the prefixes of its first conversation
    named = sequences.select(F.col("first").alias("conv"), F.col("depth").alias("length"))
    none = F.lit(None).cast("string").alias("parent")
    roots = named.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), none, F.lit(0).cast("long").alias("words"), "length")
    own = staged(rows.join(named, "conv").select(*roots.columns).unionByName(roots), "paths")
    proper = own.where("depth < length").select("node").distinct()
    leaves = sequences.join(proper, "node", "left_anti").select(F.col("first").alias("conv"))
    paths = staged(own.join(leaves, "conv", "left_semi").select(F.col("conv").alias("leaf"), "depth", "node", "parent", "words"), "leaf-paths")

    nodes = paths.groupBy("node", "depth").agg(F.min("leaf").alias("leaf"), F.count("*").alias("n_leaves"), F.min("words").alias("words"), F.min("parent").alias("parent"))
    nodes = staged(nodes, "nodes")
    weights = sequences.join(nodes.select("node", "leaf"), "node").select("leaf", "depth", "weight", "first")
    counted = upwards(paths, weights, {"members": ("sum", F.col("weight")), "least": ("min", F.col("first"))})
    counted = staged(counted.groupBy("node").agg(F.sum("members").alias("n_convs"), F.min("least").alias("conv_id")), "members")
    saves = nodes.join(counted, "node").select("leaf", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saves"))
    saved = upwards(paths, saves, {"below": ("sum", F.col("saves"))}).groupBy("node").agg(F.coalesce(F.sum("below"), F.lit(0)).alias("saved_tokens"))

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    whole = nodes.select("node", "depth", "n_leaves", "parent").join(counted, "node").join(saved, "node").join(children, "node", "left").join(ends, "node", "left")
    whole = staged(whole.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "whole-nodes")
    above = whole.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("below"))
    out = salted_join(whole, above, "parent", "node", "below", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256")
    )


def oracle(conversations: str = "conversations") -> str:
    """The same rows in DuckDB SQL: prefixes as lists of turn codes, subtrees by comparing lists."""
    return f"""
WITH base AS (
    SELECT conv_id AS c, turn, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
    FROM {conversations} WHERE conv_id IS NOT NULL),
t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, code) AS place, code, words FROM base),
h AS (SELECT c, c - c % 20 AS base, {crc32_sql("c::varchar")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (
    SELECT t.c, 1 AS source, place, code, words FROM t JOIN h ON h.c = t.c AND place > h
    UNION ALL SELECT h.c, 0, place, code, words FROM h JOIN t ON t.c = base AND place <= h),
d AS (SELECT c, row_number() OVER w AS depth, string_agg(code, '') OVER (PARTITION BY c ORDER BY source, place ROWS UNBOUNDED PRECEDING) AS node, words
      FROM r WINDOW w AS (PARTITION BY c ORDER BY source, place)
      UNION ALL SELECT c, 0, '', 0 FROM h),
whole AS (SELECT c, max(depth) AS length FROM d GROUP BY c),
n AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, min(words) AS words,
             string_agg(CASE WHEN depth = length THEN c::varchar END, ',' ORDER BY c) AS ends
      FROM d JOIN whole USING (c) GROUP BY node, depth),
k AS (SELECT left(node, (32 * (depth - 1))::int) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (SELECT a.node, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
      FROM f b CROSS JOIN unnest(range(b.depth + 1)) AS g(up) JOIN f a ON a.node = left(b.node, (32 * up)::int) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves::bigint AS n_leaves,
       s.saved::bigint AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN s USING (node) LEFT JOIN f p ON f.depth > 0 AND p.node = left(f.node, (32 * (f.depth - 1))::int)"""


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII text in DuckDB: eight shifts for each byte."""
    shift = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda k: ascii(k)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: {byte}), 4294967295)"
