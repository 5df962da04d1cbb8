"""The prefix trie against a plain one, on small conversations of all odd kinds."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tallycart.llm import prefixes, registry

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, every=20, most=4):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, code, role, text))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    size = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), sum(not any(len(m) > len(n) and m[: len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * size[n] for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie(spark, rows, **named):
    got = prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA), **named)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def branching(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "tool"]), rng.choice(["yes", "no way", "  maybe\tso\n"])))
    return rows


def odd_rows():
    return [
        (0, 1, "a", "x y"), (0, None, None, None), (0, 1, "a", "x y"), (0, 1, "ax", " y"),  # ties, a repeat, a null turn
        (3, 0, "user", ""), (3, 5, "", "late"), (3, 2, "user", "é ü"),
        (-7, 0, "a", "x y"), (-20, 0, "a", "minus"), (-20, 1, None, "two words"),
        (44, 0, "only", "one"),  # its base is absent
        (None, 0, "a", "no id"), (60, 9, "r", "a" * 50_000 + " b"), (61, 9, "r", "c"),
    ]


@pytest.mark.parametrize("rows", [branching(1, 60), odd_rows(), [(c, t, "u", "same") for c in range(40, 80) for t in range(5)]])
def test_trie_equals_a_plain_one(spark, rows):
    assert trie(spark, rows) == brute(rows)


def test_sql_gives_the_same_rows(spark):
    rows = branching(2, 50) + [(c + 100 if c is not None else None, *rest) for c, *rest in odd_rows()]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(registry.ORACLES["op11_prefixes"]).fetchall(), key=str) == trie(spark, rows)


def test_no_rows_for_an_empty_table_and_a_root_for_turnless_conversations(spark):
    assert trie(spark, []) == []
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    got = trie(spark, [(turnless, 0, "u", "gone"), (None, 1, "u", "x")])
    assert got == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_extra_columns_and_other_names(spark):
    rows = branching(3, 30)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "thread long, at long, who string, said string, node int, leaf string")
    got = prefixes.prefix_trie(frame, "thread", "at", "who", "said")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_one_conversation_runs_through_many_tasks(spark):
    """Most turns in one conversation: ranges cut it, running values go on from range to range."""
    rows = [(20, t, "u", f"w{t % 7}") for t in range(3000)] + branching(4, 20)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        turns = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "conv")
        from pyspark.sql import functions as F

        placed = prefixes.running(turns, "conv", [F.col("turn")], {"n": ("sum", F.lit(1)), "low": ("min", -F.col("turn"))})
        own = sorted((r.turn, r.n, r.low) for r in placed.where("conv = 20").collect() if r.text.startswith("w"))
        assert own == [(t, t + 1, -t) for t in range(3000)]
        got = {r.depth: r for r in prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA)).where("depth > 10").collect()}
        assert len(got) == 2990 and all(r.n_convs == 1 and r.n_leaves == 1 for r in got.values()) and got[3000].n_children == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_query_covers_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = registry.QUERIES["op11_prefixes"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
