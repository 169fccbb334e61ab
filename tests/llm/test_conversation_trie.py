"""The trie of conversations against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from waybill.llm import conversation_trie as trie
from waybill.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def by_hand(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    below = defaultdict(lambda: [0, 0])
    for node, ids in members.items():
        spared = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][0] += not children[node]
            below[node[:d]][1] += spared
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(convs[c]) == len(node))
        out.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children[node]), *below[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def made(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), n):
        for t in range(rng.choice([1, 2, 3, 8, 9, most])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", "ja", "é" * 7, None, f"w{rng.randrange(3)}"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, n, most", [(1, 80, 12), (2, 200, 4), (3, 12, 60)])
def test_query_equals_a_trie_built_by_hand(spark, tmp_path, seed, n, most):
    rows = made(seed, n, most)
    rows += [(500 + k, t, "user", f"same {t}") for k in range(120) for t in range(11)]  # copies
    rows += [(None, 1, "user", "of no conversation"), (801, None, None, None), (802, None, "r", "first"), (802, 1, "r", "then")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("id", "place", "k1", "t1", "block", "depth", "head")})
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = QUERIES["op12_conversation_trie"](spark, str(tmp_path))
    assert sorted([tuple(r[c] for c in COLUMNS) for r in found.collect()], key=str) == by_hand(rebuilt(rows))
    assert {t for c, t in found.dtypes if c != "ends_sha256"} == {"bigint"}


def test_ties_and_repeated_rows_have_one_order(spark):
    rows = [(1, 1, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (2, 1, "user", "b"), (2, 1, "user", "b"), (2, 1, "user", "a")]
    nodes = trie.prefix_nodes(trie.turn_ids(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    assert sorted((r["depth"], r["n_convs"]) for r in nodes) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 1, "us", "erx"), (2, 1, "user", "x"), (3, 1, "", "userx")]
    nodes = trie.prefix_nodes(trie.turn_ids(spark.createDataFrame(rows, SCHEMA)))
    assert nodes.where("depth = 1").count() == 3
    texts = trie.spelled(nodes, spark.createDataFrame(rows, SCHEMA)).where("depth = 1").select("conv_id", "role", "text")
    assert sorted(tuple(r) for r in texts.collect()) == [(1, "us", "erx"), (2, "user", "x"), (3, "", "userx")]


def test_empty_table_has_no_node(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_conversation_trie"](spark, str(tmp_path)).count() == 0


def test_ends_of_one_node_come_in_pieces(spark, monkeypatch):
    ids = list(range(5, 30_000))
    random.Random(1).shuffle(ids)
    ends = spark.createDataFrame([(7, 8, 2, c) for c in ids] + [(7, 8, 3, 4), (1, 1, 0, -9)], "k1 bigint, k2 bigint, depth bigint, conv_id bigint")
    found = {r["depth"]: r["ends_sha256"] for r in trie._ids_digest(ends.repartition(6)).collect()}
    want = {2: ",".join(map(str, range(5, 30_000))), 3: "4", 0: "-9"}
    assert found == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}


def test_beginnings_are_combined_before_the_exchange(spark):
    nodes = trie._counted(trie._laid_out(trie.turn_ids(spark.createDataFrame(made(1, 9, 4), SCHEMA))).select(
        "conv_id", F.col("depth").alias("block"), "k1", "k2", "t1", "t2", "t3", "t4", "bytes_left", "last",
        F.lit(0).alias("since"), F.lit(True).alias("leaf"), F.lit(0).alias("owned")))
    plan = nodes._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" in plan and plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan
