"""The trie against one made of Python dictionaries, for whole tables and for many small tasks."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from residua.llm import prefix_trie as T
from residua.llm.queries import all_queries

SCHEMA = "conv_id long, turn long, role string, text string"


def lists(rows):
    """Turns by conversation; the order of equal numbers follows the documented key."""
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            found.setdefault(c, []).append(((turn is not None, turn or 0), key, (role, text)))
    return {c: [t[2] for t in sorted(v, key=lambda t: t[:2])] for c, v in found.items()}


def rebuilt(original):
    done = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        done[c] = original.get(c - c % 100, [])[:h] + own[h:]
    return done


def expected(conversations):
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    rows = []
    for node, convs in members.items():
        below = [k for k in members if k[: len(node)] == node]
        children = [k for k in below if len(k) == len(node) + 1]
        leaves = sum(not any(o[: len(k)] == k and len(o) > len(k) for o in below) for k in below)
        saved = sum((len(members[k]) - 1) * (len(k[-1][1]) if k else 0) for k in below)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        rows.append(
            (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), leaves, saved)
            + (hashlib.sha256(ids.encode()).hexdigest(),)
        )
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def values(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def some_rows(seed):
    rng = random.Random(seed)
    said = ["", "a", "bb", "é𝄞", None]
    rows = []
    for c in list(range(60)) + [100, 101, 102, 205, 399]:
        shared = rng.random() < 0.4
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            role, text = ("user", "same") if shared else (rng.choice(["user", "assistant", None]), rng.choice(said))
            rows.append((c, turn if rng.random() < 0.95 else None, role, text))
    rows += [(None, 0, "user", "nobody"), (7, 0, "user", "twice"), (7, 0, "user", "twice"), (300, None, None, None)]
    return rows


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_query(spark, tmp_path, tasks):
    rows = some_rows(tasks)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS depth", "3 AS path")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert values(all_queries()["op13_prefix_trie"](spark, str(tmp_path))) == expected(rebuilt(lists(rows)))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_group_of_equal_conversations_over_many_tasks(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)] + [(1000, 0, "user", "turn 0")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes, ends = T.prefix_trie(T.paths_of(spark.createDataFrame(rows, SCHEMA)))
        parts = ends.groupBy("node").count().orderBy("count").collect()
        assert [r["count"] for r in parts] == [1, 400]
        assert values(T.digests(nodes, ends)) == expected(lists(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_negative_ids_and_deep_conversations(spark):
    rows = [(-250, t, "user", "x") for t in range(600)] + [(-200, t, "user", "x") for t in range(590)] + [(3, 0, "a", "b")]
    nodes, ends = T.prefix_trie(T.paths_of(spark.createDataFrame(rows, SCHEMA)))
    found = {(r["depth"], r["conv_id"]): r for r in T.digests(nodes, ends).collect()}
    assert len(found) == 602 and found[(0, -250)]["n_convs"] == 3
    assert found[(590, -250)]["n_convs"] == 2 and found[(591, -250)]["n_convs"] == 1
    assert found[(1, -250)]["saved_tokens"] == 590 and found[(0, -250)]["n_leaves"] == 2


def test_turnless_conversations_end_at_the_root(spark):
    empty = F.array().cast("array<struct<key:binary,size:int>>")
    paths = spark.range(3).select(F.col("id").alias("conv_id"), empty.alias("path"))
    assert values(T.digests(*T.prefix_trie(paths))) == expected({0: [], 1: [], 2: []})


def test_empty_table(spark):
    assert T.digests(*T.prefix_trie(T.paths_of(spark.createDataFrame([], SCHEMA)))).count() == 0
