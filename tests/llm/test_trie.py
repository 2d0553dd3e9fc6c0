"""The prefix trie against a plain version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tranche.llm import catalog, trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))

    def key(turn):
        both = f"{len(turn[1].encode())}:{turn[1]}{turn[2]}".encode()
        return (turn[0] is not None, turn[0] or 0, hashlib.sha256(both).digest())

    own = {c: [t[1:] for t in sorted(turns, key=key)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    found = set()
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        leaves = [n for n in below if not any(m[:len(n)] == n and len(m) > len(n) for m in members)]
        children = [n for n in below if len(n) == len(node) + 1]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        found.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves),
            saved, hashlib.sha256(listed.encode()).hexdigest(),
        ))
    return found


def conversations():
    rows = []
    for c in range(40):
        length = (c * 7) % 13
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"é{min(c // 10, t)} {t}") for t in range(length)]
    rows += [(100, t, "user", "same") for t in range(37)] + [(101, t, "user", "same") for t in range(50)]
    rows += [(103, None, None, None), (103, None, "b", "x"), (103, 1, "user", ""), (103, 1, "user", "y" * 9000)]
    rows += [(103, 1, "user", "")] * 2 + [(None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(7000 + c, t, "user", f"hot {t}") for c in range(30) for t in range(10)]
    return rows


@pytest.mark.parametrize("height", [32, 3])
def test_nodes(spark, tmp_path, monkeypatch, height):
    monkeypatch.setattr(trie, "HEIGHT", height)
    rows = conversations()
    more = [(*r, "x", "y") for r in rows]
    table = spark.createDataFrame(more, f"{SCHEMA}, depth string, ID string").repartition(4)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    found = catalog.op12_prefix_trie(spark, str(tmp_path))
    assert found.columns == NAMES
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain(rows)


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert catalog.op12_prefix_trie(spark, str(tmp_path)).count() == 0


def test_ends_of_one_node(spark, monkeypatch):
    """Lists made in ranges join into the hash of the whole list."""
    ids = [*range(-70, 5000, 3)]
    ends = spark.createDataFrame([(b"n", i) for i in ids], "id binary, conv_id long").repartition(5)
    monkeypatch.setattr(trie, "LISTED_BITS", 6)
    found = trie.digests_of_ends(ends).collect()
    assert [r["ends_sha256"] for r in found] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]


def test_place_over_partitions(spark):
    """One conversation in several range partitions is numbered through."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select(F.lit(1).alias("conv_id"), "id", F.lit("u").alias("role"), F.lit("t").alias("text"))
        found = trie.ordered(rows.withColumnRenamed("id", "turn"))
        assert sorted(r["place"] for r in found.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
