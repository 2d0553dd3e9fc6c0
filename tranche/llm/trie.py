"""Prefix trie of conversations, with subtree totals rolled up in bands of depth.

A node is a distinct sequence of first turns; its id is a hash of that sequence. Depths are cut into
bands of ``HEIGHT``. Inside a band every node is exploded to its ancestors of the same band only, at
most ``HEIGHT`` rows for a node. The totals of band roots are then completed, by the same step on the
much smaller tree that only the band roots form, and each completed total is given to the ancestors in
the band above. So rounds are a logarithm of the longest conversation and no step collects more than
``HEIGHT`` turns: a conversation that holds a third of all rows is spread over tasks like any other.

Ids are 128 bits of SHA-256. They are chained inside a band and start from the id of the bands before
it, which is the same chain over whole bands; long conversations therefore need no long chain either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tranche.session import settle

HEIGHT = 32
#: Conversations whose ids differ only in so many low bits are listed together.
LISTED_BITS = 12
EMPTY = b""


def hashed(value: Column) -> Column:
    """128 bits of SHA-256, as binary."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def turn_key(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the length of the role keeps it apart from the text."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.sha2(both.cast("binary"), 256))


def ordered(conversations: DataFrame) -> DataFrame:
    """Place each turn in its conversation: conv_id, place (from 0), digest, size (bytes of the text).

    Reads conv_id, turn, role and text. The order is by turn, null first; equal turns are ordered by
    the digest of role and text, and repeated rows all count. A null role or text is an empty one; rows
    without conv_id are left out. Rows are numbered in range partitions, so one conversation may span
    many of them.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        turn_key(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size"),
    )
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    rows = settle(rows.select("conv_id", "digest", "size", at.alias("at"), F.shiftright(at, 33).alias("part")))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("place"), "digest", "size"
    )


def grafted(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Rebuild every conversation c on its family's first one, c - c % ``family``: first that one's h
    turns (fewer if it has fewer, none if it is absent), then c's own turns after its own first h, where
    h is the unsigned crc32 of the decimal c, modulo ``most``.

    ``turns`` is as ``ordered`` gives it; so is the result, with a column length (turns of the rebuilt
    conversation) and one row more for each conversation, which stands for the root: place -1, an empty
    digest and size 0.
    """
    turns = settle(turns)
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    base = own.where(c % family == 0).select(c.alias("base"), F.col("n").alias("base_n"))
    members = own.select(
        c, "n", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % most).alias("skip")
    ).join(base, "base", "left")
    members = members.withColumn("taken", F.least("skip", F.coalesce("base_n", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("skip"), F.lit(0))
    members = settle(members.select("conv_id", "base", "skip", "taken", length.alias("length")))
    rest = turns.join(members, "conv_id").where(F.col("place") >= F.col("skip")).select(
        "conv_id", (F.col("place") - F.col("skip") + F.col("taken")).alias("place"), "digest", "size", "length"
    )
    heads = turns.where((F.col("place") < most - 1) & (c % family == 0)).withColumnRenamed("conv_id", "base")
    front = members.join(heads, "base").where(F.col("place") < F.col("taken"))
    roots = members.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(EMPTY).alias("digest"),
                           F.lit(0).cast("long").alias("size"), "length")
    return rest.unionByName(front.select(*rest.columns)).unionByName(roots)


def banded(entries: DataFrame, *more: str) -> DataFrame:
    """Entries (conv_id, depth, …) as one array ``path`` for each conversation and band."""
    fields = F.struct("depth", *more)
    band = F.floor(F.col("depth") / F.lit(HEIGHT)).cast("long").alias("band")
    return entries.groupBy("conv_id", band).agg(F.sort_array(F.collect_list(fields)).alias("path"))


def chained(bands: DataFrame, highest: int) -> DataFrame:
    """Add ``ids`` to bands with ``path`` of (depth, digest, …): the id of each prefix that ends there.
    ``highest`` is the largest depth."""
    if highest >= HEIGHT:
        digests = F.transform("path", lambda x: x["digest"])
        whole = F.aggregate(digests, F.lit(EMPTY), lambda acc, x: F.concat(acc, x))
        blocks = bands.select("conv_id", F.col("band").alias("depth"), F.unhex(F.sha2(whole, 256)).alias("digest"))
        upper = chained(banded(blocks, "digest"), highest // HEIGHT)
        upper = upper.select("conv_id", F.explode(F.arrays_zip(F.col("path.depth").alias("d"), F.col("ids").alias("i"))).alias("x"))
        prior = upper.select("conv_id", (F.col("x.d") + 1).alias("band"), F.col("x.i").alias("prior"))
        bands = bands.join(prior, ["conv_id", "band"], "left").withColumn("prior", F.coalesce("prior", F.lit(EMPTY)))
    else:
        bands = bands.withColumn("prior", F.lit(EMPTY))
    steps = F.aggregate(
        "path", F.array("prior"),
        lambda acc, x: F.concat(acc, F.array(hashed(F.concat(F.element_at(acc, -1), x["digest"])))),
    )
    return bands.withColumn("ids", F.slice(steps, F.lit(2), F.size("path"))).drop("prior")


@dataclass
class Trie:
    """``nodes``: one row per node with id, parent (its id; root: null), depth, conv_id (smallest
    member), parent_conv_id, n_convs, n_children, n_leaves and saved_tokens. ``ends``: id and conv_id of
    each member that has no further turn. A node's last turn is that of place depth - 1 of its conv_id."""

    nodes: DataFrame
    ends: DataFrame


def rolled_up(nodes: DataFrame, paths: DataFrame, sums: list[str], highest: int) -> DataFrame:
    """Subtree totals of ``sums``: (id, depth, *sums). ``nodes``: id, conv_id (any member), depth, *sums;
    ``paths``: conv_id, band, ids (of the depths of that band, in order)."""
    band = F.floor(F.col("depth") / F.lit(HEIGHT)).cast("long")

    def given(rows: DataFrame, to: Column, count: Column) -> DataFrame:
        return rows.withColumn("band", to).join(paths, ["conv_id", "band"]).select(
            F.explode(F.slice("ids", F.lit(1), count)).alias("id"), *sums
        )

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(*[F.sum(s).alias(s) for s in sums])

    local = given(nodes, band, (F.col("depth") % HEIGHT + 1).cast("int"))
    if highest < HEIGHT:
        return added(local)
    local = settle(added(local))
    roots = nodes.where(F.col("depth") % HEIGHT == 0).select("id", "conv_id", band.alias("depth"))
    roots = settle(roots.join(local, "id"))
    firsts = paths.select("conv_id", F.col("band").alias("depth"), F.col("ids")[0].alias("id"))
    upper = banded(firsts, "id").select("conv_id", "band", F.col("path.id").alias("ids"))
    complete = rolled_up(roots, settle(upper), sums, highest // HEIGHT)
    below = roots.select("id", "conv_id", "depth").join(complete, "id").where("depth > 0")
    return added(local.unionByName(given(below, F.col("depth") - 1, F.lit(HEIGHT))))


def prefix_trie(entries: DataFrame) -> Trie:
    """The trie of conversations given as ``grafted`` gives them.

    Reads conv_id, place (-1: the root), digest, size and length. Conversations without a turn are
    members of the root and end there. Without conversations there is no node.
    """
    entries = settle(entries.select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "size", "length"))
    highest = entries.agg(F.max("depth")).first()[0] or 0
    bands = chained(banded(entries, "digest", "size", "length"), highest)
    bands = settle(bands.select("conv_id", "band", F.col("path.size").alias("sizes"), F.col("path.length")[0].alias("length"), "ids"))
    if highest >= HEIGHT:
        last = bands.select("conv_id", (F.col("band") + 1).alias("band"), F.element_at("ids", -1).alias("before"))
        walked = bands.join(last, ["conv_id", "band"], "left")
    else:
        walked = bands.withColumn("before", F.lit(None).cast("binary"))
    above = F.concat(F.array("before"), F.slice("ids", F.lit(1), F.size("ids") - 1))
    steps = walked.select(
        "conv_id", "band", "length",
        F.posexplode(F.arrays_zip(F.col("ids").alias("id"), F.col("sizes").alias("size"), above.alias("parent"))).alias("k", "x"),
    ).select("conv_id", (F.col("band") * HEIGHT + F.col("k")).alias("depth"), "length", "x.id", "x.size", "x.parent")
    nodes = settle(steps.groupBy("id").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("size").alias("size"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
    ))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = settle(nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size"),
    }))
    sums = ["n_leaves", "saved_tokens"]
    totals = rolled_up(nodes.select("id", "conv_id", "depth", *sums), bands.select("conv_id", "band", "ids"), sums, highest)
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.drop(*sums, "size").join(totals, "id").join(parents, "parent", "left")
    return Trie(found, steps.where("depth = length").select("id", "conv_id"))


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """For each node that has any, the lower-case SHA-256 of its ends' decimal ids, ascending and joined by
    commas: (id, ends_sha256). Lists are made for ranges of ids and hashed one after another as they come
    sorted from the shuffle, so a node's list is never held as a whole."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    parts = ends.groupBy("id", F.shiftright("conv_id", LISTED_BITS).alias("range")).agg(F.array_join(ids, ",").alias("listed"))
    parts = parts.repartition("id").sortWithinPartitions("id", "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def made(nodes: list, sums: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], ["id", "ends_sha256"])

        for batch in batches:
            nodes, sums = [], []
            for node, listed in zip(batch.column("id").to_pylist(), batch.column("listed").to_pylist()):
                if node == current:
                    digest.update(b"," + listed.encode())
                    continue
                if current is not None:
                    nodes.append(current)
                    sums.append(digest.hexdigest())
                current, digest = node, hashlib.sha256(listed.encode())
            yield made(nodes, sums)
        if current is not None:
            yield made([current], [digest.hexdigest()])

    return parts.select("id", "listed").mapInArrow(run, "id binary, ends_sha256 string")
