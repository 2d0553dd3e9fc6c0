"""Near-duplicate vectors by tiled comparison in the order of their principal components.

Vectors are compared when they have the same label. Equal ones are joined first. The second moments
of all vectors give principal axes; along these the leading coordinates hold most of a product, and
by Cauchy-Schwarz the rest is at most the product of the norms of the remaining coordinates. A tile
compares two blocks of vectors: products of the leading coordinates first, then more coordinates of
those pairs only whose bound still reaches the threshold, and last the cosine itself. Vectors whose
first coordinates differ by more than the threshold allows are in no common tile.

A tile gives each vector's links as a count and its connections as a forest, not as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.llm.components import components
from tranche.session import run_folder

THRESHOLD = 0.98
#: Vectors of a block, about; a tile is two blocks.
BLOCK = 1024
#: Rows of a tile compared at a time.
ROWS = 256
LEADING = 8
SLACK = 1e-9


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def axes(classes: DataFrame) -> np.ndarray:
    """Principal axes as columns, the strongest first, from the second moments of all unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = unit(matrix(batch.column("vector")))
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            d = len(total)
            i, j = np.divmod(np.arange(d * d), d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "moment"]
            )

    # As many rows as a matrix of the vectors' dimension has cells.
    cells = (
        classes.select("vector").mapInArrow(run, "i int, j int, moment double")
        .groupBy("i", "j").agg(F.sum("moment").alias("moment")).collect()
    )
    d = max((c["i"] for c in cells), default=-1) + 1
    moments = np.zeros((d, d))
    for c in cells:
        moments[c["i"], c["j"]] = c["moment"]
    values, found = np.linalg.eigh((moments + moments.T) / 2)
    return found[:, np.argsort(-values, kind="stable")]


def linked_pairs(
    a: np.ndarray, b: np.ndarray, turned_a: np.ndarray, turned_b: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors whose product reaches the threshold; of one block with itself each
    pair once."""
    d = a.shape[1]
    steps = []
    low = 0
    while low < d:
        high = min(d, max(LEADING, 2 * low))
        steps.append((low, high))
        low = high
    rest_a = [np.sqrt(np.maximum((turned_a[:, h:] ** 2).sum(axis=1), 0)) for _, h in steps]
    rest_b = [np.sqrt(np.maximum((turned_b[:, h:] ** 2).sum(axis=1), 0)) for _, h in steps]
    first = steps[0][1]
    for at in range(0, len(a), ROWS):
        part = turned_a[at:at + ROWS, :first] @ turned_b[:, :first].T
        reach = part + rest_a[0][at:at + ROWS, None] * rest_b[0][None, :]
        keep = reach >= threshold - SLACK
        if same:
            keep &= np.arange(at, at + len(part))[:, None] < np.arange(len(b))[None, :]
        i, j = np.nonzero(keep)
        sums, i = part[i, j], i + at
        for (low, high), ra, rb in zip(steps[1:], rest_a[1:], rest_b[1:]):
            sums = sums + np.einsum("ij,ij->i", turned_a[i, low:high], turned_b[j, low:high])
            open_ = sums + ra[i] * rb[j] >= threshold - SLACK
            i, j, sums = i[open_], j[open_], sums[open_]
        sure = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
        yield i[sure], j[sure]


def forest(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index connected to each of ``count`` nodes by the pairs."""
    root = np.arange(count)
    while True:
        before = root
        low = np.minimum(root[i], root[j])
        root = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (root == before).all():
            return root


def classes_of(embeddings: DataFrame) -> DataFrame:
    """Equal vectors of a label as one: rep (least vec_id), label, vector, copies. Left out are those
    without label, null, empty or zero vectors, and those with null or non-finite components."""
    vector = F.col("embedding").cast("array<double>")
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector")).where(
        F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
        & F.exists("vector", lambda x: x != 0)
    )
    return usable.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine reaches the threshold. Unusable vectors
    (see ``classes_of``) link with nothing. Vectors of different dimension link with nothing either.
    vec_id is taken to be a key; rows with the same id share their result. Null ids link with nothing.
    """
    spark = embeddings.sparkSession
    folder = run_folder(spark)
    keyed = embeddings.where(F.col("vec_id").isNotNull())
    classes_of(keyed).select("*", F.size("vector").alias("dim")).write.partitionBy("dim").parquet(f"{folder}/classes")
    dims = [r[0] for r in keyed.select(F.size("embedding").alias("dim")).distinct().collect() if (r[0] or 0) > 0]
    result = None
    for dim in sorted(dims):  # one as a rule
        own = spark.read.schema(
            "label " + keyed.schema["label"].dataType.simpleString() + ", vector array<double>, rep long, copies long, dim int"
        ).parquet(f"{folder}/classes").where(F.col("dim") == dim)
        found = tiled(own, threshold, block)
        result = found if result is None else result.unionByName(found)
    ids = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"))
    if result is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.lit(True).alias("kept"))
    result.write.parquet(f"{folder}/tiles")
    tiles = spark.read.parquet(f"{folder}/tiles")
    links = tiles.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(tiles.where("root is not null and root != rep").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = spark.read.parquet(f"{folder}/classes").select("label", "vector", "rep", "copies")
    classes = classes.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector")
    )
    # Null ids have no class of their own, and so no partner here.
    key = F.when(F.col("vec_id").isNotNull(), F.col("label"))
    joined = rows.withColumn("label", key).join(classes, ["label", "vector"], "left")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def tiled(classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Compare classes of one dimension: rep, links (copies of the classes linked), root (connected
    within a tile), one row for each class and tile."""
    spark = classes.sparkSession
    turn = spark.sparkContext.broadcast(axes(classes))  # a matrix of the vectors' dimension
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                first = unit(matrix(batch.column("vector"))) @ turn.value[:, 0]
                slab = pa.array(np.floor(first / width).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, slab], [*batch.schema.names, "slab"])

    label = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "rep", "copies", "vector").mapInArrow(
        lead, f"label {label}, rep long, copies long, vector array<double>, slab long"
    )
    folder = f"{run_folder(spark)}/placed"
    placed.write.parquet(folder)
    placed = spark.read.parquet(folder)
    # Slabs are as wide as linked vectors' first coordinates may differ, so links stay within a slab or
    # lead to the next. A slab of many vectors has several blocks, dealt out by a hash of the id.
    counts = placed.groupBy("label", "slab").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    after = counts.select("label", (F.col("slab") - 1).alias("slab"), F.col("blocks").alias("next_blocks"))
    slabs = counts.join(after, ["label", "slab"], "left").withColumn("next_blocks", F.coalesce("next_blocks", F.lit(0)))
    before = counts.select("label", (F.col("slab") + 1).alias("slab"), F.col("blocks").alias("before_blocks"))
    slabs = slabs.join(before, ["label", "slab"], "left").withColumn("before_blocks", F.coalesce("before_blocks", F.lit(0)))
    rows = placed.join(slabs, ["label", "slab"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # Tiles (slab, block, next slab or not, other block) that a vector is in, and on which side.
    def side(low, high, name, make):
        return F.when(high > low, F.transform(F.sequence(low, high - 1), make)).otherwise(F.array().cast(name))

    kind = "array<struct<slab:bigint,first:int,across:boolean,second:int,left:boolean>>"

    def tile(slab, first, across, second, left):
        return F.struct(slab.alias("slab"), first.alias("first"), F.lit(across).alias("across"),
                        second.alias("second"), F.lit(left).alias("left"))

    slab, own = F.col("slab"), F.col("own")
    zero = F.lit(0)
    tiles = F.concat(
        side(own, F.col("blocks"), kind, lambda k: tile(slab, own, False, k, True)),
        side(zero, own, kind, lambda k: tile(slab, k, False, own, False)),
        side(zero, F.col("next_blocks"), kind, lambda k: tile(slab, own, True, k, True)),
        side(zero, F.col("before_blocks"), kind, lambda k: tile(slab - 1, k, True, own, False)),
    )
    dealt = rows.select("label", "rep", "copies", "vector", F.explode(tiles).alias("tile")).select(
        "label", "rep", "copies", "vector", "tile.*"
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        left = table.column("left").to_numpy()
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        vectors = unit(matrix(table.column("vector").combine_chunks()))
        turned = vectors @ turn.value
        one = np.flatnonzero(left)
        two = np.flatnonzero(~left)
        alone = not table.column("across")[0].as_py() and table.column("first")[0] == table.column("second")[0]
        two = one if alone else two
        links = np.zeros(len(rep), np.int64)
        root = np.arange(len(rep))
        if len(one) and len(two):
            for i, j in linked_pairs(vectors[one], vectors[two], turned[one], turned[two], threshold, alone):
                if len(i):
                    i, j = one[i], two[j]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    # what was connected before, and the new pairs
                    nodes = np.arange(len(rep))
                    root = forest(len(rep), np.concatenate((nodes, i)), np.concatenate((root, j)))
        found = np.flatnonzero(links)
        return pa.table({"rep": rep[found], "links": links[found], "root": rep[root[found]]})

    return dealt.groupBy("label", "slab", "first", "across", "second").applyInArrow(
        compare, "rep long, links long, root long"
    )
