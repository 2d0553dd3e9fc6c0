"""Exact Jaccard join of documents' word shingles, as a join in the metric space of sets.

1. Documents of equal shingle sets become one class, known by a 64-bit hash of its set.
2. At Jaccard distance 1 a pivot says nothing, and documents of a corpus are at distance 1 from nearly
   all others. So the outermost regions are made by pivots of a single shingle: a class belongs to the
   region of each of its rarest shingles, as many as it must have so that two linked classes meet in
   at least one region (n - ceil(0.75 n) + 1 of n). What is rare is told by a table of counters of
   fixed size that counts the shingles of all documents; it only orders them. Of a class in a region its
   tail is known: how many of its shingles are not rarer than the region's. In the region of the rarest
   shingle that two linked sets share, both tails hold all they share: 3/7 of both sizes or more. Pairs
   of shorter tails are left to other regions. Regions with the same classes are one.
3. In a region every class is compared with a pivot class. A region whose classes are by now all
   connected is done: that two of them are linked too changes no component.
4. What is left is joined recursively. A large region gets several pivot classes; every class goes to
   the cell of its nearest pivot, and also to each cell whose pivot is at most twice the radius farther
   (boundary documents); the pivots themselves are done. A small region, or one that pivots do not take
   apart, is compared pair by pair, between classes that are not connected yet, whose tails allow a link
   and whose distances from the pivot differ by at most the radius (triangle inequality).
5. Links found make the components.

Every comparison is an exact count over the shingle sets, held as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tranche.llm import words as W
from tranche.llm.components import components
from tranche.llm.frames import fresh
from tranche.session import counted_side, measured, run_folder, shuffles_dropped

SHINGLE = 5
#: Linked at PERCENT or more of the union.
PERCENT = 75
RADIUS = 0.25
#: The counters that order shingles, and how many of them go in a row.
COUNTERS = 1 << 20
COUNTERS_ROW = 1 << 10
#: Regions of at most so many classes are compared pair by pair.
LEAF = 64
PIVOTS = 8
#: A region is not taken apart if its cells hold more than so many times its classes, or one cell more
#: than this share of them. So cells shrink fast, and their number stays bounded.
SPREAD = 1.5
SHRINK = 0.7


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 20)).astype(np.int64)


def shingled(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece of a batch: first row, set sizes, and the (document, hash) pairs."""
    for piece in W.pieces(texts):
        doc, value = W.shingles(W.words(piece, W.SPACES), size)
        yield piece.first, np.bincount(doc, minlength=piece.last - piece.first), doc, value


def set_keys(counts: np.ndarray, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A hash of each document's set: of the sum of its shingles' hashes."""
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(W.mixed(value ^ W.BASE), out=sums[1:])
    ends = np.cumsum(counts)
    return W.mixed(sums[ends] - sums[ends - counts] + counts.astype(np.uint64)).view(np.int64)


def surveyed(documents: DataFrame, size: int, folder: str) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, cls; cls null without shingles) of every document, and the counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "n_shingles", "cls", "row", "counts"]
        for batch in batches:
            for first, counts, doc, value in shingled(batch.column("text"), size):
                counters += np.bincount(slot(value), minlength=COUNTERS)
                keys = set_keys(counts, doc, value)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(counts.astype(np.int64)),
                     pa.array(keys, mask=counts == 0), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names,
                )
        rows = counters.reshape(-1, COUNTERS_ROW)
        used = np.flatnonzero(rows.any(axis=1))
        for at in range(0, len(used), 64):
            some = used[at:at + 64]
            blobs = [np.minimum(rows[k], 0xFFFFFFFF).astype("<u4").tobytes() for k in some]
            empty = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [empty, empty, empty, pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], names
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, blob in zip(batch.column("row").to_pylist(), batch.column("counts").to_pylist()):
                values = np.frombuffer(blob, "<u4").astype(np.int64)
                sums[row] = sums[row] + values if row in sums else values
        if sums:
            blobs = [np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(blobs, pa.binary())], ["row", "counts"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen, _ = measured(rows.mapInArrow(run, "doc_id long, n_shingles long, cls long, row int, counts binary"), folder)
    added = seen.where("row is not null").select("row", "counts").repartition("row").mapInArrow(add, "row int, counts binary")
    counters = np.zeros((COUNTERS // COUNTERS_ROW, COUNTERS_ROW), np.uint32)
    for row in added.collect():  # COUNTERS numbers at any size of the input
        counters[row["row"]] = np.frombuffer(row["counts"], "<u4")
    return seen.where("row is null").select("doc_id", "n_shingles", "cls"), counters.ravel()


def rarest(documents: DataFrame, size: int, counters: np.ndarray) -> DataFrame:
    """(shingle, cls, n, tail): of each class the shingles whose regions it belongs to, its size, and
    its shingles from this one on."""
    shared = documents.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a class once for each task
        for batch in batches:
            for _, counts, doc, value in shingled(batch.column("text"), size):
                keys = set_keys(counts, doc, value)
                new = np.zeros(len(counts), bool)
                for k in np.flatnonzero(counts):
                    if int(keys[k]) not in seen:
                        seen.add(int(keys[k]))
                        new[k] = True
                keep = new[doc]
                doc, value = doc[keep], value[keep]
                order = np.lexsort((value, shared.value[slot(value)], doc))
                doc, value = doc[order], value[order]
                place = np.arange(len(doc)) - np.searchsorted(doc, doc)
                n = counts[doc]
                short = place < n - (PERCENT * n + 99) // 100 + 1
                tail = (n - place)[short].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[short].view(np.int64)), pa.array(keys[doc[short]]),
                     pa.array(n[short].astype(np.int32)), pa.array(tail)], ["shingle", "cls", "n", "tail"]
                )

    rows = documents.where(F.col("doc_id").isNotNull()).select("text")
    return rows.mapInArrow(run, "shingle long, cls long, n int, tail int")


def possible(na, nb, tail_a, tail_b):
    """Whether sizes and tails allow two sets to be linked."""
    sizes = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    return sizes & ((100 + PERCENT) * F.least(tail_a, tail_b) >= PERCENT * (na + nb))


def wanted_texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, is_a, is_b) of the wanted documents (rep, each once, and the flags)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("rep"), "text")
    return rows.join(wanted, "rep").select("text", "is_a", "is_b")


def sets_of(texts: DataFrame, size: int) -> DataFrame:
    """(cls, items): the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, counts, doc, value in shingled(batch.column("text"), size):
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(counts, doc, value)), items], ["cls", "items"])

    return texts.select("text").mapInArrow(run, "cls long, items array<long>")


def linked_documents(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id reachable by links).

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and
    carriage return, with A-Z lowered; a document of fewer words than ``size`` has its whole sequence
    as its one shingle. A null, empty or blank text has no shingles and its own id as component.
    Documents with a null id are counted but link with nothing (component null). Repeated rows come
    back each. An empty table gives no rows. Other columns are not read.
    """
    with shuffles_dropped(documents.sparkSession):
        return _linked(documents, size)


def _linked(documents: DataFrame, size: int) -> DataFrame:
    spark = documents.sparkSession
    folder = run_folder(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        return measured(df, f"{folder}/{name}")[0]

    seen, counters = surveyed(documents, size, f"{folder}/seen")
    classes = stored(
        seen.where("doc_id is not null and cls is not null")
        .groupBy("cls").agg(F.min("doc_id").alias("rep")),
        "classes",
    )
    # Outermost regions. Of two linked sets the smaller one's tail holds 6/7 of it; a region where no
    # class has such a tail has no link to find.
    own = Window.partitionBy("shingle")
    long_tail = ((100 + PERCENT) * F.col("tail") >= 2 * PERCENT * F.col("n")).cast("int")
    regions = (
        rarest(documents, size, counters).repartition("shingle").dropDuplicates(["shingle", "cls"])
        .select(
            "cls", "n", "tail",
            F.min("cls").over(own).alias("least"),
            F.max("cls").over(own).alias("most"),
            F.max(long_tail).over(own).alias("long_tail"),
            F.xxhash64(F.bit_xor(F.xxhash64("cls")).over(own), F.min("cls").over(own), F.count("*").over(own)).alias("region"),
        )
        .where("least != most and long_tail = 1")
        .groupBy("region", "cls").agg(F.max("n").cast("long").alias("n"), F.max("tail").cast("long").alias("tail"))
    )
    # In a region, by size: where the next class is too much larger, no link leads across.
    own = Window.partitionBy("region").orderBy("n", "cls")
    apart = F.coalesce((100 * F.lag("n").over(own) < PERCENT * F.col("n")).cast("int"), F.lit(1))
    regions = regions.withColumn("apart", apart).withColumn("chain", F.sum("apart").over(own))
    regions = regions.withColumn("region", F.xxhash64("region", "chain")).drop("apart", "chain")
    # The pivot: the class with the least before its tail. It links with most of those that link at all.
    own = Window.partitionBy("region")
    head = F.floor((F.col("n") - F.col("tail")) * 1_000_000 / F.col("n"))
    first = F.min(F.struct(head.alias("head"), "cls", "n", "tail")).over(own)
    regions = regions.withColumn("pivot", first).withColumn("members", F.count("*").over(own))
    regions = stored(regions.where("members > 1").drop("members"), "regions0")

    number, links = 0, 0  # links: found since the components were made
    compared: DataFrame | None = None

    def compare(pairs: DataFrame) -> None:
        """Compare pairs (a, b, na, nb) whose sizes allow a link and that were not compared before."""
        nonlocal number, links, compared
        swap = F.col("a") > F.col("b")
        pairs = pairs.where((F.col("a") != F.col("b")) & (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")))
        pairs = pairs.select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
            F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
            F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"),
        ).distinct()
        if compared is not None:
            pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
        pairs, count = measured(pairs, f"{folder}/pairs{number}")
        ends = F.explode(F.array(*[
            F.struct(F.col(end).alias("cls"), F.lit(end == "a").alias("is_a"), F.lit(end == "b").alias("is_b")) for end in "ab"
        ]))
        wanted = pairs.select(ends.alias("end")).select("end.*").distinct().join(classes, "cls")
        wanted = wanted.groupBy("rep").agg(F.bool_or("is_a").alias("is_a"), F.bool_or("is_b").alias("is_b"))
        wanted, reps = measured(wanted, f"{folder}/wanted{number}")
        # Lists of ids and of pairs are broadcast if counts prove them short; else both sides are shuffled.
        # Texts are stored, at less than half the bytes of their sets, and either side makes its own sets from them.
        texts = stored(wanted_texts(documents, counted_side(wanted, reps["rows"])), f"texts{number}")
        # Sets move once to meet those of the other side.
        left = sets_of(texts.where("is_a"), size).toDF("a", "sa").join(counted_side(pairs, count["rows"]), "a")
        right = sets_of(texts.where("is_b"), size).toDF("b", "sb")
        both = left.join(right, "b")
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        both = both.select("a", "b", "na", "nb", common.alias("common"))
        union = F.col("na") + F.col("nb") - F.col("common")
        found = both.distinct().select(
            "a", "b", (1 - F.col("common") / union).alias("distance"),
            (100 * F.col("common") >= PERCENT * union).alias("linked"),
        )
        _, seen_here = measured(found, f"{folder}/compared/round={number}", linked=F.count_if("linked"))
        number += 1
        links += seen_here["linked"] or 0
        compared = spark.read.schema(found.schema).parquet(f"{folder}/compared").drop("round")

    def with_distance(pairs: DataFrame) -> DataFrame:
        """``pairs`` (…, a, b) with their distance, null where they were not compared."""
        keyed = pairs.withColumn("x", F.least("a", "b")).withColumn("y", F.greatest("a", "b"))
        known = compared.select(F.col("a").alias("x"), F.col("b").alias("y"), "distance")
        return keyed.join(known, ["x", "y"], "left").drop("x", "y")

    def connected(name: str) -> DataFrame:
        nonlocal links
        links = 0
        return stored(components(compared.where("linked").select("a", "b")), name)

    pivot = F.col("pivot")
    star = regions.where(F.col("cls") != pivot["cls"]).select(
        "region", F.col("cls").alias("a"), pivot["cls"].alias("b"), F.col("n").alias("na"), pivot["n"].alias("nb"),
        "tail", pivot["tail"].alias("pivot_tail"),
    )
    compare(star.where(possible(F.col("na"), F.col("nb"), F.col("tail"), F.col("pivot_tail"))))
    own = Window.partitionBy("region")
    # Pivots go: what the tails allow them has been compared.
    regions = with_distance(star).select(
        "region", F.col("a").alias("cls"), F.col("na").alias("n"), "tail", "distance", F.lit(False).alias("whole")
    )
    depth = 0
    while True:
        depth += 1
        if depth == 1 or links:  # else the components are as before
            roots = connected(f"roots{depth}")
        root = F.coalesce("component", "cls")
        state = regions.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", root).drop("component")
        # In a region whose classes are all connected nothing is left to find.
        state = state.withColumn("members", F.count("*").over(own))
        state = state.withColumn("least", F.min("root").over(own)).withColumn("most", F.max("root").over(own))
        state, count = measured(state.where("least != most").drop("least", "most"), f"{folder}/open{depth}")
        if not count["rows"]:
            break
        small = state.where((F.col("members") <= LEAF) | F.col("whole"))
        left, right = (
            small.select("region", *[F.col(c).alias(c + end) for c in ("cls", "root", "n", "tail", "distance")])
            for end in "ab"
        )
        pairs = left.join(right, "region").where(
            (F.col("clsa") < F.col("clsb")) & (F.col("roota") != F.col("rootb"))
            & possible(F.col("na"), F.col("nb"), F.col("taila"), F.col("tailb"))
            & F.coalesce(F.abs(F.col("distancea") - F.col("distanceb")) <= RADIUS + 1e-9, F.lit(True))
        ).select(F.col("clsa").alias("a"), F.col("clsb").alias("b"), "na", "nb")
        large = state.where((F.col("members") > LEAF) & ~F.col("whole"))
        # Half of the pivots by the same rule, half by a hash
        best = F.row_number().over(own.orderBy(head, "cls"))
        drawn = F.row_number().over(own.orderBy(F.xxhash64("cls", F.lit(depth)), "cls"))
        pivots = large.withColumn("best", best).withColumn("drawn", drawn)
        pivots = pivots.where(F.least("best", "drawn") <= PIVOTS // 2)
        pivots, count = measured(
            pivots.select("region", F.col("cls").alias("b"), F.col("n").alias("nb")), f"{folder}/pivots{depth}"
        )
        star = large.select("region", F.col("cls").alias("a"), F.col("n").alias("na"), "tail", "members").join(pivots, "region")
        compare(pairs.unionByName(star.select("a", "b", "na", "nb")))
        if not count["rows"]:
            roots = connected(f"roots{depth + 1}") if links else roots
            break
        # Voronoi cells, with boundary classes in more than one; pivots go
        reach = with_distance(star.where("a != b")).join(
            pivots.select("region", F.col("b").alias("a")), ["region", "a"], "left_anti"
        )
        mine = Window.partitionBy("region", "a")
        reach = reach.withColumn("nearest", F.min(F.coalesce("distance", F.lit(1.0))).over(mine))
        reach = reach.where(F.coalesce(F.col("distance") <= F.col("nearest") + 2 * RADIUS + 1e-9, F.lit(True)))
        in_cell = F.count("*").over(Window.partitionBy("region", "b"))
        reach = reach.withColumn("in_cell", in_cell)
        reach = reach.withColumn(
            "whole",
            (F.count("*").over(own) > SPREAD * F.col("members")) | (F.max("in_cell").over(own) > SHRINK * F.col("members")),
        )
        reach = reach.withColumn("place", F.row_number().over(mine.orderBy("distance", "b")))
        cells = reach.where("place = 1 or not whole").select(
            F.when(F.col("whole"), F.col("region")).otherwise(F.xxhash64("region", "b")).alias("region"),
            F.col("a").alias("cls"), F.col("na").alias("n"), "tail",
            F.when(~F.col("whole"), F.col("distance")).alias("distance"), "whole",
        )
        regions = stored(cells, f"cells{depth}")

    # From classes back to documents
    placed = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "rep", F.coalesce("component", "cls").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = placed.join(least, "root").select("cls", "component_id")
    return seen.join(placed, "cls", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def deduplicated(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The documents whose id is the least of their component, with their own columns. Rows of the same id
    share their fate; documents without shingles or id all stay."""
    found = linked_documents(documents, size).where("n_shingles > 0 and doc_id is not null")
    name = fresh("__away", documents.columns)
    away = found.where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    away, count = measured(away, f"{run_folder(documents.sparkSession)}/away")
    return documents.join(counted_side(away, count["rows"]), F.col("doc_id").cast("long") == F.col(name), "left_anti")
