"""Line deduplication by pairwise alignment.

Documents overlap where they share a run of lines. A single line, a licence's say, is often frequent,
so candidates are found through least runs: from each line the shortest run with enough words that
begins with it, and the shortest one that ends with it. A run is as rare as its rarest line or rarer, and
every line of a common block lies in such a run inside the block. Each holder of a run is paired with
the run's first holder, so a run that very many documents have makes one pair for each of them.

A pair is aligned by patience diff on hashes of the lines that lie in shared runs; aligned lines that are
next to each other in both documents are common blocks, and those of enough words are deleted from the
later document (the larger doc_id). What is left is aligned again with the whole earlier document,
since a block may lie crosswise to another, until no shared run is left. So a line goes exactly if it
lies in a run of lines of enough words that some earlier document has too, whichever pair finds it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.llm import words as W
from tranche.llm.frames import fresh
from tranche.session import run_folder

#: Words of a common block that is deleted, at least.
MIN_WORDS = 50


def lines_of(piece: W.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number in it, hash and words of each line with words. White space does not matter."""
    found = W.words(piece, W.SPACES)
    breaks = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum(piece.data == 10, out=breaks[1:])
    line = breaks[found.begin]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (found.doc[1:] != found.doc[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(line))
    doc = found.doc[first]
    return doc, line[first] - breaks[piece.starts[doc]], W.span_hashes(found.hash, first, end), end - first


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops: list[int] = []
    top_index: list[int] = []
    before: list[int] = []
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(top_index[pile - 1] if pile else -1)
        tops[pile:pile + 1], top_index[pile:pile + 1] = [value], [k]
    chain = []
    at = top_index[-1] if top_index else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: equal ends match; lines that occur once on either side anchor the rest, in a
    longest common order; the stretches between anchors are aligned likewise."""
    matches = []
    stretches = [(0, len(a), 0, len(b))]
    while stretches:
        low_a, high_a, low_b, high_b = stretches.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            matches.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            matches.append((high_a, high_b))
        if low_a == high_a or low_b == high_b:
            continue
        in_a, in_b = Counter(a[low_a:high_a]), Counter(b[low_b:high_b])
        place = {x: k for k, x in enumerate(b[low_b:high_b], low_b) if in_b[x] == 1}
        both = [(k, place[x]) for k, x in enumerate(a[low_a:high_a], low_a) if in_a[x] == 1 and x in place]
        anchors = [both[k] for k in increasing([j for _, j in both])]
        if not anchors:
            continue
        for (i, j), (next_i, next_j) in zip([(low_a, low_b), *[(i + 1, j + 1) for i, j in anchors]], [*anchors, (high_a, high_b)]):
            stretches.append((i, next_i, j, next_j))
        matches += anchors
    return sorted(matches)


def blocks_once(at: list[int], a: list[int], b: list[int], words: list[int], least: int) -> list[int]:
    """The lines (indices ``at``) of ``a`` that one alignment with ``b`` puts in blocks of enough words."""
    found: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*aligned([a[k] for k in at], b), (-9, -9)]:
        line = at[i] if i >= 0 else i
        if (line, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= least:
                found += block
            block = []
        block.append(line)
        last = (line, j)
    return found


def run_spans(words: list[int], least: int) -> list[tuple[int, int]]:
    """Begin and end of the least runs of a document."""
    begin, end = spans_of(np.zeros(len(words), np.int64), np.array(words, np.int64), least)
    return sorted(set(zip(begin.tolist(), end.tolist())))


def common_blocks(a: list[int], b: list[int], words: list[int], other: list[int], least: int) -> list[int]:
    """Indices of the lines of ``a`` in common blocks of at least ``least`` words. ``other``: the words of
    the lines of ``b``."""
    held = {tuple(b[i:j]) for i, j in run_spans(other, least)}
    shared = [(i, j) for i, j in run_spans(words, least) if tuple(a[i:j]) in held]
    found: set[int] = set()
    while shared:
        left = sorted({k for i, j in shared for k in range(i, j)} - found)
        new = blocks_once(left, a, b, words, least)
        if not new:  # what is left of runs cut by other blocks, or kept apart by repeated lines, goes run by run
            cut = [run for run in shared if not found.isdisjoint(range(*run))]
            new = [k for run in cut or shared[:1] for k in range(*run)]
        found.update(new)
        shared = [(i, j) for i, j in shared if not found.issuperset(range(i, j))]
    return sorted(found)


def lined(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, places, hashes, words) of documents with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch.column("text"), lower=False):
                doc, place, value, words = lines_of(piece)
                n = piece.last - piece.first
                offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in
                         (place.astype(np.int32), value.view(np.int64), words.astype(np.int32))]
                own = [batch.column(c).slice(piece.first, n) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, *lists], ["doc_id", "text_hash", "places", "hashes", "words"])

    rows = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    schema = "doc_id long, text_hash long, places array<int>, hashes array<long>, words array<int>"
    return rows.mapInArrow(run, schema).where(F.size("hashes") > 0)


def spans_of(doc: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the least runs with at least ``least`` words, none across documents."""
    reached = np.zeros(len(words) + 1, np.int64)
    np.cumsum(words, out=reached[1:])
    at = np.arange(len(words))
    ends = np.searchsorted(reached, reached[:-1] + least)
    begins = np.searchsorted(reached, reached[1:] - least, "right") - 1
    begin, end = np.concatenate((at, begins)), np.concatenate((ends, at + 1))
    good = (begin >= 0) & (end <= len(words))
    begin, end = begin[good], end[good]
    within = doc[begin] == doc[end - 1]
    return begin[within], end[within]


def least_runs(doc: np.ndarray, value: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of the least runs: from each line the shortest one with at least ``least`` words
    that begins with it, and the shortest one that ends with it."""
    begin, end = spans_of(doc, words, least)
    return doc[begin], W.span_hashes(value, begin, end)


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def runs_held(documents: DataFrame, least: int) -> DataFrame:
    """(doc_id, run) of documents (doc_id, hashes, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = batch.column("hashes"), batch.column("words").flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), hashes.value_lengths().to_numpy(zero_copy_only=False))
            value = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            own, found = least_runs(doc, value, words, least)
            if len(own):
                own, found = distinct(own, found.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(own)), pa.array(found)], ["doc_id", "run"])

    return documents.select("doc_id", "hashes", "words").mapInArrow(run, "doc_id long, run long")


def overlapping(documents: DataFrame, least: int) -> DataFrame:
    """Pairs (later, earlier): each document (doc_id, hashes, words) with the first holder of each of its
    least runs."""
    runs = runs_held(documents, least)
    first = runs.groupBy("run").agg(F.min("doc_id").alias("earlier"), F.count("*").alias("n")).where("n > 1")
    # A run's holders join its one first holder; a run with very many is split by the planner.
    pairs = runs.join(first, "run").select(F.col("doc_id").alias("later"), "earlier")
    return pairs.where("earlier < later").distinct()


def deduplicated(documents: DataFrame, least: int = MIN_WORDS) -> tuple[DataFrame, list[str]]:
    """Documents without the blocks, with two more columns (names returned): removed_lines and
    removed_words.

    Lines are parted by line feeds and are equal if their words are; lines without words match
    nothing, part no blocks, and stay. Null texts stay null, rows with a null id stay as they are. Of
    an id with several texts only one text takes part; repeated rows share their fate. An empty table
    stays empty. A document whose lines all go has an empty text.
    """
    spark = documents.sparkSession
    folder = run_folder(spark)
    lined(documents).write.parquet(f"{folder}/lines")
    rows = spark.read.parquet(f"{folder}/lines")
    ids = rows.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    rows = rows.join(ids, ["doc_id", "text_hash"]).dropDuplicates(["doc_id"])
    rows.write.parquet(f"{folder}/documents")
    rows = spark.read.parquet(f"{folder}/documents")
    pairs = overlapping(rows, least)
    later = rows.select(F.col("doc_id").alias("later"), "text_hash", "places", "hashes", "words")
    earlier = rows.select(F.col("doc_id").alias("earlier"), F.col("hashes").alias("other"), F.col("words").alias("lengths"))
    both = pairs.join(later, "later").join(earlier, "earlier").select(
        "later", "text_hash", "places", "hashes", "words", "other", "lengths"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                hashes, other, words, lengths, places = (
                    batch.column(c).to_pylist() for c in ("hashes", "other", "words", "lengths", "places")
                )
                found = [common_blocks(*pair, least) for pair in zip(hashes, other, words, lengths)]
                lines = [[p[k] for k in f] for p, f in zip(places, found)]
                counts = [[w[k] for k in f] for w, f in zip(words, found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("later"), batch.column("text_hash"), pa.array(lines, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "text_hash", "lines", "words"],
                )

    blocks = both.mapInArrow(run, "doc_id long, text_hash long, lines array<int>, words array<int>")
    gone = blocks.select("doc_id", "text_hash", F.explode(F.arrays_zip("lines", "words")).alias("line")).distinct()
    # At most the lines of a document are gathered.
    gone = gone.groupBy("doc_id", "text_hash").agg(
        F.collect_set("line.lines").alias("places"), F.sum("line.words").alias("n")
    )
    own, text_hash, places, n = (fresh(x, documents.columns) for x in ("__id", "__hash", "__gone", "__words"))
    gone = gone.toDF(own, text_hash, places, n)
    names = [fresh(x, documents.columns) for x in ("removed_lines", "removed_words")]
    joined = documents.join(
        gone, (F.col("doc_id").cast("long") == F.col(own)) & (F.xxhash64("text") == F.col(text_hash)), "left"
    )
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(places, i))
    text = F.when(F.col(places).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in documents.columns],
        F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).cast("long").alias(names[0]),
        F.coalesce(n, F.lit(0)).cast("long").alias(names[1]),
    ), names
