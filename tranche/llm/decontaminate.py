"""Benchmark decontamination by Wu-Manber search over words.

Every run of ``WINDOW`` words of a benchmark item is a pattern; an item of fewer words is one
pattern. Patterns are grouped by their length m. For each group a shift table, indexed by a hash of
a block of two words, tells how far the search may move on because no pattern has this block nearer
to its end; where it may not move, the bucket of patterns with this block as their suffix is
compared word by word, first by hash and then by the bytes themselves. The search advances through
many stretches of text at the same time, in numpy.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.llm import words as W
from tranche.llm.frames import with_columns
from tranche.session import run_folder

WINDOW = 13
#: A document is contaminated if it has hits and this many times the hit words are at least its words.
HIT_FACTOR = 20
SLOTS = 1 << 16
STRETCH = 512
#: Bytes of benchmark text searched for in one pass, and so broadcast at once; more take more passes.
PASS_BYTES = 8 << 20


def block_hashes(hashes: np.ndarray, block: int) -> np.ndarray:
    """For each word the hash of the block that ends with it (of the first word: some number)."""
    if block == 1:
        return hashes
    before = np.concatenate((hashes[:1], hashes[:-1]))
    return W.mixed(before * W.BASE + hashes)


@dataclass
class Group:
    """Patterns of one length. ``patterns``: their word hashes; ``texts``: their words, each with a
    space after it; ``items``: who has them; ``suffix``: sorted hashes of their last blocks."""

    length: int
    block: int
    patterns: np.ndarray
    texts: list[bytes]
    items: list[list[str]]
    shift: np.ndarray
    suffix: np.ndarray

    @classmethod
    def of(cls, length: int, found: dict[bytes, tuple[np.ndarray, set[str]]]) -> Group:
        block = min(2, length)
        texts = sorted(found)
        patterns = np.array([found[t][0] for t in texts], np.uint64).reshape(len(texts), length)
        shift = np.full(SLOTS, length - block + 1, np.uint8 if length < 255 else np.int64)
        ends = np.empty(len(texts), np.uint64)
        for k in range(len(texts)):
            blocks = block_hashes(patterns[k], block)
            ends[k] = blocks[-1]
            for at in range(block - 1, length):
                slot = int(blocks[at]) & (SLOTS - 1)
                shift[slot] = min(shift[slot], length - 1 - at)
        order = np.argsort(ends, kind="stable")
        return cls(
            length, block, patterns[order], [texts[k] for k in order],
            [sorted(found[texts[k]][1]) for k in order], shift, ends[order],
        )

    def search(self, piece: W.Piece, found: W.Words) -> list[tuple[int, int]]:
        """(index of the first word, pattern) of every occurrence in the piece."""
        lengths = np.diff(found.starts)
        # Windows may end at any word but a document's first ones; stretches share these ends out.
        first_end, last_end = found.starts[:-1] + self.length - 1, found.starts[1:]
        count = np.where(lengths >= self.length, -(-(lengths - self.length + 1) // STRETCH), 0)
        if not count.sum():
            return []
        own = np.repeat(np.arange(len(lengths)), count)
        part = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        at = first_end[own] + part * STRETCH
        stop = np.minimum(at + STRETCH, last_end[own])
        blocks = block_hashes(found.hash, self.block)
        slots = (blocks & np.uint64(SLOTS - 1)).astype(np.int64)
        stays = []
        while len(at):
            moves = self.shift[slots[at]].astype(np.int64)
            stays.append(at[moves == 0])
            at = at + np.maximum(moves, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.sort(np.concatenate(stays))
        low = np.searchsorted(self.suffix, blocks[ends], "left")
        high = np.searchsorted(self.suffix, blocks[ends], "right")
        bucket = high - low
        which = np.repeat(low, bucket) + np.arange(bucket.sum()) - np.repeat(np.cumsum(bucket) - bucket, bucket)
        begins = np.repeat(ends, bucket) - self.length + 1
        for k in range(self.length):
            same = self.patterns[which, k] == found.hash[begins + k]
            which, begins = which[same], begins[same]
        data = piece.data
        hits = []
        for begin, pattern in zip(begins.tolist(), which.tolist()):
            spans = zip(found.begin[begin:begin + self.length], found.end[begin:begin + self.length])
            if b"".join(data[b:e].tobytes() + b" " for b, e in spans) == self.texts[pattern]:
                hits.append((begin, pattern))
        return hits


def groups(items: list[tuple[str | None, str]], window: int) -> list[Group]:
    """The patterns of some benchmark items, by length."""
    ids = [i for i, _ in items]
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
    for piece in W.pieces(pa.array([t for _, t in items], pa.large_string())):
        found = W.words(piece, W.NOT_LETTERS)
        for d in range(piece.last - piece.first):
            low, high = found.starts[d], found.starts[d + 1]
            size = min(window, high - low)
            for begin in range(low, high - size + 1 if size else low):
                text = b"".join(
                    piece.data[found.begin[k]:found.end[k]].tobytes() + b" " for k in range(begin, begin + size)
                )
                own = by_length.setdefault(int(size), {}).setdefault(text, (found.hash[begin:begin + size], set()))
                if ids[piece.first + d] is not None:
                    own[1].add(ids[piece.first + d])
    return [Group.of(length, found) for length, found in sorted(by_length.items())]


def search_batch(texts: pa.Array, patterns: list[Group], spans: list, items: list) -> list[int]:
    """Add to each text's ``spans`` (first word, end) and ``items`` what occurs in it; give the word counts."""
    counts = []
    for piece in W.pieces(texts):
        found = W.words(piece, W.NOT_LETTERS)
        counts += np.diff(found.starts).tolist()
        for group in patterns:
            for begin, pattern in group.search(piece, found):
                doc = int(found.doc[begin])
                start = begin - int(found.starts[doc])
                spans[piece.first + doc] += [start, start + group.length]
                items[piece.first + doc].update(group.items[pattern])
    return counts


def covered(spans: list[int]) -> int:
    """How many words lie in any of the spans."""
    total, reached = 0, 0
    for begin, end in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, end - max(begin, reached))
        reached = max(reached, end)
    return total


def blocks_of(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in blocks of about PASS_BYTES."""
    own = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text")).where(F.col("text").isNotNull())
    size = own.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-size // PASS_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [own.where(block == k) for k in range(count)] if count > 1 else [own]


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> tuple[DataFrame, list[str]]:
    """Documents with five more columns, whose names are returned: n_words, n_hit, n_items,
    items_sha256, contaminated.

    Words are runs of lower-case letters, digits and characters beyond ASCII, after A-Z are lowered.
    Null and empty texts have no words and are clean. Items without text are no patterns; those
    without id are searched like others, but neither counted nor listed as items. An empty benchmark
    leaves all documents clean, an empty document table stays empty. Repeated rows are judged each. A
    benchmark over PASS_BYTES is searched for in several passes, each written before the next one's
    patterns are made, so the driver and the executors hold one block at a time.
    """
    spark = documents.sparkSession
    blocks = blocks_of(benchmark)
    rows, state = documents, []
    for number, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(groups([tuple(r) for r in block.collect()], window))
        last = number == len(blocks) - 1

        def compute(batch: pa.RecordBatch, shared=shared, state=tuple(state), last=last) -> list[pa.Array]:
            texts = batch.column("text")
            if state:
                spans = batch.column(state[0]).to_pylist()
                items = [set(x) for x in batch.column(state[1]).to_pylist()]
            else:
                spans, items = [[] for _ in range(len(texts))], [set() for _ in range(len(texts))]
            counts = search_batch(texts, shared.value, spans, items)
            if not last:
                return [pa.array(spans, pa.list_(pa.int64())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            hits = [covered(x) for x in spans]
            digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
            return [
                pa.array(counts, pa.int64()), pa.array(hits, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()),
                pa.array([h > 0 and HIT_FACTOR * h >= c for h, c in zip(hits, counts)], pa.bool_()),
            ]

        added = (
            "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
            if last else f"__spans{number} array<long>, __items{number} array<string>"
        )
        rows, state = with_columns(rows, added, compute)
        if not last:
            folder = run_folder(spark)
            rows.write.parquet(folder)
            shared.unpersist()
            rows = spark.read.parquet(folder)
    return rows.select(*documents.columns, *state), state


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    judged, names = contamination(documents, benchmark)
    return judged.where(~F.col(names[-1])).select(*documents.columns)
