"""Alignment of two tokenizers over a corpus, with link counts by external spill counting.

A text, with a space before it, is encoded by a byte-level tokenizer (A) and by a piece model (B).
Byte offsets where tokens of both end cut the text into groups; every token of A is linked with every
token of B of its group. The number of documents that hold an id pair linked is counted corpus-wide:

1. A task encodes documents and collects pair-document records. Each time ``RUN_RECORDS`` are held they
   are sorted by pair, cut by radix of the A id, and spilled as a zstd run: per radix the pairs with
   their document counts, and the records themselves. Runs are rows of a table in the shared folder.
2. The pairs of one radix, from all runs, meet in one task: a k-way heap merge of the sorted runs adds up
   each pair's documents. All pairs of an A id are neighbours in this order, so its highest count is
   known when its last pair has passed. The totals go back to each run, in the run's own order.
3. A run's records and its totals stream past one another, radix by radix, and add up to its documents.

A pair that all documents hold is one entry in each run, so no key is hot. With as many radixes as runs
one merge reads about as many pairs as one run has, whatever the corpus holds.

Texts are encoded in units that neither tokenizer joins: they are cut before a space that follows
anything but white space. A unit met before by the worker is not encoded again, and new ones are encoded
many at a time.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import itertools
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.session import settle

RUN_RECORDS = 2_000_000
#: Units remembered in each of two generations, and the longest one that is.
REMEMBERED, LONGEST = 200_000, 48
#: Documents are encoded in slices of about so many characters.
SLICE_CHARS = 2_000_000
#: Units encoded in one call.
TOGETHER = 500
#: In groups with more links than this, equal ids are counted before they are paired.
SMALL_GROUP = 256
CUT = re.compile(r"(?<=\S)(?= +\S)")
SPACED = re.compile(r"[^\S ] ")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
RUN = "run string, radix int, kind int, data binary"
DOCUMENTS, PAIRS, RECORDS, TOTALS = range(4)
RESULT = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()),
]


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the
    others in order from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Aligner:
    """Encodes units by both tokenizers and links their tokens. ``definition``: a byte-level tokenizers
    file; ``model``: a serialized piece model that puts a space before a text."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters, vocabulary = byte_letters(), json.loads(definition)["model"]["vocab"]
        self.bytes_a = [b""] * max(self.a.get_vocab_size(), max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = BYTE_PIECE.fullmatch(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("ids must be below 65,536")
        # A unit must not be joined with the next one, so no piece holds a space behind anything else.
        self.apart = not any(" " in p.lstrip(b" ").decode(errors="replace") for p in self.bytes_b)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.long: list[str] = []

    def _cut(self, text: str) -> list[str]:
        """The units of a space and ``text``, each without its first space."""
        if not self.apart:
            return [text]
        if text[0] == " " or text[-1] == " " or "  " in text or SPACED.search(text):
            return [u[1:] for u in CUT.split(f" {text}")]
        return text.split(" ")

    def aligned(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, str] | None]:
        """For each text its links (weight << 32 | a << 16 | b; a pair may come several times), the numbers of
        tokens of A and B, groups and links, and its groups as text; None if it has no tokens."""
        cut = [self._cut(t) if t else [] for t in texts]
        self._meet(set(itertools.chain.from_iterable(cut)))
        known, result = self.young.__getitem__, []
        for units in cut:
            entries = list(map(known, units))
            if not entries or None in entries:
                result.append(None)
                continue
            links, sizes, groups = zip(*entries)
            sizes = np.frombuffer(b"".join(sizes), np.int64).reshape(-1, 4).sum(axis=0)
            result.append((np.frombuffer(b"".join(links), np.uint64), sizes, ";".join(groups)))
        self._forget()
        return result

    def _meet(self, units: set[str]) -> None:
        """Make ``units`` known, in the young generation."""
        new = []
        for unit in units.difference(self.young):
            if unit in self.old:
                self.young[unit] = self.old[unit]
            else:
                new.append(unit)
        self.long = [u for u in new if len(u) > LONGEST]
        # Units that end with white space are encoded alone, the others together.
        alone = [[u] for u in new if not u or u[-1].isspace()]
        joined = [u for u in new if u and not u[-1].isspace()] if self.apart else []
        alone += [] if self.apart else [[u] for u in new if u and not u[-1].isspace()]
        chunks = alone + [joined[k:k + TOGETHER] for k in range(0, len(joined), TOGETHER)]
        broken = self._link(chunks)
        for chunk in self._link([[u] for chunk in broken for u in chunk]):
            self.young[chunk[0]] = None

    def _forget(self) -> None:
        for unit in self.long:
            del self.young[unit]
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young

    def _link(self, chunks: list[list[str]]) -> list[list[str]]:
        """Encode units, each chunk's together, and remember their links, sizes and groups. Chunks of which a
        tokenizer's bytes differ from the text are returned."""
        texts = [" " + " ".join(chunk) for chunk in chunks]
        ids_a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)] if chunks else []
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1) if chunks else []
        get_a, get_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        good = [
            b"".join(map(get_a, a)) == p and b"".join(map(get_b, b)) == p
            for a, b, p in zip(ids_a, ids_b, (t.encode() for t in texts))
        ]
        broken = [chunk for chunk, ok in zip(chunks, good) if not ok]
        units = [u for chunk, ok in zip(chunks, good) if ok for u in chunk]
        if not units:
            return broken
        flat_a = np.fromiter(itertools.chain.from_iterable(x for x, ok in zip(ids_a, good) if ok), np.int64)
        flat_b = np.fromiter(itertools.chain.from_iterable(x for x, ok in zip(ids_b, good) if ok), np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        unit_ends = np.cumsum([len(u) + 1 if u.isascii() else len(u.encode()) + 1 for u in units])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)  # holds the units' ends
        size_a = np.diff(np.searchsorted(ends_a, common, "right"), prepend=0)
        size_b = np.diff(np.searchsorted(ends_b, common, "right"), prepend=0)
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        n_links = size_a * size_b
        held = np.where(n_links <= SMALL_GROUP, n_links, 0)
        group = np.repeat(np.arange(len(common)), held)
        step = np.arange(len(group)) - np.repeat(np.cumsum(held) - held, held)
        a = flat_a[first_a[group] + step // size_b[group]]
        b = flat_b[first_b[group] + step % size_b[group]]
        links = (1 << 32 | a << 16 | b).astype(np.uint64).tobytes()
        groups_to = np.searchsorted(common, unit_ends, "right")
        large: dict[int, list[bytes]] = {}
        for g in np.flatnonzero(n_links > SMALL_GROUP):
            unit = int(np.searchsorted(groups_to, g, "right"))
            large.setdefault(unit, []).extend(
                weighted(flat_a[first_a[g]:first_a[g] + size_a[g]], flat_b[first_b[g]:first_b[g] + size_b[g]])
            )
        names_a, names_b = flat_a.tolist(), flat_b.tolist()
        shown = [
            f"{names_a[i]}|{names_b[j]}" if m == 1 and n == 1
            else f"{','.join(map(str, names_a[i:i + m]))}|{','.join(map(str, names_b[j:j + n]))}"
            for i, m, j, n in zip(first_a.tolist(), size_a.tolist(), first_b.tolist(), size_b.tolist())
        ]

        def per_unit(x: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(x))[groups_to], prepend=0)

        counted = np.column_stack([per_unit(x) for x in (size_a, size_b, np.ones(len(common)), n_links)])
        counted = counted.astype(np.int64).tobytes()
        links_to = (8 * np.append(0, np.cumsum(held))[groups_to]).tolist()
        group_at = link_at = 0
        for k, (unit, group_to, link_to) in enumerate(zip(units, groups_to.tolist(), links_to)):
            self.young[unit] = (
                links[link_at:link_to], counted[32 * k:32 * k + 32],
                shown[group_at] if group_to == group_at + 1 else ";".join(shown[group_at:group_to]),
            )
            group_at, link_at = group_to, link_to
        for k, more in large.items():
            own, sizes, groups = self.young[units[k]]
            self.young[units[k]] = (own + b"".join(more), sizes, groups)
        return broken


def weighted(a: np.ndarray, b: np.ndarray) -> Iterator[bytes]:
    """The links of a large group: each id pair once, with its weight, or more often where that exceeds 32 bits."""
    own_a, times_a = np.unique(a, return_counts=True)
    own_b, times_b = np.unique(b, return_counts=True)
    for x, times in zip(own_a.tolist(), times_a.tolist()):
        pairs, rest = (x << 16 | own_b).astype(np.uint64), (times * times_b).astype(np.uint64)
        while rest.any():
            part = np.minimum(rest, np.uint64(0xFFFFFFFF))
            yield (part << np.uint64(32) | pairs)[part > 0].tobytes()
            rest = rest - part


#: One aligner for each pair of tokenizers that a worker has met.
_aligners: dict[str, Aligner] = {}


def aligner(definition: str, model: bytes) -> Aligner:
    key = hashlib.sha256(definition.encode() + model).hexdigest()
    if key not in _aligners:
        _aligners[key] = Aligner(definition, model)
    return _aligners[key]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame: their lengths and item sizes, then their bytes."""
    head = np.array([len(arrays), *itertools.chain(*[(len(x), x.itemsize) for x in arrays])], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *[x.tobytes() for x in arrays]]))


def unpacked(data: bytes) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    head = np.frombuffer(plain, np.int64, 1 + 2 * int(np.frombuffer(plain, np.int64, 1)[0]))
    at, arrays = head.nbytes, []
    for length, width in head[1:].reshape(-1, 2).tolist():
        arrays.append(np.frombuffer(plain, f"u{width}", length, at))
        at += length * width
    return arrays


class Spill:
    """Holds documents and their links until they are spilled as a run."""

    def __init__(self, radixes: int, digest: bool):
        self.radixes, self.digest = radixes, digest
        # Pairs are ordered by the radix of A's id, then by that id, then by B's.
        spread = (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        self.radix = (spread % np.uint64(radixes)).astype(np.int64)
        self.ids = np.lexsort((np.arange(1 << 16), self.radix))
        self.rank = np.empty(1 << 16, np.uint64)
        self.rank[self.ids] = np.arange(1 << 16, dtype=np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.links, self.sizes, self.groups, self.doc_ids, self.held = [], [], [], [], 0

    def add(self, doc_id: int | None, aligned: tuple | None) -> None:
        links, sizes, groups = aligned or (np.zeros(0, np.uint64), np.zeros(4, np.int64), "")
        self.links.append(links)
        self.sizes.append(sizes)
        self.groups.append(hashlib.sha256(groups.encode()).hexdigest() if groups and self.digest else groups)
        self.doc_ids.append(doc_id)
        self.held += len(links) + 10

    def run(self) -> Iterator[tuple[int, int, bytes]]:
        """(radix, kind, data) of what is held, which is then forgotten. Document numbers are those of the run."""
        table = pa.table({
            "doc_id": pa.array(self.doc_ids, pa.int64()), "groups": pa.array(self.groups, pa.large_string()),
            **{name: pa.array([int(s[k]) for s in self.sizes], pa.int64()) for k, (name, _) in enumerate(RESULT[1:5])},
        })
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        yield -1, DOCUMENTS, sink.getvalue().to_pybytes()
        documents = np.repeat(np.arange(len(self.links), dtype=np.uint64), [len(x) for x in self.links])
        links = np.concatenate(self.links)
        self._clear()
        if not len(links):
            return
        a, b = links >> np.uint64(16) & np.uint64(0xFFFF), links & np.uint64(0xFFFF)
        keys = (self.rank[a] << np.uint64(16) | b) << np.uint64(32) | documents
        order = np.argsort(keys)
        keys, weights = keys[order], (links >> np.uint64(32))[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, weights = keys[first], np.add.reduceat(weights, first)
        pairs = keys >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        counts = np.diff(np.append(starts, len(keys)))
        own = pairs[starts]
        radix = self.radix[self.ids[(own >> np.uint64(16)).astype(np.int64)]]
        cuts = np.flatnonzero(np.append(True, radix[1:] != radix[:-1]))
        for at, to in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)]):
            begin, end = int(starts[at]), int(starts[to]) if to < len(own) else len(keys)
            steps = np.diff(keys[begin:end] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0)).astype(np.int32)
            narrow = weights[begin:end]
            narrow = narrow.astype(np.uint16 if narrow.max() < 1 << 16 else np.uint64)
            shared = counts[at:to].astype(np.uint32)
            yield int(radix[at]), PAIRS, packed(own[at:to].astype(np.uint32), shared)
            yield int(radix[at]), RECORDS, packed(shared, steps.view(np.uint32), narrow)


def merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one radix with the sum of their counts, and whether that is the highest of their A id."""

    def entries(data: bytes) -> Iterator[int]:
        pairs, counts = unpacked(data)
        return iter((pairs.astype(np.uint64) << np.uint64(32) | counts).tolist())

    pairs, counts = [], []
    for pair, same in itertools.groupby(heapq.merge(*map(entries, runs)), key=lambda x: x >> 32):
        pairs.append(pair)
        counts.append(sum(x & 0xFFFFFFFF for x in same))
    pairs, counts = np.array(pairs, np.uint32), np.array(counts, np.uint64)
    side = pairs >> np.uint32(16)
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(side))))
    return pairs, counts, counts == highest


def align(documents: DataFrame, definition: str, model: bytes, digest: bool = True, radixes: int | None = None) -> DataFrame:
    """Align the tokens of every whole text of ``documents`` (doc_id, text; other columns are not read).

    One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their
    A id), count_sum (of all links), and groups_sha256, or with ``digest=False`` groups: ``a1,a2|b1;a3|b2``, the
    ids of each group in order. A null or empty text, and one whose tokens' bytes differ from a space and
    the text, has no tokens: zeros and an empty string. Repeated rows and rows without doc_id are documents
    of their own. ``radixes`` defaults to the number of shuffle partitions, 64 at least.
    """
    spark = documents.sparkSession
    radixes = radixes or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast((definition, model))  # two files of fixed size
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def batch_of(found: list[tuple[str, int, int, bytes]]) -> pa.RecordBatch:
        names, kinds = ["run", "radix", "kind", "data"], [pa.string(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], names)

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held = aligner(*shared.value), Spill(radixes, digest)
        gc.disable()  # many small objects and no cycles: counting references suffices

        def run() -> pa.RecordBatch:
            name = uuid.uuid4().hex
            return batch_of([(name, *x) for x in held.run()])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            while at < batch.num_rows:
                some, chars = [], 0
                while at + len(some) < batch.num_rows and chars < SLICE_CHARS:
                    some.append(texts[at + len(some)].as_py())
                    chars += len(some[-1])
                for doc_id, aligned in zip(ids[at:at + len(some)], encoder.aligned(some)):
                    held.add(doc_id, aligned)
                    if held.held >= RUN_RECORDS:
                        yield run()
                at += len(some)
        if held.doc_ids:
            yield run()
        gc.enable()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[batch.column(k).to_pylist() for k in range(4)]))
        for radix, group in itertools.groupby(rows, key=lambda r: r[1]):
            group = list(group)
            pairs, totals, best = merged([r[3] for r in group])
            sent = totals << np.uint64(1) | best
            for run, _, _, data in group:
                own = unpacked(data)[0]
                order = np.searchsorted(pairs, own)
                yield batch_of([(run, radix, TOTALS, packed(sent[order]))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sums = best = records = None

        def done() -> pa.RecordBatch:
            columns = [table.column(name) for name, _ in RESULT[:5]] + [pa.array(best), pa.array(sums), table.column("groups")]
            names = [name for name, _ in RESULT] + ["groups"]
            return pa.table(columns, names).cast(pa.schema([*RESULT, ("groups", pa.string())])).combine_chunks().to_batches()

        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
                if kind == DOCUMENTS:
                    if table is not None:
                        yield from done()
                    table = pa.ipc.open_stream(data).read_all()
                    sums, best = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
                elif kind == RECORDS:
                    records = unpacked(data)
                else:
                    shared_by, steps, weights = records
                    places = np.cumsum(steps.view(np.int32), dtype=np.int64)
                    totals = np.repeat(unpacked(data)[0], shared_by)
                    weights = weights.astype(np.int64)
                    np.add.at(sums, places, weights * (totals >> np.uint64(1)).astype(np.int64))
                    np.add.at(best, places, weights * (totals & np.uint64(1)).astype(np.int64))
        if table is not None:
            yield from done()

    runs = settle(rows.mapInArrow(spill, RUN))
    pairs = runs.where(F.col("kind") == PAIRS).repartition("radix").sortWithinPartitions("radix", "run")
    totals = pairs.mapInArrow(count, RUN)
    back = runs.where(F.col("kind") != PAIRS).unionByName(totals)
    back = back.repartition("run").sortWithinPartitions("run", "radix", "kind").select("kind", "data")
    schema = ", ".join([*[f"{name} long" for name, _ in RESULT], "groups string"])
    return back.mapInArrow(finish, schema).withColumnRenamed("groups", "groups_sha256" if digest else "groups")
