"""Token ids in Arrow files of equal-length sequences.

Documents are sorted into ranges of ascending doc_id, or of another order. Each task encodes one range into one stream of
ids, cuts it into sequences of ``seq_len`` and writes them as an Arrow file: batches of ``BATCH_ROWS``
sequences in two fixed-size-list columns, ``ids`` and ``mask`` (false only on the padding behind the
last id). Batches are uncompressed and of equal length, so sequence i is row ``i mod BATCH_ROWS`` of
batch ``i div BATCH_ROWS``, and a memory-mapped file gives it without a copy. Beside it lies an Arrow
file with doc_id, start and n_tokens of each document. File names are unique for each attempt; the
manifest, a Parquet table, names those of the attempts that counted, so a task that runs twice does
no harm.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.llm.encoding import encoder as remembered

SEQ_LEN = 2048
BATCH_ROWS = 256
END_ID = 2
MANIFEST = "part int, file string, docs long, tokens long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach."""
    folder = re.sub(r"^file:/+", "/", folder)
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


class SequenceWriter:
    """Writes one part: ids in, full batches of sequences out."""

    def __init__(self, folder: str, name: str, kind: type, seq_len: int):
        self.system, path = opened(folder)
        self.seq_len, self.kind = seq_len, kind
        self.system.create_dir(path, recursive=True)
        value = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(value, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.sinks = [self.system.open_output_stream(f"{path}/{name}{end}") for end in (".arrow", ".docs.arrow")]
        self.sequences = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], INDEX)
        self.waiting: list[np.ndarray] = []
        self.held = self.docs = self.tokens = 0

    def add(self, doc_ids: pa.Array, documents: list[np.ndarray]) -> None:
        lengths = np.array([len(x) for x in documents], np.int64)
        starts = self.tokens + np.cumsum(lengths) - lengths
        self.index.write_batch(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(lengths)], INDEX))
        self.docs += len(documents)
        self.tokens += int(lengths.sum())
        self.waiting += documents
        self.held += int(lengths.sum())
        full = self.seq_len * BATCH_ROWS
        if self.held >= full:
            ids = np.concatenate(self.waiting)
            for at in range(0, len(ids) - full + 1, full):
                self._write(ids[at:at + full], full)
            rest = ids[len(ids) // full * full:]
            self.waiting, self.held = [rest], len(rest)

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len)
            for x in (np.ascontiguousarray(ids, self.kind), mask)
        ]
        self.sequences.write_batch(pa.record_batch(columns, self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(ids) // self.seq_len) * self.seq_len, self.kind)
            padded[:len(ids)] = ids
            self._write(padded, len(ids))
        for closing in (self.sequences, self.index, *self.sinks):
            closing.close()


class SequenceReader:
    """Random access to a part. On a local or mounted file system the views share the file's memory."""

    def __init__(self, folder: str, name: str):
        system, path = opened(folder)
        def open_one(end: str) -> pa.NativeFile:
            if isinstance(system, fs.LocalFileSystem):
                return pa.memory_map(f"{path}/{name}{end}")
            return system.open_input_file(f"{path}/{name}{end}")

        self.file = pa.ipc.open_file(open_one(".arrow"))
        self.index = pa.ipc.open_file(open_one(".docs.arrow"))
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def _ids(self, number: int) -> np.ndarray:
        if number != self.at:
            self.at, self.batch = number, self.file.get_batch(number)
        return self.batch.column(0).values.to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``i``."""
        batch, row = divmod(i, BATCH_ROWS)
        ids = self._ids(batch)[row * self.seq_len:(row + 1) * self.seq_len]
        return ids, self.batch.column(1).values.slice(row * self.seq_len, self.seq_len)

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of the batches they lie in."""
        full = self.seq_len * BATCH_ROWS
        while count > 0:
            batch, at = divmod(start, full)
            view = self._ids(batch)[at:at + count]
            yield view
            start, count = start + len(view), count - len(view)

    def documents(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.index.num_record_batches):
            yield self.index.get_batch(k)


def write(
    documents: DataFrame, definition: str, folder: str, seq_len: int = SEQ_LEN, end_id: int = END_ID,
    order: list[Column] | None = None,
) -> DataFrame:
    """Write the ids of ``documents`` (doc_id, text; others are not read) below ``folder``, a new
    folder that all executors reach; return the manifest.

    ``definition`` is the content of a tokenizers file. A null text is an empty one, whose only id
    is the end id. Ties of doc_id are ordered by a hash of the text; null doc_ids come first. With
    ``order``, columns of ``documents`` to sort by instead, the files follow that. An empty table
    gives no files.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(definition)  # one file of fixed size
    text = F.coalesce("text", F.lit("")).alias("text")
    given = [c.alias(f"order{k}") for k, c in enumerate(order or [])]
    by = [F.col(f"order{k}") for k in range(len(given))] or [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text, *given)
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = encoder = name = part = None
        for batch in batches:
            if batch.num_rows and writer is None:
                part = batch.column("part")[0].as_py()
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                encoder = remembered(shared.value, end_id)
                writer = SequenceWriter(folder, name, encoder.kind, seq_len)
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                writer.add(some.column("doc_id"), encoder.encode(some.column("text")))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([writer.docs]), pa.array([writer.tokens])],
                ["part", "file", "docs", "tokens"],
            )

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, read back from the files below ``folder``: doc_id, start (ids of all
    documents before it), n_tokens (with the end id), ids_crc32 (of the ids as little-endian unsigned
    32-bit integers)."""
    parts, start = [], 0
    for row in sorted(spark.read.parquet(f"{folder}/manifest").collect()):  # one row for each file
        parts.append((row["file"], start))
        start += row["tokens"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not parts:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                reader = SequenceReader(folder, part["file"])
                for docs in reader.documents():
                    sums = []
                    for begin, count in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                        crc = 0
                        for view in reader.tokens(begin, count):
                            crc = zlib.crc32(view.astype("<u4"), crc)
                        sums.append(crc)
                    starts = pa.array(docs.column("start").to_numpy() + part["start"])
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), starts, docs.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    listed = spark.createDataFrame(parts, "file string, start long").repartition(len(parts))
    return listed.mapInArrow(run, schema)
