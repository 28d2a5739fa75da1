"""Token ids in Arrow stream files of equal-length sequences.

A set of files holds the ids of all documents in ascending id order.  Each
part is a pair of Arrow streams:

* ``ids-*.arrows``: batches of ``ROWS`` rows with two fixed-size lists,
  ``ids`` and ``mask`` (false at padding, which only the part's last sequence
  has).  No buffer is compressed, so all full batches are equally long and
  sequence k of a mapped file is found by arithmetic, without a copy;
* ``docs-*.arrows``: each document's id, its start among the part's ids and
  its number of ids.

Executors write the parts to the shared folder under names that no other
attempt uses; the manifest, a Parquet table that Spark commits, names the parts
that count.  A repeated or lost task leaves at most a part nobody names.

Cases: a null text is an empty one (its only id is the end id).  Null ids come
first, in the place of a smallest id.  Rows with the same id follow each other
in the order of their texts' hashes; equal rows are interchangeable.  An empty
table gives an empty manifest and an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlens.llm.common import id_and_text, local_uri, ready, saved
from cartlens.llm.tokens import encoder, tokenizer_path
from cartlens.session import scratch_path

SEQUENCE_LENGTH = 1024
ROWS = 256
MANIFEST = ("file_no int, folder string, ids_file string, docs_file string, n_docs long, "
            "n_tokens long, n_sequences long")
RESULT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids_crc32", pa.int64())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(width: int, length: int) -> pa.Schema:
    kind = pa.uint16() if width == 2 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, False), length), False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length),
                               False)])


class PartWriter:
    """Writes one part: ``add`` documents in order, then ``close``."""

    def __init__(self, fs: pafs.FileSystem, folder: str, name: str, width: int,
                 length: int = SEQUENCE_LENGTH, rows: int = ROWS, pad_id: int = 0) -> None:
        self.length, self.rows, self.pad_id = length, rows, pad_id
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.schema = sequence_schema(width, length)
        self.ids_sink = fs.open_output_stream(f"{folder}/ids-{name}.arrows")
        self.ids = pa.ipc.new_stream(self.ids_sink, self.schema)
        self.docs_sink = fs.open_output_stream(f"{folder}/docs-{name}.arrows")
        self.docs = pa.ipc.new_stream(self.docs_sink, _DOCS)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = self.n_sequences = 0
        self.batch_ids = rows * length

    def add(self, doc_ids: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Documents with their ids in one array, and the number of each."""
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch(
            [doc_ids.cast(pa.int64()), pa.array(starts), pa.array(sizes)], schema=_DOCS))
        self.n_tokens += len(flat)
        self.n_docs += len(doc_ids)
        self.held.append(flat)
        self.n_held += len(flat)
        if self.n_held >= self.batch_ids:
            whole = np.concatenate(self.held)
            cut = len(whole) - len(whole) % self.batch_ids
            for k in range(0, cut, self.batch_ids):
                self._write(whole[k:k + self.batch_ids], None)
            self.held, self.n_held = [whole[cut:].copy()], len(whole) - cut

    def _write(self, flat: np.ndarray, mask: np.ndarray | None) -> None:
        mask = np.ones(len(flat), bool) if mask is None else mask
        n = len(flat) // self.length
        self.ids.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat), type=self.schema[0].type),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema[1].type)],
            schema=self.schema))
        self.n_sequences += n

    def close(self) -> None:
        flat = np.concatenate([np.zeros(0, self.dtype), *self.held])
        if len(flat):
            n = -(-len(flat) // self.length) * self.length
            full = np.full(n, self.pad_id, self.dtype)
            full[:len(flat)] = flat
            self._write(full, np.arange(n) < len(flat))
        for out in (self.ids, self.ids_sink, self.docs, self.docs_sink):
            out.close()


class SequenceFile:
    """Random access to one ids file: ``ids(k)`` and ``mask(k)`` of sequence k.

    The ids are a view of the mapped file; masks are stored as bits, so theirs
    is unpacked from such a view."""

    def __init__(self, path: str) -> None:
        self.source = pa.memory_map(path)
        reader = pa.ipc.open_stream(self.source)
        self.schema, self.begin = reader.schema, self.source.tell()
        self.length = self.schema.field("ids").type.list_size
        first = pa.ipc.read_message(self.source)
        self.step = self.source.tell() - self.begin
        self.rows = pa.ipc.read_record_batch(first, self.schema).num_rows

    def _batch(self, k: int) -> pa.RecordBatch:
        self.source.seek(self.begin + k // self.rows * self.step)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def ids(self, k: int) -> np.ndarray:
        values = self._batch(k).column("ids").values
        return values.to_numpy(zero_copy_only=True)[k % self.rows * self.length:][:self.length]

    def mask(self, k: int) -> np.ndarray:
        values = self._batch(k).column("mask").values
        at = k % self.rows * self.length
        return values.slice(at, self.length).to_numpy(zero_copy_only=False)


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                      end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                      length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Encode every text, append ``end_id``, write the parts and return the
    manifest (``MANIFEST``), already written as a table.

    Rows are dealt by ranges of (id, text hash, row), so that an id that holds
    a third of the rows still spreads over many parts."""
    spark = docs.sparkSession
    ready(spark)
    path = tokenizer_path(tokenizer)
    folder = (folder or scratch_path(spark, "token-files")).rstrip("/")
    keys = ["doc_id", "_h", "_row"]
    dealt = (id_and_text(docs, id_col, text_col)
             .withColumn("_h", F.xxhash64("text"))
             .withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
             .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
             .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(path), None
        fs, where = pafs.FileSystem.from_uri(local_uri(folder))
        number = TaskContext.get().partitionId()
        name = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        end = int(end_id).to_bytes(enc.width, "little")
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(where, recursive=True)
                out = PartWriter(fs, where, name, enc.width, length)
            out.add(batch.column(0), *enc.encode_column(batch.column(1), end))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([number], pa.int32()), "folder": [folder],
                "ids_file": [f"ids-{name}.arrows"], "docs_file": [f"docs-{name}.arrows"],
                "n_docs": [out.n_docs], "n_tokens": [out.n_tokens],
                "n_sequences": [out.n_sequences]})

    return saved(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all earlier documents.  The manifest has one
    row per part; each part is read by one task, batch after batch."""
    ready(spark)
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_part(row)

    return parts.repartition(n).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_part(row: dict) -> Iterator[pa.RecordBatch]:
    fs, where = pafs.FileSystem.from_uri(local_uri(row["folder"]))
    with fs.open_input_file(f"{where}/{row['docs_file']}") as docs_source, \
            fs.open_input_file(f"{where}/{row['ids_file']}") as ids_source:
        sequences = iter(pa.ipc.open_stream(ids_source))
        held, left = np.zeros(0, "<u4"), None
        for docs in pa.ipc.open_stream(docs_source):
            sizes = docs.column("n_tokens").to_numpy()
            need, got = int(sizes.sum()), [held]
            have = len(held)
            while have < need:
                left = next(sequences)
                ids = left.column("ids").values.to_numpy(zero_copy_only=True)
                mask = left.column("mask").values.to_numpy(zero_copy_only=False)
                got.append((ids if mask.all() else ids[mask]).astype("<u4"))
                have += len(got[-1])
            flat = np.concatenate(got)
            held = flat[need:].copy()
            raw, ends = memoryview(flat[:need]).cast("B"), np.cumsum(sizes) * 4
            crcs = [zlib.crc32(raw[e - 4 * n:e]) for e, n in zip(ends.tolist(), sizes.tolist(),
                                                                  strict=True)]
            starts = docs.column("start").to_numpy() + row["base"]
            yield pa.RecordBatch.from_arrays(
                [docs.column("doc_id"), pa.array(starts), pa.array(sizes),
                 pa.array(crcs, pa.int64())], schema=RESULT)


def op1_token_files(docs: DataFrame) -> DataFrame:
    return read_token_files(docs.sparkSession, write_token_files(docs))
