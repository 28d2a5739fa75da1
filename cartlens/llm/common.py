"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cartlens
from cartlens.session import scratch_path

#: Rows and bytes that one Arrow batch may hold on its way to a Python worker.
#: A batch is cut at whichever bound is met first, so a run of very long texts
#: does not fill a worker's memory.
BATCH_ROWS = 4096
BATCH_BYTES = 16 << 20

#: A word: a run of characters other than space, tab, line feed, vertical tab,
#: form feed and carriage return.  ``bytes.split()`` splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()

#: What a Python worker keeps from task to task: owner -> the dictionary.
_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """The worker's dictionary of ``owner``.  Workers live on after an operator's
    tasks; whoever asks next empties all others' dictionaries, so a worker holds
    the memo of one operator at a time."""
    others = [held for name, held in _KEPT.items() if name != owner and held]
    for held in others:
        held.clear()
    if others:
        given_back()
    return _KEPT.setdefault(owner, {})


def given_back() -> None:
    """Return memory that the worker has freed to the system.  An allocator keeps it
    otherwise, some hundred MB a worker, idle ones too, and an executor's memory is
    that of its JVM and all its workers.  Arrow's allocations go to the system's
    allocator first, which NumPy and Python use as well: so one call does for all."""
    pool = pa.system_memory_pool()
    pa.set_memory_pool(pool)
    pool.release_unused()


def light(run):
    """A ``mapInArrow`` function that gives freed memory back before each batch and
    at its end."""
    def batch_by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            given_back()

    def lightly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given_back()
        yield from run(batch_by_batch(batches))
        given_back()

    return lightly


def ready(spark: SparkSession) -> None:
    """Bound Arrow batches and send this package to the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(cartlens.__file__))
    if os.path.isdir(root):          # a zip or egg on the path is already shipped
        target = os.path.join(tempfile.mkdtemp(prefix="cartlens-code-"), "cartlens-code.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for top, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(top, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (bigint) and ``text``, under these names: other columns,
    whatever they are called, never reach an operator's own columns."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


#: Spark removes a query's shuffle files when it ends, not when the driver
#: happens to collect garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run in here go when each ends."""
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the checkpoint root and read it back: lineage ends at
    files that every executor can read again, and the step's shuffle files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batches(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[f.name], type=f.type) for f in schema], schema=schema)


def local_uri(path: str) -> str:
    """``file:/x`` and ``/x`` in the form that pyarrow's file systems accept."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return path if "://" in path else "file://" + path


def pieces(items: list, size: int) -> Iterator[list]:
    for k in range(0, len(items), size):
        yield items[k:k + size]
