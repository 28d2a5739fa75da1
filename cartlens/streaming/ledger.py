"""A file sink that applies each micro-batch once, with a ledger of its own.

``foreachBatch`` may hand a batch over again: after a crash between the write
and the checkpoint's commit the same batch id comes back.  Here a batch is
written to a folder of its own, named by the batch and the attempt, and then one
row (batch, attempt, rows) goes to the ledger.  A batch that the ledger has is
not written again; an attempt that it has not does not count.  So readers of
``committed`` see every batch once, whatever crashed, and the target needs no
commit log of Spark's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

LEDGER = "batch_id long, attempt string, n_rows long"


def _ledger(spark: SparkSession, target: str) -> DataFrame:
    """The batches that count.  Were a batch in the ledger twice (two runs of a
    query at once), the first attempt by name would count."""
    rows = spark.read.schema(LEDGER).parquet(f"{target}/ledger")
    return rows.groupBy("batch_id").agg(F.min_by(F.struct("attempt", "n_rows"), "attempt").alias("a")
                                        ).select("batch_id", "a.*")


def prepare(spark: SparkSession, target: str) -> None:
    """Make an empty ledger where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{target}/ledger")


def apply_batch(batch: DataFrame, batch_id: int, target: str,
                before_ledger: Callable[[int], None] | None = None) -> bool:
    """Write one batch unless the ledger has it; whether it was written.
    ``before_ledger`` is called between the write and the ledger (tests crash
    there)."""
    spark = batch.sparkSession
    if not _ledger(spark, target).where(F.col("batch_id") == int(batch_id)).isEmpty():
        return False
    attempt, seen = uuid.uuid4().hex, Observation()
    (batch.observe(seen, F.count(F.lit(1)).alias("n"))
     .write.parquet(f"{target}/data/batch_id={int(batch_id)}/attempt={attempt}"))
    if before_ledger:
        before_ledger(int(batch_id))
    (spark.createDataFrame([(int(batch_id), attempt, int(seen.get["n"]))], LEDGER).coalesce(1)
     .write.mode("append").parquet(f"{target}/ledger"))
    return True


def start_ledger_sink(df: DataFrame, target: str, checkpoint: str, available_now: bool = False,
                      query_name: str | None = None,
                      before_ledger: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start a streaming write of ``df`` to ``target``, each batch once."""
    prepare(df.sparkSession, target)
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, target, before_ledger) and None)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def committed(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The rows of the batches in the ledger, with the columns of ``like``."""
    ledger = _ledger(spark, target)
    if ledger.isEmpty():
        return spark.createDataFrame([], like.schema)
    schema = StructType([*like.schema.fields, StructField("batch_id", LongType()),
                         StructField("attempt", StringType())])
    data = spark.read.schema(schema).parquet(f"{target}/data")
    return data.join(ledger.select("batch_id", "attempt"), ["batch_id", "attempt"],
                     "left_semi").select(*like.columns)
