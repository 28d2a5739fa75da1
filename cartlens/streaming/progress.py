"""What each micro-batch of a stream did, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Batches whose progress Spark keeps for a query.
KEPT_BATCHES = 100_000
_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
PROGRESS = ("query string, batch_id long, input_rows long, at string, "
            "observed map<string, map<string, long>>, durations map<string, long>")


def keep_progress(spark: SparkSession, batches: int = KEPT_BATCHES) -> None:
    """Call before a query starts: Spark otherwise keeps 100 batches only."""
    spark.conf.set(_KEPT, str(int(batches)))


def progress_table(query: StreamingQuery) -> DataFrame:
    """One row per batch of this run of the query that read rows: ``query,
    batch_id, input_rows, at`` (its start), the counts ``observed`` in it, by the
    name given to ``observe``, and ``durations`` in milliseconds by step.

    The numbers come from the query itself; nothing is read again.  If Spark
    has dropped the run's first batches, that is an error."""
    spark = SparkSession.active()
    updates = query.recentProgress
    if len(updates) >= int(spark.conf.get(_KEPT, "100")):
        raise RuntimeError("the first batches are no longer known: call keep_progress earlier")
    rows = {p.batchId: (p.name or str(p.id), p.batchId, p.numInputRows, p.timestamp,
                        {name: {k: int(v) for k, v in counts.asDict().items()}
                         for name, counts in p.observedMetrics.items()},
                        {k: int(v) for k, v in p.durationMs.items()})
            for p in updates if p.numInputRows}
    table = spark.createDataFrame(list(rows.values()), PROGRESS)
    return table.withColumn("at", F.to_timestamp("at"))
