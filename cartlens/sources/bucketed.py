"""Tables kept in buckets of a join key: what is joined or grouped on it again
and again is shuffled once, when it is written.

A table written with ``write_bucketed`` has one file per bucket, sorted by the
key.  Two such tables with the same number of buckets are joined on the key, and
one is grouped by it, without an exchange; a sort-merge join needs no sort.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cartlens.session import scratch_path


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str,
                   path: str | None = None) -> str:
    """Write ``df`` as a table of the session's catalog with ``buckets`` files and
    return the table's name, a new one that begins with ``name``.  Tables to be
    joined need the same ``buckets``; choose it so that a bucket of the larger
    one fits a task (some 200 MB).  ``path`` is a new scratch folder if not given."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    # Dealt by the same hash as the buckets are: one file per bucket.
    (df.repartition(int(buckets), *keys).write.format("parquet")
     .option("path", path or scratch_path(df.sparkSession, name))
     .bucketBy(int(buckets), *keys).sortBy(*keys).saveAsTable(table))
    return table


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
