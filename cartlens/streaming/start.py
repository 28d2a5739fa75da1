"""A start position for file sources: ``latest`` skips what is there already.

At the first start the files present are written to a table beside the
checkpoint; every later start reads that table, so a restart goes on from the
same position.  A row of the stream is kept if its file is younger than all of
these, or as old as the youngest and not among them.  The first test is on file
metadata alone, so older files are left out before they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.sources.listing import listing
from cartlens.streaming.baskets import read_messages

START = "path string, modified timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def start_table(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """``path, modified`` of the youngest files below ``path`` when the stream of
    ``checkpoint`` was first started."""
    where = f"{checkpoint.rstrip('/')}-start"
    if not _exists(spark, where):
        present = listing(spark, [path]).select("path", "modified")
        youngest = present.agg(F.max("modified").alias("modified"))
        present.join(youngest, "modified").select("path", "modified").coalesce(1).write.mode(
            "overwrite").parquet(where)
    return spark.read.schema(START).parquet(where)


def read_latest(spark: SparkSession, path: str, checkpoint: str,
                max_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` rows of the files that come after the first start."""
    start = start_table(spark, path, checkpoint)
    youngest = start.agg(F.max("modified")).first()[0]
    rows = read_messages(spark, "text", path=path, max_per_trigger=max_per_trigger)
    if youngest is None:
        return rows
    old = start.select(F.col("path").alias("_old"))
    rows = rows.select("value", F.col("_metadata.file_path").alias("_path"),
                       F.col("_metadata.file_modification_time").alias("_modified"))
    # Listings and metadata may spell one path differently: compare what follows
    # the scheme's slashes.
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return (rows.where(F.col("_modified") >= F.lit(youngest))
            .join(old, plain(F.col("_path")) == plain(F.col("_old")), "left_anti").select("value"))
