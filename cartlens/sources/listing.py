"""What files a table has now, without reading them."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, paths: Sequence[str], glob: str = "*") -> DataFrame:
    """``path, length, modified`` of all files below ``paths``; a path may be a
    file.  The contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(list(paths))
            .select("path", "length", F.col("modificationTime").alias("modified")))


def fingerprint(spark: SparkSession, paths: Sequence[str], glob: str = "*.parquet") -> str:
    """A text that changes with the files' names, lengths or times.

    Paths that are files are looked up one by one on the driver; directories
    are listed and summed up by Spark."""
    files, folders = [], []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        status = at.getFileSystem(conf).getFileStatus(at)
        if status.isFile():
            files.append((path, status.getLen(), status.getModificationTime()))
        else:
            folders.append(path)
    summary: tuple = tuple(sorted(files))
    if folders:
        summary += tuple(listing(spark, folders, glob).agg(
            F.count(F.lit(1)), F.sum("length"), F.max("modified").cast("string"),
            F.bit_xor(F.xxhash64("path", "length", "modified"))).first())
    return hashlib.sha256(repr(summary).encode()).hexdigest()
