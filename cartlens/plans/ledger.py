"""A ledger of finished stages: a rerun goes on behind the last written one.

A stage is named, and its key is a hash of its parameters and of the listing of
the files it reads.  When it has written its output, one row (stage, key, result
as JSON) is added to the ledger; a run that asks for the same stage with the same
key gets that result and does nothing.  Changed files or parameters are another
key.  A stage that died has no row and is done again, into a folder of its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.sources.listing import fingerprint

LEDGER = "stage string, key string, result string, at timestamp"


class StageLedger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def run(self, stage: str, key: str, make: Callable[[], dict]) -> dict:
        """What the stage gave before under ``key``, or gives now."""
        done = (self.rows().where((F.col("stage") == stage) & (F.col("key") == key))
                .orderBy("at").limit(1).collect())
        if done:
            return json.loads(done[0]["result"])
        result = make()
        (self.spark.createDataFrame([(stage, key, json.dumps(result))],
                                    "stage string, key string, result string")
         .withColumn("at", F.current_timestamp()).coalesce(1)
         .write.mode("append").parquet(self.path))
        return result


def stage_key(spark: SparkSession, inputs: Sequence[DataFrame | str], params: dict) -> str:
    """A hash of the parameters and of the listing of all files the inputs read
    (tables, or paths of tables)."""
    files = sorted({f for i in inputs for f in ([i] if isinstance(i, str) else i.inputFiles())})
    listed = fingerprint(spark, files) if files else ""
    return hashlib.sha256(json.dumps([listed, params], sort_keys=True).encode()).hexdigest()
