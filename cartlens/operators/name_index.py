"""A persisted inverted index for the search in product names.

Distinct names are numbered and cut into trigrams of their folded form.  The
postings (trigram, name) are written in folders by a hash of the trigram, sorted
within, so a search reads the folders and row groups of its own trigrams only.
A pattern's trigrams are those of the letters it must contain; a name has to
have all of them, and the pattern itself then decides.  A pattern from which no
trigram follows is tested on every name.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.codec import _col
from cartlens.operators.report import ranked
from cartlens.operators.serving import name_matches
from cartlens.session import scratch_path

#: Folders of postings.
FOLDERS = 64
NAMES = "id long, name string"
POSTINGS = "gram string, id long, folder int"


@dataclass(frozen=True)
class NameIndex:
    path: str

    def names(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(NAMES).parquet(f"{self.path}/names")

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(POSTINGS).parquet(f"{self.path}/postings")


def folded(text: str | Column) -> Column:
    """A form that all spellings share which a case-insensitive pattern takes for
    the same: each letter's capital in lower case, without the special cases of
    whole words (final sigma, the dot that a capital İ leaves)."""
    dot = F.lit("\u0307")
    # The replacement in between keeps the optimizer from dropping the capitals.
    low = F.lower(F.replace(F.upper(_col(text)), dot, F.lit("")))
    return F.replace(F.replace(low, F.lit("ς"), F.lit("σ")), dot, F.lit(""))


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text, none if it is shorter."""
    n = F.length(text)
    return F.when(n >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), n - 2), lambda i: F.substring(text, i, F.lit(3))))).otherwise(
        F.array().cast("array<string>"))


def _folder(gram: Column) -> Column:
    return (F.crc32(gram.cast("binary")) % FOLDERS).cast("int")


def build_index(rules: DataFrame, col: str = "antecedent_product_names",
                path: str | None = None) -> NameIndex:
    """Write the index of the distinct names in ``col`` and return it."""
    spark = rules.sparkSession
    path = path or scratch_path(spark, "name-index")
    names = (rules.select(F.col(col).alias("name")).where("name IS NOT NULL").distinct()
             .select(F.monotonically_increasing_id().alias("id"), "name"))
    names.write.parquet(f"{path}/names")
    index = NameIndex(path)
    # The name's length bounds its postings; the folded text is made once.
    grams = (index.names(spark).select("id", folded("name").alias("f"))
             .select("id", F.explode(trigrams(F.col("f"))).alias("gram"))
             .withColumn("folder", _folder(F.col("gram"))))
    (grams.repartitionByRange("folder", "gram", "id").sortWithinPartitions("folder", "gram", "id")
     .write.partitionBy("folder").parquet(f"{path}/postings"))
    return index


def required_runs(pattern: str, regex: bool = True) -> list[str]:
    """Runs of letters that every text the pattern matches must contain.

    Of an expression with alternatives, groups or flags none is taken; a letter
    that may be left out or a class of letters ends a run."""
    if not regex:
        return [pattern]
    if re.search(r"[|()]|\\Q|\(\?", pattern):
        return []
    runs, run, k = [], "", 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            follow = pattern[k + 1:k + 2]
            if follow and not follow.isalnum():
                run += follow
            else:               # a class, an anchor or a code
                return runs + [run]
            k += 2
            continue
        if c in "?*{":          # the last letter may be missing or repeated
            runs.append(run[:-1])
            run = ""
            if c == "{":
                k = pattern.find("}", k)
                if k < 0:
                    return []
        elif c == "+":
            runs.append(run)
            run = run[-1:]
        elif c == "[":
            end = pattern.find("]", k + 2)
            if end < 0 or "[" in pattern[k + 1:end] or "&&" in pattern[k:end]:
                return runs + [run]
            runs.append(run)
            run, k = "", end
        elif c in ".^$":
            runs.append(run)
            run = ""
        else:
            run += c
        k += 1
    return [*runs, run]


def matching_names(spark: SparkSession, index: NameIndex, text: str,
                   regex: bool = True) -> DataFrame:
    """The distinct names that the pattern matches."""
    grams = _grams_of(spark, required_runs(text, regex))
    names = index.names(spark)
    if grams:
        folders = sorted({zlib.crc32(g.encode()) % FOLDERS for g in grams})
        hits = (index.postings(spark)
                .where(F.col("folder").isin(folders) & F.col("gram").isin(grams))
                .groupBy("id").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") == len(grams)).select("id"))
        names = names.join(hits, "id", "left_semi")
    return names.where(name_matches("name", text, regex)).select("name")


def _grams_of(spark: SparkSession, runs: list[str]) -> list[str]:
    """The trigrams of a pattern's runs, folded as the names are."""
    if not runs:
        return []
    rows = spark.createDataFrame([(r,) for r in runs], "r string")
    grams = rows.select(F.explode(trigrams(folded("r"))).alias("g")).distinct().collect()
    return sorted(r["g"] for r in grams)


def search_indexed(rules: DataFrame, index: NameIndex, text: str, regex: bool = True,
                   col: str = "antecedent_product_names") -> DataFrame:
    """``serving.search_rules`` by way of the index: the same rules, ranked alike."""
    found = matching_names(rules.sparkSession, index, text, regex)
    hits = rules.join(found.withColumnRenamed("name", col), col, "left_semi")
    return ranked(hits.select(*rules.columns), [F.desc("lift"), F.desc("confidence")])
