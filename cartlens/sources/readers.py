"""Batch sources with declared schemas (no inference job, no ANSI surprises)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cartlens.defaults import CSV_NULL
from cartlens.schemas import NAMED_RULE, PRODUCT_TEXT


def _csv_reader(spark: SparkSession, header: bool, multi_line: bool, options: dict[str, str]):
    reader = (spark.read.option("header", header).option("nullValue", CSV_NULL)
              .option("multiLine", multi_line))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader


def _plain_text(c: Column) -> Column:
    """Undo what ``write_csv`` does to texts that look like the null mark."""
    return F.when(c.rlike(r"^\\\\+N$"), F.substring(c, 2, 1 << 30)).otherwise(c)


def unescape_breaks(text: Column) -> Column:
    """Undo ``writers.escape_breaks``: between doubled backslashes a single one
    only stands before n or r."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(F.replace(
        x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             multi_line: bool = False, **options: str) -> DataFrame:
    """CSV scan with an explicit schema (columns by position, the header
    checked against it); only the columns later selected are parsed.
    ``multi_line`` lets a text hold line breaks; files are then not split, so
    it is for small tables."""
    raw = (_csv_reader(spark, header, multi_line, options)
           .option("enforceSchema", False).schema(schema).csv(path))
    return raw.select(*[_plain_text(F.col(f.name)).alias(f.name)
                        if isinstance(f.dataType, StringType) else F.col(f.name)
                        for f in schema.fields])


def read_csv_columns(spark: SparkSession, path: str, columns: StructType,
                     allow_missing: bool = False, multi_line: bool = False,
                     one_line: bool = False, **options: str) -> DataFrame:
    """CSV with header, columns picked by header name (any order, extra
    columns ignored) and converted with ``try_cast``.  Every field is read
    as text, so there is no inference pass, and a bad value becomes null.
    ``allow_missing`` turns a column absent from the header into nulls.  Files
    written with ``one_line`` are read with it: they are split among tasks,
    however large, and their line breaks come back."""
    if one_line:
        options = {"escape": '"', **options}
    decode = unescape_breaks if one_line else _plain_text
    raw = _csv_reader(spark, True, multi_line and not one_line, options).csv(path)
    present = set(raw.columns)
    out = []
    for f in columns.fields:
        if f.name in present:
            out.append(decode(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name))
        elif allow_missing:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"{path}: no column {f.name!r} in header {raw.columns}")
    return raw.select(*out)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A small in-memory table (smoke checks, fixtures)."""
    return spark.createDataFrame(list(rows), schema)


def products_from_text(df: DataFrame, id_col: str = "product_id",
                       name_col: str = "product_name", id_type: str = "bigint",
                       observation: Observation | None = None) -> DataFrame:
    """Two-column product dimension with the id converted by ``try_cast``: an
    id that is not a number becomes null instead of failing the job.  Such
    ids are counted as ``rejected_ids`` in ``observation``."""
    product_id = F.col(id_col).try_cast(id_type)
    if observation is not None:
        df = df.observe(observation, F.count_if(
            F.col(id_col).isNotNull() & product_id.isNull()).alias("rejected_ids"))
    return df.select(product_id.alias("product_id"),
                     F.col(name_col).cast("string").alias("product_name"))


def read_products_csv(spark: SparkSession, path: str, id_type: str = "bigint",
                      observation: Observation | None = None,
                      one_line: bool = False) -> DataFrame:
    """Product dimension from CSV with header; ``product_id`` and
    ``product_name`` are picked by name, other columns are ignored.  Files of
    other tools may have quoted line breaks, which forbid splitting; those
    written with ``one_line`` are split."""
    return products_from_text(read_csv_columns(spark, path, PRODUCT_TEXT, multi_line=True,
                                               one_line=one_line),
                              id_type=id_type, observation=observation)


def read_named_rules_csv(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """Named rules from CSV, columns by header name; a file without
    ``support`` (six-column exports) gives null support.  An empty name that
    was written by ``write_csv`` stays empty; a field left out is null."""
    return read_csv_columns(spark, path, NAMED_RULE, allow_missing=True, multi_line=True,
                            one_line=one_line)
