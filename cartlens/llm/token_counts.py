"""Exact histogram of encoded lengths, and what suffix sums say of it.

Each task counts its documents per encoded length, so the shuffle carries one
row per task and length.  Suffix sums over the histogram answer, for every
context limit L, how many documents reach L and how many tokens are left if
each document is cut at L.  The sums are taken in two steps, within blocks of
``BLOCK`` lengths and over the blocks' totals, so no task sees more than
``BLOCK`` rows or one row per block.

Cases: null and empty texts count as length 0.  Repeated rows count each.  An
empty table gives an empty histogram.  Ids play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import ready, saved
from cartlens.llm.tokens import encoder, tokenizer_path

BLOCK = 256


def length_histogram(docs: DataFrame, tokenizer: str | None = None, extra: int = 0,
                     text_col: str = "text") -> DataFrame:
    """``n_tokens, n_docs`` for each encoded length (``extra`` ids added)."""
    ready(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, found = encoder(path), Counter()
        for batch in batches:
            found.update((enc.count_column(batch.column(0)) + extra).tolist())
        if found:
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(found.keys(), pa.int64()),
                                              "n_docs": pa.array(found.values(), pa.int64())})

    return (docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(count, "n_tokens long, n_docs long")
            .groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length L of the histogram (which is read twice): ``n_docs``; ``docs_at_least`` and
    ``tokens_at_least`` (documents of L or more ids, and their ids);
    ``docs_at_most``; ``truncated_tokens`` (ids left if documents are cut at L)
    and ``lost_tokens``."""
    h = (histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("t"))
         .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("t").alias("s"))
              .select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                      F.coalesce(F.sum("s").over(above), F.lit(0)).alias("s_above"),
                      F.sum("d").over(Window.orderBy(F.lit(0)).rowsBetween(
                          Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_d"),
                      F.sum("s").over(Window.orderBy(F.lit(0)).rowsBetween(
                          Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_s")))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    ge_d = F.sum("n_docs").over(down) + F.col("d_above")
    ge_t = F.sum("t").over(down) + F.col("s_above")
    cut = F.col("all_s") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return (h.join(blocks, "block")
            .select("n_tokens", "n_docs", "all_d", "all_s", ge_d.alias("docs_at_least"),
                    ge_t.alias("tokens_at_least"))
            .select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
                    (F.col("all_d") - F.col("docs_at_least") + F.col("n_docs"))
                    .alias("docs_at_most"),
                    cut.alias("truncated_tokens"), (F.col("all_s") - cut).alias("lost_tokens")))


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit (given, any number): documents over it, ids kept if
    cut there, ids in all.  The limits are the only rows that meet the whole
    histogram, each as one aggregate column."""
    if not limits:
        raise ValueError("no limits given")
    n, d = F.col("n_tokens"), F.col("n_docs")
    aggs = [F.sum(d).alias("docs"), F.sum(n * d).alias("tokens")]
    for k, limit in enumerate(limits):
        aggs += [F.sum(F.when(n > limit, d).otherwise(0)).alias(f"over_{k}"),
                 F.sum(F.least(n, F.lit(limit)) * d).alias(f"kept_{k}")]
    one = histogram.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(int(limit)).cast("long").alias("limit"),
                              F.coalesce("docs", F.lit(0)).alias("docs"),
                              F.coalesce("tokens", F.lit(0)).alias("tokens"),
                              F.coalesce(f"over_{k}", F.lit(0)).alias("docs_over"),
                              F.coalesce(f"kept_{k}", F.lit(0)).alias("tokens_kept"))
                     for k, limit in enumerate(limits)])
    return one.select(F.inline(rows))


def quantiles(sums: DataFrame, probabilities: list[float]) -> DataFrame:
    """From ``suffix_sums``: per probability p the least length L such that at
    least the share p of all documents (one at the least) is no longer."""
    total = F.col("docs_at_most") + F.col("docs_at_least") - F.col("n_docs")
    aggs = [F.min(F.when(F.col("docs_at_most") >= F.greatest(F.lit(1.0), F.lit(float(p)) * total),
                         F.col("n_tokens"))).alias(f"q{k}") for k, p in enumerate(probabilities)]
    rows = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col(f"q{k}")
                              .alias("n_tokens")) for k, p in enumerate(probabilities)])
    return sums.agg(*aggs).select(F.inline(rows))


def op3_token_counts(docs: DataFrame) -> DataFrame:
    return suffix_sums(saved(length_histogram(docs), "lengths"))
