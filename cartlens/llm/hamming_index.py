"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors become binary codes: each is scaled so that the largest inner product
is the smallest angle (one more component makes all rows equally long, and is
zero for queries), centred, turned by learned rotations and cut to signs.  Each
rotation is fitted by alternating between the signs and the best rotation onto
them, from a random start; ``ROTATIONS`` of them make a long code.  They are
learned from at most ``SAMPLE`` vectors, chosen by a hash of their ids.

Codes are split evenly into substrings of at most 64 bits (260 bits: five of 52),
each kept in a word of 64 and indexed by its values.  Two
codes that differ in at most r bits differ in one of m substrings by at most
floor(r / m) bits, or one less for all but the first r mod m + 1: a query probes
the values within these distances, the codes found are compared in full, and
those within r are ranked by the inner product of the original vectors.

The radius is the distance within which the sample's true neighbours lie for
``COVERAGE`` of all cases.  The sample is sparser than the table, so its
neighbours are farther: on the whole table the share is higher.  A query that
finds fewer than it asks for within the radius is asked again without one.

Rows and queries are dealt in blocks of bounded size; a task holds the index of
one block of rows and answers one block of queries.  It passes on no more than k
rows a query, and these are merged.  Nothing is broadcast but the codebook.  Rows
are copied once for every ``QUERY_BLOCK`` queries and queries once for every
``ROW_BLOCK`` rows; smaller tables are cut into more blocks, for all cores to work.

Cases: vectors that are null, zero or hold a null or non-finite component take
no part, nor do rows without an id or vectors of another length than the most
frequent one (of several, the longest).  Of rows with one id the smallest vector counts.  Equal
scores go to the smaller id.  If there are fewer than k candidates all are
ranked; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import ready, saved

ROTATIONS = 4
SAMPLE = 4_096
SAMPLE_QUERIES = 512
COVERAGE = 0.95
ROW_BLOCK, QUERY_BLOCK = 65_536, 32_768
#: A block of rows is not cut further below this.
SMALL_BLOCK = 4_096
#: Queries of a block that are answered at once, and pairs ranked at once.
AT_ONCE, PAIRS = 64, 1 << 18
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Codebook:
    """What turns vectors into codes; ``radius`` is in bits."""

    longest: float
    mean: np.ndarray
    rotations: tuple[np.ndarray, ...]
    radius: int

    def codes(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """Codes as rows of unsigned 64-bit words, a substring in each."""
        x = _equally_long(vectors, self.longest, queries) - self.mean
        bits = np.concatenate([x @ r > 0 for r in self.rotations], axis=1)
        parts = np.array_split(bits, -(-bits.shape[1] // 64), axis=1)
        words = np.concatenate([np.pad(p, ((0, 0), (0, 64 - p.shape[1]))) for p in parts], axis=1)
        return np.ascontiguousarray(np.packbits(words, axis=1)).view("<u8")


def _equally_long(x: np.ndarray, longest: float, queries: bool) -> np.ndarray:
    if queries:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.pad(x, ((0, 0), (0, 1)))
    x = x / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))
    return np.concatenate([x, rest], axis=1)


def _rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
        r = u @ v
    return r


def learn_codebook(vectors: np.ndarray, longest: float, k: int, seed: int = 7) -> Codebook:
    """Rotations and radius from a sample of row vectors."""
    rng = np.random.default_rng(seed)
    x = _equally_long(vectors, longest, False)
    mean = x.mean(axis=0)
    book = Codebook(longest, mean, tuple(_rotation(x - mean, rng) for _ in range(ROTATIONS)), 0)
    codes = book.codes(vectors)
    q = vectors[:SAMPLE_QUERIES]
    scores = q @ vectors.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, :max(1, min(k, len(vectors) - 1))]
    asked = book.codes(q, queries=True)
    distances = np.bitwise_count(asked[:, None, :] ^ codes[near]).sum(axis=2, dtype=np.int64)
    return Codebook(longest, mean, book.rotations, int(np.ceil(np.quantile(distances, COVERAGE))))


class BlockIndex:
    """Substring tables over one block's codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]

    def probed(self, asked: np.ndarray, radius: int) -> np.ndarray:
        """Which codes (columns) each query (row) meets in one of the tables."""
        m = len(self.tables)
        share, more = divmod(radius, m)
        hit = np.zeros((len(asked), len(self.codes)), bool)
        for j, (values, place) in enumerate(self.tables):
            least = share if j <= more else share - 1
            if least >= 0:
                probed = np.bitwise_count(asked[:, j, None] ^ values) <= least
                hit |= probed[:, place]
        return hit

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) numbers of all codes within ``radius`` of a query."""
        q, r = np.nonzero(self.probed(asked, radius))
        far = np.bitwise_count(asked[q] ^ self.codes[r]).sum(axis=1, dtype=np.int64) > radius
        return q[~far], r[~far]


def best_of_block(rows: tuple, queries: tuple, book: Codebook, radius: int, k: int) -> pa.Table:
    """The k best of a block's rows for each of a block's queries; ``rows`` and
    ``queries`` are (ids, vectors)."""
    (ids, x), (q_ids, q) = rows, queries
    index = BlockIndex(book.codes(x))
    asked = book.codes(q, queries=True)
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(q), AT_ONCE):
        n, r = index.within(asked[at:at + AT_ONCE], radius)
        other = ids[r] != q_ids[n + at]
        n, r = n[other] + at, r[other]
        score = np.concatenate([(q[n[c:c + PAIRS]] * x[r[c:c + PAIRS]]).sum(axis=1)
                                for c in range(0, len(n), PAIRS)] or [np.zeros(0)])
        order = np.lexsort((ids[r], -score, n))
        n, r, score = n[order], r[order], score[order]
        first = np.searchsorted(n, n, "left")
        top = np.arange(len(n)) - first < k
        for col, part in zip(out, (q_ids[n[top]], ids[r[top]], score[top]), strict=True):
            col.append(part)
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=FOUND)


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vec").combine_chunks().flatten().to_numpy()
    return ids, flat.reshape(len(ids), -1)


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, vec`` (array of double) of the rows that take part."""
    v = F.col("vec")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                        F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull())
            .where(~odd & F.exists(v, lambda x: x != 0)))
    one = saved(good.groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    first = (one.groupBy(F.size("vec").alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).first())
    return one.where(F.size("vec") == (first["d"] if first else 0))


def nearest(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product
    for each row for which ``is_query`` (a condition on ``vec_id``) holds."""
    spark = rows.sparkSession
    ready(spark)
    base = valid_vectors(rows, id_col, vec_col)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    n, longest = base.agg(F.count(F.lit(1)), F.max(norm)).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)
    sample = (base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow())
    book = learn_codebook(_arrays(sample)[1], longest, k)
    # A row's number within its part of the table deals rows out evenly.
    number = F.monotonically_increasing_id()
    asked = base.where(is_query)
    n_asked = max(1, -(-asked.count() // QUERY_BLOCK))
    wanted = 2 * spark.sparkContext.defaultParallelism // n_asked
    n_rows = max(-(-n // ROW_BLOCK), min(wanted, -(-n // SMALL_BLOCK)))
    row_blocks = (base.withColumn("a", number % n_rows)
                  .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))))
    query_blocks = (asked.withColumn("b", (number % n_asked).cast("int"))
                    .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"),
                                                          F.lit(n_rows - 1).cast("long")))))

    def search(queries: DataFrame, radius: int) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return FOUND.empty_table()
            return best_of_block(_arrays(left), _arrays(right), book, radius, k)

        found = (row_blocks.groupBy("a", "b").cogroup(queries.groupBy("a", "b"))
                 .applyInArrow(run, "query_id long, vec_id long, score double"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    first = saved(search(query_blocks, book.radius), "neighbours")
    full = (first.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1))
            .select(F.col("query_id").alias("vec_id")))
    short = saved(query_blocks.join(full, "vec_id", "left_anti"), "short-of-neighbours")
    if short.isEmpty():
        return first
    bits = sum(r.shape[1] for r in book.rotations)
    again = search(short, bits)
    return (first.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
            .unionByName(again))


def op7_neighbours(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, F.col("vec_id") % 20 == 0)
