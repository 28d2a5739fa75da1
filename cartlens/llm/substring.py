"""Repeated passages across documents, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words.  A word goes if a window over it
also starts in a document with a smaller id.  Hashing every window of every
document and shuffling all of them is avoided as follows.

``COVER`` is a difference cover modulo ``PERIOD``: for any two positions i and
j there is a shift d < PERIOD that puts both i + d and j + d on the cover.  So
if a window starts at i in one document and at j in another, both documents
have an anchor, a run of ``ANCHOR`` words at a cover position, at the same
place d inside the window, with the same words; ``ANCHOR`` = WINDOW - PERIOD + 1
words always fit.  Hence:

1. hash runs of ANCHOR words at cover positions only (3 of 7), and keep those
   that occur in at least two documents;
2. extend: the windows that hold a kept anchor are the only ones that can
   repeat; hash these whole (96 bits) and take the least id of each;
3. in a document, the words under windows whose least id is below its own go.

No pair of documents is formed.  An anchor or window that a document has often
is sent once; its other places are found again in the text.  Before a shuffle
each task settles, run of ``RUN`` rows by run, what it can settle alone: an
anchor that two documents of the run share is known to repeat, a window that a
smaller document of the run has is known to go.  Such rows are dealt out at
random, and only one row for each run goes on to the others' place.  So a
passage that a third of all documents share makes a group of one row per run,
not one per document.

The texts are shuffled once: every row gets a number, and the rows are written in
buckets of it.  Kept anchors and windows come back to their rows by that number,
without another exchange of the texts.  Rows of one id, and equal rows, have
numbers of their own, so no id or text is hot.

Cases: a null text has no words.  A document of fewer than WINDOW words keeps
all.  Rows with one id do not repeat each other (none is smaller), and each is
judged by its own text.  A row with a null id neither loses words nor makes
others lose any.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import cleaned, kept, light, ready, saved, texts_of
from cartlens.sources.bucketed import read_bucketed, write_bucketed

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Odd multipliers of the two rolling sums (fixed, so that tasks agree).
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Rows among which a task looks for repeats of its own.
RUN = 1 << 20
_ANCHORS = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()),
                      ("pos", pa.int32())])
_WINDOWS = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc_id", pa.int64()),
                      ("row", pa.int64()), ("pos", pa.int32())])


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, length: int, starts: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the runs of ``length`` word hashes at ``starts``."""
    mult = np.uint64(_MULTIPLIERS[which])
    out = np.zeros(len(starts), np.uint64)
    for k in range(length):
        out = out * mult + words[starts + k]
    out ^= out >> np.uint64(32)
    return (out * mult) ^ (out >> np.uint64(29))


def cover_positions(n: int) -> np.ndarray:
    """Positions on the cover at which an anchor fits into n words."""
    at = np.arange(max(0, n - ANCHOR + 1))
    return at[np.isin(at % PERIOD, COVER)]


def elsewhere(h: np.ndarray, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A key that no other row is likely to have."""
    mixed = (h.view(np.uint64) ^ (row.view(np.uint64) * np.uint64(_MULTIPLIERS[0]))) + (
        pos.astype(np.uint64) * np.uint64(_MULTIPLIERS[1]))
    mixed ^= mixed >> np.uint64(31)
    return (mixed * np.uint64(_MULTIPLIERS[0])).view(np.int64)


def runs(batches: Iterator[pa.RecordBatch], rows_of, settle) -> Iterator[pa.RecordBatch]:
    """Gather the columns that ``rows_of`` makes of each batch to runs of at
    least RUN rows and yield what ``settle`` makes of them."""
    kept("substring")
    held, n = [], 0
    for batch in batches:
        for cols in rows_of(batch):
            held.append(cols)
            n += len(cols[0])
            if n >= RUN:
                yield settle(_gathered(held))
                n = 0
    if n:
        yield settle(_gathered(held))


def _gathered(held: list[tuple]) -> list[np.ndarray]:
    """The columns of all parts; ``held`` is emptied."""
    cols = [np.concatenate(c) for c in zip(*held, strict=True)]
    held.clear()
    return cols


def settle_anchors(cols: list[np.ndarray]) -> pa.RecordBatch:
    """From (anchor, document, row, place): a row's first place of each anchor.
    A known repeat has -1 - pos for its position, and all but one of these are
    dealt elsewhere."""
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    h, doc, row, pos = (c[order] for c in cols)
    new = np.r_[True, h[1:] != h[:-1]]
    once = new | np.r_[True, row[1:] != row[:-1]]
    h, doc, row, pos, new = (c[once] for c in (h, doc, row, pos, new))
    first = np.flatnonzero(new)
    sizes = np.diff(np.r_[first, len(h)])
    shared = np.repeat(doc[first] != doc[first + sizes - 1], sizes)
    away = shared & ~new
    h[away] = elsewhere(h[away], row[away], pos[away])
    pos[shared] = -1 - pos[shared]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, doc, row, pos)], schema=_ANCHORS)


def settle_windows(cols: list[np.ndarray]) -> pa.RecordBatch:
    """A window known to go has -1 - pos for its position.  Of the others all
    are rows of the run's least id.  A row's first place of a window counts."""
    order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
    h1, h2, doc, row, pos = (c[order] for c in cols)
    new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
    once = new | np.r_[True, row[1:] != row[:-1]]
    h1, h2, doc, row, pos, new = (c[once] for c in (h1, h2, doc, row, pos, new))
    first = np.flatnonzero(new)
    sizes = np.diff(np.r_[first, len(h1)])
    gone = doc > np.repeat(doc[first], sizes)
    h1[gone] = elsewhere(h1[gone], row[gone], pos[gone])
    pos[gone] = -1 - pos[gone]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, doc, row, pos)],
                                      schema=_WINDOWS)


def anchors(rows: DataFrame) -> DataFrame:
    """``h, doc_id, row, pos``: the anchors of each row (``row, doc_id, text``)."""

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for row, doc, text in zip(batch.column("row").to_pylist(),
                                  batch.column("doc_id").to_pylist(),
                                  texts_of(batch.column("text")), strict=True):
            words = word_hashes(text.split()) if doc is not None else ()
            if len(words) >= WINDOW:
                at = cover_positions(len(words))
                yield (run_hashes(words, ANCHOR, at).view(np.int64),
                       np.full(len(at), doc, np.int64), np.full(len(at), row, np.int64),
                       at.astype(np.int32))

    return rows.select("row", "doc_id", "text").mapInArrow(
        light(lambda x: runs(x, rows_of, settle_anchors)), "h long, doc_id long, row long, pos int")


def candidate_windows(rows: DataFrame) -> DataFrame:
    """``h1, h2, doc_id, row, pos`` of the windows that hold a kept anchor, for
    rows with ``row, doc_id, text, at``: ``at`` lists the kept anchors'
    positions, the first of each in the text; others of its positions are found
    by their hashes."""

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for row, doc, text, places in zip(
                batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(),
                texts_of(batch.column("text")), batch.column("at"), strict=True):
            words = word_hashes(text.split())
            at = cover_positions(len(words))
            anchor = run_hashes(words, ANCHOR, at)
            at = at[np.isin(anchor, anchor[np.isin(at, np.asarray(places.values))])]
            starts = np.unique((at[:, None] - np.arange(PERIOD)).ravel())
            starts = starts[(starts >= 0) & (starts <= len(words) - WINDOW)]
            yield (run_hashes(words, WINDOW, starts, 0).view(np.int64),
                   run_hashes(words, WINDOW, starts, 1).astype(np.uint32).view(np.int32),
                   np.full(len(starts), doc, np.int64), np.full(len(starts), row, np.int64),
                   starts.astype(np.int32))

    return rows.select("row", "doc_id", "text", "at").mapInArrow(
        light(lambda x: runs(x, rows_of, settle_windows)),
        "h1 long, h2 int, doc_id long, row long, pos int")


def dealt(docs: DataFrame, id_col: str, text_col: str, rest: bool = False) -> DataFrame:
    """``row, doc_id, text`` of all rows (and all other columns as the struct
    ``rest``), written in buckets of ``row``, a number of its own for each row.

    The bucketed table is known to the session by name only until it is read."""
    cols = [F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{text_col}`").cast("string").alias("text")]
    if rest:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
                    .alias("rest"))
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with cleaned(spark):
        name = write_bucketed(docs.select(*cols), ["row"], buckets, "numbered_texts")
    rows = read_bucketed(spark, name)
    spark.sql(f"DROP TABLE {name}")         # an external table: its files stay
    return rows


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``row, starts``: the starts of the row's windows that also start in a
    document with a smaller id.  Either step's result is written, and its shuffle
    files go before the next."""
    by_anchor, by_window = Window.partitionBy("h"), Window.partitionBy("h1", "h2")
    place = F.when(F.col("pos") < 0, -1 - F.col("pos")).otherwise(F.col("pos"))
    found = saved(
        anchors(rows)
            .select("row", "pos", F.min("doc_id").over(by_anchor).alias("lo"),
                    F.max("doc_id").over(by_anchor).alias("hi"),
                    F.min("pos").over(by_anchor).alias("known"))
            .where("lo < hi OR known < 0")
            .groupBy("row").agg(F.collect_set(place).alias("at")), "anchors")
    return saved(
        candidate_windows(rows.join(found, "row"))
            .withColumn("lo", F.min("doc_id").over(by_window))
            .where("lo < doc_id OR pos < 0")
            .groupBy("row").agg(F.collect_set(place).alias("starts")),
        "repeats")


def covered(words: list[bytes], starts: np.ndarray) -> np.ndarray:
    """Which words lie under a window that stands at one of ``starts``, there or
    anywhere else in the text."""
    hashes = run_hashes(word_hashes(words), WINDOW, np.arange(len(words) - WINDOW + 1))
    starts = np.flatnonzero(np.isin(hashes, hashes[starts]))
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return np.cumsum(edges[:-1]) > 0


def kept_words(text: bytes | None, starts: pa.Scalar) -> tuple[list[bytes], int]:
    """The words left of a text, and how many words it had."""
    words = (text or b"").split()
    if not starts.is_valid:
        return words, len(words)
    gone = covered(words, np.asarray(starts.values)).tolist()
    return [w for w, g in zip(words, gone, strict=True) if not g], len(words)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256``, the last of the
    words left, joined by single spaces."""
    ready(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for text, starts in zip(texts_of(batch.column("text")), batch.column("starts"),
                                    strict=True):
                left, n = kept_words(text, starts)
                for col, x in zip(out, (n, n - len(left),
                                        hashlib.sha256(b" ".join(left)).hexdigest()), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x) for x in out]], schema=schema)

    rows = dealt(docs, id_col, text_col)
    return (rows.join(repeated_windows(rows), "row", "left").select("doc_id", "text", "starts")
            .mapInArrow(light(run), "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, repeated passages taken out of the text.
    A text that loses nothing stays as it is, white space included; one that
    loses words is the words left, joined by single spaces; one that loses
    every word is empty.  No row goes."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("text")
            for text, starts in zip(texts.cast(pa.binary()).to_pylist(), batch.column("starts"),
                                    strict=True):
                out.append(b" ".join(kept_words(text, starts)[0]) if starts.is_valid else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(out, pa.binary()).cast(pa.string())],
                names=["rest", "text"])

    rows = dealt(docs, id_col, text_col, rest=True)
    joined = rows.join(repeated_windows(rows), "row", "left").select("rest", "text", "starts")
    left = joined.mapInArrow(light(run), joined.select("rest", "text").schema)
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                         for c in docs.columns])


def op10_substring(docs: DataFrame) -> DataFrame:
    return removals(docs)
