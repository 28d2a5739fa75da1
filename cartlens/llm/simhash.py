"""SimHash near-duplicates by a grid join over segment bit counts.

A text's fingerprint has bit b where more than half of its word shingles'
hashes have it.  Documents with one fingerprint are one node; what follows
works on distinct fingerprints.

A fingerprint is cut into ``SEGMENTS`` segments of four bits, and the numbers
of bits in the segments are a point on a grid.  The Manhattan distance of two
points is never more than the number of differing bits.  Two points no more
than 2 apart share a grid cell that is at most 1 from each of them, so it is
enough that every fingerprint enters its own cell and the cells one step away
(2 * SEGMENTS + 1 in all) and that cells are joined with themselves.  The steps
that two fingerprints took to a common cell tell their Manhattan distance; each
pair that is left is verified on the bits themselves.  For a maximum of d bits
each enters the cells up to ceil(d / 2) steps away.

A cell with more than ``CELL`` fingerprints is not joined with itself.  Its
members enter the finest grid instead, of 64 segments of one bit, where the
cells hold at most 65 members by geometry, and whose members are linked without
comparing pairs: the cell is at most one bit from each.  Links are the same.

Cases: a null or empty text, or one without words, has fingerprint zero and is
linked like any other.  A text of fewer words than a shingle is one shingle.
Rows with equal ids are separate; a component's id is the smallest non-null
doc_id in it, null if all are null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import fresh, id_and_text, kept, light, ready, saved, texts_of
from cartlens.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 16
CELL = 256
#: Shingle hashes whose bits are counted at once.
_SLICE = 1 << 14
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint, as a signed number."""
    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _SLICE):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(starts[k:k + _SLICE], stops[k:k + _SLICE], strict=True)],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th, fp`` (bigint) per row; ``th`` is the text's hash."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("simhash")
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fps, pa.int64())], schema=_SCHEMA)

    return (id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
            .mapInArrow(light(run), "doc_id long, th long, fp long"))


def _cell(fp: F.Column) -> F.Column:
    """The grid point of a fingerprint: sixteen 4-bit fields, each one more
    than the number of bits in its segment (so that a step down stays in it)."""
    ones = F.lit(0x1111111111111111)
    out = ones
    for k in range(4):
        out = out + F.shiftrightunsigned(fp, k).bitwiseAND(ones)
    return out


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _steps(reach: int, fields: int = SEGMENTS) -> list[tuple[int, ...]]:
    """All vectors of at most ``reach`` unit steps, as sorted tuples of signed
    field numbers (1-based); no vector steps forth and back in one field."""
    found, last = {()}, {()}
    for _ in range(reach):
        last = {tuple(sorted((*v, s * f))) for v in last for f in range(1, fields + 1)
                for s in (1, -1) if -s * f not in v}
        found |= last
    return sorted(found, key=lambda v: (len(v), v))


def near_pairs(nodes: DataFrame, max_bits: int = MAX_BITS, cell_size: int = CELL) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints ``fp`` of ``nodes``: every
    pair within ``max_bits`` bits is linked, directly or, in crowded cells,
    through the members of a cell of the finest grid."""
    if max_bits < 1:
        return nodes.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("u <> v")
    if max_bits > 2:
        raise ValueError("the grid's steps are worked out for at most 2 differing bits")
    vectors = _steps(1)
    shifts = [_signed(sum((1 if f > 0 else -1) << (4 * (abs(f) - 1)) for f in v))
              for v in vectors]
    entries = (nodes.select("fp", _cell(F.col("fp")).alias("home"))
               .select("fp", F.posexplode(F.array(*[F.col("home") + F.lit(s) for s in shifts]))
                       .alias("step", "cell"))
               .repartition("cell"))
    crowded = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_size)
    open_ = entries.join(crowded, "cell", "left_anti")
    # Equal steps lead from one point; those meet in their own cell (step 0).
    a, b = open_.alias("a"), open_.alias("b")
    met = (a.join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
                  & ((F.col("a.step") != F.col("b.step")) | (F.col("a.step") == 0))
                  & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits))
           .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    dense = entries.join(crowded, "cell", "left_semi").select("fp").distinct()
    return met.unionByName(finest_links(dense, max_bits))


def finest_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links by the grid whose segments are single bits: a fingerprint enters
    itself and its 64 neighbours, and a cell's members are linked to the least
    of them.  For 2 bits any two members of a cell are near; for 1 bit only a
    cell's own fingerprint is near the others."""
    flips = [0, *[_signed(1 << b) for b in range(64)]]
    entries = (nodes.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x))
                                                      for x in flips])).alias("cell")))
    if max_bits == 1:
        return (entries.join(nodes.select(F.col("fp").alias("cell")), "cell", "left_semi")
                .where("fp <> cell").select(F.col("fp").alias("u"), F.col("cell").alias("v")))
    entries = entries.repartition("cell")
    least = (entries.groupBy("cell").agg(F.min("fp").alias("m"), F.count(F.lit(1)).alias("n"))
             .where("n > 1"))
    return (entries.join(least, "cell").where("fp <> m")
            .select(F.col("fp").alias("u"), F.col("m").alias("v")))


def print_roots(prints: DataFrame, max_bits: int = MAX_BITS, cell_size: int = CELL) -> DataFrame:
    """``fp, root, least``: each distinct fingerprint's component (named by its
    smallest fingerprint) and the smallest doc_id that has the fingerprint."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(near_pairs(nodes.select("fp"), max_bits, cell_size))
    known = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    return saved(known.select("fp", F.coalesce("root", "fp").alias("root"), "least"),
                 "fingerprint-roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    cell_size: int = CELL) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    roots = print_roots(prints, max_bits, cell_size)
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = roots.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                cell_size: int = CELL) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the
    smallest doc_id (a null id comes last), of several such rows the one with
    the smallest text hash, of equal ones any."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    roots = print_roots(prints, max_bits, cell_size).select("fp", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "th"))
    key, th = fresh(docs, "_k"), fresh(docs, "_th")
    keep = (prints.join(roots, "fp").groupBy("root").agg(first.alias("f"))
            .select(F.coalesce("f.doc_id", "f.th").alias(key), F.col("f.th").alias(th)))
    text = F.col(f"`{text_col}`").cast("string")
    return (docs.withColumn(th, F.xxhash64(text))
            .withColumn(key, F.coalesce(F.col(f"`{id_col}`").cast("long"), F.col(th)))
            .join(keep, [key, th], "left_semi").dropDuplicates([key, th]).drop(key, th))


def op6_simhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
