"""Hierarchical packing of documents into sequences of several lengths.

Tiers are context sizes, each a power of two (1024, 512, ... by default).  A
document fills whole windows of the longest tier by itself; its rest is routed
to the least tier that holds it.  The tiers are packed from the longest to the
shortest: a rest opens a window of its tier, and the gap behind it takes the
longest waiting rest that fits, again and again.  Where none fits, the head of
the shortest longer one is cut off to fill the gap exactly, and what is left of
it is routed anew.  Only the last window of a block can stay open; it is cut
into sequences whose lengths are powers of two.  So no sequence needs padding.

Sequences of one tier are then dealt to steps of ``step_tokens`` ids.  The cost
of a sequence is the sum of the squares of its pieces' lengths (attention
within documents); sequences are dealt in order of cost, forth and back, so the
steps of a tier cost about the same.

A block is the run of documents, in one task, whose rests are packed together:
it ends after ``block_docs`` documents or ``block_bytes`` of ids.  The bounds
hold a worker's memory down and depend on no input size; padding stays zero
for any block, and no shuffle is needed.  A recomputed task reads the same rows
in the same order and so makes the same sequences.

Cases: null and empty texts have the end id only.  Rows with equal or null ids
are packed each for itself.  An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cartlens.llm.common import id_and_text, light, ready
from cartlens.llm.tokens import encoder, tokenizer_path

TIERS = (1024, 512, 256, 128, 64)
BLOCK_DOCS = 8192
BLOCK_BYTES = 32 << 20
STEP_TOKENS = 16_384
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()),
                    ("step_id", pa.int64())])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, tier long, step_id long")


class Waiting:
    """Pieces that wait for a place, by length.  Bit n of ``mask`` is set
    while a piece of length n waits."""

    def __init__(self) -> None:
        self.by: dict[int, list[tuple[int, int]]] = {}
        self.mask = 0

    def put(self, length: int, doc: int, start: int) -> None:
        self.by.setdefault(length, []).append((doc, start))
        self.mask |= 1 << length

    def take(self, length: int) -> tuple[int, int]:
        held = self.by[length]
        item = held.pop()
        if not held:
            self.mask &= ~(1 << length)
        return item

    def longest(self, most: int | None = None) -> int:
        """The greatest waiting length (up to ``most``), or 0."""
        mask = self.mask if most is None else self.mask & ((2 << most) - 1)
        return mask.bit_length() - 1 if mask else 0

    def shortest_over(self, length: int) -> int:
        above = self.mask >> (length + 1)
        return (above & -above).bit_length() + length if above else 0


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list]]:
    """Sequences (tier, [(document, start, length), ...]) for documents of the
    given numbers of ids."""
    top, waiting, out = tiers[0], Waiting(), []
    for doc, n in enumerate(sizes):
        whole = n - n % top
        out += [(top, [(doc, at, top)]) for at in range(0, whole, top)]
        if n > whole:
            waiting.put(n - whole, doc, whole)
    while first := waiting.longest():
        tier = min((t for t in tiers if t >= first), default=top)
        doc, start = waiting.take(first)
        held, gap = [(doc, start, first)], tier - first
        while gap:
            if n := waiting.longest(gap):
                doc, start = waiting.take(n)
                held.append((doc, start, n))
                gap -= n
            elif n := waiting.shortest_over(gap):
                doc, start = waiting.take(n)
                held.append((doc, start, gap))
                waiting.put(n - gap, doc, start + gap)
                gap = 0
            else:
                break
        if not gap:
            out.append((tier, held))
        else:
            out += by_powers(held, tier - gap)
    return out


def by_powers(held: list[tuple[int, int, int]], used: int) -> list[tuple[int, list]]:
    """Cut a run of pieces into sequences whose lengths are powers of two."""
    out, left = [], list(held)
    while used:
        size = 1 << (used.bit_length() - 1)
        room, now = size, []
        while room:
            doc, start, n = left.pop(0)
            k = min(n, room)
            now.append((doc, start, k))
            if n > k:
                left.insert(0, (doc, start + k, n - k))
            room -= k
        out.append((size, now))
        used -= size
    return out


def steps(sequences: list[tuple[int, list]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step number for each sequence: steps of one tier hold the same number
    of sequences (the last excepted by at most one each) and much the same
    cost."""
    order: dict[int, list[tuple[int, int]]] = {}
    for k, (tier, held) in enumerate(sequences):
        order.setdefault(tier, []).append((-sum(n * n for _, _, n in held), k))
    out, base = [0] * len(sequences), 0
    for tier in sorted(order, reverse=True):
        ranked = sorted(order[tier])
        n_steps = -(-len(ranked) * tier // step_tokens)
        for at, (_, k) in enumerate(ranked):
            lap, place = divmod(at, n_steps)
            out[k] = base + (place if lap % 2 == 0 else n_steps - 1 - place)
        base += n_steps
    return out


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0,
                   tiers: tuple[int, ...] = TIERS, id_col: str = "doc_id",
                   text_col: str = "text", block_docs: int = BLOCK_DOCS,
                   block_bytes: int = BLOCK_BYTES, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece (``PIECES_DDL``).  ``tier`` is its sequence's length."""
    tiers = tuple(sorted(tiers, reverse=True))
    if not tiers or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError(f"tiers have to be powers of two: {tiers}")
    ready(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = int(end_id).to_bytes(enc.width, "little")
        base = TaskContext.get().partitionId() << 40
        ids, flat, sizes, n_ids, n_seq, n_step = [], [], [], 0, 0, 0
        for batch in batches:
            new, counts = enc.encode_column(batch.column(1), end)
            ids += batch.column(0).to_pylist()
            flat.append(new)
            sizes += counts.tolist()
            n_ids += len(new)
            if len(ids) >= block_docs or n_ids * enc.width >= block_bytes:
                yield from block(ids, flat, sizes, base + n_seq, base + n_step, found := [0, 0])
                n_seq, n_step = n_seq + found[0], n_step + found[1]
                ids, flat, sizes, n_ids = [], [], [], 0
        if ids:
            yield from block(ids, flat, sizes, base + n_seq, base + n_step, [0, 0])

    def block(ids, flat, sizes, first_sequence, first_step, found) -> Iterator[pa.RecordBatch]:
        raw = np.concatenate(flat)
        flat.clear()
        at = (np.cumsum(sizes) - sizes).tolist()
        sequences = pack(sizes, tiers)
        step = steps(sequences, step_tokens)
        found[:] = [len(sequences), max(step, default=-1) + 1]
        cols = [[] for _ in PIECES]
        for k, (tier, held) in enumerate(sequences):
            offset = 0
            for doc, start, n in held:
                first = at[doc] + start
                crc = zlib.crc32(raw[first:first + n].astype("<u4"))
                for col, x in zip(cols, (ids[doc], start, n, crc, sizes[doc],
                                         first_sequence + k, offset, tier,
                                         first_step + step[k]), strict=True):
                    col.append(x)
                offset += n
            if len(cols[0]) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 schema=PIECES)
                cols = [[] for _ in PIECES]
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             schema=PIECES)

    return id_and_text(docs, id_col, text_col).mapInArrow(light(run), PIECES_DDL)


def op4_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
