"""Runs: stretches of words that repeat with a period, by an enhanced suffix array.

A run is a stretch with a smallest period q and a length of at least 2 q that
neither neighbouring word extends.  Its last square (two equal halves of q
words) stands at p = end - 2 q, and the suffixes at p and p + q agree in exactly
q words, since the word behind the run breaks the period.  So all runs come out
of pairs of suffixes that are as far apart as their common prefix is long:

1. the texts of a batch, words as numbers that no two texts share and an end
   mark after each, get one suffix array, by sorting on prefixes of 1, 2, 4, ...
   words (only what is not yet told apart is sorted again); the ranks of each
   step also give the common prefixes (LCP) of neighbours;
2. every LCP value belongs to an interval of the array, which it splits in two;
   the ends come from the nearest smaller values.  The suffixes of the smaller
   part alone are tested: does the suffix ``depth`` words on, or back, lie in
   the other part, as the inverse array (ISA) says?  That is n log n tests, all
   on arrays, and no tree is built;
3. a square found is rotated to the left as long as the words agree, and squares
   that grow into the same stretch are one run with the smallest period.

Texts are independent of each other: one pass over the documents, no shuffle.
Memory is bounded by ``GROUP_WORDS`` words or one text, whichever is more.

Cases: a null text has no words and so no run.  Each row is analysed for itself,
whatever its id; a null id stays null.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import WORD, id_and_text, ready, texts_of

MIN_LENGTH = 12
#: Words that are sorted together.
GROUP_WORDS = 1 << 19
#: Suffixes tested at once.
TESTS = 1 << 20
#: Words by which squares are rotated together; longer ones go on one by one.
STEPS = 32
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_DDL = "array<struct<start: long, length: long, period: long>>"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, its inverse, the ranks of each step).  In step k suffixes
    share a rank if and only if they agree in their first 2^k symbols.  No
    symbol sequence may run into another: ends need symbols of their own."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks = _ranks(np.arange(n), symbols[order], order, np.empty(n, np.int64))
    levels, step = [ranks.astype(np.int32)], 1
    while True:
        # Slots whose suffix shares its rank with a neighbour.
        new = np.r_[True, ranks[order][1:] != ranks[order][:-1], True]
        slots = np.flatnonzero(~(new[:-1] & new[1:]))
        if not len(slots):
            return order, ranks, levels
        at = order[slots]
        key = ranks[at] * n + ranks[at + step]
        by = np.argsort(key, kind="stable")
        order[slots] = at[by]
        ranks = _ranks(slots, key[by], at[by], ranks.copy())
        step *= 2
        levels.append(ranks.astype(np.int32))


def _ranks(slots: np.ndarray, keys: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Each suffix's rank is the first slot with its key."""
    new = np.r_[True, keys[1:] != keys[:-1]]
    ranks[at] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
    return ranks


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """``lcp[i]``: how far the suffixes in slots i - 1 and i agree (``lcp[0]`` = 0)."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    slots = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b, n = order[slots - 1], order[slots], np.zeros(len(slots), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        n += np.where(levels[k][a + n] == levels[k][b + n], 1 << k, 0)
    out[slots] = n
    return out


def splits(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, lefts, rights): the LCP value of each slot >= 1 splits the interval
    from ``left`` to ``right`` (exclusive), in which no value is smaller."""
    busy = lcp > 0
    kept = np.flatnonzero(busy | np.r_[busy[1:], False])
    if not len(kept):
        return kept, kept, kept
    values = np.r_[lcp[kept], 0]            # runs of values > 0 begin behind a 0
    at = np.flatnonzero(values)
    zeros = np.flatnonzero(values == 0)
    longest = int(np.diff(zeros).max())
    least = [values]                        # least[j][i]: of values[i : i + 2^j]
    for j in range(1, longest.bit_length() + 1):
        prev, half = least[-1], 1 << (j - 1)
        now = np.zeros_like(prev)
        if half < len(prev):
            now[:-half] = np.minimum(prev[:-half], prev[half:])
        least.append(now)
    own, left, right = values[at], at - 1, at + 1
    for j in range(len(least) - 1, -1, -1):
        begin = left - (1 << j) + 1
        left = np.where((begin >= 0) & (least[j][np.maximum(begin, 0)] >= own), begin - 1, left)
        right = np.where(least[j][np.minimum(right, len(values) - 1)] > own, right + (1 << j), right)
    # Between left and right all slots are kept, so slots differ as places do.
    slot = kept[at]
    return slot, slot - (at - left), slot + (right - at)


def squares(order: np.ndarray, ranks: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, periods) of the squares whose next word breaks the period."""
    slot, left, right = splits(lcp)
    low = slot - left <= right - slot
    begin, size = np.where(low, left, slot), np.where(low, slot - left, right - slot)
    other, beyond = np.where(low, slot, left), np.where(low, right, slot)
    depth, done, found = lcp[slot], np.r_[0, np.cumsum(size)], []
    a = 0
    while a < len(slot):
        b = max(a + 1, int(np.searchsorted(done, done[a] + TESTS, "right")) - 1)
        node = np.repeat(np.arange(a, b), size[a:b])
        at = order[begin[node] + np.arange(len(node)) - (done[node] - done[a])]
        for step in (depth[node], -depth[node]):
            partner = at + step
            inside = (partner >= 0) & (partner < len(order))
            rank = ranks[np.where(inside, partner, 0)]
            hit = np.flatnonzero(inside & (rank >= other[node]) & (rank < beyond[node]))
            found.append((np.minimum(at[hit], partner[hit]), depth[node[hit]]))
        a = b
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def rotated(symbols: np.ndarray, starts: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """The starts after moving each square to the left while the words agree."""
    ends, starts = starts + 2 * periods, starts.copy()
    moving = np.arange(len(starts))
    for _ in range(STEPS):
        at = starts[moving]
        moving = moving[(at > 0) & (symbols[at - 1] == symbols[at - 1 + periods[moving]])]
        if not len(moving):
            return starts
        starts[moving] -= 1
    # By end, the least period first: a square within a run that ends there, whose
    # period is a multiple of the run's, is part of that run.
    moving = moving[np.lexsort((periods[moving], ends[moving]))]
    end, known = -1, []
    for k in moving.tolist():
        at, q, size = int(starts[k]), int(periods[k]), STEPS
        if ends[k] != end:
            end, known = int(ends[k]), []
        inside = [s for s, r in known if q % r == 0 and end - 2 * q >= s]
        if inside:
            starts[k] = inside[0]
            continue
        while at:
            size = min(size, at)
            differ = np.flatnonzero(symbols[at - size:at] != symbols[at - size + q:at + q])
            if len(differ):
                at -= size - 1 - int(differ[-1])
                break
            at, size = at - size, 2 * size
        starts[k] = at
        known.append((at, q))
    return starts


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows of start, end, period, in order: the runs of at least ``min_length``
    symbols."""
    order, ranks, levels = suffix_array(symbols)
    lcp = common_prefixes(order, levels)
    del levels
    at, periods = squares(order, ranks, lcp)
    starts, ends = rotated(symbols, at, periods), at + 2 * periods
    long = ends - starts >= min_length
    rows = np.stack([starts[long], ends[long], periods[long]], 1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)] if len(rows) else []
    rows = rows[np.asarray(first, bool)]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def analysed(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Each text's runs (start, end, period)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = pa.array(chain.from_iterable(texts), pa.binary()).dictionary_encode()
    n_codes = len(codes.dictionary)
    first = np.r_[0, np.cumsum(sizes + 1)]
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    symbols = np.full(first[-1], n_codes, np.int64)
    symbols[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(texts)), sizes)] = \
        codes.indices.to_numpy()
    rows = runs_of(owner * (n_codes + 1) + symbols, min_length)
    cuts = np.searchsorted(rows[:, 0], first)
    return [rows[a:b] - [base, base, 0] for a, b, base in zip(
        cuts[:-1].tolist(), cuts[1:].tolist(), first[:-1].tolist(), strict=True)]


def groups(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in groups of some GROUP_WORDS words."""
    held, n = [], 0
    for text in texts:
        words = text.split()
        if held and n + len(words) > GROUP_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def first_periods(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(rows):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edges, rows[:, 1], -1)
    gone = (np.cumsum(edges[:-1]) > 0).tolist()
    return [w for w, g in zip(words, gone, strict=True) if not g]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (by start, then period) and
    ``collapsed_sha256``, of the words that no run holds after its first period."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in groups(texts_of(batch.column(1))):
                found = analysed(texts, min_length)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(at, len(texts)),
                    "n_words": pa.array([len(x) for x in texts], pa.int64()),
                    "runs": pa.array([[{"start": s, "length": e - s, "period": q}
                                       for s, e, q in rows.tolist()] for rows in found], RUNS),
                    "collapsed_sha256": [hashlib.sha256(b" ".join(first_periods(words, rows)))
                                         .hexdigest()
                                         for words, rows in zip(texts, found, strict=True)]})
                at += len(texts)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS_DDL}, collapsed_sha256 string")


def collapsed(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, of each run only the first period left.  A
    text without runs stays as it is; else its words are joined by spaces."""
    ready(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column("text").cast(pa.binary()).to_pylist()
            at = 0
            for texts in groups(texts_of(batch.column("text"))):
                for words, found in zip(texts, analysed(texts, min_length), strict=True):
                    if len(found):
                        out[at] = b" ".join(first_periods(words, found))
                    at += 1
            yield pa.RecordBatch.from_pydict({
                "rest": batch.column("rest"), "text": pa.array(out, pa.binary()).cast(pa.string())})

    left = rows.mapInArrow(run, rows.schema)
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                         for c in docs.columns])


def echoed(doc_id: Column, text: Column) -> Column:
    """The text that op12 examines: with h = crc32 of the id and g = h / 10, one
    text in ten repeats p words from word g mod n on, to its end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = (g % n).cast("int")
        left = (n - a).cast("int")
        p = (1 + F.floor(left / (3 + g % 8))).cast("int")
        echo = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil(left / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(echo, F.lit(1), left)),
                            " ")

    # One element: the words are looked for once.
    words = F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
    return F.when((h % 10 == 0) & text.rlike(WORD), F.transform(words, changed)[0]).otherwise(text)


def op12_runs(docs: DataFrame) -> DataFrame:
    found = periodic_runs(docs.select(
        "doc_id", echoed(F.col("doc_id").cast("long"), F.col("text")).alias("text")))
    # Of the longest run the first, and of these the one with the least period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"),
        (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","),
                                                   r["period"], F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        "top.length", (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256")
