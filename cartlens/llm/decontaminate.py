"""Benchmark passages in documents, found by a generalised suffix automaton.

Texts are lower-cased (A-Z only) and cut into words: runs of ASCII letters and
digits and of all characters beyond ASCII.  A window is ``WINDOW`` consecutive
words of a test item; an item with fewer words is one window.

1. The items' words go into suffix automata, one automaton for each block of
   some ``BLOCK_WORDS`` words (long items are cut into overlapping pieces, so
   every window is whole in a piece).  Each block is built by a Spark task.
2. The documents are streamed past a block's automaton word by word.  The state
   gives the longest run of words, ending here, that some item has.  Where it
   is ``WINDOW`` or longer, all its words are hit, and the state's class of
   ``WINDOW`` words names the items; whole short items are found along the
   suffix links.
3. Hit words that touch are one span.  ``decontaminated`` takes out spans that
   reach the length limit, and documents whose share of hit words is beyond
   the coverage limit.

A block's automaton is broadcast; ``BLOCK_WORDS`` bounds it, however many items
there are.  Test sets mostly are one block: then the documents are read once,
without a shuffle.  Each further block is a further pass over the rows written
by the pass before, which carry their spans and items along.

Cases: a null or empty text has no words, as document and as item.  A null item
id marks words as hit but is not named.  Items are told apart by their ids: rows
with the same id count once.  Each document row is judged for itself, whatever
its id.  Empty tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import kept, ready, saved, texts_of

WINDOW = 10
#: Words of one automaton (it has at most twice as many states: some 40 MB).
BLOCK_WORDS = 100_000
#: Words of one piece of a long item.
PIECE_WORDS = 4_096

#: Every byte that is no part of a word becomes a space; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else
              b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences.

    ``go`` maps state * size of the vocabulary + word to a state, ``link`` is
    the suffix link and ``length`` the longest run of a state's class."""

    def __init__(self, pieces: list[tuple[str | None, bool, list[bytes]]],
                 window: int = WINDOW) -> None:
        """``pieces``: (item id, whether a whole item, words)."""
        self.window = window
        vocabulary: dict[bytes, int] = {}
        coded = [(item, whole, [vocabulary.setdefault(w, len(vocabulary)) for w in words])
                 for item, whole, words in pieces if words]
        self.vocabulary, self.size = vocabulary, max(1, len(vocabulary))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.go = {s * self.size + w: t for s, out in enumerate(self.next) for w, t in out.items()}
        self.next = []
        self._classes()
        self._name(coded)

    def _extend(self, last: int, w: int) -> int:
        """The state of the run so far and ``w``."""
        if w in self.next[last]:
            found = self.next[last][w]
            if self.length[found] == self.length[last] + 1:
                return found
            return self._split(last, found, w)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            found = self.next[at][w]
            self.link[new] = (found if self.length[found] == self.length[at] + 1
                              else self._split(at, found, w))
        return new

    def _state(self, length: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.length.append(length)
        self.link.append(0)
        return len(self.length) - 1

    def _split(self, at: int, found: int, w: int) -> int:
        """A state of its own for the shorter runs of ``found``."""
        copy = self._state(self.length[at] + 1, dict(self.next[found]))
        self.link[copy] = self.link[found]
        self.link[found] = copy
        while at >= 0 and self.next[at].get(w) == found:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def _classes(self) -> None:
        """``wide[s]``: the class of the last ``window`` words of state s."""
        self.wide = [-1] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            if self.length[s] >= self.window:
                above = self.wide[self.link[s]]
                self.wide[s] = above if above >= 0 else s

    def _name(self, coded: list[tuple[str | None, bool, list[int]]]) -> None:
        """``items``: the distinct sets of item ids; ``named``: state -> its set's
        number; ``short``: state -> the longest whole short item that ends it."""
        of: dict[int, set[str | None]] = {}
        ends: set[int] = set()
        for item, whole, words in coded:
            s = 0
            for w in words:
                s = self.go[s * self.size + w]
                if self.wide[s] >= 0:
                    of.setdefault(self.wide[s], set()).add(item)
            if whole and len(words) < self.window:
                ends.add(s)
                of.setdefault(s, set()).add(item)
        numbers: dict[frozenset, int] = {}
        self.named = {s: numbers.setdefault(frozenset(found - {None}), len(numbers))
                      for s, found in of.items()}
        self.items = [sorted(found) for found in numbers]
        # A whole short item is the longest run of its class: nothing stands
        # before it where the item begins.
        self.short = [-1] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.short[s] = s if s in ends else self.short[self.link[s]]
        self.least = min([self.window, *(self.length[s] for s in ends)])

    def read(self, words: list[bytes]) -> tuple[list[int], set[int], int]:
        """(hit spans as start, end, start, end, ..., numbers of the item sets,
        length of the longest run)."""
        go, link, length, wide, short = self.go.get, self.link, self.length, self.wide, self.short
        size, window, least = self.size, self.window, self.least
        spans: list[int] = []
        found: set[int] = set()
        s = n = longest = 0
        for i, w in enumerate(map(self.vocabulary.get, words)):
            if w is None:
                s = n = 0
                continue
            t = go(s * size + w)
            if t is not None:
                n += 1
            else:
                while s and t is None:
                    s = link[s]
                    t = go(s * size + w)
                n = length[s] + 1
                if t is None:           # no item begins a run here
                    s = n = 0
                    continue
            s = t
            if n < least:
                continue
            hit = 0
            if n >= window:
                hit = n
                found.add(wide[s])
                longest = max(longest, n)
            end = short[s] if n == length[s] else short[link[s]]
            if end >= 0:
                hit = max(hit, length[end])
                longest = max(longest, length[end])
                found.add(end)
            if hit:
                add_span(spans, i + 1 - hit, i + 1)
        return spans, self._sets(found), longest

    def _sets(self, found: set[int]) -> set[int]:
        numbers = set()
        for s in found:
            while s >= 0 and s in self.named:
                numbers.add(self.named[s])
                s = self.short[self.link[s]]
        return numbers


def add_span(spans: list[int], start: int, end: int) -> None:
    """Add a span that ends no earlier than all before it."""
    while spans and spans[-2] >= start:
        del spans[-2:]
    if spans and spans[-1] >= start:
        spans[-1] = end
    else:
        spans += [start, end]


def merged(one: list[int], other: list[int]) -> list[int]:
    """The union of two lists of spans."""
    out: list[int] = []
    for start, end in sorted([*zip(one[::2], one[1::2], strict=True),
                              *zip(other[::2], other[1::2], strict=True)], key=lambda x: x[1]):
        add_span(out, start, end)
    return out


def cut(words: list[bytes], window: int) -> Iterator[tuple[bool, list[bytes]]]:
    """(whether whole, words) of an item's pieces, which overlap by a window less one."""
    if len(words) <= PIECE_WORDS:
        yield True, words
        return
    for k in range(0, len(words) - window + 1, PIECE_WORDS - window + 1):
        yield False, words[k:k + PIECE_WORDS]


def automata(items: DataFrame, window: int = WINDOW, item_col: str = "item_id",
             text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block, automaton`` (pickled), one row per block of items."""
    ready(items.sparkSession)
    rows = items.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                  strict=True):
                for whole, words in cut(words_of(text), window):
                    if words:
                        yield pa.RecordBatch.from_pydict(
                            {"item": pa.array([item], pa.string()), "whole": [whole],
                             "n": [len(words)], "words": pa.array([b" ".join(words)], pa.binary())})

    found = saved(rows.distinct().mapInArrow(pieces, "item string, whole boolean, n long, words binary"),
                  "item-pieces")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        held = Automaton([(i, whole, words.split()) for i, whole, words in zip(
            table["item"].to_pylist(), table["whole"].to_pylist(), table["words"].to_pylist(),
            strict=True)], window)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "automaton": pa.array([pickle.dumps(held)], pa.binary())})

    return saved(found.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
                 .groupBy("block").applyInArrow(build, "block long, automaton binary"), "automata")


def _held(name: str, raw: bytes) -> Automaton:
    """The worker's automaton, one at a time."""
    held = kept("decontaminate")
    if name not in held:
        held.clear()
        held[name] = pickle.loads(raw)
    return held[name]


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
          keep: tuple[str, ...] = (), item_col: str = "item_id", item_text_col: str = "text",
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: the ``keep`` columns, and the struct ``leak`` of ``n_words``,
    ``n_hit``, ``spans`` (starts and ends of the hit spans, in words), ``longest``
    (the longest run of words in common) and ``items`` (ids, in order)."""
    spark = docs.sparkSession
    ready(spark)
    names = automata(items, window, item_col, item_text_col, block_words)
    blocks = sorted(r["block"] for r in names.select("block").collect())
    text = f"`{text_col}`"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0)).alias("rest"),
                       F.col(text).cast("string").alias("text"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<int>").alias("spans"),
                       F.lit(0).cast("long").alias("longest"),
                       F.array().cast("array<string>").alias("items"))
    for k, block in enumerate(blocks or [None]):
        # One block at a time: the bound holds for the driver, too.
        raw = (pickle.dumps(Automaton([], window)) if block is None else
               bytes(names.where(F.col("block") == block).first()["automaton"]))
        last = k >= len(blocks) - 1
        rows = _pass(rows, raw, last)
        if not last:
            rows = saved(rows, "leaks")
    n_hit = F.expr("aggregate(transform(spans, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)")
    return rows.select(*[F.col(f"rest.`{c}`").alias(c) for c in keep],
                       F.struct("n_words", n_hit.alias("n_hit"), "spans", "longest",
                                "items").alias("leak"))


def _pass(rows: DataFrame, raw: bytes, last: bool) -> DataFrame:
    """``rows`` read past one automaton; the last pass leaves the texts out."""
    shared = rows.sparkSession.sparkContext.broadcast(raw)
    name = hashlib.sha256(raw).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _held(name, shared.value)
        for batch in batches:
            n_words, spans, longest, items = [], [], [], []
            for text, old_spans, old_longest, old_items in zip(
                    texts_of(batch.column("text")), batch.column("spans").to_pylist(),
                    batch.column("longest").to_pylist(), batch.column("items").to_pylist(),
                    strict=True):
                words = words_of(text)
                hit, sets, most = automaton.read(words)
                n_words.append(len(words))
                spans.append(merged(old_spans, hit) if old_spans else hit)
                longest.append(max(old_longest, most))
                items.append(sorted(set(old_items).union(*[automaton.items[k] for k in sets]))
                             if sets else old_items)
            cols = {"rest": batch.column("rest"), "text": batch.column("text"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "spans": pa.array(spans, pa.list_(pa.int32())),
                    "longest": pa.array(longest, pa.int64()),
                    "items": pa.array(items, pa.list_(pa.string()))}
            if last:
                del cols["text"]
            yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(read, (rows.drop("text") if last else rows).schema)


def decontaminated(docs: DataFrame, items: DataFrame, min_length: int = WINDOW,
                   max_coverage: float = 0.5, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with all its columns, without spans of at least ``min_length``
    words (shorter whole items included) in common with an item; a document
    with a greater share of such words than ``max_coverage`` goes."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    found = leaks(whole, items, min_length, "text", ("rest", "text"), item_col, item_text_col,
                  block_words)
    rows = (found.where(F.col("leak.n_hit") <= F.col("leak.n_words") * F.lit(float(max_coverage)))
            .select("rest", "text", "leak.spans"))

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(t, spans) if spans else t for t, spans in zip(
                batch.column("text").cast(pa.binary()).to_pylist(),
                batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "rest": batch.column("rest"), "text": pa.array(texts, pa.binary()).cast(pa.string())})

    left = rows.mapInArrow(take_out, rows.select("rest", "text").schema)
    return left.select(*[F.col("text").alias(c) if c == text_col else
                         F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def without(text: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans and what lies between them."""
    at = [m.span() for m in _WORDS.finditer(text)]
    out, done = [], 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[done:at[start][0]])
        done = at[end - 1][1]
    return b"".join([*out, text[done:]])


def listed(ids: Column) -> Column:
    """Lowercase hex of the sha256 of the ids, joined by commas."""
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def op13_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = leaks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items,
                  keep=("doc_id",))
    return found.select(
        "doc_id", "leak.n_words", "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        listed(F.col("leak.items")).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"))
