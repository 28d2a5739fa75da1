"""Spelling variants: words one edit apart, found by a relational trie frontier.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at
least ``MIN_LENGTH`` code points that occur at least ``MIN_COUNT`` times.  Two are
near if one insertion, deletion or replacement of a code point makes one of the
other.

The words form two tries, one of the words and one of the reversed words, kept
as a distributed table: one row per node below which two words or more lie, with
its edges (at most one for each letter, so the row is bounded).  A row of the
frontier is a state (word, position, node, edits).  It begins, without an edit,
at the node of half the word, forwards and backwards: an edit in the later half
is met in the one trie, one in the earlier half in the other, so the many
branches near the roots are never walked.  Level by level the states are joined
with their nodes' edges:

* without an edit, on the word's own letter; or with a replacement on any later
  letter of the alphabet (each pair is found from one of its words); or with the
  letter left out (an insertion is a deletion seen from the other word);
* after the edit, on the word's own letters alone.

Behind each edge a mask has one bit by the hash of every word there, and a state
whose word's bit is not set ends at once.  A state after its edit with at most
``FEW`` words below goes to the terminal test: is the word that it would become one
of the words?  The others walk on.  A terminal state after one edit is a pair of
neighbours.  Each level is written to the shared folder, so no lineage grows.
States at one node share a join key; the node's side is one row of it, so adaptive
execution splits a hot node's states over tasks.

Words longer than ``TRIE_LETTERS`` would need one join per letter; they are
compared by hashes of the word with each letter left out, and pairs that share
one are verified.

Cases: a null text has no words; a null id is written as nothing.  Rows of one
id are separate texts.  No words, or none that is near another, give an empty
result or null forms; ties are settled by code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import id_and_text, ready, saved, texts_of

MIN_LENGTH = 5
MIN_COUNT = 3
#: A form is at least so many times as frequent.
RATIO = 2
#: Words of up to so many code points go through the tries.
TRIE_LETTERS = 32
#: Words behind an edited state for which it need not walk on.
FEW = 32
#: op11 misspells one word in so many.
NOISE = 97
#: Distinct words a task counts before it sends them on.
HELD_WORDS = 400_000

#: Letters beyond ASCII are the two-byte characters that begin with C3.
_OTHER = re.compile(rb"[\xc2\xc4-\xf7][\x80-\xbf]+")
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))
#: Modulus and base of the hashes of long words.
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def letters_of(text: bytes) -> list[bytes]:
    """The text's runs of letters, A-Z lower-cased."""
    if not text.isascii():
        text = _OTHER.sub(b" ", text)
    return text.translate(_LETTERS).split()


def misspelt(word: bytes, h: int) -> bytes:
    """The word without its code point number h mod length."""
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                noise: int | None = None) -> DataFrame:
    """``word, n`` over all texts.  With ``noise``, a word of a text whose crc32 of
    ``<id>:<word>`` that number divides loses a letter there before it is counted."""
    ready(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def sent(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()),
             pa.array(list(held.values()), pa.int64())],
            schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        crc = zlib.crc32
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                    strict=True):
                words = letters_of(text)
                if noise:
                    begin = crc(b":" if doc_id is None else b"%d:" % doc_id)
                    bad = {w: misspelt(w, crc(w, begin)) for w in set(words)
                           if not crc(w, begin) % noise}
                    if bad:
                        words = [bad.get(w, w) for w in words]
                held.update(words)
                if len(held) > HELD_WORDS:
                    yield sent(held)
                    held = Counter()
        yield sent(held)

    return (id_and_text(docs, id_col, text_col).mapInArrow(count, "word string, n long")
            .where(F.length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _turned(words: DataFrame) -> DataFrame:
    """``dir, s, k``: each word and its reverse, and the letters of the half that
    an edit leaves alone."""
    half = F.floor(F.length("word") / 2).cast("int")
    ways = [F.struct(F.lit(0).alias("dir"), F.col("word").alias("s"), half.alias("k")),
            F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("s"),
                     (F.length("word") - half).alias("k"))]
    return words.select(F.explode(F.array(*ways)).alias("way")).select("way.*")


def tries(words: DataFrame) -> DataFrame:
    """``dir, node, depth, edges``: nodes with at least two words below, from half
    of each word's length on.  An edge has the letter ``c`` (empty where a word
    ends at the node), the number ``n`` of words behind it, the least of their
    hashes, and a ``mask`` of one bit by each hash: a word whose bit is not set is not
    there.
    ``dir`` is 0 for the words, 1 for the reversed words."""
    both = _turned(words)
    steps = both.select("dir", "s", F.xxhash64("s").alias("h"),
                        F.explode(F.sequence("k", F.length("s"))).alias("depth"))
    # Counts, hashes and masks only: the edges' sums stay in a hash aggregate.
    edges = (steps.select("dir", F.expr("substring(s, 1, depth)").alias("node"),
                          F.expr("substring(s, depth + 1, 1)").alias("c"), "h")
             .groupBy("dir", "node", "c")
             .agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("one"),
                  F.bit_or(F.expr(_BIT.format("h"))).alias("mask")))
    return (edges.groupBy("dir", "node")
            .agg(F.collect_list(F.struct("c", "n", "one", "mask")).alias("edges"),
                 F.sum("n").alias("n"))
            .where(F.col("n") > 1).drop("n").withColumn("depth", F.length("node")))


#: One of 64 bits by a hash.
_BIT = "shiftleft(1L, CAST(pmod({}, 64) AS INT))"
#: A state is (dir, s, y, k): the word ``s``, the word ``y`` that its edit makes of
#: it (null: no edit yet), and the node ``k`` letters down.  ``a`` and ``b`` are the
#: word's letters there and behind, ``d`` is the letter of ``y``.  An edge leads on:
#: by the letter of ``y``, by the own one, or by one that replaces it; and by the
#: letter behind, the own one left out.
_NEXT = """concat(
  transform(
    filter(edges, e -> IF(y IS NOT NULL, e.c = d,
                          a <> '' AND (e.c > a OR e.c = a AND e.n > 1))),
    e -> named_struct('y', CASE WHEN y IS NOT NULL THEN y
                                WHEN e.c <> a THEN concat(head, e.c, tail) END,
                      'k', k + 1, 'n', e.n, 'one', e.one, 'mask', e.mask)),
  transform(
    filter(edges, e -> y IS NULL AND a <> '' AND e.c = b AND b <> a),
    e -> named_struct('y', concat(head, tail),
                      'k', k + 1, 'n', e.n, 'one', e.one, 'mask', e.mask)))"""


def trie_pairs(words: DataFrame) -> DataFrame:
    """``word, other``: pairs one edit apart, each from one side (a pair may occur
    twice)."""
    nodes = saved(tries(words), "trie")
    open_ = _turned(words).select("dir", "s", F.lit(None).cast("string").alias("y"), "k")
    found, level = [], 0
    while True:
        at = open_.withColumns({c: F.expr(x) for c, x in {
            "node": "substring(coalesce(y, s), 1, k)", "a": "substring(s, k + 1, 1)",
            "b": "substring(s, k + 2, 1)", "d": "substring(y, k + 1, 1)"}.items()})
        step = (at.join(nodes.where(F.col("depth") >= level), ["dir", "node"])
                .withColumns({"head": F.expr("substring(s, 1, k)"),
                              "tail": F.expr("substring(s, k + 2)")})
                .select("dir", "s", F.explode(F.expr(_NEXT)).alias("next")).select("dir", "s", "next.*")
                .withColumn("h", F.xxhash64("y"))
                .where(f"y IS NULL OR (n > 1 OR one = h) AND (mask & {_BIT.format('h')}) <> 0")
                .select("dir", "s", "y", "k", (F.col("y").isNotNull() & (F.col("n") <= FEW))
                        .alias("ended")))
        states = saved(step, "frontier")
        found.append(states.where("ended").select("dir", "s", "y"))
        open_ = states.where("NOT ended").drop("ended")
        level += 1
        if open_.isEmpty():
            break
    ended = found[0]
    for more in found[1:]:
        ended = ended.unionByName(more)
    turned = [F.when(F.col("dir") == 1, F.reverse(c)).otherwise(F.col(c)) for c in ("s", "y")]
    return (ended.select(turned[0].alias("word"), turned[1].alias("other"))
            .join(words.select(F.col("word").alias("other")), "other", "left_semi")
            .select("word", "other"))


def long_pairs(words: DataFrame) -> DataFrame:
    """``word, other`` for words of any length: pairs that share the hash of the
    word with a letter left out (at one place, or of one and the whole other)."""
    schema = pa.schema([("id", pa.int64()), ("at", pa.int32()), ("h", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                at, hashes = left_out(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(at), pa.int64()), pa.array(at, pa.int32()),
                     pa.array(hashes, pa.int64())], schema=schema)

    named = saved(words.select(F.monotonically_increasing_id().alias("id"), "word"), "long-words")
    keys = saved(named.mapInArrow(hashed, "id long, at int, h long"), "long-keys")
    a, b = keys.where("at >= 0").alias("a"), keys.alias("b")
    # The same place left out (replacement), or nothing left out (at = -1).
    pairs = (a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.id") != F.col("b.id"))
                    & ((F.col("b.at") == -1)
                       | ((F.col("a.at") == F.col("b.at")) & (F.col("a.id") < F.col("b.id")))))
             .select(F.col("a.id").alias("id"), F.col("b.id").alias("other_id")).distinct())
    other = named.select(F.col("id").alias("other_id"), F.col("word").alias("other"))
    return (pairs.join(named, "id").join(other, "other_id")
            .where(F.levenshtein("word", "other", 1) == 1).select("word", "other"))


def left_out(word: str) -> tuple[list[int], list[int]]:
    """(places, hashes): of the whole word (place -1) and without each letter."""
    after, power = [0] * (len(word) + 1), 1
    for i in range(len(word) - 1, -1, -1):
        after[i] = (after[i + 1] + ord(word[i]) * power) % _MODULUS
        power = power * _BASE % _MODULUS
    powers = [1]
    for _ in word:
        powers.append(powers[-1] * _BASE % _MODULUS)
    at, hashes, before = [-1], [after[0]], 0
    for i, c in enumerate(word):
        rest = len(word) - 1 - i
        at.append(i)
        hashes.append((before * powers[rest] + after[i + 1]) % _MODULUS)
        before = (before * _BASE + ord(c)) % _MODULUS
    return at, hashes


def near_pairs(words: DataFrame, trie_letters: int = TRIE_LETTERS) -> DataFrame:
    """``word, other`` for every two distinct words one edit apart, both ways.
    Words of just ``trie_letters`` go both ways, so no pair falls between."""
    length = F.length("word")
    pairs = trie_pairs(words.where(length <= trie_letters))
    long = words.where(length >= trie_letters)
    if not long.where(length > trie_letters).isEmpty():
        pairs = pairs.unionByName(long_pairs(long))
    both = F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"),
                                                       F.col("word").alias("other")))
    return pairs.select(F.explode(both).alias("pair")).select("pair.*").distinct()


def variants(words: DataFrame, ratio: float = RATIO,
             trie_letters: int = TRIE_LETTERS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (word, n)."""
    words = saved(words.select("word", F.col("n").cast("long").alias("n")), "words")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (near_pairs(words, trie_letters).join(others, "other").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("w")))
                 .alias("b")))
    large = -F.col("b.n") >= F.col("n") * F.lit(ratio)
    formed = saved(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("b.w")).alias("form"), F.when(large, -F.col("b.n")).alias("form_n")),
        "forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: the end of each word's chain of forms.  Counts grow along a
    chain by the ratio, so it is short, and each round doubles what is known."""
    while True:
        ends = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = saved(links.join(ends, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"),
            F.col("beyond").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def op11_spelling(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs, noise=NOISE))
