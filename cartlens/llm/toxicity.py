"""Toxicity by a weighted lexicon.

A text is folded: compatibility forms and look-alike letters of other scripts
become plain ones, digits and signs that stand in for letters become these,
case goes, and what is left is words parted by single spaces.  Digits and signs
at a word's end may be letters or not (``a55``, ``idiot99``): the word is read
without them, and where that is no hit, with them.  An Aho-Corasick automaton
finds the lexicon's words and word beginnings in it in one pass; l and i, which
1, ! and | stand for alike, are one letter to it.  Hits inside an exception phrase do not count; of hits that begin at one place
the heaviest does.  The sum of the weights, alone and by length, goes through
a logistic curve: the score, from 0 to 1.

The lexicon is learned from labelled documents: words, and beginnings of words
of 4 to 6 letters, that many more toxic than other documents have, weighted by
the logarithm of the ratio.  How few documents may carry an entry depends on
chance alone, not on the number of documents: a word of one language or topic
enters however small that one's part is.  A phrase of two words around such a word, which
several other documents and no toxic one have, becomes an exception.  Learning
takes at most ``SAMPLE`` labelled documents of each class, chosen by a hash of
their ids, so that the ids can be broadcast, and one text of each id; the share of
toxic labels is taken from all of them.  All entries and exceptions that pass the
tests are kept: as each needs ``SUPPORT`` documents of the sample, that bounds
them.  Scoring reads every text whole.

Cases: a null or empty text has no hits and gets the score of such a text.
Labels whose doc_id or class is null are left out; of several for one id the
toxic one counts.  Without labelled documents of either class the lexicon is
empty and every score is the share of toxic labels (0 if there are none).
Rows with equal or null ids are scored each by its own text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import given_back, id_and_text, kept, light, ready, saved

#: Labelled documents of each class that the lexicon is learned from, at most.
SAMPLE = 20_000
#: Toxic documents that must have an entry; entries that may be expected by mere
#: chance among all terms counted; the least weight (a ratio of 5).
SUPPORT = 5
BY_CHANCE = 1.0
LEAST_WEIGHT = math.log(5)
STEMS = (4, 5, 6)
#: Terms that a task counts before it sends them on.
HELD_TERMS = 200_000

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "ո": "n", "ս": "u", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a",
    "­": "", "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "",
}
#: Digits and signs that stand in for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "i"}

_FROM_OTHERS = str.maketrans(HOMOGLYPHS)
_LETTERS = str.maketrans(SUBSTITUTES)
#: A run of letters and substitutes that has a substitute.
_RUN = re.compile(r"(?<![^\W\d_])[^\W\d_]*[013457890@$!|](?:[^\W\d_]|[013457890@$!|])*")
_SIGNS = re.compile(r"[0-9@$!|]")
_WORDS = re.compile(r"[^\W\d_]+")
#: A letter that marks the second reading of the word before.
_SECOND = "\ua7ff"


def _stood_in(match: re.Match) -> str:
    """A run with its substitutes read as letters: without those at its end, and
    then, marked, with them.  A run without a letter stays."""
    run = match[0].lstrip("!|")
    word = run.rstrip("013457890@$!|")
    if not _WORDS.search(word):
        return match[0]
    tail = run[len(word):]
    if not tail.strip("!"):
        return word.translate(_LETTERS) + tail
    return f"{word.translate(_LETTERS)} {_SECOND}{run.translate(_LETTERS)} "


def readings(text: str) -> tuple[str, list[tuple[int, str]]]:
    """``" word word "``, the folded words, parted and enclosed by spaces; and the
    second readings of some: (place of the space before the word, reading)."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = text.replace(_SECOND, " ").lower().translate(_FROM_OTHERS)
    else:
        text = text.lower()
    if _SIGNS.search(text):
        text = _RUN.sub(_stood_in, text)
    words = _WORDS.findall(text)
    if _SECOND not in text:
        return f" {' '.join(words)} ", []
    first, second, place, at = [], [], 0, 0
    for w in words:
        if w[0] == _SECOND:
            second.append((place, w[1:]))
        else:
            first.append(w)
            place, at = at, at + len(w) + 1
    return f" {' '.join(first)} ", second


def fold(text: str) -> str:
    """``" word word "``: the folded words, parted and enclosed by spaces."""
    return readings(text)[0]


@dataclass
class Lexicon:
    """``words`` and ``stems`` (word beginnings) with weights, phrases that
    excuse the hits in them, and the curve's coefficients."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    prior: float = 0.0

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        entries: dict[str, list] = {}
        for pattern, weight in [*[(f" {w} ", x) for w, x in lexicon.words.items()],
                                *[(f" {s}", x) for s, x in lexicon.stems.items()]]:
            found = entries.setdefault(pattern.replace("l", "i"), [0.0, False])
            found[0] = max(found[0], weight)
        for phrase in lexicon.exceptions:
            entries.setdefault(fold(phrase).replace("l", "i"), [0.0, False])[1] = True
        self.automaton = ahocorasick.Automaton()
        for pattern, (weight, excuse) in entries.items():
            self.automaton.add_word(pattern, (len(pattern), weight, excuse))
        if entries:
            self.automaton.make_automaton()
        self.empty = not entries

    def hits(self, folded: str, second: Iterable[tuple[int, str]] = ()) -> dict[int, float]:
        """Weight by the place (of the space) before the word that is hit."""
        found: dict[int, float] = {}
        if self.empty:
            return found
        excused = []
        for end, (size, weight, excuse) in self.automaton.iter(folded.replace("l", "i")):
            start = end - size + 1
            if weight > found.get(start, 0.0):
                found[start] = weight
            if excuse:
                excused.append((start, end))
        for place, word in second:
            if place not in found:
                weight = max((w for end, (size, w, _) in self.automaton.iter(
                    f" {word} ".replace("l", "i")) if end == size - 1), default=0.0)
                if weight:
                    found[place] = weight
        for a, b in excused:
            for start in [s for s in found if a <= s < b]:
                del found[start]
        return found

    def features(self, text: str) -> tuple[float, float]:
        folded, second = readings(text)
        total = sum(self.hits(folded, second).values())
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100 * total / (folded.count(" ") - 1))

    def score(self, text: str) -> float:
        if self.empty:
            return self.lexicon.prior
        a, b, c = self.lexicon.curve
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * x + c * y))))


def _matcher(lexicon: Lexicon) -> Matcher:
    """The worker's matcher; the last few lexicons' automata are kept."""
    matchers, key = kept("toxicity"), repr(lexicon)
    if key not in matchers:
        if len(matchers) >= 4:
            matchers.clear()
        matchers[key] = lexicon.matcher()
    return matchers[key]


def score_column(lexicon: Lexicon, text: Column) -> Column:
    """The score of each text (null: as an empty text)."""

    @F.pandas_udf("double")
    def score(texts):
        given_back()
        m = _matcher(lexicon)
        return type(texts)([m.score(t or "") for t in texts], dtype="float64")

    return score(text.cast("string"))


def terms(folded: str) -> set[str]:
    """Words, as ``w word``, and word beginnings, as ``s stem``."""
    words = set(folded.split())
    out = {f"w {w}" for w in words}
    for n in STEMS:
        out.update(f"s {w[:n]}" for w in words if len(w) > n)
    return out


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str, sample: int) -> DataFrame:
    """``text, toxic`` of the sampled labelled documents, written out.  Of rows
    with one id the least text counts."""
    ids = (labels.groupBy("doc_id").agg(F.max(label_col).alias("toxic"))
           .withColumn("_h", F.xxhash64("doc_id")))
    pick = lambda y: (ids.where(F.col("toxic") == y).orderBy("_h", "doc_id")
                      .limit(sample).select("doc_id", "toxic"))
    picked = saved(pick(1).unionByName(pick(0)), "toxic-ids")
    return saved(docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id")
                 .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
                 .select("text", "toxic"), "toxic-sample")


def _counted(sample: DataFrame, make, least: int) -> DataFrame:
    """``term, pos, neg``: documents of either class that have a term; only
    those that ``least`` documents of one class have."""

    def sent(pos: Counter, neg: Counter) -> Iterator[pa.RecordBatch]:
        names = list(pos.keys() | neg.keys())
        for k in range(0, len(names), 50_000):
            part = names[k:k + 50_000]
            yield pa.RecordBatch.from_pydict({
                "term": part, "pos": pa.array([pos[t] for t in part], pa.int64()),
                "neg": pa.array([neg[t] for t in part], pa.int64())})
        pos.clear()
        neg.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                (pos if toxic else neg).update(make(text or ""))
                if len(pos) + len(neg) > HELD_TERMS:
                    yield from sent(pos, neg)
        yield from sent(pos, neg)

    return (sample.mapInArrow(light(run), "term string, pos long, neg long").groupBy("term")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .where(F.greatest("pos", "neg") >= least))


def _surprise(n_pos: int, n_neg: int) -> Column:
    """Minus the logarithm of a bound (Chernoff's) of the chance that so many of
    a term's documents are toxic, were it as frequent in both classes."""
    both = F.col("pos") + F.col("neg")
    part = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(
        F.col(c) * (n_pos + n_neg) / (both * n))).otherwise(0.0)
    return part("pos", n_pos) + part("neg", n_neg)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE,
          exceptions: Iterable[str] = ()) -> Lexicon:
    """A lexicon from ``labels`` (doc_id and ``label_col``, 1 for toxic)."""
    ready(docs.sparkSession)
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col)
                           .cast("int").alias(label_col)).where(
        f"doc_id IS NOT NULL AND `{label_col}` IN (0, 1)")
    share = labels.agg(F.avg(label_col)).first()[0] or 0.0
    data = _labelled(id_and_text(docs, id_col, text_col), labels, label_col, sample)
    sizes = dict(data.groupBy("toxic").count().collect())
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return Lexicon(prior=float(share), exceptions=tuple(exceptions))

    weight = (F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1)))
    counted = saved(_counted(data, lambda t: terms(fold(t)), SUPPORT), "toxic-terms")
    least = math.log(max(1, counted.count()) / BY_CHANCE)
    rows = (counted.where((F.col("pos") >= SUPPORT) & (_surprise(n_pos, n_neg) >= least))
            .withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
            .orderBy("term").collect())
    lexicon = _without_implied({r["term"]: (r["weight"], r["pos"]) for r in rows})
    lexicon.exceptions = (*exceptions, *_phrases(data, lexicon))
    lexicon.curve = _curve(data, lexicon, float(share))
    lexicon.prior = float(share)
    return lexicon


def _without_implied(found: dict[str, tuple[float, int]]) -> Lexicon:
    """Of entries that begin alike keep the longest, unless a shorter one is
    in clearly more documents; then leave out what a kept stem says as well."""
    most: dict[str, int] = {}
    for term, (_, pos) in found.items():
        text = term[2:]
        for n in STEMS:
            if n < len(text):
                most[text[:n]] = max(most.get(text[:n], 0), pos)
    stems = {t[2:]: w for t, (w, pos) in found.items()
             if t[0] == "s" and most.get(t[2:], 0) < 0.9 * pos}
    implied = lambda t, w: any(stems.get(t[:n], -1.0) >= w - 0.7
                               for n in STEMS if n < len(t))
    return Lexicon(words={t[2:]: w for t, (w, _) in found.items()
                          if t[0] == "w" and not implied(t[2:], w)},
                   stems={t: w for t, w in stems.items() if not implied(t, w)})


def _phrases(data: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around a hit that at least ``SUPPORT`` other documents
    and no toxic one have."""

    def around(text: str) -> set[str]:
        folded, out = fold(text), set()
        hits = _matcher(lexicon).hits(folded)
        if hits:
            at, words = {}, folded.split()
            place = 0
            for k, w in enumerate(words):
                at[place] = k
                place += len(w) + 1
            for start in hits:
                k = at[start]
                out.update(" ".join(words[a:a + 2]) for a in (k - 1, k)
                           if a >= 0 and a + 2 <= len(words))
        return out

    rows = _counted(data, around, SUPPORT).where("pos = 0").orderBy("term").collect()
    return [r["term"] for r in rows]


def _curve(data: DataFrame, lexicon: Lexicon, share: float) -> tuple[float, float, float]:
    """Logistic regression over a grid of the two features, counted on Spark,
    with the classes weighted to ``share``."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, found = _matcher(lexicon), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                x, y = m.features(text or "")
                found[(round(x * 5), round(y * 5), toxic)] += 1
        if found:
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([k[0] for k in found], pa.int32()),
                "y": pa.array([k[1] for k in found], pa.int32()),
                "toxic": pa.array([k[2] for k in found], pa.int32()),
                "n": pa.array(list(found.values()), pa.int64())})

    rows = (data.mapInArrow(light(cells), "x int, y int, toxic int, n long").groupBy("x", "y", "toxic")
            .agg(F.sum("n").alias("n")).collect())
    grid = np.array([(1.0, r["x"] / 5, r["y"] / 5) for r in rows])
    label = np.array([r["toxic"] for r in rows], float)
    count = np.array([r["n"] for r in rows], float)
    for y, s in ((1.0, share), (0.0, 1 - share)):
        count[label == y] *= s / count[label == y].sum()
    count *= sum(r["n"] for r in rows)
    beta, ridge = np.zeros(3), np.diag([0.1, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(grid @ beta, -30, 30)))
        step = np.linalg.solve((grid * (count * p * (1 - p))[:, None]).T @ grid + ridge,
                               grid.T @ (count * (label - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def non_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    lexicon = learn(docs, labels.where(~held_out()), id_col=id_col, text_col=text_col)
    return docs.where(score_column(lexicon, F.col(f"`{text_col}`")) < threshold)


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    lexicon = learn(docs, labels.where(~held_out()))
    return (id_and_text(docs)
            .select("doc_id", held_out().alias("held_out"),
                    score_column(lexicon, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
