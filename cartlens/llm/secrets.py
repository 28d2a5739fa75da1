"""Secret scans with a trigram index, in DataFrame operations only.

Each rule is a regular expression.  The trigrams that any match must hold form
a Boolean query, derived from the expression: literals and small classes are
spelled out, alternatives become OR, what follows one another AND; an element
that can be anything ends the run.  A rule without mandatory trigrams scans all
documents.

The index lists, for every trigram that occurs in a query, the documents that
have it (letters lower-cased): a posting per trigram and document, written as a
table in order of the trigram.  The rules' queries are answered on the postings
alone.  Only candidates are then verified by the expression itself; a text that
is no rule's candidate is read by the full-scan rules only.

A match's place is found without a user function: splitting at the expression
gives the texts between the matches, extracting gives the matches, and the
running sum of their lengths gives starts and ends, in code points.  Running sums
and maxima take log n rounds over the array, and a text is cut by way of blocks of
``BLOCK`` code points, so that the work grows with a text and its matches, not with
their product.

Cases: a null or empty text has no match.  Rows with one id are indexed
together, so each is a candidate if any of them is, and is verified by its own
text; a null id is indexed under its text's hash.  Other columns play no part.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import re._parser as regex_parser
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import fresh, id_and_text, saved

#: Trigram query: True (no demand), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple


@dataclass(frozen=True)
class Rule:
    """A match counts if group ``group`` has at least ``least`` characters;
    matches are leftmost and do not overlap, whether they count or not."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Fixed by the result's contract.  A match of ``[0-9a-f]+`` is a maximal run, so
#: asking for 16 characters in the expression finds the runs that count, and so
#: does asking for 18 of the access rule, whose matches end where a run ends.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds, whose spans are added.
MORE = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9+/_.=-]{20,}"),
)
RULES = (*BASE, *MORE)
#: A class of at most so many characters is spelled out, and so many strings
#: may stand for one run.
CLASS_SIZE, RUN_SIZE = 6, 64
#: Code points of a block in which a long text is cut.
BLOCK = 256


def _conj(parts: list[Query]) -> Query:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _disj(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    if True in parts or not parts:
        return True
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _demands(run: frozenset[str]) -> Query:
    """What a text must have that holds one of the run's strings: trigrams
    that cover the string, overlapping only at its end."""
    return _disj([_conj([s[k:k + 3] for k in sorted({*range(0, len(s) - 2, 3), len(s) - 3})
                         if k >= 0]) for s in sorted(run)])


def _spelled(op, arg) -> frozenset[str] | None:
    """All (lower-cased) strings an element can match, if these are few."""
    name = str(op)
    if name == "LITERAL":
        return frozenset({chr(arg).lower()})
    if name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
        size = sum(1 if str(o) == "LITERAL" else a[1] - a[0] + 1 for o, a in arg)
        if size <= CLASS_SIZE:
            return frozenset(chr(c).lower() for o, a in arg
                             for c in ([a] if str(o) == "LITERAL" else range(a[0], a[1] + 1)))
    return None


def _parts(items) -> tuple[frozenset[str] | None, Query]:
    """(all strings a sequence can match, or None; its demands)."""
    run, whole, found = frozenset({""}), True, []
    for op, arg in items:
        name, strings, inner = str(op), _spelled(op, arg), True
        if name == "SUBPATTERN":
            strings, inner = _parts(arg[3])
        elif name == "BRANCH":
            each = [_parts(b) for b in arg[1]]
            inner = _disj([q for _, q in each])
            if all(s is not None for s, _ in each):
                strings = frozenset().union(*[s for s, _ in each])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 1:
            strings, _ = _parts(arg[2])
            strings = None if strings is None else strings | {""}
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            strings, inner = None, _parts(arg[2])[1]
        elif name == "AT":
            continue
        if strings is not None and len(run) * len(strings) <= RUN_SIZE:
            run = frozenset(a + b for a in run for b in strings)
            continue
        found += [_demands(run), inner if strings is None else _demands(strings)]
        run, whole = frozenset({""}), False
    return (run if whole else None), _conj([*found, _demands(run)])


def trigram_query(pattern: str) -> Query:
    """The trigrams (lower-cased) that every match of ``pattern`` must hold."""
    return _parts(regex_parser.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _answer(query: Query, has: dict[str, Column]) -> Column:
    if isinstance(query, str):
        return has[query]
    return reduce(lambda a, b: (a & b) if query[0] == "and" else (a | b),
                  [_answer(q, has) for q in query[1]])


def _key(id_col: Column, text: Column) -> Column:
    return F.coalesce(id_col.cast("long"), F.xxhash64(text))


def any_of(trigrams: list[str]) -> str:
    """An expression that finds, in one pass and at every place of a text, the
    trigram that begins there (group 1)."""
    by: dict[str, list[str]] = {}
    for t in sorted(trigrams):
        by.setdefault(t[0], []).append(re.escape(t[1:]))
    return "(?=(" + "|".join(f"{re.escape(c)}(?:{'|'.join(r)})" for c, r in by.items()) + "))"


def trigram_index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings ``trigram, k`` of (k, text) rows for the wanted trigrams, found
    in one pass over each text, without repeats, written as a table ordered by trigram.  Postings of one
    trigram are dealt over many tasks by k as well: a common one is no task's
    list."""
    here = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(any_of(wanted)), F.lit(1)))
    return saved(docs.select("k", F.explode(here).alias("trigram")).distinct()
                 .repartitionByRange("trigram", "k").sortWithinPartitions("trigram", "k"),
                 "trigram-index")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``k, kinds``: per key the indexed rules whose queries its postings
    answer.  All rules' postings are intersected by one aggregate."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = sorted(set().union(*map(trigrams, queries.values())))
    flags = index.groupBy("k").agg(*[F.max(F.when(F.col("trigram") == t, True).otherwise(False))
                                     .alias(f"t{k}") for k, t in enumerate(wanted)])
    has = {t: F.col(f"t{k}") for k, t in enumerate(wanted)}
    kinds = F.array_compact(F.array(*[F.when(_answer(q, has), F.lit(kind))
                                      for kind, q in queries.items() if q is not True]))
    return flags.select("k", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each element joined with all before it.  In round j an element takes in
    the 2^j elements before those that it has."""
    def rounds(v: Column) -> Column:
        last = F.ceil(F.log2(F.greatest(F.size(v), F.lit(2)))).cast("int")
        shifts = F.transform(F.sequence(F.lit(0), last), lambda j: F.pow(F.lit(2), j).cast("int"))
        return F.aggregate(shifts, v, lambda acc, d: F.transform(acc, lambda x, i: F.when(
            i >= d, join(x, F.get(acc, i - d))).otherwise(x)))
    return _bound(values, rounds)


def spans_of(text: Column, rule: Rule) -> Column:
    """The counting matches of a rule: array of (start, end)."""
    pattern = F.lit(rule.pattern)
    lengths = lambda found: F.transform(found, lambda x: F.length(x).cast("long"))
    sizes = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    held = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else sizes
    found = F.struct(lengths(F.split(text, rule.pattern, -1)).alias("gaps"), sizes.alias("sizes"),
                     held.alias("held"))

    def spans(m: Column) -> Column:
        # Behind the last match there is a gap more.
        steps = F.zip_with(m["gaps"], m["sizes"], lambda g, s: g + F.coalesce(s, F.lit(0)))
        ends = _running(steps, lambda a, b: a + b)
        rows = F.arrays_zip(ends.alias("end"), m["sizes"].alias("size"), m["held"].alias("held"))
        return F.transform(F.filter(rows, lambda r: r["held"] >= rule.least), lambda r: F.struct(
            (r["end"] - r["size"]).alias("start"), r["end"].alias("end")))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.when(text.rlike(rule.pattern), _bound(found, spans)).otherwise(empty)


def _labelled(spans: Column, number: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"),
        F.lit(kind).alias("kind")))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
               text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the column ``spans_col``: array of (kind, start, end,
    number), ordered by start and then by the rules' order (``number``)."""
    key_col, kinds_col = fresh(docs, "_k"), fresh(docs, "_kinds")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.withColumn(key_col, _key(F.col(f"`{id_col}`"), text))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = sorted(set().union(*map(trigrams, queries.values())))
    if wanted:
        index = trigram_index(keyed.select(F.col(key_col).alias("k"), text.alias("text")), wanted)
        hits = candidates(index, rules).select(F.col("k").alias(key_col),
                                               F.col("kinds").alias(kinds_col))
        keyed = keyed.join(hits, key_col, "left")
    else:
        keyed = keyed.withColumn(kinds_col, F.array().cast("array<string>"))
    kind = "array<struct<start:bigint,number:int,end:bigint,kind:string>>"
    each = []
    for number, rule in enumerate(rules):
        found = _labelled(spans_of(text, rule), number, rule.kind)
        if queries[rule.kind] is not True:
            found = F.when(F.array_contains(kinds_col, rule.kind), found)
        each.append(F.coalesce(found, F.array()).cast(kind))
    return keyed.withColumn(spans_col, F.array_sort(F.concat(*each))).drop(key_col, kinds_col)


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, each span replaced by ``[kind]``; of
    spans that overlap the first is named and all are gone.  Texts without a
    secret stay as they are."""
    spans_col = fresh(docs, "_spans")
    found = with_spans(docs, rules, id_col, text_col, spans_col)
    text, spans = F.col(f"`{text_col}`"), F.col(spans_col)
    done = _bound(F.struct(spans.alias("spans"), F.regexp_extract_all(
        text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
        _running(F.transform(spans, lambda s: s["end"]), F.greatest).alias("ends")), _replaced)
    new = F.when(F.size(spans) > 0, done).otherwise(text)
    return found.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`")
                          for c in docs.columns])


def _replaced(v: Column) -> Column:
    """The text in ``blocks`` with the ``spans`` replaced; ``ends`` has the greatest
    end up to each span."""
    def cut(a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        blocks = F.slice(v["blocks"], first + 1, F.floor((b - 1) / BLOCK).cast("int") - first + 1)
        return F.when(b > a, F.array_join(blocks, "").substr(
            (a - first * BLOCK + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def piece(s: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(v["ends"], i - 1)).otherwise(0)
        return F.when(s["start"] >= before, F.concat(cut(before, s["start"]), F.lit("["), s["kind"],
                                                     F.lit("]"))).otherwise("")

    n = F.size(v["blocks"])
    last = F.element_at(v["blocks"], -1)
    return F.concat(F.array_join(F.transform(v["spans"], piece), ""), cut(
        F.element_at(v["ends"], -1), ((n - 1) * BLOCK + F.length(last)).cast("long")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(docs: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["number"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return with_spans(id_and_text(docs)).select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
