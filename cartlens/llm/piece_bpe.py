"""SentencePiece BPE by a prefix table, and decoding by the library.

The pieces of a BPE model are merged in order of their scores.  For such a
vocabulary the last token of a prefix's encoding is unique, and a row of tokens
is the encoding of its text if and only if each two neighbours are: if the
encoding of the two together is the two.  So one pass over a word is enough:

* an Aho-Corasick automaton gives, at each place, the pieces that end there;
* of these the one is stored whose left neighbour, the last token of the prefix
  before it, goes with it (or that begins the word);
* the ids are recovered from the end of the word backwards.

Whether two tokens go together is tested by merging the two as the model would,
and remembered.  Pieces that no merging of their own text leads to are left out.

A text is parted at spaces: no piece goes on after a space, but for the pieces of
spaces alone, which have the lowest score of all, so they form after all others
from the spaces left over, leftmost first.  Characters outside the vocabulary
stand alone and become their bytes.

Distinct words are encoded once for each worker and remembered up to a bound.

Cases: a null or empty text has no ids and decodes to the empty text.  Rows with
equal or null ids are encoded each by its own text.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from cartlens.llm.common import id_and_text, kept, ready

DEFAULT_MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Distinct words, and pairs of tokens, that a worker remembers before it
#: starts anew; longer words are not remembered.
MEMO_WORDS, MEMO_PAIRS, MEMO_LENGTH = 1_000_000, 1_000_000, 64
RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def model_path(path: str | None) -> str:
    """The given model, or the public 32k one."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


def model(path: str) -> "PieceBpe":
    """The worker's encoder for a model file."""
    models = kept("pieces")
    if path not in models:
        models[path] = PieceBpe(path)
    return models[path]


class PieceBpe:
    """Encodes as ``SentencePieceProcessor.encode`` does, without sampling and
    begin or end ids, for BPE models that keep texts as they are (identity
    normalizer, a space put in front, spaces kept)."""

    def __init__(self, path: str) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError(f"{path}: not a model that keeps texts as they are")
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.runs = {len(p): i for p, i in self.ids.items() if p.strip(SPACE) == ""}
        if any(SPACE in p[1:] for p in self.ids if p.strip(SPACE)):
            raise ValueError(f"{path}: a piece goes on after a space")
        self.bare = self.ids[SPACE]
        self.texts = {i: p for p, i in self.ids.items()}
        #: Neighbouring characters that some piece holds; between others no
        #: piece goes on.
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) == 1 or (piece.strip(SPACE) and self.merged(piece) == [piece]):
                self.automaton.add_word(piece, (len(piece), self.ids[piece]))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """The model's own rule, for short texts: merge the best-scored pair,
        the leftmost of equals, until no two neighbours form a piece."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def together(self, left: int, right: int) -> bool:
        """Whether the encoding of both texts together is the two tokens."""
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs = {}
        pair = [self.texts[left], self.texts[right]]
        known = self.pairs[left << 32 | right] = self.merged("".join(pair)) == pair
        return known

    def tokens(self, text: str) -> list[int]:
        """The ids of a text in which a space stands at most at the front."""
        last, back = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        last[0], known, together, done = -2, self.pairs.get, self.together, 0
        for end, (size, piece) in self.automaton.iter(text):
            if end < done:
                continue
            before = last[end + 1 - size]
            if before >= 0:
                good = known(before << 32 | piece)
                if good is None:
                    good = together(before, piece)
                if not good:
                    continue
            elif before == -1:
                continue
            done = end + 1
            last[done], back[done] = piece, size
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= back[at]
        out.reverse()
        return out

    def word(self, word: str) -> bytes:
        """The ids (little-endian, 4 bytes) of a space and a word."""
        known = self.words.get(word)
        if known is None:
            stop = word[-1:] in self.ids and word[-2:] not in self.inside and len(word) > 1
            if stop:      # parted from the rest, which is the more often met
                rest = self.words.get(word[:-1]) or self._keep(word[:-1], self._word(
                    SPACE + word[:-1]))
                known = rest + self.ids[word[-1]].to_bytes(4, "little")
            else:
                known = self._word(SPACE + word)
            self._keep(word, known)
        return known

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(word) <= MEMO_LENGTH:
            if len(self.words) >= MEMO_WORDS:
                self.words = {}
            self.words[word] = ids
        return ids

    def _word(self, text: str) -> bytes:
        out, start = [], 0
        for k, char in enumerate(text):
            if char not in self.ids:      # stands alone, as its bytes
                if k > start:
                    out += self.tokens(text[start:k])
                out += [self.byte_ids[b] for b in char.encode()]
                start = k + 1
        if start < len(text):
            out += self.tokens(text[start:])
        return array("i", out).tobytes()

    def spaces(self, n: int) -> bytes:
        """The ids of n spaces that no word took."""
        most, out = max(self.runs), []
        while n:
            size = min(n, most)
            while size not in self.runs:
                size -= 1
            out.append(self.runs[size])
            n -= size
        return array("i", out).tobytes()

    def spaced(self, words: list[str]) -> bytes:
        """The ids of words with a space in front of each, where some words are
        empty."""
        out, run = [], 0
        for w in words:
            if not w:
                run += 1
                continue
            ids = self.word(w)
            if int.from_bytes(ids[:4], "little") == self.bare:
                run, ids = run + 1, ids[4:]
            out += [self.spaces(run), ids]
            run = 0
        return b"".join([*out, self.spaces(run)])

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is an empty text."""
        if not len(column):
            return
        texts = pc.replace_substring(column.cast(pa.string()).fill_null(""), SPACE, " ")
        lists = pc.split_pattern(texts, " ")
        first = np.cumsum(np.r_[0, pc.list_value_length(lists).to_numpy()]).tolist()
        found = lists.flatten().dictionary_encode()
        at, words = found.indices.to_numpy().tolist(), found.dictionary.to_pylist()
        known = [self.word(w) if w else None for w in words]
        empty = words.index("") if "" in words else -1
        for a, b in zip(first, first[1:], strict=False):
            codes = at[a:b]
            if empty in codes:
                raw = b"" if b - a == 1 else self.spaced([words[c] for c in codes])
            else:
                raw = b"".join([known[c] for c in codes])
            yield np.frombuffer(raw, "<i4")


def encoded(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each text."""
    ready(docs.sparkSession)
    path = model_path(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(bpe.encode(batch.column(1))),
                                           pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``RESULT`` per row: encoded, digested and decoded in one pass."""
    ready(docs.sparkSession)
    path = model_path(model_file)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        decimal = [str(i) for i in range(bpe.library.get_piece_size())]
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for ids in bpe.encode(batch.column(1)):
                listed = ids.tolist()
                n.append(len(listed))
                ids_sha.append(sha(",".join([decimal[i] for i in listed]).encode()))
                text_sha.append(sha((bpe.library.decode(listed) if listed else "").encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], schema=RESULT)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_pieces(docs: DataFrame) -> DataFrame:
    return digests(docs)
