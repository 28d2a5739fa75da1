"""Token ids of whole texts with the ``tokenizers`` library, one worker at a time.

A byte-level BPE with the usual pre-tokenizer never lets a token run from a
non-space character into a space, so a text falls apart, without changing its
ids, at every space that follows a non-space character.  The pieces between
such places repeat a great deal; each distinct one is encoded by the library
once.  A worker keeps pieces and ids in flat arrays (some 30 bytes a piece, where
a dictionary takes 250), up to a bound in bytes; beyond it the pieces not met for
longest go.  Pieces are looked up and ids put in place a batch at a time, without a
loop over them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from cartlens.llm.common import given_back, kept, pieces

DEFAULT_TOKENIZER = "byte_bpe_50k.json"

#: Bytes of pieces and ids that a worker remembers.
MEMO_BYTES = 72 << 20
#: First pieces of texts that it remembers.
HEADS = 50_000
#: Pieces that are encoded by one call, and ids that are put in place at once.
CALL_PIECES = 2_000
GATHERED = 1 << 20
#: Bytes of texts that are looked up at once.
LOOKED_UP = 4 << 20

#: How a byte-level vocabulary spells a space.
SPACE = "Ġ"


def tokenizer_path(path: str | None) -> str:
    """The given file, or the public 50k byte-level vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_TOKENIZER)


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file."""
    encoders = kept("tokens")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


class Growing:
    """An array that grows at its end, seldom copied.  What is put there for the time
    being lies behind ``held`` until the next entries take its place."""

    def __init__(self, values: np.ndarray) -> None:
        self.data, self.n = values, len(values)

    @property
    def held(self) -> np.ndarray:
        return self.data[:self.n]

    def put(self, values: np.ndarray, keep: bool = True) -> np.ndarray:
        """All entries, the new ones last."""
        end = self.n + len(values)
        if end > len(self.data):
            longer = np.empty(max(end, self.n * 3 // 2), self.data.dtype)
            longer[:self.n] = self.held
            self.data = longer
        self.data[self.n:end] = values
        self.n = end if keep else self.n
        return self.data[:end]


class Encoder:
    """``encode(texts)`` gives, per text, its ids as little-endian unsigned
    integers of ``width`` bytes (2 where the vocabulary fits, else 4).

    A string of an added token (``<|endoftext|>``) is that token, as the library
    has it: such texts are parted there first."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.dtype.itemsize
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[:1] == SPACE]] = True
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], self.dtype) for i, t in added.items()}
        #: Whether the added tokens are met as they stand, wherever they stand.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.parting = re.compile("(" + "|".join(
            map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.heads: dict[str, np.ndarray] = {}
        self.batch = 0
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.int32)
        self._hold(pa.chunked_array([], pa.string()), none, none, none, np.zeros(0, self.dtype))

    def _hold(self, pieces_: pa.ChunkedArray, begin: np.ndarray, size: np.ndarray,
              met: np.ndarray, arena: np.ndarray) -> None:
        #: In chunks, so that new pieces are added without copying the others.
        self.pieces = pieces_
        #: Of each piece: its ids' place in ``arena``, their number, the last batch.
        self._begin, self._size, self._met = Growing(begin), Growing(size), Growing(met)
        self._arena = Growing(arena)

    begin = property(lambda self: self._begin.held)
    size = property(lambda self: self._size.held)
    met = property(lambda self: self._met.held)
    arena = property(lambda self: self._arena.held)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids."""
        flat, sizes = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = flat.tobytes(), np.cumsum(sizes) * self.width
        return [raw[e - n * self.width:e] for e, n in zip(ends.tolist(), sizes.tolist(),
                                                          strict=True)]

    def encode_column(self, column: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in one array, each followed by ``end``; each
        text's number of ids).  Null is an empty text."""
        found = [self._encoded(part, end) for part in _parts(column)]
        if not found:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _encoded(self, column: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        arena, begins, sizes, at, first = self._looked_up(column, np.frombuffer(end, self.dtype))
        if end:             # the last entry
            at = np.insert(at, first[1:], len(sizes) - 1)
            first = first + np.arange(len(first))
        begin, size = begins[at], sizes[at]
        done = np.cumsum(size, dtype=np.int64) - size
        out = np.empty(int(size.sum(dtype=np.int64)), self.dtype)
        # Texts by texts, so that the places of the ids take little memory.
        for a, b in _spans(first, size, GATHERED):
            n = int(size[a:b].sum())
            if n:
                places = np.repeat((begin[a:b] - done[a:b] + done[a]).astype(np.int32), size[a:b])
                places += np.arange(n, dtype=np.int32)
                out[done[a]:done[a] + n] = arena[places]
        return out, np.add.reduceat(size, first[:-1], dtype=np.int64)

    def count_column(self, column: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        found = [np.zeros(0, np.int64)]
        for part in _parts(column):
            _, _, sizes, at, first = self._looked_up(part, np.zeros(0, self.dtype))
            found.append(np.add.reduceat(sizes[at], first[:-1], dtype=np.int64))
        return np.concatenate(found)

    def _looked_up(self, column: pa.Array, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(ids; entries' places there and sizes; each piece's entry; each text's
        first piece, and the end).  The last entry is ``end``."""
        texts = column.cast(pa.string()).fill_null("")
        lists = pc.split_pattern(texts, " ")
        first = np.cumsum(np.r_[0, pc.list_value_length(lists).to_numpy()])
        found = lists.flatten().dictionary_encode()
        codes, parts = found.indices.to_numpy(), found.dictionary
        loose_parts = _loose_ends(parts)
        self.batch += 1
        if self.pieces.nbytes + self.arena.nbytes + 12 * len(self.size) > MEMO_BYTES:
            self._forget()
        at = self._places(parts, loose_parts)[codes]

        # Only a space after another character is sure to begin a token: a text
        # with a space after white space is cut anew, piece by piece, and so is
        # one with an added token.
        loose = loose_parts[codes]
        loose[first[1:] - 1] = False
        whole = np.unique(np.searchsorted(first, np.flatnonzero(loose), "right") - 1)
        for token in self.added:
            held = pc.match_substring(texts, token)
            if pc.any(held).as_py():
                whole = np.union1d(whole, np.flatnonzero(held.to_numpy(zero_copy_only=False)))
        anew = {k: self._whole(texts[k].as_py()) for k in whole.tolist()}
        # What stands behind the memo's entries, for this batch alone: nothing,
        # texts' first pieces (no space in front), whole texts, the end.
        n, extra = len(self.size), [np.zeros(0, self.dtype)]
        heads: dict[int, int] = {}
        for k, code in zip(first.tolist(), codes[first[:-1]].tolist(), strict=False):
            if code not in heads:
                heads[code] = n + len(extra)
                extra.append(self._head(parts[code].as_py()))
            at[k] = heads[code]
        for k, ids in anew.items():
            at[first[k]:first[k + 1]] = n
            at[first[k]] = n + len(extra)
            extra.append(ids)
        extra.append(end)
        more = np.fromiter(map(len, extra), np.int32, len(extra))
        begins = (len(self.arena) + np.cumsum(more) - more).astype(np.int32)
        return (self._arena.put(np.concatenate(extra), keep=False),
                self._begin.put(begins, keep=False), self._size.put(more, keep=False), at, first)

    def _places(self, parts: pa.Array, loose: np.ndarray) -> np.ndarray:
        """The memo's entry of each distinct piece (with a space in front), learned
        if need be."""
        # The hash table is made of the batch's pieces and asked for the memo's: made
        # of the memo's it would take several times the memory of the memo itself.
        places, before = np.full(len(parts), -1, np.int32), 0
        found = pc.index_in(self.pieces, value_set=parts)
        for chunk in found.chunks:
            known = np.flatnonzero(chunk.is_valid().to_numpy(zero_copy_only=False))
            places[chunk.drop_null().to_numpy()] = before + known
            before += len(chunk)
        for kind in (False, True):
            new = np.flatnonzero((places < 0) & (loose == kind))
            if len(new):
                places[new] = len(self.size) + np.arange(len(new))
                pieces_ = parts.take(pa.array(new))
                ids, sizes = (self._one_by_one if kind else self._in_runs)(pieces_.to_pylist())
                self.pieces = pa.chunked_array([*self.pieces.chunks, pieces_])
                sizes = sizes.astype(np.int32)
                self._begin.put(len(self.arena) + np.cumsum(sizes) - sizes)
                self._size.put(sizes)
                self._met.put(np.zeros(len(new), np.int32))
                self._arena.put(ids)
        self.met[places] = self.batch
        return places

    def _forget(self) -> None:
        """Keep the half of the pieces that was met last."""
        order = np.argsort(self.met, kind="stable")[len(self.met) - len(self.met) // 2:]
        keep = np.sort(order).astype(np.int32)
        if not len(keep):
            return self._clear()
        size, stays = self.size[keep], np.zeros(len(self.met), bool)
        stays[keep] = True
        pieces_ = self.pieces.take(pa.array(keep)).combine_chunks()
        self._hold(pa.chunked_array([pieces_]), (np.cumsum(size) - size).astype(np.int32), size,
                   self.met[keep], self.arena[np.repeat(stays, self.size)])

    def _in_runs(self, missing: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, the number of each).  No piece ends in white space,
        so many are encoded as one text, whose ids are parted where a token begins
        with a space."""
        ids, sizes = [], []
        for part in pieces(missing, CALL_PIECES):
            (found,) = self.tokenizer.encode_batch_fast([" " + " ".join(part)],
                                                        add_special_tokens=False)
            run = np.array(found.ids, self.dtype)
            at = np.flatnonzero(self.begins[run])
            if len(at) == len(part):
                ids.append(run)
                sizes.append(np.diff(np.r_[at, len(run)]))
            else:           # a vocabulary that spells spaces otherwise
                run, size = self._one_by_one(part)
                ids.append(run)
                sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _one_by_one(self, missing: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for part in pieces(missing, CALL_PIECES)
                 for e in self.tokenizer.encode_batch_fast([" " + p for p in part],
                                                           add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.dtype, int(sizes.sum())), sizes

    def _head(self, piece: str) -> np.ndarray:
        """The ids of a text's first piece, which has no space in front."""
        ids = self.heads.get(piece)
        if ids is None:
            ids = self._ids(piece)
            if len(self.heads) >= HEADS:
                self.heads.clear()
            self.heads[piece] = ids
        return ids

    def _whole(self, text: str) -> np.ndarray:
        """The ids of a text that may hold added tokens or runs of white space."""
        if not self.plain and self.parting and self.parting.search(text):
            return self._ids(text)
        cut = self.parting.split(text) if self.parting else [text]
        return np.concatenate([np.zeros(0, self.dtype), *[
            self.added[part] if k % 2 else self._loose(part) for k, part in enumerate(cut) if part]])

    def _loose(self, text: str) -> np.ndarray:
        head, *parts = _merged(text.split(" "))
        found = pa.array(parts, pa.string()).dictionary_encode()
        at = self._places(found.dictionary, _loose_ends(found.dictionary))[found.indices.to_numpy()]
        size = self.size[at]
        places = np.repeat(self.begin[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.concatenate([self._ids(head), self.arena[places]])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """The column in runs of texts with some ``LOOKED_UP`` bytes, or of one text."""
    column = column.cast(pa.string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(), dtype=np.int64)
    a = 0
    while a < len(ends):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + LOOKED_UP, "right")))
        yield column.slice(a, b - a)
        given_back()
        a = b


def _loose_ends(parts: pa.Array) -> np.ndarray:
    """Which pieces are empty or end in white space."""
    last = pc.utf8_slice_codeunits(parts, -1).dictionary_encode()
    loose = np.array([not c or c.isspace() for c in last.dictionary.to_pylist()], bool)
    return loose[last.indices.to_numpy()]


def _merged(parts: list[str]) -> list[str]:
    """Undo the cuts at spaces that follow white space: only a space after
    another character is sure to begin a token."""
    out: list[str] = []
    held: list[str] = []
    loose = True
    for p in parts:
        if held and not loose:
            out.append(" ".join(held))
            held = []
        held.append(p)
        loose = not p or p[-1].isspace()
    return [*out, " ".join(held)]


def _spans(first: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of pieces of whole texts with some ``most`` ids, or of one text."""
    ends = np.cumsum(np.add.reduceat(size, first[:-1], dtype=np.int64))
    a = 0
    while a < len(ends):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + most, "right")))
        yield int(first[a]), int(first[b])
        a = b
