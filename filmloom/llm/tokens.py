"""Texts to token ids inside tasks, with a public tokenizer file.

Byte-level BPE never merges over the border between a character that is no white space and a space that starts a
word, so a text is cut there, each distinct piece of a batch is encoded once by the tokenizers library, and the ids are
gathered. The first PIECES_KEPT pieces that a Python worker meets are kept; later ones are encoded once a batch.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from filmloom.llm.common import sized_slices

PIECES_KEPT = 400_000
JOINED = 256
#: Bytes and rows of texts that are encoded at once.
BATCH_BYTES, BATCH_TEXTS = 2 << 20, 1024
#: How the file writes the byte 0x20.
SPACE = "Ġ"
_WHITE = re.compile(r"\s")
_WHITE_SPACE = "".join(chr(x) for x in range(0x3001) if chr(x).isspace())
#: A space before white space or at the end after white space: single spaces aren't the only borders' marks then.
_UNEVEN = f" [{_WHITE_SPACE}]|[{_WHITE_SPACE}] \\z"
_BORDER = re.compile(r"(?<=\S)(?= \S)")
_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Store:
    """Id sequences end to end in one growing array; what is added without being kept is overwritten by the next."""

    def __init__(self) -> None:
        self._ids = np.zeros(1 << 16, "<u4")
        self._held = 0

    def add(self, ids: np.ndarray, at: int) -> int:
        """Put ids at a place at or after what is kept; returns the place after them."""
        if at + len(ids) > len(self._ids):
            grown = np.zeros(max(2 * len(self._ids), at + len(ids)), "<u4")
            grown[:at] = self._ids[:at]
            self._ids = grown
        self._ids[at : at + len(ids)] = ids
        return at + len(ids)

    @property
    def held(self) -> int:
        return self._held

    def keep(self, upto: int) -> None:
        self._held = upto

    def gather(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return self._ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._opens = np.zeros(self._tokenizer.get_vocab_size(), bool)
        for token, at in self._tokenizer.get_vocab().items():
            self._opens[at] = token.startswith(SPACE)
        self._known: dict[str, int] = {}
        self._starts = np.zeros(1024, np.int64)
        self._sizes = np.zeros(1024, np.int32)
        self._store = _Store()

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and their numbers."""
        coded = [x.ids for x in self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.array([len(x) for x in coded], np.int64)
        return np.fromiter(chain.from_iterable(coded), "<u4", sizes.sum()), sizes

    def _spaced(self, pieces: list[str]) -> tuple[list[str], list[np.ndarray], np.ndarray]:
        """Pieces, each after a space, in a new order, their ids, and their numbers of ids.

        Plain words are joined to longer strings, and the ids cut where a space starts.
        """
        plain = [x for x in pieces if x and not _WHITE.search(x)]
        order, rest = [], [x for x in pieces if not x or _WHITE.search(x)]
        ids, sizes = [], []
        groups = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
        coded = self._tokenizer.encode_batch_fast([" " + " ".join(x) for x in groups], add_special_tokens=False)
        for group, x in zip(groups, coded, strict=True):
            some = np.array(x.ids, "<u4")
            starts = np.flatnonzero(self._opens[some])
            if len(starts) != len(group):
                rest += group
                continue
            order += group
            ids.append(some)
            sizes.append(np.diff(starts, append=len(some)))
        if rest:
            some, n = self._each([" " + x for x in rest])
            order, ids, sizes = order + rest, [*ids, some], [*sizes, n]
        return order, ids, np.concatenate(sizes) if sizes else np.zeros(0, np.int64)

    @staticmethod
    def _cut(texts: pa.Array) -> pa.ListArray:
        """Of each text the first piece, then pieces that stand after one space each, without that space."""
        uneven = np.flatnonzero(pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False))
        if not len(uneven):
            return pc.split_pattern(texts, " ")
        lists = []
        for x in texts.take(pa.array(uneven)).to_pylist():
            first, *rest = _BORDER.split(x)
            lists.append([first, *(y[1:] for y in rest)])
        even = np.setdiff1d(np.arange(len(texts)), uneven)
        kind = pa.list_(pa.string())
        both = pa.concat_arrays([pc.split_pattern(texts.take(pa.array(even)), " ").cast(kind), pa.array(lists, kind)])
        place = np.empty(len(texts), np.int64)
        place[even], place[uneven] = np.arange(len(even)), len(even) + np.arange(len(uneven))
        return both.take(pa.array(place))

    def _found(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """Place in the store and number of ids of each word after a space, and the end of what is stored."""
        at = np.fromiter(map(self._known.get, words, repeat(-1)), np.int64, len(words))
        starts, sizes = self._starts[at], self._sizes[at].astype(np.int64)
        end = self._store.held
        if not len(new := np.flatnonzero(at < 0)):
            return starts, sizes, end
        number = {words[i]: i for i in new.tolist()}
        order, ids, n = self._spaced(list(number))
        begin, ends = end, np.cumsum(n)
        for x in ids:
            end = self._store.add(x, end)
        of = np.array([number[x] for x in order])
        starts[of], sizes[of] = begin + ends - n, n
        kept = min(len(order), PIECES_KEPT - len(self._known))
        if kept > 0:
            first = len(self._known)
            if first + kept > len(self._starts):
                size = max(2 * len(self._starts), first + kept)
                self._starts, self._sizes = np.resize(self._starts, size), np.resize(self._sizes, size)
            self._starts[first : first + kept], self._sizes[first : first + kept] = (begin + ends - n)[:kept], n[:kept]
            self._known.update(zip(order[:kept], range(first, first + kept), strict=True))
            self._store.keep(begin + int(ends[kept - 1]))
        return starts, sizes, end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and each text's number of ids."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        lists = self._cut(texts)
        pieces, firsts = lists.flatten(), lists.offsets.to_numpy()[:-1].astype(np.int64) - lists.offsets[0].as_py()
        heads, head_sizes = self._each(pieces.take(pa.array(firsts)).to_pylist())
        later = np.ones(len(pieces), bool)
        later[firsts] = False
        words = pieces.filter(pa.array(later)).dictionary_encode()
        starts, sizes, end = self._found(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = words.indices.to_numpy()
        all_starts, all_sizes = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        all_starts[later], all_sizes[later] = starts[at], sizes[at]
        self._store.add(heads, end)
        all_starts[firsts], all_sizes[firsts] = end + np.cumsum(head_sizes) - head_sizes, head_sizes
        return self._store.gather(all_starts, all_sizes), np.add.reduceat(all_sizes, firsts)

    def vocabulary(self) -> dict[str, int]:
        return self._tokenizer.get_vocab()

    def ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As encode, with an end id after each text."""
        ids, sizes = self.encode(texts)
        return np.insert(ids, np.cumsum(sizes), end_id).astype("<u4"), sizes + 1


def text_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a size that suits encode."""
    return sized_slices(batches, most=BATCH_BYTES, rows=BATCH_TEXTS)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
