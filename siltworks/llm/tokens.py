"""Byte-level BPE ids of whole texts, made in batches from Arrow string columns.

Ids come from the ``tokenizers`` library. Texts are cut where the vocabulary's splitting rule
always cuts, whatever stands around: before a single space between other characters, and on
both sides of such a newline. Equal pieces have equal ids, so a Python worker asks the library
once for each piece it meets and looks the rest up, a batch at a time: pieces are keyed by a
polynomial hash of their bytes, and a hit must also agree in length and in its first and last
eight bytes. Anything unusual (runs of white space, special tokens) merely stays inside a
longer piece, which the library encodes whole.
"""

from __future__ import annotations

import codecs
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex

#: Pieces remembered by one Python worker before it starts anew (about 60 bytes each).
REMEMBERED = 600_000
#: Words remembered likewise (Python objects, about 200 bytes each).
WORDS = 100_000
#: Bytes of text worked on at once.
AT_ONCE = 1 << 20

# Byte-level vocabularies write a byte as a printable character: itself, or one from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_CHARS = "".join(chr(b if b in _PRINTABLE else 256 + _OTHERS.index(b)) for b in range(256))
_RULE = regex.compile(public_tokenizers.PATTERN)
_PLAIN = re.compile(r" ?\S{1,200}").fullmatch
_ONE_BYTE_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE_SPACE = [c.encode() for c in "\x85\xa0 ᠎    　" + "".join(map(chr, range(0x2000, 0x200B)))]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file on the machine that asks."""
    return public_tokenizers.path(name)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the bounds of its rows; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a white-space character."""
    space = _ONE_BYTE_SPACE[data]
    for c in _WIDE_SPACE:
        head = np.flatnonzero(data[: len(data) - len(c) + 1] == c[0]) if len(data) >= len(c) else ()
        if len(head):
            for k in range(1, len(c)):
                head = head[data[head + k] == c[k]]
            for k in range(len(c)):
                space[head + k] = True
    return space


def gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start:start + count] of every row, one after another."""
    ends = np.cumsum(count)
    return flat[np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Encodes Arrow string columns with one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.powers = powers(_BASE, AT_ONCE + 1)
        self.back = powers(_INVERSE, AT_ONCE + 1)
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, bytes] = {}
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.facts = np.zeros((0, 5), np.uint64)  # length, first and last bytes, where its ids are, how many
        self.ids, self.n_ids = np.zeros(1 << 20, np.uint32), 0

    def _library(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _word(self, word: str) -> bytes:
        tokens = self.model.tokenize(codecs.charmap_decode(word.encode(), "strict", _BYTE_CHARS)[0])
        ids = self.words[word] = array("I", [t.id for t in tokens]).tobytes()
        return ids

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces. The splitting rule runs once over all plain ones, set on lines of their own."""
        if len(self.words) > WORDS:
            self.words.clear()
        odd = {p for p in pieces if any(t in p for t in self.special)} if any(t in "\n".join(pieces) for t in self.special) else ()
        plain = [bool(_PLAIN(p)) and p not in odd for p in pieces]
        rest = iter(self._library([p for p, ok in zip(pieces, plain, strict=True) if not ok]))
        words, lines, ids = self.words, [], []
        for word in _RULE.findall("".join([f"{p}\n" for p, ok in zip(pieces, plain, strict=True) if ok])):
            if word in words:
                ids.append(words[word])
            elif word != "\n":
                ids.append(self._word(word))
            else:
                lines.append(ids[0] if len(ids) == 1 else b"".join(ids))
                ids = []
        found = iter(lines)
        return [next(found) if ok else next(rest) for ok in plain]

    def _ends(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Length, first eight and last eight bytes of pieces."""
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        size = (end - start).astype(np.uint64)
        unused = (8 - np.minimum(size, 8)) * np.uint64(8)
        out = np.empty((len(start), 3), np.uint64)
        out[:, 0] = size
        out[:, 1] = eight[start + 8] << unused
        out[:, 2] = eight[end] >> unused
        return out

    def _look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Row of ``facts`` for each distinct hash (sorted); what is new is encoded and remembered."""
        ends = self._ends(data, start, end)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        there = at < len(self.hashes)
        known[there] = self.hashes[at[there]] == hashes[there]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            found = self.encode_pieces([raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            flat = np.frombuffer(b"".join(found), np.uint32)
            count = np.fromiter(map(len, found), np.int64, len(found)) >> 2
            while self.n_ids + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.n_ids : self.n_ids + len(flat)] = flat
            first = self.n_ids + np.cumsum(count) - count
            self.n_ids += len(flat)
            facts = np.column_stack([ends[new], first.astype(np.uint64), count.astype(np.uint64)])
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.facts = np.insert(self.facts, at[new], facts, axis=0)
            at = np.searchsorted(self.hashes, hashes)
        if not np.array_equal(self.facts[at, :3], ends):
            raise ArithmeticError("two pieces of text share a hash")  # not met: 64 bits and the ends would have to agree
        return at

    def _block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of adjacent texts and how many each has."""
        space = white_space(data)
        alone = np.zeros(len(data), bool)
        alone[1:-1] = space[1:-1] & ~space[:-2] & ~space[2:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        alone[edges] = False
        alone[edges - 1] = False
        line = np.flatnonzero(alone & (data == 10))
        cut = np.zeros(len(data) + 1, bool)
        cut[np.flatnonzero(alone & (data == 32))] = True
        cut[line] = cut[line + 1] = True
        cut[bounds] = True
        cut[len(data)] = False
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * self.powers[: len(data)], out=total[1:])
        hashes = (total[end] - total[start]) * self.back[start]
        hashes ^= (end - start).astype(np.uint64)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        row = self._look_up(data, start[first], end[first], distinct)[which]
        # A batch's pieces that share a hash must be the same text, not only those that are looked up.
        if not np.array_equal(self._ends(data, start, end), self.facts[row, :3]):
            raise ArithmeticError("two pieces of text share a hash")
        count = self.facts[row, 4].astype(np.int64)
        ids = gather(self.ids, self.facts[row, 3].astype(np.int64), count)
        up_to = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(up_to[np.searchsorted(start, bounds)])

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32 bits) of all texts of an Arrow column, and how many each text has."""
        data, bounds = bytes_of(column)
        ids, counts, at = [], [], 0
        while at < len(bounds) - 1:
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + AT_ONCE, "right")) - 1)
            low, high = bounds[at], bounds[upto]
            if high - low > AT_ONCE:  # one very long text
                found = self._library([data[low:high].tobytes().decode()])[0]
                ids.append(np.frombuffer(found, np.uint32))
                counts.append(np.array([len(found) >> 2]))
            else:
                if len(self.hashes) > REMEMBERED:
                    self.forget()
                got, n = self._block(data[low:high], bounds[at : upto + 1] - low)
                ids.append(got)
                counts.append(n)
            at = upto
        return np.concatenate(ids or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder: the file is read once per Python process."""
    return Encoder(path)


def encode_documents(path: str, column, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column with ``end_id`` after each, and the bounds of the texts."""
    ids, n = encoder(path).encode(column)
    if end_id is None:
        return ids, np.concatenate([[0], np.cumsum(n)])
    return np.insert(ids, np.cumsum(n), np.uint32(end_id)), np.concatenate([[0], np.cumsum(n + 1)])
