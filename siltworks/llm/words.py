"""Words of texts in byte buffers: a block of texts is folded, and words are runs of bytes that are no delimiters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from siltworks.llm.tokens import bytes_of

#: Bytes of text and number of texts worked on at once; a longer text is a block of its own.
AT_ONCE, TEXTS = 1 << 20, 1000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(column, at_once: int = AT_ONCE, texts: int = TEXTS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows low to high of a string column with their bytes and bounds."""
    data, bounds = bytes_of(column)
    at = 0
    while at < len(bounds) - 1:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + at_once, "right")) - 1)
        upto = min(upto, at + texts)
        yield at, upto, data[bounds[at] : bounds[upto]], bounds[at : upto + 1] - bounds[at]
        at = upto


class Words:
    """The words of a block, lower-cased (A-Z only) and set apart by single spaces.

    ``text`` begins with a space, and a space follows each word. ``start`` and ``end`` are the words'
    places in it, and text i has the words ``of[i]`` to ``of[i + 1]``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, delimiter: np.ndarray):
        folded = np.insert(LOWER[data], bounds, 32)  # a delimiter before and after each text
        is_word = ~delimiter[folded]
        keep = is_word.copy()
        keep[1:] |= is_word[:-1]
        keep[0] = True
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        text = np.where(is_word, folded, np.uint8(32))[keep]
        place = np.cumsum(keep) - 1
        self.text = text
        self.start = place[np.flatnonzero(begins)]
        inside = text != 32
        self.end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        self.of = np.searchsorted(self.start, place[bounds + np.arange(len(bounds))])
