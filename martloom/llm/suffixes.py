"""Suffix-array dedup over sparse suffixes.

Suffixes are retained at content-selected minimiser places only: the least
hash of ``GRAM`` words among the first ``SPREAD`` starts of a window. Equal
passages retain equal suffixes. These are sorted by the hashes of their successive pieces - the
words that any window around the place has from there on, then three shorter pieces up to a window's
length. Of all suffixes a sorted one has most in common with its neighbours, so the pieces it shares
with these say how far a match can extend to the right and which starts to the left
it can have; of those windows the repeated ones are found exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import DIGEST, PIECE, Anchors, window_hashes, without_repeats

#: Least words of a repeated passage.
WINDOW = 50
GRAM, SPREAD = 8, 16


def minimiser_anchors(window: int = WINDOW, gram: int = GRAM, spread: int = SPREAD) -> Anchors:
    begin = window - spread + 1
    if begin < gram:
        raise ValueError("a window must hold its spread of starts and a gram")
    ends = [begin + (window - begin) * part // 3 for part in range(4)]

    def find(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grams = window_hashes(words, np.arange(len(words) - gram + 1), gram)
        starts = np.arange(len(words) - window + 1)
        view = np.lib.stride_tricks.sliding_window_view(grams, spread)[: len(starts)]
        at = np.unique(starts + view.argmin(axis=1))
        longer = np.append(words, np.zeros(window, dtype=np.uint64))  # texts that end alike count as alike beyond their end
        following = np.zeros(len(at), dtype=np.uint64)
        for a, b in zip(ends, ends[1:]):
            piece = window_hashes(longer, at + a, b - a) if b > a else np.zeros(len(at), dtype=np.uint64)
            following = following << PIECE | piece >> np.uint64(64) - PIECE
        return at, window_hashes(words, at, begin), following

    # With n pieces in common a match ends before the next piece does, so its window starts that far to the left at least.
    return Anchors(find, spread - 1, (*(max(0, window - end + 1) for end in ends[1:]), 0))


def suffix_dedup(docs: DataFrame, window: int = WINDOW, result: tuple = DIGEST) -> DataFrame:
    """Each document without the words of passages of ``window`` or more that also start earlier; see ``without_repeats``."""
    return without_repeats(docs, window, minimiser_anchors(window), result)
