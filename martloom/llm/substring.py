"""Substring dedup from difference-cover anchors.

Windows are hashed only at places whose remainder modulo the period is in a
difference cover. Whatever the places of two equal passages, some offset within
one period puts both on the cover, so any match of ``WINDOW`` words shares an
aligned anchor; from there it is extended to the whole window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import DIGEST, Anchors, window_hashes, without_repeats

WINDOW = 20
#: Every remainder modulo 13 is a difference of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)


def cover_anchors(window: int = WINDOW) -> Anchors:
    size = window - PERIOD + 1
    if size < 1:
        raise ValueError(f"a window needs at least {PERIOD} words")
    covered = np.zeros(PERIOD, dtype=bool)
    covered[list(COVER)] = True

    def find(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, None]:
        at = np.arange(len(words) - size + 1)
        at = at[covered[at % PERIOD]]
        return at, window_hashes(words, at, size), None

    return Anchors(find, PERIOD - 1)


def substring_dedup(docs: DataFrame, window: int = WINDOW, result: tuple = DIGEST) -> DataFrame:
    """Each document without the words of windows that also start earlier; see ``without_repeats``."""
    return without_repeats(docs, window, cover_anchors(window), result)
