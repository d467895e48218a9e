"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash of the text itself chooses the cut places, so passages that
documents share fall into equal chunks, which a task encodes and decodes once.
Chunk joins are then repaired: the text around a join is encoded again, and
chunks whose ids don't agree with that are merged and re-encoded until they do.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from .text import per_document

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Bytes whose rolling hash decides on a cut, and the mean distance between the cuts.
HASHED, MEAN_CHUNK = 16, 512
#: Bytes of chunks and ids that a task keeps for reuse.
REUSE_BYTES = 48 << 20

# Fixed value: the byte-level pre-tokenizer's pattern, as the tokenizer's documentation has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space of this many characters or more is cut out of a text by a scanner: the pattern would step back
#: through it character by character, and gives up at some length.
LONG_RUN = 10_000
# Fixed value: the characters that the pattern's \\s stands for.
_LONG_RUNS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is visible, else one past 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoding(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The vocabulary file as an encoder: merges in order of rank, added tokens as special ones."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    special = {token["content"]: token["id"] for token in spec["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
    }
    merges = spec["model"]["merges"]
    for i, pair in enumerate(merges):
        token = "".join(pair.split(" ") if isinstance(pair, str) else pair)
        if ranks[bytes(letters[c] for c in token)] != len(letters) + i:
            raise ValueError("ids must follow the order of the merges")
    return tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def cut_places(data: bytes) -> list[int]:
    """Content-defined cuts: spaces after a non-space whose last ``HASHED`` bytes hash to a multiple of the mean.

    Words begin at their space, so such a cut can only part two words. The hash
    depends on the bytes before the cut alone, wherever they stand in a text.
    """
    a = np.frombuffer(data, dtype=np.uint8)
    if len(a) <= HASHED + 1:
        return []
    places = np.flatnonzero((a[HASHED:-1] == 32) & (a[HASHED - 1 : -2] > 32) & (a[HASHED + 1 :] > 32)) + HASHED
    # An ASCII letter or digit on both sides keeps clear of white space and marks outside ASCII.
    letter = np.zeros(256, dtype=bool)
    letter[48:58] = letter[65:91] = letter[97:123] = True
    places = places[letter[a[places - 1]] & letter[a[places + 1]]]
    rolled = np.zeros(len(places), dtype=np.uint32)
    for back in range(HASHED, 0, -1):
        rolled = rolled * np.uint32(0x01000193) + a[places - back]
    rolled ^= rolled >> np.uint32(15)
    mean_words = MEAN_CHUNK // 8
    return places[rolled % np.uint32(mean_words) == 0].tolist()


class ChunkEncoder:
    """Encodes and decodes texts, reusing what was done for equal chunks; its memory is bounded."""

    def __init__(self, path: str, reuse_bytes: int = REUSE_BYTES) -> None:
        self.path, self.reuse_bytes = path, reuse_bytes
        self.loaded: tiktoken.Encoding | None = None
        self.blank: tiktoken.Encoding | None = None
        self.known: dict[bytes, tuple[bytes, bytes]] = {}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self.held = 0

    def __reduce__(self):
        return ChunkEncoder, (self.path, self.reuse_bytes)

    @property
    def encoding(self) -> tiktoken.Encoding:
        if self.loaded is None:
            self.loaded = encoding(self.path)
        return self.loaded

    def ids(self, text: str) -> list[int]:
        """The ids of a text. By the pattern a run of white space is one piece but for its last character, which
        belongs to what follows; at the end of the text or before a special token it is one piece as a whole."""
        found, at = [], 0
        for run in _LONG_RUNS.finditer(text) if len(text) >= LONG_RUN else ():
            start, end = run.span()
            if end < len(text) and not text.startswith(tuple(self.encoding.special_tokens_set), end):
                end -= 1
            found += self.encoding.encode(text[at:start], allowed_special="all") + self.blank_ids(text[start:end])
            at = end
        return found + self.encoding.encode(text[at:], allowed_special="all")

    def blank_ids(self, run: str) -> list[int]:
        """The ids of white space as one piece."""
        if self.blank is None:
            self.blank = encoding(self.path, r"\s+")
        return self.blank.encode_ordinary(run)

    def chunk(self, data: bytes) -> tuple[bytes, bytes]:
        """Little-endian ids of a chunk, and the bytes they decode to."""
        done = self.known.get(data)
        if done is None:
            ids = self.ids(data.decode("utf-8"))
            done = np.asarray(ids, dtype="<u4").tobytes(), self.encoding.decode_bytes(ids)
            self.held += 2 * len(data) + len(done[0]) + 200
            if self.held > self.reuse_bytes:
                self.known, self.joins, self.held = {}, {}, 0
            self.known[data] = done
        return done

    def agrees(self, left: bytes, right: bytes) -> bool:
        """Whether the words next to the join encode together as they do apart."""
        a, b = left[left.rfind(b" ", 0, len(left) - 1) + 1 :], right[: _word_end(right)]
        done = self.joins.get((a, b))
        if done is None:
            apart = self.ids(a.decode("utf-8", "ignore")) + self.ids(b.decode("utf-8", "ignore"))
            done = self.ids((a + b).decode("utf-8", "ignore")) == apart
            if len(a) + len(b) < 200:
                self.held += len(a) + len(b) + 200
                self.joins[a, b] = done
        return done

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Little-endian 32-bit ids of the whole text, and the bytes they decode to."""
        data = text.encode("utf-8")
        cuts = [0, *cut_places(data), len(data)]
        chunks = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        agreed = chunks[:1]
        for right in chunks[1:]:
            if self.agrees(agreed[-1], right):
                agreed.append(right)
            else:
                agreed[-1] += right
        parts = [self.chunk(chunk) for chunk in agreed if chunk]
        return b"".join(ids for ids, _ in parts), b"".join(decoded for _, decoded in parts)


def _word_end(data: bytes) -> int:
    end = data.find(b" ", 1)
    return len(data) if end < 0 else end


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``RESULT`` for every row of ``docs``; a null text is empty.

    ``path`` names a byte-level BPE vocabulary (a tokenizers JSON file) that every
    executor has. Ids and decoded texts are as that library gives them.
    """
    coder = ChunkEncoder(path)

    def result(text: str) -> tuple:
        ids, decoded = coder.encode(text)
        plain = decoded.decode("utf-8", "replace").encode("utf-8")
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(plain).hexdigest()

    return per_document(docs, RESULT, result)


def encoded_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids themselves (array<int>) for every row of ``docs``."""
    coder = ChunkEncoder(path)
    return per_document(docs, "ids array<int>", lambda text: (np.frombuffer(coder.encode(text)[0], "<u4").tolist(),))
