"""Exact repeats of word windows over all documents, found from sparse anchors.

Shared by the operators that differ in how they choose anchors. Anchors whose
hash stands more than once are extended to the windows they can belong to; those
windows' 96-bit hashes are sorted, and equal neighbours are told apart by place.
A task first settles repeats among its own documents and sends one row for each
different hash, so a passage in a third of all documents is not a third of the
shuffled rows, and no pairs are made.

Rows are shuffled by the hundred for every document, so their columns are few and in an
order that compresses: random bits first, small numbers after them, zeros last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.sinks.folders import materialise

from .text import arrow_schema, handed_back, id_type, pieces

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True  # fixed value: what parts words
_ONE, _TWO = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_BLOCK = 1 << 22
#: Keys for rows that are settled already and need no partner, so that these spread over the tasks.
_SPREAD = 1 << 20
#: Longest word whose bytes and length fit 64 bits.
_SHORT = 7

#: A document: its id (0 for a null one), whether that is null, and what tells its texts apart.
DOCUMENT = ["id", "no_id", "tie"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that nearby ones have nothing in common; different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """64 bits for each word: bytes and length of a short one, so that these never collide, else XXH64.

    Blocks keep the memory small for very long texts.
    """
    found, at = [], 0
    masks = np.array([(1 << 8 * n) - 1 for n in range(_SHORT + 1)], dtype=np.uint64)
    while at < len(data):
        end = at + _BLOCK
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        block = data[at:end]
        inside = np.zeros(len(block) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[np.frombuffer(block, dtype=np.uint8)]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        lengths = ends - starts
        eight = np.ndarray(len(block), dtype="<u8", buffer=block + bytes(8), strides=(1,))
        words = (eight[starts] & masks[np.minimum(lengths, _SHORT)]) | (lengths.astype(np.uint64) << np.uint64(56))
        long = np.flatnonzero(lengths > _SHORT)
        words[long] = np.fromiter(
            (xxhash.xxh64_intdigest(block[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())), np.uint64, len(long)
        )
        found.append(_mixed(words))
        at = end
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int, lane: np.uint64 = _ONE) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each start on.

    Neighbours are hashed to pairs, pairs to fours and so on; a window is put together from such runs.
    Every step mixes, so no pattern of words makes windows collide.
    """
    run, offset, done = 1, 0, None
    while True:
        if size & run:
            part = words[starts + offset]
            done = part if done is None else _mixed(done * lane + part)
            offset += run
        if 2 * run > size:
            return _mixed(done ^ lane)
        words = _mixed(words[:-run] * lane + words[run:])
        run *= 2


def _told_apart(docs: DataFrame) -> DataFrame:
    """id, no_id, tie and text of each row; tie is 0 for an id with one text only, as nearly all have.

    Else it is a hash of the text. That keeps what is shuffled with every word short. The ids in question
    are written to the shared folder first, so that the join with them is planned by their size.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    several = rows.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("several"))
    several = several.agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low <> high")
    rows = rows.join(materialise(several.select("several"), "repeated-ids"), F.col("doc_id") == F.col("several"), "left")
    alone = F.col("doc_id").isNotNull() & F.col("several").isNull()
    return rows.select(
        F.coalesce("doc_id", F.lit(0).cast(id_type(docs))).alias("id"),
        F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col("text_hash")).alias("tie"),
        "text",
    )


def _packed_rows(schema: pa.Schema):
    """A document's columns, packed, size: texts compressed better than the shuffle would, as they cross it once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=6).compress
        for batch in pieces(batches, "text"):
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            arrays = [*(batch.column(c) for c in DOCUMENT), pa.array(map(pack, texts), pa.binary()), sizes]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows


def _unpacked(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(p.as_py()) for p in batch.column("packed")]


@dataclass(frozen=True)
class Anchors:
    """Places of a text that stand for the windows around them.

    ``find`` gives a text's places, a hash of the words that begin there and, where anchors are ordered, three
    hashes of ``PIECE`` bits of the words that follow these. Equal windows have anchors of equal hash at equal offsets of
    at most ``reach`` from their starts. ``offsets`` has, for 0 to 3 following hashes in common with a
    neighbour, the least offset that a common window can have.
    """

    find: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None]]
    reach: int
    offsets: tuple[int, int, int, int] = (0, 0, 0, 0)

    @property
    def ordered(self) -> bool:
        return any(self.offsets)


PIECE = np.uint64(21)
#: Different continuations of one hash that a task sends on as they are; where it has more, all rows of the hash count as repeated
#: throughout, its own and, by a row that is marked as below, those of other tasks.
_SIDES = 16
#: Instead of a continuation: the task has more of them. As a signed number it sorts before all continuations, which are not negative.
_CROWDED = np.uint64((1 << 64) - 1)


def _in_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the three leading hashes two continuations have in common."""
    apart = a ^ b
    return (apart >> PIECE * np.uint64(2) == 0).astype(np.int32) + (apart >> PIECE == 0) + (apart == 0)


def _anchor_rows(anchors: Anchors, window: int, schema: pa.Schema):
    """(key, at, document, following): one row per anchor; ~at instead of at says that it is known to repeat throughout.

    Of a hash with more than ``_SIDES`` continuations one row keeps the key. It is marked, so that a row of
    another task needs no neighbour with its own continuation to count as repeated.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found, owners = [], []
            for number, text in enumerate(batch.column("text").cast(pa.binary())):
                words = word_hashes(text.as_py() or b"")
                if len(words) >= window:
                    found.append(anchors.find(words)[: 2 + anchors.ordered])
                    owners.append(np.full(len(found[-1][0]), number))
            if not found:
                continue
            at, key, *rest = map(np.concatenate, zip(*found))
            owner = pa.array(np.concatenate(owners))
            order = np.lexsort((*rest, key))
            fresh_key = np.concatenate([[True], key[order][1:] != key[order][:-1]])
            fresh = fresh_key.copy()
            for part in rest:
                fresh[1:] |= part[order][1:] != part[order][:-1]
            group = np.cumsum(fresh) - 1
            again = np.bincount(group) > 1
            of_key = np.cumsum(fresh_key)[fresh] - 1
            crowded = (np.bincount(of_key) > _SIDES)[of_key]
            known, spare = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
            known[order] = (again | crowded)[group]
            spare[order] = np.where(crowded[group], ~fresh_key, ~fresh)
            for part in rest:
                part[order[fresh_key & crowded[group]]] = _CROWDED
            at = at.astype(np.int32)
            at = np.where(known, ~at, at)
            key = key.view(np.int64)
            key[spare] = np.arange(np.count_nonzero(spare)) % _SPREAD
            documents = [batch.column(c).take(owner) for c in DOCUMENT]
            yield from handed_back([pa.array(key), pa.array(at), *documents, *(pa.array(r.view(np.int64)) for r in rest)], schema)

    return rows


def _repeated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and what follows, those with a neighbour of their key: document, 4 * place + hashes in common.

    Where a key's first row is marked as crowded, its rows have all hashes in common with one that was not sent.
    """
    waiting, back, marked = None, -1, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        key = np.asarray(batch.column("key"))
        same = key[1:] == key[:-1]
        if "following" in batch.schema.names:
            following = np.asarray(batch.column("following")).view(np.uint64)
            shared = np.where(same, _in_common(following[1:], following[:-1]), -1)
            fresh = np.append(True, ~same)
            crowded = (following == _CROWDED)[fresh]
            crowded[0] |= marked
            crowded = crowded[np.cumsum(fresh) - 1]
            shared[same & crowded[1:]] = 3
            marked = bool(crowded[-1])
        else:
            shared = np.where(same, 3, -1)
        before = np.append(back, shared)
        yield from _reached(batch.slice(0, batch.num_rows - 1), np.maximum(before[:-1], shared))
        waiting, back = batch.slice(batch.num_rows - 1), int(before[-1])
    if waiting is not None:
        yield from _reached(waiting, np.array([back]))


def _reached(batch: pa.RecordBatch, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    at = np.asarray(batch.column("at"))
    common = np.where(at < 0, 3, common)
    keep = common >= 0
    if keep.any():
        places = (np.where(at < 0, ~at, at).astype(np.int64) * 4 + common)[keep]
        documents = [batch.column(c).filter(pa.array(keep)) for c in DOCUMENT]
        yield pa.RecordBatch.from_arrays([*documents, pa.array(places)], [*DOCUMENT, "at"])


def _window_rows(window: int, anchors: Anchors, schema: pa.Schema):
    """(k1, place, document, settled): the windows that repeated anchors can belong to.

    ``place`` is 32 more bits of hash and the start. Windows that stand earlier among the task's own rows
    are settled: they go on as runs, with the run's length in place of the hash.
    """

    least = np.array(anchors.offsets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "size"):
            batch = batch.filter(batch.column("at").is_valid())
            marks = batch.column("at")
            names = list(zip(*(batch.column(c).to_pylist() for c in ("id", "no_id", "tie"))))
            texts = _unpacked(batch)
            ones, twos, starts, owners = [], [], [], []
            for number in sorted(range(len(names)), key=lambda n: (1 - names[n][1], names[n][0], names[n][2])):
                words = word_hashes(texts[number])
                at = np.asarray(marks[number].values)
                low = np.maximum((at >> 2) - anchors.reach, 0)
                high = np.minimum((at >> 2) + 1 - least[at & 3], len(words) - window + 1)
                near = np.zeros(len(words) - window + 2, dtype=np.int32)
                np.add.at(near, low[low < high], 1)
                np.add.at(near, high[low < high], -1)
                start = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                ones.append(window_hashes(words, start, window, _ONE))
                twos.append(window_hashes(words, start, window, _TWO) >> np.uint64(32))
                starts.append(start)
                owners.append(np.full(len(start), number))
            if not starts:
                continue
            one, two, start, owner = map(np.concatenate, (ones, twos, starts, owners))
            order = np.lexsort((two, one))  # stable: of equal windows the earliest comes first
            later = np.zeros(len(one), dtype=bool)
            later[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
            beside = np.zeros(len(one), dtype=bool)
            beside[1:] = later[1:] & later[:-1] & (owner[1:] == owner[:-1]) & (start[1:] == start[:-1] + 1)
            heads = np.flatnonzero(~beside)
            length = np.diff(np.append(heads, len(one))).astype(np.uint64)
            settled = later[heads]
            one, two, start = one[heads].view(np.int64), two[heads], start[heads].astype(np.uint64)
            one[settled] = np.arange(np.count_nonzero(settled)) % _SPREAD
            place = (np.where(settled, length, two) << np.uint64(32)) | start
            owner = pa.array(owner[heads])
            document = [batch.column(c).take(owner) for c in DOCUMENT]
            yield from handed_back([pa.array(one), pa.array(place.view(np.int64)), *document, pa.array(settled.astype(np.int32))], schema)

    return rows


def _later_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by window and place, those that are not their window's first: document and number of windows << 32 | start."""
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k1, place = np.asarray(batch.column("k1")), np.asarray(batch.column("place")).view(np.uint64)
        settled = np.asarray(batch.column("settled")) > 0
        k2 = place >> np.uint64(32)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | settled[:-1]
        if last is not None:
            fresh[0] = (k1[0], k2[0], False) != last
        last = k1[-1], k2[-1], bool(settled[-1])
        keep = settled | ~fresh
        if keep.any():
            start = place & np.uint64(0xFFFFFFFF)
            spans = (np.where(settled, k2, np.uint64(1)) << np.uint64(32)) | start
            documents = [batch.column(c).filter(pa.array(keep)) for c in DOCUMENT]
            yield pa.RecordBatch.from_arrays([*documents, pa.array(spans[keep].view(np.int64))], [*DOCUMENT, "span"])


def _cut_rows(window: int, result: Callable[[list, np.ndarray], tuple], schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "size"):
            spans, found = batch.column("spans"), []
            for number, data in enumerate(_unpacked(batch)):
                words = data.split()
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                if spans[number].is_valid:
                    own = np.asarray(spans[number].values)
                    start = own & 0xFFFFFFFF
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + (own >> 32) - 1 + window, -1)
                found.append(result(words, np.cumsum(gone[:-1]) > 0))
            ids = pc.if_else(pc.equal(batch.column("no_id"), 1), pa.scalar(None, batch.column("id").type), batch.column("id"))
            arrays = [ids, batch.column("copies")]
            for i, field in enumerate(list(schema)[2:]):
                arrays.append(pa.array([row[i] for row in found], field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows


def cut_digest(words: list[bytes], gone: np.ndarray) -> tuple[int, int, str]:
    kept = [word for word, out in zip(words, gone.tolist()) if not out] if gone.any() else words
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def cut_text(words: list[bytes], gone: np.ndarray) -> tuple[int, int, str]:
    kept = [word for word, out in zip(words, gone.tolist()) if not out] if gone.any() else words
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


DIGEST = (cut_digest, "n_words long, n_removed long, kept_sha256 string")
TEXT = (cut_text, "n_words long, n_removed long, kept_text string")


def without_repeats(docs: DataFrame, window: int, anchors: Anchors, result: tuple = DIGEST) -> DataFrame:
    """Remove each word inside a window whose words also start earlier; one row per row of ``docs``.

    Earlier is a smaller doc_id (null first, rows of one doc_id by a hash of their
    text) or an earlier start in the same document. Windows are judged on the input.
    Rows equal in doc_id and text are one document. Null and empty texts have no words.
    """
    document = f"id {id_type(docs)}, no_id int, tie long"
    packed = f"{document}, packed binary, size long"
    marks = f"key long, at int, {document}" + (", following long" if anchors.ordered else "")
    windows = f"k1 long, place long, {document}, settled int"
    docs = _told_apart(docs)
    # Equal rows meet in the map-side aggregate already. Both joins below take the same columns, so they read this one exchange.
    texts = (
        docs.mapInArrow(_packed_rows(arrow_schema(packed)), packed)
        .groupBy(*DOCUMENT)
        .agg(F.any_value("packed").alias("packed"), F.any_value("size").alias("size"), F.count("*").alias("copies"))
    )
    marked = (
        docs.mapInArrow(_anchor_rows(anchors, window, arrow_schema(marks)), marks)
        .repartition("key")
        .sortWithinPartitions("key", *(["following"] if anchors.ordered else []))
        .mapInArrow(_repeated_rows, f"{document}, at long")
        .groupBy(*DOCUMENT)
        .agg(F.collect_set("at").alias("at"))  # copies of a row name the same places
    )
    spans = (
        texts.join(marked, DOCUMENT, "left")
        .select(*DOCUMENT, "packed", "size", "copies", "at")
        .mapInArrow(_window_rows(window, anchors, arrow_schema(windows)), windows)
        .repartition("k1")
        .sortWithinPartitions("k1", "settled", F.shiftright("place", 32), F.desc("no_id"), "id", "tie", "place")
        .mapInArrow(_later_rows, f"{document}, span long")
        .groupBy(*DOCUMENT)
        .agg(F.collect_list("span").alias("spans"))
    )
    out = f"doc_id {id_type(docs, 'id')}, copies long, {result[1]}"
    return (
        texts.join(spans, DOCUMENT, "left")
        .select(*DOCUMENT, "packed", "size", "copies", "spans")
        .mapInArrow(_cut_rows(window, result[0], arrow_schema(out)), out)
        .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("copies")
    )
