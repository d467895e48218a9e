"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints that differ in at most three of 64 bits agree in at least one of
four 16-bit segments, and a following segment then differs in at most two bits
for one such choice. That segment is decoded with the perfect (23, 12) Golay
code: the fingerprint gets the codeword indices of all words within one bit of
it, one or six, and two words within two bits of each other share at least one.
Exact segment and index together are a key; equal keys are candidates, which
are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import arrow_schema, checkpointed, id_type, text_key

BITS, SEED, SHINGLE = 3, 42, 3
SEGMENTS, WIDTH = 4, 16
#: Fingerprints of one key are compared in blocks of about this many.
BLOCK = 2048
#: A task hands its links on as stars once they have more nodes than this.
STARS = 1 << 20


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number; no words: 0."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z are lower-cased, only ASCII blanks part words
    if len(words) > SHINGLE:
        shingles = [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
    else:
        shingles = [b" ".join(words)] if words else []
    if not shingles:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    counts = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def golay_leaders() -> np.ndarray:
    """For each of the 2048 syndromes of the Golay code, the error of at most three bits that makes it."""
    leaders = np.zeros(2048, dtype=np.int64)
    ones = [1 << i for i in range(23)]
    errors = ones + [a | b for a in ones for b in ones if a < b]
    errors += [a | b | c for a in ones for b in ones for c in ones if a < b < c]
    errors = np.array(errors)
    leaders[golay_syndrome(errors)] = errors
    return leaders


def golay_syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the code's generator, x^11+x^10+x^6+x^5+x^4+x^2+1."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (0b110001110101 << (bit - 11)), rest)
    return rest


def golay_indices(words: np.ndarray, leaders: np.ndarray) -> np.ndarray:
    """Per word a row of the codeword indices of the word and of all its neighbours at one bit."""
    near = words[:, None] ^ np.array([0, *(1 << i for i in range(23))])[None, :]
    return (near ^ leaders[golay_syndrome(near)]) >> 11


def fuzzy_keys(prints: np.ndarray, leaders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every different key of each 64-bit fingerprint."""
    rows, keys = [], []
    segments = [(prints >> np.uint64(WIDTH * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(SEGMENTS)]
    for i in range(SEGMENTS):
        index = np.sort(golay_indices(segments[(i + 1) % SEGMENTS], leaders), axis=1)
        new = np.ones(index.shape, dtype=bool)
        new[:, 1:] = index[:, 1:] != index[:, :-1]
        row, column = np.nonzero(new)
        rows.append(row)
        keys.append(((i << WIDTH | segments[i][row]) << 12) | index[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _forest(prints: list[int]) -> list[tuple[int, int]]:
    """Links of at most ``BITS`` differing bits that hold together what all such links would."""
    if len(prints) == 2:
        a, b = prints
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= BITS else []
    links, left = [], np.array(prints, dtype=np.int64)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= BITS
            joined = left[near]
            links += [(int(at), x) for x in joined.tolist()]
            queue += list(joined)
            left = left[~near]
    return links


class _Stars:
    """Nodes of the links so far, each with a node on the way to the least one that these links reach."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, node: int) -> int:
        above = self.above
        while (up := above.setdefault(node, node)) != node:
            above[node] = above.setdefault(up, up)
            node = up
        return node

    def add(self, links: list[tuple[int, int]]) -> None:
        for a, b in links:
            a, b = self.top(a), self.top(b)
            self.above[max(a, b)] = min(a, b)

    def links(self) -> pa.RecordBatch:
        found = [(node, self.top(node)) for node in list(self.above)]
        self.above = {}
        return _as_links([(a, b) for a, b in found if a != b])


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j): stars that hold together what the links within the task's block pairs do."""
    group, held, stars = None, [], _Stars()
    for batch in batches:
        columns = [np.asarray(batch.column(c)) for c in ("key", "i", "j", "print")]
        new = np.ones(batch.num_rows, dtype=bool)
        if batch.num_rows:
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            own = tuple(int(c[a]) for c in columns[:3])
            if own != group:
                stars.add(_forest(held) if len(held) > 1 else [])
                group, held = own, []
            held += columns[3][a:b].tolist()
        if len(stars.above) > STARS:
            yield stars.links()
    stars.add(_forest(held) if len(held) > 1 else [])
    yield stars.links()


def _as_links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"]
    )


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that hold together the different fingerprints ``print`` that verified links do.

    A group of fingerprints gives a spanning forest of its links, a task the stars of all its forests: a node and the
    least one that it reaches there, so long chains are short and pairs that share several keys are few before
    the first round. A key with many fingerprints is cut into blocks by a hash, and every pair of
    blocks is a group of its own, so no group grows with the input and none is skipped.
    """
    leaders = golay_leaders()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column("print"))
            row, key = fuzzy_keys(own.view(np.uint64), leaders)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[row])], ["key", "print"])

    keyed = prints.select("print").mapInArrow(keys, "key long, print long")
    sizes = keyed.groupBy("key").count().where("count > 1").withColumnRenamed("key", "of")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    pairs = (
        keyed.join(sizes, keyed["key"] == sizes["of"])
        .select("key", "print", blocks.alias("blocks"))
        .withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
        .select("key", "print", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "print")
    )
    return pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_link_rows, "a long, b long")


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, print) of every row, and (of, root, least) of every different fingerprint ``of``."""
    schema = f"doc_id {id_type(docs)}, text_key long, print long"
    arrow = arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text or "") for text in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").cast(arrow.field(0).type)
            yield pa.RecordBatch.from_arrays([ids, batch.column("text_key"), pa.array(found, pa.int64())], schema=arrow)

    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    prints = checkpointed(keyed.mapInArrow(rows, schema))
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(least))
    rooted = checkpointed(
        least.join(roots, least["print"] == roots["node"], "left").select(
            F.col("print").alias("of"), F.coalesce("root", "print").alias("root"), "least"
        )
    )
    return prints, rooted


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    The component of a fingerprint is all that links of ``BITS`` or fewer differing
    bits reach; its id is the least doc_id, null if all its ids are null. Null and
    empty texts have the fingerprint 0.
    """
    prints, rooted = _rooted(docs)
    named = rooted.groupBy(F.col("root").alias("by")).agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, rooted["root"] == named["by"]).select("of", "component_id")
    return prints.join(labels, prints["print"] == labels["of"]).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component_id").cast(id_type(docs)),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the least doc_id (null last), of one id the text of the least hash.

    Components are told apart by their root, as ids can be null or stand in several components. Of several rows of
    that id and text the one stays whose columns, as JSON text, have the least SHA-256; rows equal in all columns are
    one. Null and empty texts are one component with whatever else has the fingerprint 0. No rows give no rows.
    """
    prints, rooted = _rooted(docs)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "copies")
    firsts = prints.groupBy("print", "doc_id", "text_key").agg(F.count("*").alias("copies")).groupBy("print").agg(F.min(order).alias("first"))
    chosen = firsts.join(rooted, firsts["print"] == rooted["of"]).groupBy("root").agg(F.min("first").alias("first"))
    wanted = chosen.select(*[F.col(f"first.{c}").alias(f"_wanted_{c}") for c in ("doc_id", "text_key", "copies")])
    own = docs["doc_id"].eqNullSafe(wanted["_wanted_doc_id"]) & (text_key(docs["text"]) == wanted["_wanted_text_key"])
    kept = docs.join(wanted, own)
    several = kept.where("_wanted_copies > 1").groupBy("_wanted_doc_id", "_wanted_text_key")
    row = F.struct(*[docs[c] for c in docs.columns])
    several = several.agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("_row"))
    alone = kept.where("_wanted_copies = 1").select(*[docs[c] for c in docs.columns])
    return alone.unionByName(several.select("_row.*"))
