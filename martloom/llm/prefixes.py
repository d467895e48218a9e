"""Trie of conversation prefixes, grouped by digests of fixed-length blocks of turns.

Conversations are cut into blocks of ``BLOCK`` turns; a block's digest covers all turns
up to its end. Grouping by these digests gives the trie in steps of a block. Only where
several different blocks follow the same one, their turns are told apart one by one;
elsewhere every turn of a block has the block's members.

Every node belongs to its smallest member, so a conversation owns the nodes of its path
from some depth on. Sums over a subtree are a running sum along the owner's path and what
other conversations that pass the node own below; the latter is again summed by block first.
Digests are sums of 128 bits over (place, role, text), so that a conversation of any
length is summed piecewise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import unique_lookup
from martloom.sinks.folders import materialise

from .running import running_sums
from .text import arrow_schema

#: Turns of a block, conversations that share a beginning, remainders that give its length.
BLOCK, SHARED, LENGTHS = 4, 100, 6
#: Characters of conversation ids handed on at once.
CHUNK = 1 << 15

_NODE = ["depth", "a", "b"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that nearby ones have nothing in common."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, size): every turn with its place, a digest of role and text, and its text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
    )
    counted = running_sums(turns, "conv_id", [F.asc_nulls_first("turn"), F.col("digest")], {"one": "place"}, "turns")
    return counted.select("conv_id", (F.col("place") - 1).alias("pos"), "digest", "size")


def rebuilt_turns(turns: DataFrame, shared: int = SHARED, lengths: int = LENGTHS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, and all conversation ids.

    The first h turns of c are those of c - c % ``shared``, where h = crc32(c) % ``lengths``; its own follow
    after its first h.
    """
    conv = F.col("conv_id")
    base, h = conv - conv % shared, F.crc32(conv.cast("string").cast("binary")) % lengths
    ids = turns.where("pos = 0").select("conv_id")
    heads = turns.where((conv % shared == 0) & (F.col("pos") < lengths - 1)).select(F.col("conv_id").alias("base"), "pos", "digest", "size")
    borrowed = (
        ids.select("conv_id", base.alias("base"), h.alias("h"))
        .where("h > 0")
        .join(heads, "base")
        .where("pos < h")
        .select("conv_id", F.col("pos").alias("q"), "digest", "size")
    )
    there = unique_lookup(heads.select(F.col("base").alias("of"), (F.col("pos") + 1).alias("n_heads")), ["of"], "n_heads")
    own = turns.select("*", base.alias("base"), h.alias("h")).where("pos >= h")
    own = own.join(there, own["base"] == there["of"], "left").select(
        "conv_id", (F.least("h", F.coalesce("n_heads", F.lit(0))) + F.col("pos") - F.col("h")).alias("q"), "digest", "size"
    )
    return borrowed.unionByName(own), ids


def _block_rows(schema: pa.Schema):
    """Digests of a block's turns as two 64-bit numbers, summed within the block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turns")
            lengths = np.asarray(turns.value_lengths(), dtype=np.int64)
            flat = turns.flatten()
            place = np.asarray(flat.field("q")).astype(np.uint64)
            digest = np.frombuffer(b"".join(flat.field("digest").to_pylist()), dtype=np.uint64).reshape(-1, 2)
            lanes = [_mixed(digest[:, i] + _mixed(place * np.uint64(2) + np.uint64(i + 1))).view(np.int64) for i in (0, 1)]
            ends = np.cumsum(lengths)
            sums = [np.cumsum(lane) for lane in lanes]
            totals = [np.diff(np.append(0, s[ends - 1])) for s in sums]
            inside = [s - np.repeat(np.append(0, s[ends - 1][:-1]), lengths) for s in sums]
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (*inside, np.asarray(flat.field("size")))]
            arrays = [batch.column("conv_id"), batch.column("j"), pa.array(lengths), *map(pa.array, totals), *lists]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return rows


def _path_rows(schema: pa.Schema):
    """Blocks with digests of everything up to their start, their end and each of their turns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column("n"))
            ends = [np.asarray(batch.column(c)) for c in ("sum_a", "sum_b")]
            before = [e - np.asarray(batch.column(c)) for e, c in zip(ends, ("own_a", "own_b"))]
            offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
            steps = [
                pa.ListArray.from_arrays(offsets, pa.array(np.asarray(batch.column(c).flatten()) + np.repeat(b, lengths)))
                for b, c in zip(before, ("in_a", "in_b"))
            ]
            arrays = [batch.column("conv_id"), batch.column("j"), batch.column("n"), *map(pa.array, (*before, *ends)), *steps, batch.column("sizes")]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return rows


def block_paths(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, j, n turns, digests (from_a, from_b) up to the block and (a, b) up to its end, and of each step inside."""
    lists = "in_a array<bigint>, in_b array<bigint>, sizes array<bigint>"
    local = f"conv_id long, j long, n long, own_a long, own_b long, {lists}"
    out = "conv_id long, j long, n long, from_a long, from_b long, a long, b long, step_a array<bigint>, step_b array<bigint>, sizes array<bigint>"
    blocks = (
        turns.groupBy("conv_id", F.floor(F.col("q") / block).alias("j"))
        .agg(F.sort_array(F.collect_list(F.struct("q", "digest", "size"))).alias("turns"))
        .mapInArrow(_block_rows(arrow_schema(local)), local)
    )
    summed = running_sums(blocks, "conv_id", [F.col("j")], {"own_a": "sum_a", "own_b": "sum_b"}, "blocks")
    return materialise(summed.mapInArrow(_path_rows(arrow_schema(out)), out), "paths")


def _steps(blocks: DataFrame, block: int, *columns: str) -> DataFrame:
    """One row per turn of each block: its node, the node before it, and ``columns``."""
    steps = F.arrays_zip(
        "step_a", "step_b", "sizes",
        F.concat(F.array("from_a"), F.slice("step_a", 1, F.size("step_a") - 1)).alias("up_a"),
        F.concat(F.array("from_b"), F.slice("step_b", 1, F.size("step_b") - 1)).alias("up_b"),
    )
    rows = blocks.select(F.posexplode(steps).alias("i", "s"), "j", *columns)
    return rows.select(
        (F.col("j") * block + F.col("i") + 1).alias("depth"), F.col("s.step_a").alias("a"), F.col("s.step_b").alias("b"),
        F.col("s.up_a").alias("up_a"), F.col("s.up_b").alias("up_b"), F.col("s.sizes").alias("size"), *columns,
    )


def distinct_blocks(paths: DataFrame) -> DataFrame:
    """Different blocks with their number of conversations and the smallest; ``alone`` if no other follows the same beginning."""
    start = ["j", "from_a", "from_b"]
    blocks = materialise(
        paths.groupBy(*start, "n", "a", "b").agg(
            F.count("*").alias("members"),
            F.min("conv_id").alias("owner"),
            *[F.any_value(c).alias(c) for c in ("step_a", "step_b", "sizes")],
        ),
        "distinct-blocks",
    )
    many = blocks.groupBy(*start).agg(F.count("*").alias("siblings")).where("siblings > 1")
    many = unique_lookup(many.select(*[F.col(c).alias(f"_{c}") for c in start], "siblings"), [f"_{c}" for c in start], "siblings")
    match = [blocks[c] == many[f"_{c}"] for c in start]
    return blocks.join(many, match[0] & match[1] & match[2], "left").select(*blocks.columns, F.col("siblings").isNull().alias("alone"))


def trie_nodes(blocks: DataFrame, ids: DataFrame, block: int) -> DataFrame:
    """depth, a, b, the node above (up_a, up_b), size, members, owner: all nodes, the root at depth 0."""
    node = [*_NODE, "up_a", "up_b", "size"]
    split = _steps(blocks.where("not alone"), block, "members", "owner")
    split = split.groupBy(*node).agg(F.sum("members").alias("members"), F.min("owner").alias("owner"))
    root = ids.agg(F.count("*").alias("members"), F.min("conv_id").alias("owner")).where("members > 0")
    zero = [F.lit(0).cast("long").alias(c) for c in node]
    plain = _steps(blocks.where("alone"), block, "members", "owner")
    return plain.unionByName(split).unionByName(root.select(*zero, "members", "owner"))


def _on(left: DataFrame, right: DataFrame, names: list[str]):
    """Equality of ``names`` with the right side's columns of that name and a dash before it."""
    condition = left[names[0]] == right[f"_{names[0]}"]
    for name in names[1:]:
        condition = condition & (left[name] == right[f"_{name}"])
    return condition


def _dashed(df: DataFrame, names: list[str], *rest: Column | str) -> DataFrame:
    return df.select(*[F.col(n).alias(f"_{n}") for n in names], *rest)


def _with_family(nodes: DataFrame) -> DataFrame:
    """Nodes with the owner of the node above and the number of nodes below."""
    above = nodes.select((F.col("depth") + 1).alias("_depth"), F.col("a").alias("_up_a"), F.col("b").alias("_up_b"), F.col("owner").alias("parent"))
    above = unique_lookup(above, ["_depth", "_up_a", "_up_b"], "parent")
    found = nodes.join(above, _on(nodes, above, ["depth", "up_a", "up_b"]), "left").select(*nodes.columns, "parent")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("_depth"), F.col("up_a").alias("_a"), F.col("up_b").alias("_b"))
    below = below.agg(F.count("*").alias("children"))
    return found.join(below, _on(found, below, _NODE), "left").select(
        *found.columns, F.coalesce("children", F.lit(0)).cast("long").alias("children")
    )


def _passing_sums(paths: DataFrame, blocks: DataFrame, owned: DataFrame, block: int) -> DataFrame:
    """_depth, _a, _b, more_leaves, more_saved: what conversations own below a node that they pass and another owns."""
    top = unique_lookup(_dashed(owned, ["owner"], F.struct("top", "leaves", "saved").alias("of")), ["_owner"], "of")
    passing = (
        paths.join(top, paths["conv_id"] == top["_owner"])
        .where(F.col("j") * block < F.col("of.top") - 1)
        .select(*paths.columns, "of.top", "of.leaves", "of.saved")
    )
    whole = (F.col("j") * block + F.col("n")) < F.col("top")
    key = ["j", "n", "from_a", "from_b", "a", "b"]
    by_block = passing.where(whole).groupBy(*[F.col(k).alias(f"_{k}") for k in key])
    by_block = by_block.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    through = _steps(blocks.join(by_block, _on(blocks, by_block, key)), block, "leaves", "saved")
    halfway = _steps(passing.where(~whole), block, "leaves", "saved", "top").where("depth < top")
    root = owned.where("top > 0").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = root.select(*[F.lit(0).cast("long").alias(c) for c in _NODE], "leaves", "saved")
    rows = through.select(*_NODE, "leaves", "saved").unionByName(halfway.select(*_NODE, "leaves", "saved")).unionByName(root)
    return rows.groupBy(*[F.col(n).alias(f"_{n}") for n in _NODE]).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def _chunk_rows(schema: pa.Schema):
    """Rows sorted by node and conversation: runs of ids joined by commas, each with its first id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.stack([np.asarray(batch.column(c)) for c in _NODE])
            conv = np.asarray(batch.column("conv_id"))
            fresh = np.concatenate([[True], (node[:, 1:] != node[:, :-1]).any(axis=0)])
            starts = np.flatnonzero(fresh).tolist()
            texts = list(map(str, conv.tolist()))
            most, pieces = CHUNK // 20, []
            for start, end in zip(starts, [*starts[1:], len(texts)]):
                pieces += [(at, min(end, at + most)) for at in range(start, end, most)]
            first = np.array([p[0] for p in pieces])
            arrays = [*map(pa.array, node[:, first]), pa.array(conv[first]), pa.array([",".join(texts[x:y]) for x, y in pieces])]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and first id: the SHA-256 of a node's ids, fed piece by piece."""
    names = ["_depth", "_a", "_b", "ends_sha256"]
    last, digest = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if node != last:
                if last is not None:
                    done.append((*last, digest.hexdigest()))
                last, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*last, digest.hexdigest())], names)


def end_digests(paths: DataFrame, ids: DataFrame, block: int) -> DataFrame:
    """_depth, _a, _b, ends_sha256 of nodes where conversations end: ids are joined in ranges, then fed to one hash a node."""
    length = paths.groupBy(F.col("conv_id").alias("_conv_id")).agg(F.max("j").alias("_j"))
    depth = (F.col("j") * block + F.col("n")).alias("depth")
    ends = paths.join(length, _on(paths, length, ["conv_id", "j"])).select("conv_id", depth, "a", "b")
    none = ids.join(length, ids["conv_id"] == length["_conv_id"], "left_anti").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _NODE])
    chunks = "depth long, a long, b long, first long, ids string"
    return (
        ends.unionByName(none)
        .repartitionByRange("conv_id")
        .sortWithinPartitions(*_NODE, "conv_id")
        .mapInArrow(_chunk_rows(arrow_schema(chunks)), chunks)
        .repartition(*_NODE)
        .sortWithinPartitions(*_NODE, "first")
        .mapInArrow(_digest_rows, "_depth long, _a long, _b long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame, block: int = BLOCK, shared: int = SHARED, lengths: int = LENGTHS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, as ``rebuilt_turns`` defines them.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves and
    saved_tokens over the node's subtree, ends_sha256 over the members that end at it.

    Turns come in the order of ``turn``, null first, equal ones by a digest of role and text; repeated rows are
    turns of their own. Null role or text is empty. Rows without a conv_id belong to no conversation and are left out.
    Remainders keep the id's sign. No rows give no nodes, not even a root.
    """
    turns = numbered_turns(conversations)
    rebuilt, ids = rebuilt_turns(turns, shared, lengths)
    paths = block_paths(rebuilt, block)
    blocks = materialise(distinct_blocks(paths), "marked-blocks")
    nodes = materialise(trie_nodes(blocks, ids, block), "nodes")
    family = _with_family(nodes).select(
        "*",
        (F.col("children") == 0).cast("long").alias("leaf"),
        ((F.col("members") - 1) * F.col("size")).alias("own_saved"),
    )
    tree = running_sums(family, "owner", [F.desc("depth")], {"leaf": "path_leaves", "own_saved": "path_saved"}, "tree")
    owned = tree.groupBy("owner").agg(F.min("depth").alias("top"), F.sum("leaf").alias("leaves"), F.sum("own_saved").alias("saved"))
    more = _passing_sums(paths, blocks, owned, block)
    ends = end_digests(paths, ids, block)
    found = tree.join(more, _on(tree, more, _NODE), "left")
    found = found.join(ends.withColumnsRenamed({f"_{n}": f"__{n}" for n in _NODE}), [F.col(n) == F.col(f"__{n}") for n in _NODE], "left")
    return found.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        (F.col("path_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("path_saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
