"""Benchmark decontamination: a hash set of normalised test n-grams against token windows.

DataFrame operations only. Every window of a document's words is hashed where it
is read and looked up in the benchmark's windows; equal hashes are verified word
by word. Only documents' summary rows and hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normal_words, text_key

WINDOW = 13

#: Bytes that the distinct benchmark windows and their item ids may take for the set to be broadcast; a larger
#: set is joined by a shuffle on the window's hash.
BROADCAST_BYTES = 256 << 20
#: Longs of the bit field that keeps windows out of that shuffle: one for every four windows, within these bounds.
FIELD_LEAST, FIELD_MOST = 1 << 6, 1 << 22


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: gram (array of words), size and the items' ids.

    An item of fewer words than a window, but not none, is one window. Items
    without an id count as hits but not as items.
    """
    items = benchmark.select("item_id", normal_words(F.col("text")).alias("item_words"))
    n = F.size("item_words")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - window + 1))
    return (
        items.where(n > 0)
        .select("item_id", "item_words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("item_words", F.col("start"), F.lit(window)).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_set("item_id").alias("items"))
        .select(F.xxhash64("gram").alias("gram_hash"), F.size("gram").alias("gram_size"), "gram", "items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """What of each document occurs in the benchmark.

    One row per different (doc_id, text), so repeated rows are one document:
    doc_id, text_hash, n_words, hits (sorted (start, size) of matched windows),
    n_hit (words inside a hit), items (ids of matched items, sorted as strings).
    Null text has no words; null ids are a document of their own.
    """
    grams = benchmark_windows(benchmark, window)
    # What a row takes in memory: its words and ids, and a header for each of them and for the row.
    held = F.octet_length(F.array_join("gram", " ")) + F.size("gram") * 16 + F.size("items") * 32 + 96
    sizes = {r["gram_size"]: r for r in grams.groupBy("gram_size").agg(F.count("*").alias("n"), F.sum(held.cast("long")).alias("held")).collect()}
    small = sum(r["held"] for r in sizes.values()) <= BROADCAST_BYTES
    lengths = sorted(sizes) or [window]

    words = docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), normal_words(F.col("text")).alias("words"))
    at = words.select("*", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("start"))
    if len(lengths) > 1:
        at = at.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("length"))
    else:
        at = at.withColumn("length", F.lit(lengths[0]))
    # Start 0 stands for the document itself, start n for its n-th word. Rows without a window
    # have a hash of their own, so that they don't meet on NULL where the join is a shuffle, and
    # rows carry their window only, never all words.
    fits = (F.col("start") > 0) & (F.col("start") + F.col("length") <= F.size("words") + 1)
    window_words = F.slice("words", F.greatest("start", F.lit(1)), F.col("length"))
    rows = at.select(
        "doc_id",
        "text_hash",
        F.size("words").alias("n_words"),
        "start",
        F.when(fits, window_words).alias("window_words"),
    ).select("*", F.coalesce(F.when(F.col("window_words").isNotNull(), F.xxhash64("window_words")),
                             F.xxhash64("text_hash", "doc_id", "start")).alias("hash"))
    same = (F.col("hash") == F.col("gram_hash")) & (F.col("window_words") == F.col("gram"))
    if small:
        grams = F.broadcast(grams)
    else:
        rows = rows.where((F.col("start") == 0) | may_occur(grams, sum(r["n"] for r in sizes.values()), F.col("hash")))
    found = rows.join(grams, same, "left").where((F.col("start") == 0) | F.col("gram_hash").isNotNull())
    hit = F.when(F.col("start") > 0, F.struct((F.col("start") - 1).alias("start"), F.col("gram_size").alias("size")))
    return (
        found.select("doc_id", "text_hash", "n_words", hit.alias("hit"), "items")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.sort_array(F.collect_set("hit")).alias("hits"),
            F.sort_array(
                F.array_distinct(F.transform(F.flatten(F.collect_set("items")), lambda x: x.cast("string")))
            ).alias("items"),
        )
        .withColumn("n_hit", _covered(F.col("hits")))
    )


def may_occur(grams: DataFrame, n: int, window_hash: Column) -> Column:
    """False for hashes that no window of ``grams`` has, and for some sixteenth or less of the others true by chance.

    A bit is set for every window in a field of longs that grows with their number ``n`` up to 32 MB, so it is
    one row of bounded size; it is computed once and handed to every task with the plan.
    """
    longs = min(FIELD_MOST, max(FIELD_LEAST, 1 << (n // 4).bit_length()))

    def place(value: Column) -> Column:
        return F.shiftrightunsigned(value, 6).bitwiseAND(F.lit(longs - 1))

    def bit(value: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int"))

    marked = grams.groupBy(place(F.col("gram_hash")).alias("at")).agg(F.bit_or(bit(F.col("gram_hash"))).alias("bits"))
    every = grams.sparkSession.range(longs).join(marked, F.col("id") == F.col("at"), "left")
    entries = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    field = every.agg(F.transform(entries, lambda entry: entry["bits"]).alias("field"))
    own = F.element_at(field.scalar(), (place(window_hash) + 1).cast("int"))
    return own.bitwiseAND(bit(window_hash)) != 0


def _covered(hits: Column) -> Column:
    """Words inside any of the sorted (start, size) intervals."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))

    def add(done: Column, hit: Column) -> Column:
        end = hit["start"] + hit["size"]
        more = F.greatest(F.lit(0), end - F.greatest(done["end"], hit["start"]))
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["words"] + more).alias("words"))

    return F.aggregate(hits, empty, add, lambda done: done["words"])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The rule: a hit, and at least a twentieth of the words inside hits."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they were.

    Rows equal in id and text stay or go together, null ids are ids like others, null and empty texts have no
    words and stay. Without benchmark items with a word nothing goes.
    """
    bad = (
        contamination(docs, benchmark, window)
        .where(contaminated(F.col("n_hit"), F.col("n_words")))
        .select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    )
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_key(docs["text"]) == bad["bad_hash"])
    return docs.join(bad, same, "left_anti")
