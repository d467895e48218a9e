"""Secret scans: fixed patterns, and character Markov models told apart by log-likelihood ratio.

DataFrame operations only. One model is of random strings, the other of ordinary
identifiers; both are bigram tables over a fixed alphabet, counted on a bounded
sample that the fixed patterns label.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import text_key

# The base kinds' patterns. The last group of a match must be as long as the number says.
BASE = {
    "assign": (r"(?:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 6),
    "access": (r"(AKIA[A-Z0-9]+)", 20),
    "hex": (r"([0-9a-f]+)", 24),
}
KINDS = (*BASE, "random")

#: The models' alphabet, and candidates: runs of it of at least ``LONG`` characters with a letter and a digit.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
LONG = 16
_A = r"[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_A})((?={_A}*[0-9])(?={_A}*[A-Za-z]){_A}{{{LONG},}})"

#: Documents whose labelled strings the models are counted on: this many with a base match, this many of any.
SAMPLE = 1000
#: Log-likelihood ratio (natural) from which a candidate is a secret.
MARGIN = 8.0


def _quick(kind: str) -> str:
    """What a text with an accepted match surely holds; cheap to look for."""
    return {"assign": BASE["assign"][0], "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}", "random": CANDIDATE}[kind]


def _pattern(kind: str) -> str:
    """The kind's pattern; where a match is a whole run, short runs hide nothing and are passed over."""
    whole_runs = {"access": r"(AKIA[A-Z0-9]{16,})", "hex": r"([0-9a-f]{24,})", "random": CANDIDATE}
    return whole_runs.get(kind) or BASE[kind][0]


def _piece(kind: str, ratios: list[float], margin: float) -> Callable[[Column, Column], Column]:
    """What a match with the text before it amounts to: its size, and whether it is accepted."""

    def piece(p: Column, i: Column) -> Column:
        value = F.regexp_extract(p, _pattern(kind), 1)
        sure = F.length(value) >= BASE.get(kind, (None, LONG))[1]
        if kind == "random":
            sure = F.when(sure, log_likelihood_ratio(value, ratios) >= margin).otherwise(False)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("i"),
            F.length(p).alias("step"),
            F.length(F.regexp_extract(p, _pattern(kind), 0)).alias("size"),
            sure.alias("sure"),
        )

    return piece


def _matches(text: Column, kind: str) -> Column:
    """Every match with the text before it since the last one, as strings."""
    pattern = _pattern(kind)
    # \G ties each try to the end of the last match; else every place after it would be tried to the text's end.
    every = F.regexp_extract_all(text, F.lit(rf"\G(?s).*?(?:{pattern})"), F.lit(0))
    return F.when(text.rlike(_quick(kind)), every).otherwise(F.array().cast("array<string>"))


def log_ratios(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """log P(next | character) under random strings less that under identifiers, row by row of the alphabet.

    Random strings are the base patterns' values in up to ``sample`` documents that
    have one, identifiers the other runs of 6 or more letters, digits and underscores
    in those and up to ``sample`` more. Without random strings all ratios are zero.
    """
    text = F.coalesce("text", F.lit(""))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    base = text.rlike("|".join(_quick(kind) for kind in BASE))
    known = docs.where(F.col("doc_id").isNotNull())
    with_match = known.where(base).select("doc_id").distinct().orderBy(order, "doc_id").limit(sample)
    of_any = known.select("doc_id").distinct().orderBy(order, "doc_id").limit(sample)
    chosen = with_match.union(of_any).distinct()
    texts = known.join(F.broadcast(chosen), "doc_id").select(text.alias("text"))
    values = F.concat(
        *(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)) for pattern, _ in BASE.values())
    )
    values = F.filter(values, lambda v: F.length(v) >= LONG)
    plain = F.col("text")
    for pattern, _ in BASE.values():
        plain = F.regexp_replace(plain, pattern if "f]" not in pattern else r"[0-9a-f]{24,}", " ")
    words = F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9_]{6,}"), F.lit(0))
    strings = (
        texts.select(
            F.explode(
                F.concat(
                    F.transform(F.array_distinct(values), lambda v: F.struct(F.lit(1).alias("random"), v.alias("value"))),
                    F.transform(F.array_distinct(words), lambda v: F.struct(F.lit(0).alias("random"), v.alias("value"))),
                )
            ).alias("s")
        )
        .select("s.random", "s.value")
        .distinct()
    )
    at = F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("at")
    pairs = (
        strings.select("random", "value", at)
        .groupBy("random", F.substring("value", F.col("at"), F.lit(2)).alias("pair"))
        .count()
        .collect()  # at most the alphabet's pairs, twice
    )
    counts = {(row["random"], row["pair"]): row["count"] for row in pairs}
    if not any(random for random, _ in counts):
        return [0.0] * len(ALPHABET) ** 2
    ratios = []
    for a in ALPHABET:
        totals = [sum(counts.get((random, a + b), 0) for b in ALPHABET) for random in (0, 1)]
        for b in ALPHABET:
            shares = [
                (counts.get((random, a + b), 0) + 0.5) / (totals[random] + 0.5 * len(ALPHABET)) for random in (0, 1)
            ]
            ratios.append(math.log(shares[1] / shares[0]))
    return ratios


def log_likelihood_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum of the log ratios over the value's character pairs."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to a constant
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1))) - 1
    step = lambda total, i: total + F.get(table, code(i) * len(ALPHABET) + code(i + 1))
    return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), step)


def secret_spans(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """Spans of secrets in each document, code points, end exclusive.

    One row per different (doc_id, text), so repeated rows are one document:
    doc_id, text_hash, found: array of (start, kind, end), kind by its place in
    ``KINDS``, in order. Null text is empty.
    """
    docs = docs.select("doc_id", "text")
    ratios = log_ratios(docs, sample)
    text = F.coalesce("text", F.lit(""))
    pieces = []
    for kind in KINDS:
        pieces.append(F.transform(_matches(F.col("text"), kind), _piece(kind, ratios, margin)))
    document = F.array(
        F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("step"), F.lit(0).alias("size"), F.lit(False).alias("sure"))
    )
    key = ["doc_id", "text_hash"]
    running = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("step").over(running)
    span = F.struct((F.col("end") - F.col("size")).cast("int").alias("start"), "kind", F.col("end").cast("int").alias("end"))
    return (
        docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), text.alias("text"))
        .select(*key, F.explode(F.concat(document, *pieces)).alias("p"))
        .select(*key, "p.*")
        .repartition(*key)
        .groupBy(*key, "kind", "i")
        .agg(F.max("step").alias("step"), F.max("size").alias("size"), F.max("sure").alias("sure"))
        .withColumn("end", end)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.when(F.col("sure"), span))).alias("found"))
    )


def spans_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def count_of(found: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(found, lambda s: s["kind"] == number)).cast("long")
