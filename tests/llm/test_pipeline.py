"""The pipeline against plain versions of its stages."""

import hashlib
import random

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from brute import SMALL
from tokenizers import Tokenizer

from martloom.llm import pii, quality


def test_stages_keep_the_columns_of_documents(spark, small):
    docs = small
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.dtypes == small.dtypes


def test_run_against_plain_stages(spark, small, labels):
    verdict = quality.judge(quality.fit_line_field(small, labels))
    docs = [(r.doc_id, r.text) for r in small.collect() if verdict(r.text or "")[-1]]
    stay = {component for _, _, component in brute.near_duplicates(docs)}
    docs = [d for d in docs if d[0] in stay]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination(docs, items) if r[5]}
    cues = pii.automaton()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in docs:
        if doc_id not in bad:
            ids = library.encode(pii.masked_text(text, pii.spans_of(text, cues)), add_special_tokens=False).ids
            expected.append((doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()))
    got = [tuple(r)[:3] for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(expected) and 0 < len(got) < small.count()


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def good_text(n):
    r = random.Random(n)
    word = lambda: "".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(1, 4)))
    return "\n".join(" ".join(word() for _ in range(14)).capitalize() + "." for _ in range(6))


#: Names that stages use inside, in columns of their own.
CLASHING = {name: name for name in (
    "words lines quality toxic print root first copies text_key text_hash start hits items bad_id bad_hash spans found score wanted _row row "
    "least order label gram hash several text_len n_words kept place depth").split()}  # fmt: skip


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, good_text(i)) for i in range(6)]
    rows += [(3, good_text(3)), (3, good_text(3)), (None, good_text(50)), (None, good_text(50)), (None, good_text(51)), (7, good_text(2)), (8, None), (9, ""), (10, " \n ")]
    rows += [(11, good_text(11) + "\nmail me@example.org or 10.1.2.3"), (12, good_text(12) + " " * 1_200_000 + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    return df.select(F.lit("en").alias("lang"), "*", *[F.lit(v).alias(k) for k, v in CLASHING.items()]).repartition(4)


def stages(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        yield name, docs


@pytest.fixture(scope="module", params=["full", "empty"])
def folder(request, spark, tmp_path_factory):
    """``labels`` and ``benchmark`` of the small table, or none of their rows."""
    path = tmp_path_factory.mktemp(request.param)
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        (table if request.param == "full" else table.limit(0)).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


def test_stages_of_odd_rows(spark, odd, folder):
    """Nulls, repeated rows, blank and very long texts, and columns with names that stages use."""
    got = {}
    for name, docs in stages(spark, odd, folder):
        if name != "bpe_encoding":
            assert docs.dtypes == odd.dtypes
            rows = docs.collect()
            assert all(r[c] == c for r in rows for c in CLASHING) and {r.lang for r in rows} == {"en"}
        got[name] = docs.collect()
    ids = lambda name: sorted((r.doc_id for r in got[name]), key=lambda i: (i is None, i))
    assert ids("quality_rules") == [0, 1, 2, 3, 3, 3, 4, 5, 7, 11, 12, None, None, None]
    assert ids("simhash_near_dedup") == ids("benchmark_decontamination") == ids("bpe_encoding")
    kept = ids("simhash_near_dedup")
    assert kept.count(3) <= 1 and 7 not in kept and {2, 12} <= set(kept)
    masked = {r.doc_id: r.text for r in got["personal_data"]}
    assert "me@example.org" not in masked[11] and "10.1.2.3" not in masked[11]


def test_each_stage_alone_on_odd_rows(spark, odd, folder):
    """Stages get rows that an earlier one would have dropped."""
    n = odd.count()
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, folder).collect()
        assert len(found) == n if name in ("benchmark_decontamination", "personal_data", "bpe_encoding") else 0 < len(found) < n
        assert stage(spark, odd.limit(0), folder).count() == 0
