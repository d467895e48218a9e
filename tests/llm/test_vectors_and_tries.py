"""Operators over embeddings and conversations against plain versions."""

import math
import random

import brute
import numpy as np
import pytest
from brute import SMALL

from martloom.llm import centroids, prefixes, running, topk
from martloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"
TURNS = "conv_id long, turn long, role string, text string"


def rows(df, *columns):
    order = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=order)


def same(df, expected):
    names = df.columns
    assert rows(df, *names) == sorted(expected, key=lambda r: tuple((x is None, x) for x in r))


def odd_vectors(n, size, seed=1):
    """Ties, copies, repeated rows, one id with several vectors, null ids and unusable vectors."""
    r = random.Random(seed)
    made = [(i, [r.choice((-0.5, -0.25, 0.0, 0.25, 0.5, 0.126)) for _ in range(size)]) for i in range(n)]
    made += made[:7] + [(i + n, made[n - 1][1]) for i in range(5)] + [(50, [0.125] * size), (None, made[0][1]), (None, [0.25] * size)]
    bad = [None, [], [0.5], [None] * size, [math.nan] + [0.1] * (size - 1), [math.inf] + [0.1] * (size - 1), [0.1] * (size + 1)]
    return made + [(10_000 + i, v) for i, v in enumerate(bad)] + [(-100, [-0.0] * size)]


def test_clusters_of_the_small_tables(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    same(QUERIES["op11_centroid_clustering"](spark, SMALL), brute.clusters([tuple(r) for r in table.select("vec_id", "embedding").collect()]))


@pytest.mark.parametrize("n", [120, 3, 0])
def test_clusters_of_odd_vectors(spark, n):
    made = odd_vectors(n, 64) if n else [(1, None), (2, [])]
    df = spark.createDataFrame(made, VECTORS).selectExpr("1 cluster", "*", "2 about", "3 total", "4 distance", "5 vector").repartition(5)
    same(centroids.clusters(df), brute.clusters(made))
    same(centroids.clusters(df, k=3, rounds=2, size=1), brute.clusters(made, 3, 2, 1))


def test_orchard_is_nearest_with_ties():
    r = np.random.default_rng(3)
    for k in (1, 2, 9, 40):
        c, v = r.integers(-2, 3, (k, 3)), r.integers(-3, 4, (500, 3))
        every = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        at, best = centroids.orchard(v, c)
        assert (at == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_orchard_leaves_far_centroids_out():
    """Vectors of one of two distant camps never meet the other camp beyond the one they start from."""
    looked = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype.kind == "i" and self.ndim == 2:
                looked.extend(key.tolist())
            return super().__getitem__(key)

    c = np.array([[0, 0], [1, 0], [0, 1], [1000, 0], [1001, 0], [1000, 1]])
    centroids.orchard(np.array([[0, 0], [1, 1]]), c.view(Watched))
    assert set(looked) <= {1, 2}


def test_a_component_beyond_the_range_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e30] * 64)], VECTORS)
    with pytest.raises(Exception, match="beyond"):
        centroids.clusters(df).collect()
    with pytest.raises(Exception, match="beyond"):
        topk.top_inner_products(df, df).collect()


def test_top_products_of_the_small_tables(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    same(QUERIES["op12_exact_top_k"](spark, SMALL), brute.top_products([tuple(r) for r in table.select("vec_id", "embedding").collect()]))


@pytest.mark.parametrize("n, block, shard, piece", [(700, 3, 50, 64), (220, 1 << 13, 1 << 16, 1 << 12), (4, 2, 2, 2), (0, 9, 9, 9)])
def test_top_products_of_odd_vectors(spark, monkeypatch, n, block, shard, piece):
    for name, value in (("BLOCK", block), ("SHARD", shard), ("PIECE", piece), ("LEFT", 6), ("_QUERIES", 2)):
        monkeypatch.setattr(topk, name, value)
    made = odd_vectors(n, 12) if n else [(1, None), (2, [])]
    df = spark.createDataFrame(made, VECTORS).selectExpr("1 task", "2 side", "*", "3 mark", "4 block", "5 score", "6 rank").repartition(6)
    same(topk.top_inner_products(df.where("vec_id % 50 = 0"), df), brute.top_products(made))
    same(topk.top_inner_products(df.where("false"), df), [])


def test_bounds_hold_and_reading_stops_early():
    r = np.random.default_rng(5)
    vectors = r.integers(-9, 10, (300, 8))
    queries = np.concatenate([r.integers(-9, 10, (20, 8)), [[100, 0, 0, 0, 0, 0, 0, -90]]])
    best = topk.Best(queries, np.arange(-21, 0), np.zeros(21, dtype=np.int64), 5)
    lists = topk.Lists(vectors)
    for depth in (3, 40, 300):
        lists.read_to(depth)
        lower, upper = lists.bounds()
        low, high = (best.plus @ x[0].T + best.minus @ x[1].T for x in (lower, upper))
        assert (low <= queries @ vectors.T).all() and (queries @ vectors.T <= high).all()
    assert (low == high).all()
    read = []
    original = topk.Lists.read_to
    try:
        topk.Lists.read_to = lambda self, depth: (read.append(depth), original(self, depth))
        steep = np.zeros((1000, 4), dtype=np.int64)
        steep[:10] = 50
        one = topk.Best(np.array([[3, 2, 1, 1]]), np.array([-1]), np.array([0]), 5)
        topk.search(one, steep, np.zeros(1000, dtype=np.int64), np.arange(1000), np.zeros(1000, dtype=np.int64))
    finally:
        topk.Lists.read_to = original
    assert max(read) < 1000 and one.found[3].tolist() == [0, 1, 2, 3, 4]


def odd_turns(seed=2):
    """Shared beginnings, copies, long conversations, missing bases, null ids, ties and repeated rows."""
    r = random.Random(seed)
    made = []
    for conv in [*range(0, 60), *range(100, 130), *range(207, 240), -7, -101, -100, 10**12 + 5]:
        made += [(conv, t * 3 - 4, r.choice(("user", "assistant")), r.choice("ab")) for t in range(r.randrange(12))]
    made += [(300 + i, t, "user", f"line {t}") for i in range(9) for t in range(90 + (i % 2))]
    made += [(401, None, None, None), (401, None, "user", None), (402, 1, "x", ""), (402, 1, "x", ""), (402, None, "y", "é\U0001f600")]
    made += [(403, 5, "user", "tie a"), (403, 5, "user", "tie b"), (None, 1, "user", "lost"), (404, 1, "ab", "c"), (405, 1, "a", "bc")]
    return made


@pytest.mark.parametrize("block", [1, 3, 4, 16])
def test_trie_of_odd_conversations(spark, block):
    made = odd_turns()
    names = "'x' depth", "1 a", "2 b", "3 j", "4 n", "5 owner", "6 members", "7 part", "8 edge", "*", "9 h", "10 base", "11 pos", "12 size"
    df = spark.createDataFrame(made, TURNS).selectExpr(*names).repartition(7)
    same(prefixes.prefix_trie(df, block), brute.trie(made))


def test_trie_of_the_small_tables(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    same(QUERIES["op13_conversation_prefix_trie"](spark, SMALL), brute.trie([tuple(r) for r in table.collect()]))


def test_trie_of_nothing(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefixes.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0


def test_running_sums_split_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 30_000, 1, 6).selectExpr("case when id % 3 = 0 then 5 else id % 40 end k", "id", "id * 7919 % 1000 v", "9223372036854775807 w")
        found = running.running_sums(df, "k", [df["id"]], {"v": "vs", "w": "ws"}, "test").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums = {}
    for r in sorted(found, key=lambda r: r.id):
        v, n = sums.get(r.k, (0, 0))
        sums[r.k] = v + r.v, n + 1
        assert (r.vs, (r.ws + sums[r.k][1] - 2**63 * sums[r.k][1]) % 2**64) == (sums[r.k][0], 0)
    assert len(found) == 30_000
