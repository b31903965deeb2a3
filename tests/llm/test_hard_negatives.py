"""Hard negatives against brute force: ties, repeats, odd rows, hot vectors, elimination."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tunelift.llm import hard_negatives as H
from tunelift.llm import vectors as V


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    rows = sorted({(i, lab, tuple(x)) for i, lab, x in rows if i is not None and lab is not None and x is not None})

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        ranked = sorted((-dot(a[2], r[2]), r[0], r) for r in rows if r != a)
        same = [(i, -s) for s, i, r in ranked if r[1] == a[1]][:positives]
        for i, ps in same:
            found = [(j, -s) for s, j, r in ranked if r[1] != a[1] and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(a[0], i, k + 1, j, ps, s) for k, (j, s) in enumerate(found)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, label long, x array<int>").repartition(3)


def mined(spark, rows, **settings):
    return sorted(map(tuple, H.mine(frame(spark, rows), F.col("id") % 5 == 0, **settings).collect()))


def clustered(n, dims, centres, spread, seed, labels=3):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, dims)) * 100
    x = np.floor(c[rng.integers(centres, size=n)] + spread * rng.standard_normal((n, dims))).astype(int)
    return [(i, int(rng.integers(labels)), v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("rows", [
    clustered(300, 6, 8, 5, 1),
    clustered(200, 3, 200, 1, 2, labels=2),
    [(i, i % 3, [i % 4, i % 5 - 2]) for i in range(120)],                     # many ties, negative scores
    [(i, i % 2, [3, 4, 5]) for i in range(90)] + [(200, 0, [1, 1, 1])],       # one hot vector
], ids=["clusters", "spread", "ties", "hot"])
def test_matches_brute_force(spark, rows):
    want = brute(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows, sample_rows=80, leaf_rows=16, chunk_anchors=8) == want
    assert mined(spark, rows[:60], sample_rows=8, leaf_rows=1000) == brute(rows[:60], lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rows = [(0, 1, [5, 5]), (0, 1, [5, 5]), (0, 1, [4, 5]), (5, None, [1, 1]), (None, 1, [9, 9]), (10, 1, None),
            (15, 2, []), (1, 2, [3, 3]), (1, 2, [3, 3]), (2, 2, [3, 3]), (3, 2, [3, 2, 7]), (4, 1, [6]), (20, 7, [1, 2]),
            (25, 1, [0, 0]), (6, 2, [-5, -5])]
    want = brute(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows) == want and want
    extra = frame(spark, rows).withColumns({c: F.lit("x") for c in ("aid", "leaf", "block", "chunk", "low", "w", "place")})
    assert sorted(map(tuple, H.mine(extra, F.col("id") % 5 == 0).collect())) == want
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1])]) == [] and mined(spark, [(1, 1, [1]), (2, 1, [1])]) == []


def test_large_components_stay_exact(spark):
    big = 2 ** 29
    rows = [(i, i % 2, [big + i, big - 3 * i, (-1) ** i * (big - i)]) for i in range(40)]
    assert mined(spark, rows, high=100, low=0) == brute(rows, lambda i: i % 5 == 0, high=100, low=0)
    with pytest.raises(ArithmeticError):
        H.mine(frame(spark, [(0, 1, [2 ** 31 - 1] * 4)]), F.col("id") % 5 == 0)


def test_far_subtrees_are_eliminated(spark):
    rows = frame(spark, clustered(4000, 8, 16, 3, 4))
    tree = H.fit(rows, sample_rows=1000, leaf_rows=100)
    placed = H.place(rows, tree)
    H.set_ranges(placed, tree)
    assert tree.leaves > 16 and placed.select("leaf").distinct().count() > 16
    anchors = rows.where("id % 50 = 0").select(F.col("id").alias("aid"), "id", "label", "x", F.array(F.lit(H.FAR_LOW)).alias("low"),
                                               F.array(F.lit(H.FAR_HIGH)).alias("high"))
    seen = H._visits(anchors, tree, True, 5)
    assert seen.count() < 0.35 * anchors.count() * tree.leaves
    # what a visit leaves out lies outside the annulus
    x = np.array([r["x"] for r in placed.orderBy("id").collect()])
    leaf = np.array([r["leaf"] for r in placed.orderBy("id").collect()])
    for r in seen.where("aid < 200").groupBy("aid").agg(F.collect_set("leaf").alias("to"), F.first("low")[0].alias("low")).collect():
        assert set(leaf[x @ x[r["aid"]] >= r["low"]]) <= set(r["to"])


def test_blocks_of_a_hot_vector_are_bounded(spark):
    rows = frame(spark, [(i, i % 2, [7, 1]) for i in range(3000)] + [(5000 + i, 0, [i, -i]) for i in range(200)])
    tree = H.fit(rows, sample_rows=400, leaf_rows=100)
    n = H.place(rows, tree).groupBy("leaf").count().collect()
    assert max(r["count"] for r in n) >= 3000  # one leaf holds them; blocks cut it by a hash
    blocks = rows.groupBy(F.pmod(F.xxhash64("id", "x"), F.lit(30))).count().collect()
    assert max(r["count"] for r in blocks) < 200


def test_query_on_its_table(spark):
    got = H.op11_hard_negatives(spark, SF_CHECK)
    assert got.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"],
             [math.floor(256 * c) for c in r["embedding"]])
            for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()
            if r["label"] is not None and r["embedding"] is not None
            and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0)


def test_usable_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, -0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]),
                                (5, [float("-inf")]), (6, []), (7, [0.001, -0.001])], "i int, v array<double>")
    got = df.where(V.usable("v")).select("i", V.scaled("v", 256).alias("x")).collect()
    assert [(r["i"], r["x"]) for r in got] == [(1, [256, -128]), (6, []), (7, [0, -1])]
