"""Bucketed tables, the shared term ranking, the feature store, hot-key and rank sketches, k-means."""

import itertools
import os
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunelift.operators import enrich, explore, model, skew, terms
from tunelift.plans import flows as P
from tunelift.session import intermediates, materialize_bucketed
from tunelift.sources import readers, writers


@pytest.fixture()
def merge_joins(spark):
    """No broadcasts and no runtime re-plan, so that a plan shows every exchange it needs."""
    new = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- buckets --------------------------------------------------------------------------

def test_song_joins_read_bucketed_songs_as_they_lie(spark, merge_joins):
    songs = spark.range(200).select(F.col("id").alias("song_id"), F.col("id").alias("track_id"), (F.col("id") % 7).alias("artist_id"))
    plays = spark.range(0, 400, 2).select(F.col("id").alias("play_song_id"), F.col("id").alias("play_track_id"), F.lit(3).alias("play_count"))
    likes = spark.range(0, 400, 3).select(F.col("id").alias("track"), F.lit(2).alias("likes"))
    by_song = materialize_bucketed(songs, "songs", ["song_id", "track_id"])
    by_track = materialize_bucketed(songs, "songs", ["track_id"])
    for stored, join, other in ((by_song, enrich.left_join_play_count, plays), (by_track, enrich.left_join_likes, likes)):
        got, want = join(stored, other), join(songs, other)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert plan(want).count("Exchange") == 2 and plan(got).count("Exchange") == 1
        assert plan(got).count("Bucketed: true") == 1


def test_term_pairs_are_grouped_without_a_shuffle(spark, merge_joins):
    rows = [(f"a{i % 7}", f"t{i % 31}") for i in range(300)]
    pairs = terms.term_pairs(spark.createDataFrame(rows, "artist_id string, artist_term string"))
    assert pairs.agg(F.sum("repeats")).first()[0] == 300 and pairs.count() == len(set(rows))
    by_term = pairs.groupBy("artist_term").agg(F.sum("repeats"))
    both = pairs.select("artist_id", "artist_term").distinct()
    top = spark.createDataFrame([("t1",), ("t2",)], "artist_term string")
    assert "Exchange" not in plan(by_term) and "Exchange" not in plan(both)
    assert plan(pairs.join(top, "artist_term", "left")).count("Exchange") == 1


def test_bucketed_tables_end_with_their_block(spark):
    with intermediates(spark):
        df = materialize_bucketed(spark.range(50), "owned", ["id"], buckets=3)
        files = [f.removeprefix("file://") for f in df.inputFiles()]
        names = {t.name for t in spark.catalog.listTables()}
        assert len(files) <= 3 and all(map(os.path.exists, files)) and df.count() == 50
    assert not any(map(os.path.exists, files))
    assert len(names) - len({t.name for t in spark.catalog.listTables()}) == 1


def test_flows_join_bucketed_songs_with_plays(spark, merge_joins):
    r = P.Roles.from_test_tables(spark, SF_SMALL)
    shared = P.with_shared(r)
    joined = enrich.left_join_play_count(enrich.clean_song_info_serving(shared.song_info), shared.play_count)
    assert plan(joined).count("Exchange") == 1 and plan(joined).count("Bucketed: true") == 1  # that of the plays
    hot = P.replace(r, song_info=r.song_info.withColumns({"song_id": F.lit(1).cast("long"), "track_id": F.lit(1).cast("long")}))
    assert "Bucketed: true" not in plan(P.with_shared(hot).song_info)


# ---- both rankings in one aggregate -----------------------------------------------------

def test_two_measures_equal_two_rankings(spark):
    rng = random.Random(3)
    rows = [(f"a{rng.randrange(6)}", f"t{rng.randrange(12)}") for _ in range(90)] + [("a1", None), (None, "t1")]
    songs = [(f"a{rng.randrange(8)}", rng.choice([None, 0.25, 0.5, float("nan"), 1e-15, 0.1])) for _ in range(60)]
    t = spark.createDataFrame(rows, "artist_id string, artist_term string")
    s = spark.createDataFrame(songs, "artist_id string, raw double").withColumn("zero", F.coalesce(F.nanvl("raw", F.lit(0.0)), F.lit(0.0)))
    pairs = terms.term_pairs(t)
    means = {r["artist_term"]: r for r in terms.term_hotness(pairs, terms.hotness_totals(s, ["zero", "raw"]), ["zero", "raw"]).collect()}
    for m in ("zero", "raw"):
        assert {k: r[m] for k, r in means.items()} == {r[0]: r[1] for r in terms.term_mean_hotness(t, s, m).collect()}
    both = {r["artist_id"]: r for r in terms.genre_counts(pairs, s, ["zero", "raw"], k=4).collect()}
    for m in ("zero", "raw"):
        top = terms.top_terms(terms.term_mean_hotness(t, s, m), 4)
        assert {k: r[m] for k, r in both.items()} == {r[0]: r[1] for r in terms.artist_genre_match(t, top).collect()}


def test_flows_with_shared_inputs_are_the_same_and_read_documents_once(spark):
    r = P.Roles.from_test_tables(spark, SF_SMALL)
    shared = P.with_shared(r)
    for flow in (P.serving_features, P.wide_features):
        got, want = (sorted(map(repr, flow(x).collect())) for x in (shared, r))
        assert got == want and got
        assert "documents.parquet" not in plan(flow(shared)) and "lineitem.parquet" not in plan(P.serving_features(shared))
    # another k than the stored one is computed anew
    few = sorted(map(repr, P.wide_features(shared, top_k=5).collect()))
    assert few == sorted(map(repr, P.wide_features(r, top_k=5).collect())) and few != want


# ---- hot keys by a sketch -----------------------------------------------------------------

@pytest.mark.parametrize("tasks", [4, 64, 700])
def test_heavy_keys_are_the_hot_keys(spark, tasks):
    k = F.when(F.col("id") % 3 == 0, F.lit("big")).when(F.col("id") % 7 == 0, F.concat(F.lit("m"), F.col("id") % 4)) \
         .otherwise(F.concat(F.lit("k"), F.col("id") % 900))
    df = spark.range(0, 6000, 1, 40).select(k.alias("k"), (F.col("id") % 2).alias("j"))
    df = df.union(spark.createDataFrame([(None, None)] * 900, "k string, j long"))
    for keys in (["k"], ["k", "j"]):
        want = sorted(map(repr, skew.hot_keys(skew.key_counts(df, keys), keys, tasks).collect()))
        assert sorted(map(repr, skew.heavy_keys(df, keys, tasks).collect())) == want and (want or tasks < 8)
    assert skew.heavy_keys(df.limit(0), ["k"], tasks).collect() == []


def test_heavy_keys_shuffle_no_keys(spark):
    df = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 5 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    found = skew.heavy_keys(df, ["k"], tasks=16)
    assert [tuple(r) for r in found.collect()] == [(-1, 4)]
    dealt = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line]
    # what is dealt: one sketch a task, and the counts of the candidates
    assert "approx_top_k" in plan(found) and len(dealt) >= 2
    merged = [m for m in plan(found).splitlines() if "BroadcastHashJoin" in m or "BroadcastExchange" in m]
    assert merged, "candidates reach the rows by a broadcast"


# ---- ranks by sketches ----------------------------------------------------------------------

def passes(monkeypatch, df, cols):
    """exact_median's result and its number of aggregates (collected DataFrames)."""
    n, collect = [0], type(df).collect

    def counted(self):
        n[0] += 1
        return collect(self)

    stacked = explore.stack_columns(df, cols)
    with monkeypatch.context() as m:
        m.setattr(type(df), "collect", counted)
        out = explore.select_medians(stacked)
    return out, n[0]


VALUES = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True), st.sampled_from([0.0, -0.0, 1.0, 5e-324, 1e308, -1e308]))


@settings(max_examples=12, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VALUES, min_size=1, max_size=60))
def test_median_of_any_doubles_in_one_pass(spark, monkeypatch, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got, n = passes(monkeypatch, df, ["x"])
    real = sorted(v for v in values if v is not None and v == v)
    assert n <= 3
    if not real:
        assert got == {}
    else:
        a, c = real[(len(real) - 1) // 2], real[len(real) // 2]
        want = a if a == c else a / 2 + c / 2 if abs(c - a) == float("inf") else a + (c - a) * 0.5
        assert got["x"] == want or (got["x"] != got["x"] and want != want)


@pytest.mark.parametrize("kind", ["spread", "ties", "two", "magnitudes", "hot"])
def test_median_of_many_rows_in_three_passes(spark, monkeypatch, kind):
    n = 60_001
    rng = np.random.default_rng(5)
    x = {"spread": rng.random(n), "ties": rng.integers(0, 50, n).astype(float), "two": (np.arange(n) % 2).astype(float),
         "magnitudes": 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1, 1], n),
         "hot": np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(0, 1e6, n))}[kind]
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": -x})).repartition(5)
    got, passed = passes(monkeypatch, df, ["x", "y"])
    assert got == {"x": float(np.median(x)), "y": float(np.median(-x))} and passed <= 3


def test_any_ranks(spark):
    x = [float(v) for v in np.random.default_rng(2).lognormal(0, 3, 5000)]
    df = spark.createDataFrame([("f", v) for v in x], "feature string, x double")
    total, found = explore.select_ranks(df, lambda n: [[0], [n // 7, n // 7 + 1], [n - 1]])
    assert total == {"f": 5000} and found == {("f", k): sorted(x)[k] for k in (0, 714, 715, 4999)}


# ---- k-means ----------------------------------------------------------------------------------

def every_partition(values, k):
    v = sorted(values)
    best = float("inf")
    for cuts in itertools.combinations_with_replacement(range(len(v) + 1), k - 1):
        ends = [0, *cuts, len(v)]
        best = min(best, sum(np.var(v[a:b]) * (b - a) for a, b in zip(ends, ends[1:]) if b > a))
    return best


def test_optimal_cost_is_that_of_the_best_intervals(spark):
    rng = np.random.default_rng(1)
    for n, k in ((1, 3), (7, 2), (9, 3), (10, 4)):
        v = [float(x) for x in rng.integers(0, 12, n)]
        df = spark.createDataFrame([(x,) for x in v], "v double")
        assert explore.optimal_cost(df, "v", k) == pytest.approx(every_partition(v, k), abs=1e-9)
    assert explore.optimal_cost(df.where("false"), "v", 3) == 0
    with pytest.raises(ValueError):
        explore.optimal_cost(df, "v", 2, most=3)


def test_kmeans_of_all_events_is_near_the_optimum(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "value")
    rows, centers = explore.kmeans_1d(events, "value")
    best = explore.optimal_cost(events, "value")
    assert 0.999 * best <= explore.cluster_cost(rows, "value") <= 1.1 * best
    assert rows.count() == events.count() and centers == sorted(centers)
    for r in rows.collect():
        assert min(range(8), key=lambda i: (abs(r["value"] - centers[i]), i)) == r["cluster"]
    # Spark ML's fit of the same column, by the same yardstick
    assert explore.cluster_cost(explore.kmeans_label(events, "value"), "value") <= 1.25 * best


def test_kmeans_with_missing_values(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(i, float(i % 4) * 100) for i in range(40)] + [(100, None), (101, nan), (102, inf), (103, -inf)],
                               "id int, v double")
    rows, centers = explore.kmeans_1d(df, "v", k=4)
    assert centers == [0.0, 100.0, 200.0, 300.0]
    got = {r["id"]: r["cluster"] for r in rows.collect()}
    assert got[100] is None and got[101] is None and all(got[i] == i % 4 for i in range(40))
    none, centers = explore.kmeans_1d(df.where("v is null"), "v")
    assert centers == [] and [r["cluster"] for r in none.collect()] == [None]


# ---- feature store ------------------------------------------------------------------------------

def scanned_rows(df):
    """Rows that the scan of a collected DataFrame gave after skipping row groups."""
    def leaves(p):
        kids = p.children()
        if kids.size() == 0:
            return [p]
        return [x for i in range(kids.size()) for x in leaves(kids.apply(i))]

    df.collect()
    p = df._jdf.queryExecution().executedPlan()
    return sum(x.metrics().apply("numOutputRows").value() for x in leaves(p) if "FileScan" in x.toString())


def test_feature_store_reads_one_file_of_many(spark, scratch):
    feats = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 200)).alias("artist_name"),
        F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit(1).alias("td_confidence"), (F.col("id") / 7).alias("artist_hotness"))
    path = os.path.join(scratch, "store")
    writers.write_feature_store(feats, path, files=16)
    assert sorted(map(tuple, spark.read.parquet(f"{path}/rows").collect())) == sorted(map(tuple, feats.collect()))
    one = readers.read_feature_store(spark, path, artist_name="A-17")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, feats.where("artist_name = 'a17'").collect()))
    assert len(one.inputFiles()) <= 2 and "EqualTo(artist_name,a17)" in plan(one)
    assert len(readers.read_feature_store(spark, path, artist_name="hot").inputFiles()) >= 4  # a third of the rows
    title = readers.read_feature_store(spark, path, title="T 77")
    assert [r["title"] for r in title.collect()] == ["t77"] and "EqualTo(title,t77)" in plan(title)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_rows(readers.read_feature_store(spark, path, title="no such title")) == 0  # ranges and bloom filters
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert readers.read_feature_store(spark, path, artist_name="zz").collect() == []
    assert readers.read_feature_store(spark, path, artist_name="hot", title="t3").count() == 1


# ---- trees ---------------------------------------------------------------------------------------

def test_a_single_tree_predicts_the_mean_label_of_its_rows(spark):
    rows = [(float(i % 5), float(i % 3), float((i * 37) % 101)) for i in range(300)] + [(1.0, None, 5.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    fitted = model.train_forest(df, ["a", "b"], num_trees=1, max_depth=20, bootstrap=False)
    shared = model.predict_batch(fitted, df.where("label is not null")).where("b is not null").groupBy("prediction").agg(
        F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
    assert len(shared) == 15 and all(abs(r["prediction"] - r["mean"]) < 1e-9 for r in shared)


def test_forest_splits_on_confidence_as_a_category(spark):
    df = spark.createDataFrame([(i % 6, float(i % 6 in (0, 3, 4)) * 100 + i % 2, float(i % 2)) for i in range(600)],
                               "td_confidence int, td_downloads double, x double")
    data = model.prepare(df, ["td_confidence", "x"])
    tree = model.train_forest(data, ["td_confidence", "x"], num_trees=1, max_depth=2, bootstrap=False).stages[-1]
    # no threshold separates the codes 0, 3 and 4 from the others; a set of codes does
    assert "feature 0 in {" in tree.toDebugString
    assert sorted(r[0] for r in model.predict_batch(
        model.train_forest(data, ["td_confidence", "x"], 1, 2, bootstrap=False), data).select("prediction").distinct().collect()) == [0.0, 1.0, 100.0, 101.0]


def walked(spark, fitted, rows, scratch):
    """Predictions by walking the stored trees: thresholds and category sets, mean over the trees."""
    path = os.path.join(scratch, "forest")
    fitted.stages[-1].write().overwrite().save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        n = r["nodeData"] if "nodeData" in r.asDict() else r
        trees.setdefault(r["treeID"], {})[n["id"]] = n

    def value(nodes, x):
        n = nodes[0]
        while n["leftChild"] >= 0:
            s = n["split"]
            left = (x[s["featureIndex"]] in s["leftCategoriesOrThreshold"] if s["numCategories"] >= 0
                    else x[s["featureIndex"]] <= s["leftCategoriesOrThreshold"][0])
            n = nodes[n["leftChild"] if left else n["rightChild"]]
        return n["prediction"]

    return [sum(value(t, x) for t in trees.values()) / len(trees) for x in rows]


def test_request_scores_equal_the_walked_trees(spark, scratch):
    r = P.with_shared(P.Roles.from_test_tables(spark, SF_SMALL))
    from tunelift.operators.lookup import FEATURES
    wide = P.scoring_training_view(P.wide_features(r))
    fitted = model.train_forest(model.prepare(wide, FEATURES), FEATURES, num_trees=7, max_depth=5)
    got = P.score_requests(r.requests, P.serving_features(r), fitted).collect()
    want = walked(spark, fitted, [[x[c] for c in FEATURES] for x in got], scratch)
    assert [x["prediction"] for x in got] == pytest.approx(want)
    assert [x["prediction_int"] for x in got] == [int(v) for v in want]
