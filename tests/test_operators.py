"""Operator semantics on hand-written rows, and row-count properties."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tunelift.operators import enrich, explore, lookup, model, terms


def test_artist_weight_freq_skips_non_numbers(spark):
    df = spark.createDataFrame(
        [("a", "t", "0.5", "2"), ("a", "u", "1", "1"), ("a", "v", "NA", "1"), ("b", "t", "3", "1")],
        "artist_id string, artist_term string, weight string, freq string")
    got = {r[0]: r[1] for r in enrich.artist_weight_freq(df).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_artist_genre_match_keeps_zero(spark):
    t = spark.createDataFrame([("a", "t"), ("a", "t"), ("a", "u"), ("b", "u")],
                              "artist_id string, artist_term string")
    top = spark.createDataFrame([("t", 1.0)], "artist_term string, artist_hotness double")
    got = {r[0]: r[1] for r in terms.artist_genre_match(t, top).collect()}
    assert got == {"a": 1, "b": 0}


def test_term_mean_weights_artists_by_song_count(spark):
    t = spark.createDataFrame([("a", "t"), ("b", "t")], "artist_id string, artist_term string")
    songs = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0)], "artist_id string, h double")
    got = terms.term_mean_hotness(t, songs, "h").first()["artist_hotness"]
    assert abs(got - 2 / 3) < 1e-12


def test_top_terms_breaks_ties_by_term(spark):
    th = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", None)],
                               "artist_term string, artist_hotness double")
    assert [r[0] for r in terms.top_terms(th, 3).collect()] == ["c", "a", "b"]


def test_inner_join_genre_match_drops_artists_without_terms(spark):
    songs = spark.createDataFrame([(1, "a"), (2, "z")], "song_id int, artist_id string")
    genre = spark.createDataFrame([("a", 0)], "artist_id string, genre_match_count int")
    assert [r["song_id"] for r in terms.inner_join_genre_match(songs, genre).collect()] == [1]


def test_left_join_downloads_fanout_and_zero(spark):
    songs = spark.createDataFrame([("x", "s1"), ("y", "s2")], "artist_name string, title string")
    rec = spark.createDataFrame([("x", "s1", 5, 10.0), ("x", "s1", 1, 20.0)],
                                "td_artist string, td_title string, td_confidence int, td_meanPrice double")
    out = enrich.left_join_downloads(songs, rec).collect()
    assert len(out) == 3
    miss = [r for r in out if r["artist_name"] == "y"][0]
    assert miss["td_confidence"] == 0 and miss["td_meanPrice"] == 0.0
    assert miss["has_download_record"] is False


FEATS = "artist_name string, title string, td_confidence int, artist_hotness double, " \
        "song_hotness double, td_meanPrice double"


@pytest.fixture()
def features(spark):
    rows = [
        ("a1", "s1", 5, 0.2, 0.4, 10.0),                                # one exact match
        ("a2", "s2", 5, 0.2, 0.4, 10.0), ("a2", "s2", 1, 0.4, 0.6, 30.0),  # two exact
        ("a3", "s3", 4, 0.5, 0.5, 50.0),                                # artist level single
        ("a4", "s4", 2, 0.1, 0.1, 10.0), ("a4", "s5", 2, 0.3, 0.3, 30.0),  # artist level mean
        ("a5", "only", 0, 0.9, 0.9, 90.0),                              # title level
    ]
    return spark.createDataFrame(rows, FEATS)


def test_lookup_cascade_levels(spark, features):
    req = spark.createDataFrame(
        [(1, "A1", "s1"), (2, "a2", "S2!"), (3, "a3", "nope"), (4, "a4", "nope"),
         (5, "zz", "only"), (6, "zz", "zz")], "request_id int, artist string, title string")
    out = {r["request_id"]: r for r in lookup.lookup_cascade(req, features).collect()}
    assert len(out) == 6
    assert out[1]["match_level"] == "exact" and out[1]["td_confidence"] == 5.0
    assert out[2]["match_level"] == "exact" and out[2]["td_confidence"] == 3.0
    assert abs(out[2]["td_meanPrice"] - 20.0) < 1e-12
    assert out[3]["match_level"] == "artist" and out[3]["td_confidence"] == 4.0
    assert out[4]["match_level"] == "artist" and out[4]["td_confidence"] == 3.0
    assert abs(out[4]["artist_hotness"] - 0.2) < 1e-12
    assert out[5]["match_level"] == "title" and out[5]["td_meanPrice"] == 90.0
    assert out[6]["match_level"] == "global" and out[6]["td_confidence"] == 3.0
    assert abs(out[6]["td_meanPrice"] - 230.0 / 7) < 1e-9


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert explore.correlation_with_label(df, ["x"], "y").first()["r"] is None


def test_mean_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (3.0,)], "x double")
    r = explore.mean_median(df, ["x"]).first()
    assert r["mean"] == 4.0 and r["median"] == 2.5


def test_regression_metrics_match_evaluator(spark):
    rows = [(float(i), float(i) * 1.1 + (i % 3)) for i in range(50)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = model.regression_metrics(df).first()
    for name, key in [("mse", "mse"), ("rmse", "rmse"), ("r2", "r2"), ("mae", "mae"),
                      ("var", "explained_variance")]:
        ev = RegressionEvaluator(metricName=name).evaluate(df)
        assert abs(ev - m[key]) < 1e-9 * max(1.0, abs(ev)), name


def test_artist_disjoint_split_shares_no_key(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97).cast("string").alias("artist"), "id")
    s = model.artist_disjoint_split(df, "artist", 30)
    per = s.groupBy("artist").agg(F.countDistinct("split").alias("n")).where("n > 1")
    assert per.count() == 0
    assert {r[0] for r in s.select("split").distinct().collect()} == {"test", "train"}


def test_mark_categorical_maps_unknown(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,)], "td_confidence int")
    out = model.mark_categorical(df)
    assert [r[0] for r in out.collect()] == [6.0, 0.0, 5.0]
    assert out.schema["td_confidence"].metadata["ml_attr"]["type"] == "nominal"


def test_left_joins_keep_row_count(spark):
    import __spark_entry__  # noqa: F401
    from tunelift.plans.flows import Roles
    r = Roles.from_test_tables(spark, "/root/testdata/sf0.001")
    songs = enrich.clean_song_info_wide(r.song_info)
    n = songs.count()
    assert enrich.left_join_play_count(songs, r.play_count).count() == n
    assert enrich.left_join_similar_count(
        songs, enrich.similar_artist_count(r.similar_artists)).count() == n
    assert enrich.left_join_weight_freq(
        songs, enrich.artist_weight_freq(r.term_scores)).count() == n
    assert enrich.left_join_likes(songs, r.likes).count() == n


def test_stage_row_counts(spark):
    from tunelift.operators import audit
    a = spark.range(3)
    b = spark.range(5)
    got = [(r["stage"], r["rows"]) for r in audit.stage_row_counts([("a", a), ("b", b)])
           .orderBy("stage_no").collect()]
    assert got == [("a", 3), ("b", 5)]


def test_binned_scatter_counts_every_row(spark):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(100)], "x double, y double")
    out = explore.binned_scatter(df, ["x"], "y", bins=10)
    assert out.agg(F.sum("n")).first()[0] == 100
    assert out.agg(F.max("x_bin")).first()[0] == 9


@pytest.mark.parametrize("n", [1001, 1000])
def test_exact_median_selection_rounds(spark, monkeypatch, n):
    import numpy as np
    for name, value in (("SKETCH_POINTS", 8), ("SKETCH_ACCURACY", 80), ("SKETCH_ALL", 4)):
        monkeypatch.setattr(explore, name, value)
    rng = np.random.default_rng(7)
    vals = rng.lognormal(0, 2, n)
    vals[: n // 3] = 5.0                      # one hot value holds a third of the rows
    rows = [(float(v), float(i % 5), None if i % 11 == 0 else float(v) * 2) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["feature"]: r["median"] for r in explore.exact_median(df, ["a", "b", "c"]).collect()}
    assert abs(got["a"] - float(np.median(vals))) < 1e-9
    assert got["b"] == float(np.median([i % 5 for i in range(n)]))
    c = [float(v) * 2 for i, v in enumerate(vals) if i % 11 != 0]
    assert abs(got["c"] - float(np.median(c))) < 1e-9


@pytest.mark.parametrize("n", [40_000, 60_000])
def test_median_with_infinite_values(spark, n):
    """One path for all sizes: an infinite value neither fails nor widens the search."""
    x = F.when(F.col("id") == 0, float("inf")).when(F.col("id") == 1, float("nan")).otherwise(F.col("id").cast("double"))
    y = F.when(F.col("id") < 0.7 * n, float("-inf")).otherwise(1.0)
    z = F.when(F.col("id") % 2 == 0, -1e308).otherwise(1e308)
    df = spark.range(n).select(x.alias("x"), y.alias("y"), z.alias("z"))
    got = {r["feature"]: r["median"] for r in explore.exact_median(df, ["x", "y", "z"]).collect()}
    ranked = [float(i) for i in range(2, n)] + [float("inf")]      # NaN is missing
    assert got["x"] == (ranked[(len(ranked) - 1) // 2] + ranked[len(ranked) // 2]) / 2
    assert got["y"] == float("-inf") and got["z"] == 0.0


def test_binned_scatter_with_nan_and_infinity(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 1.0), (nan, 1.0), (3.0, 2.0), (2.0, None), (2.0, 1.5), (inf, 1.0), (-inf, 2.0)],
                               "x double, y double")
    got = {(r["x_bin"], r["y_bin"]): r["n"] for r in explore.binned_scatter(df, ["x"], "y", bins=2).collect()}
    # edges 1..3 and 1..2: NaN and null are missing, infinite values fall in the outer bins
    assert got == {(0, 0): 1, (1, 1): 2, (1, 0): 1, (0, 1): 1}
    assert explore.binned_scatter(df.where("false"), ["x"], "y").collect() == []


def test_kmeans_keeps_rows_without_a_value(spark):
    df = spark.createDataFrame([(i, float(i % 4) * 100) for i in range(40)] + [(100, None), (101, float("nan"))],
                               "id int, v double")
    rows = explore.kmeans_label(df, "v", k=4).collect()
    assert len(rows) == 42
    assert {r["id"] for r in rows if r["cluster"] is None} == {100, 101}
    assert len({r["cluster"] for r in rows}) == 5


def test_metrics_leave_out_missing_labels(spark):
    from tunelift.operators import model
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, 1.0), (float("nan"), 1.0), (4.0, None)],
                               "label double, prediction double")
    m = model.regression_metrics(df).first()
    assert (m["n"], m["left_out"], m["mse"]) == (2, 3, 2.5)
    assert model.mean_squared_error(df).first()["mse"] == m["mse"]
    assert model.regression_metrics(df.where("false")).first()["mse"] is None


def test_every_row_is_scored(spark):
    """A row with a null or NaN feature comes back without a score, not lost."""
    from tunelift.operators import model
    rows = [(float(i), float(i % 7), float(2 * i)) for i in range(60)] + [(None, 1.0, 3.0), (float("nan"), 1.0, 3.0)]
    data = spark.createDataFrame(rows, "a double, b double, label double")
    assert model.skipped_rows(data, ["a", "b"]) == 2
    fitted = model.train_forest(data, ["a", "b"], num_trees=3, max_depth=3)
    out = model.predict_batch(fitted, data).collect()
    assert len(out) == 62
    assert sum(r["prediction"] is None for r in out) == 2
    assert {r["reject_reason"] for r in out if r["prediction"] is None} == {"missing feature"}
    assert all(r["reject_reason"] is None for r in out if r["prediction"] is not None)


def test_top_terms_rank_on_the_exact_mean(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b")], "artist_id string, artist_term string")
    songs = spark.createDataFrame([("1", 0.5), ("2", 0.50000000004), ("2", float("inf"))], "artist_id string, h double")
    th = terms.term_mean_hotness(t, songs, "h")
    assert [r["artist_term"] for r in terms.top_terms(th, 1).collect()] == ["b"]
    # equal up to the order of the sum: a tie, broken by term
    values = [0.1, 0.2, 0.3]
    songs = spark.createDataFrame([("1", v) for v in values] + [("2", v) for v in reversed(values)], "artist_id string, h double")
    assert [r["artist_term"] for r in terms.top_terms(terms.term_mean_hotness(t, songs, "h"), 1).collect()] == ["a"]


def test_cluster_settings_scale_with_input():
    from tunelift.session import cluster_settings
    small = cluster_settings(1 << 30, 8)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    from tunelift.operators.skew import salted_join
    left = spark.createDataFrame(
        [(1, "k"), (2, "k"), (3, "a"), (4, None), (5, "z")], "lid int, lk string")
    right_rows = [("k", i) for i in range(40)] + [("k", 0)] * 5 + [("a", 100), ("b", 7), (None, 8)]
    right = spark.createDataFrame(right_rows, "rk string, v int")
    got = salted_join(left, right, [("lk", "rk")], how, tasks=8)
    want = left.join(right, left.lk == right.rk, how)
    key = lambda r: (r["lid"], -1 if r["v"] is None else r["v"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert set(got.columns) == set(want.columns)


def test_download_joins_salted_equal_plain(spark):
    from tunelift.plans.flows import Roles, serving_songs, wide_songs
    r = Roles.from_test_tables(spark, "/root/testdata/sf0.001")
    rec_a = enrich.clean_downloads(r.downloads)
    songs = serving_songs(r)
    a = enrich.left_join_downloads(songs, rec_a, tasks=10_000).drop("td_artist", "td_title")
    b = enrich.left_join_downloads(songs, rec_a).drop("td_artist", "td_title")
    assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    from tunelift.operators.skew import salted_join
    rec_b = enrich.clean_downloads(r.downloads, require_numeric_price=False)
    ws = wide_songs(r)
    c = salted_join(ws, rec_b, enrich.DOWNLOAD_KEYS, "inner", tasks=10_000)
    d = enrich.inner_join_downloads(ws, rec_b)
    assert sorted(map(tuple, c.select(*d.columns).collect())) == sorted(map(tuple, d.collect()))


def test_comma_in_value_keeps_columns(spark):
    """Values are never joined to text and split again, so a comma stays inside."""
    raw = spark.createDataFrame(
        [(1, 1, "a1", "Art, The", "Song, Part 1", "0.5", 0.1, -3.0, 120.0, 200.0, 0.7, "2001")],
        "song_id int, track_id int, artist_id string, artist_name string, title string, "
        "artist_hotttnesss string, artist_familiarity double, loudness double, tempo double, "
        "duration double, song_hotttnesss double, year string")
    row = enrich.clean_song_info_wide(raw).first()
    assert row["artist_name"] == "artthe" and row["title"] == "songpart1"
    assert row["artist_hotttnesss"] == 0.5 and row["year"] == "2001"


def test_price_check_only_in_serving_flow(spark):
    """The serving flow drops records whose mean price is not a number."""
    raw = spark.createDataFrame([("A", "t", "NA", "3", "good"), ("A", "u", "1.5", "2", "poor")],
                                "artist string, title string, mean_price string, "
                                "downloads string, confidence string")
    assert enrich.clean_downloads(raw, require_numeric_price=True).count() == 1
    both = enrich.clean_downloads(raw, require_numeric_price=False).orderBy("td_title").collect()
    assert [r["td_meanPrice"] for r in both] == [None, 1.5]
    assert [r["td_confidence"] for r in both] == [3, 1]


def test_nan_counts_as_missing_in_means(spark):
    """D10: 'NaN' passes the number test, but means skip it."""
    feats = spark.createDataFrame(
        [("a", "s", 1, float("nan"), 0.5, 10.0), ("a", "t", 2, 0.4, 0.5, 30.0)], FEATS)
    m = lookup.global_means(feats).first()
    assert abs(m["mean_artist_hotness"] - 0.4) < 1e-12
    g = {r["artist_name"]: r for r in lookup.group_mean_or_single(feats, ["artist_name"]).collect()}
    assert abs(g["a"]["artist_hotness"] - 0.4) < 1e-12
    t = spark.createDataFrame([("a", "x")], "artist_id string, artist_term string")
    songs = spark.createDataFrame([("a", float("nan")), ("a", 0.2)], "artist_id string, h double")
    assert abs(terms.term_mean_hotness(t, songs, "h").first()["artist_hotness"] - 0.2) < 1e-12


def test_lookup_cascade_null_keys_and_duplicates(spark, features):
    req = spark.createDataFrame(
        [(1, None, "s1"), (2, "A1", "s1"), (3, "A1", "s1"), (4, None, None), (5, "a3", None)],
        "request_id int, artist string, title string")
    out = {r["request_id"]: r for r in lookup.lookup_cascade(req, features).collect()}
    assert len(out) == 5
    assert out[1]["match_level"] == "title"
    assert out[2]["match_level"] == out[3]["match_level"] == "exact"
    assert out[4]["match_level"] == "global"
    assert out[5]["match_level"] == "artist"


def test_term_ranking_counts_repeated_rows(spark):
    """Ranking weighs every term row; the genre count uses distinct terms."""
    t = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y")],
                              "artist_id string, artist_term string")
    songs = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "artist_id string, h double")
    th = {r[0]: r[1] for r in terms.term_mean_hotness(t, songs, "h").collect()}
    assert abs(th["x"] - 2 / 3) < 1e-12 and th["y"] == 0.0
    g = {r[0]: r[1] for r in terms.genre_match_from_songs(t, songs, "h", k=1).collect()}
    assert g == {"a": 1, "b": 1}


def test_hot_keys_have_no_fixed_bounds(spark):
    """A key is hot above the fair share of a task; its salts follow its rows."""
    from tunelift.operators.skew import hot_keys, key_counts
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("big")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"))
    hot = hot_keys(key_counts(df, ["k"]), ["k"], tasks=64).collect()
    assert [(r["k"], r["_salts"]) for r in hot] == [("big", 22)]      # a third of 64 tasks
    many = spark.range(4000).select((F.col("id") % 2000).alias("k"))
    assert hot_keys(key_counts(many, ["k"]), ["k"], tasks=4000).count() == 2000


HOT_SESSION = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.coalescePartitions.enabled": "false",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
               "spark.sql.files.maxPartitionBytes": "1m",
               "spark.sql.shuffle.partitions": "32"}


def largest_share(df):
    """Rows of the largest task of the last stage; all columns are read, as AQE goes by bytes."""
    rows = df.select(F.spark_partition_id().alias("p"), F.xxhash64(*df.columns).alias("h"))
    counts = [x["n"] for x in rows.groupBy("p").agg(F.count("h").alias("n"), F.max("h")).collect()]
    return max(counts) / sum(counts)


def test_joins_split_a_hot_artist(spark):
    """One artist owning every third song (term, request): with broadcasts off, no task of
    J2, J6, J7, J3, J9 or the lookup's joins gets that third."""
    from tunelift.session import materialize
    old = {k: spark.conf.get(k, None) for k in HOT_SESSION}
    try:
        for k, v in HOT_SESSION.items():
            spark.conf.set(k, v)
        n = 30_000
        artist = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 2000))
        songs = materialize(spark.range(0, n, 1, 24).select(
            F.col("id").alias("song_id"), artist.alias("artist_id"), (F.col("id") % 97 / 97).alias("h"),
            F.concat(F.lit("title "), F.col("id")).alias("title")), "hot-songs")
        per = songs.groupBy("artist_id").agg(F.count("song_id").alias("similar_artist_count"))
        t = songs.select("artist_id", F.col("title").alias("artist_term"))
        joins = {
            "J2": enrich.left_join_similar_count(songs, per),
            "J6": enrich.inner_join_song_count(songs),
            "J7": enrich.left_join_weight_freq(songs, per.select("artist_id", F.lit(1.0).alias("weight_dot_freq"))),
            "J3": terms.inner_join_genre_match(songs, materialize(per, "hot-genre")),
            "J9": terms.inner_join_term_hotness(t, songs, "h"),
        }
        for name, df in joins.items():
            assert df.count() == n, name
            assert largest_share(df) < 0.1, name
        feats = songs.select(F.col("artist_id").alias("artist_name"), F.lit("x").alias("title"), F.lit(1).alias("td_confidence"),
                             F.col("h").alias("artist_hotness"), F.col("h").alias("song_hotness"), F.col("h").alias("td_meanPrice"))
        req = songs.select(F.col("song_id").alias("request_id"), F.col("artist_id").alias("artist"),
                           F.when(F.col("song_id") % 2 == 0, F.lit("x")).otherwise(F.col("title")).alias("title"))
        out = lookup.lookup_cascade(req, feats)
        assert out.count() == n
        assert largest_share(out) < 0.1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_tables_need_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace
    from tunelift import session
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_intermediates_are_deleted_with_their_block(spark):
    import os
    from tunelift.session import intermediates, materialize
    with intermediates(spark):
        df = materialize(spark.range(5), "owned")
        path = df.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))

