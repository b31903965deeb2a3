"""Streaming request lookup equals the batch lookup on the same lines."""

import os

from tunelift.operators import lookup
from tunelift.plans.flows import Roles, serving_features
from tunelift.session import materialize
from tunelift.sources.readers import parse_requests
from tunelift.streaming import scoring
from conftest import SF_SMALL


def test_stream_lookup_matches_batch(spark, scratch):
    r = Roles.from_test_tables(spark, SF_SMALL)
    features = materialize(serving_features(r), "features-test")
    lines = r.requests.selectExpr("concat(artist, ';', title) AS value")
    in_dir = os.path.join(scratch, "requests")
    lines.write.text(in_dir)

    accepted, _ = scoring.request_stream(spark, in_dir, max_files_per_trigger=2)
    out = os.path.join(scratch, "looked")
    scoring.start_sink(accepted, out, os.path.join(scratch, "ckpt"), scoring.batch_lookup(features)).awaitTermination()
    got = sorted(tuple(x) for x in spark.read.parquet(out).drop("batch_id").collect())

    batch_req, _ = parse_requests(spark.read.text(in_dir))
    want = sorted(tuple(x) for x in lookup.lookup_cascade(batch_req, features).collect())
    assert len(got) == r.requests.count()
    assert got == want


def test_stream_scores_to_parquet_sink_exactly_once(spark, scratch):
    from pyspark.sql import functions as F

    from tunelift.operators import model
    from tunelift.plans.flows import scoring_training_view, wide_features

    r = Roles.from_test_tables(spark, SF_SMALL)
    features = materialize(serving_features(r), "features-stream")
    cols = ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]
    wide = scoring_training_view(wide_features(r))
    fitted = model.train_forest(model.prepare(wide, cols), cols, num_trees=5, max_depth=4)

    in_dir = os.path.join(scratch, "req")
    r.requests.selectExpr("concat(artist, ';', title) AS value").write.text(in_dir)
    out_dir, ckpt = os.path.join(scratch, "scores"), os.path.join(scratch, "ckpt")
    accepted, _ = scoring.request_stream(spark, in_dir)
    score = scoring.batch_scores(features, fitted)
    scoring.start_sink(accepted, out_dir, ckpt, score).awaitTermination()
    n = r.requests.count()
    got = spark.read.parquet(out_dir)
    assert got.count() == n
    assert got.where(F.col("prediction_int").isNull()).count() == 0
    # a restart from the same checkpoint adds nothing (files already processed)
    accepted2, _ = scoring.request_stream(spark, in_dir)
    scoring.start_sink(accepted2, out_dir, ckpt, score).awaitTermination()
    assert spark.read.parquet(out_dir).count() == n


def test_command_line_writes_rejected_lines(spark, scratch):
    from tunelift import __main__ as cli
    from tunelift.operators import model
    from tunelift.plans import jobs
    from tunelift.plans.flows import scoring_training_view, wide_features
    from tunelift.sources import writers

    r = Roles.from_test_tables(spark, SF_SMALL)
    paths = jobs.serving_job(r, scratch)
    cols = ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]
    fitted = model.train_forest(model.prepare(scoring_training_view(wide_features(r)), cols), cols, 3, 3)
    writers.save_model(fitted, os.path.join(scratch, "model"))
    in_dir = os.path.join(scratch, "in")
    spark.createDataFrame([("Brand#13;x",), ("bad line",), ("a;b;c",)], "value string").write.text(in_dir)
    for i, more in enumerate(([], ["--one-plan"])):
        out = cli.main(["score-stream", "--requests-dir", in_dir, "--features", paths["features"], "--means", paths["means"],
                        "--model", os.path.join(scratch, "model"), "--out", os.path.join(scratch, f"out{i}"),
                        "--checkpoint", os.path.join(scratch, f"cp{i}"), "--available-now", *more])
        scores = spark.read.parquet(out["scores"]).collect()
        assert len(scores) == 1 and scores[0]["prediction_int"] is not None
        assert sorted(x["value"] for x in spark.read.parquet(out["rejected"]).collect()) == ["a;b;c", "bad line"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_static_lookup_in_triggers_with_a_restart(spark, scratch):
    """One streaming plan: two lots of request files in several triggers, a restart in between."""
    r = Roles.from_test_tables(spark, SF_SMALL)
    features = materialize(serving_features(r), "features-static")
    levels = lookup.bucketed_levels(features, buckets=4)
    looked, ended = scoring.replay(r.requests, lambda s: scoring.stream_lookup(s, levels), scratch)
    assert ended[0] >= 2 and ended[1] >= ended[0] + 2
    want = sorted(tuple(x) for x in lookup.lookup_cascade(r.requests, features).collect())
    assert sorted(tuple(x) for x in looked.collect()) == want
    # a query that starts again from the checkpoint finds nothing new
    again = spark.readStream.schema(r.requests.schema).parquet(f"{scratch}/in")
    scoring.start_file_sink(scoring.stream_lookup(again, levels), f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == len(want)


def test_stream_of_no_requests(spark, scratch):
    none = spark.createDataFrame([], "request_id long, artist string, title string")
    feats = spark.createDataFrame([("a", "s", 1, 0.1, 0.2, 3.0)], "artist_name string, title string, td_confidence int, "
                                  "artist_hotness double, song_hotness double, td_meanPrice double")
    levels = lookup.bucketed_levels(feats, buckets=2)
    assert scoring.replay(none, lambda s: scoring.stream_lookup(s, levels), scratch)[0].collect() == []


def test_level_joins_hold_no_action_and_equal_the_cascade(spark):
    feats = spark.createDataFrame(
        [("a1", "s1", 5, 0.1, 0.2, 10.0), ("a1", "s2", 1, 0.3, 0.4, 20.0), ("a2", "s1", 2, None, float("nan"), 30.0)],
        "artist_name string, title string, td_confidence int, artist_hotness double, song_hotness double, td_meanPrice double")
    requests = spark.createDataFrame(
        [(1, "A1", "S1"), (2, "A1", "zz"), (3, "zz", "s1"), (4, None, None), (5, "A2", None), (6, None, "s2")]
        + [(10 + i, "a 1", "s 1!") for i in range(30)], "request_id int, artist string, title string")
    levels = lookup.bucketed_levels(feats, buckets=4)
    from pyspark.sql import functions as F
    key = F.col("request_id")
    joined = lookup.join_levels(requests, levels).orderBy(key).collect()
    assert repr(joined) == repr(lookup.lookup_cascade(requests, None, levels=levels).orderBy(key).collect())
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        plan = _plan(lookup.join_levels(requests, levels))
        # the requests are dealt for each level; the bucketed levels are read as they lie
        assert plan.count("Exchange") == 3 and plan.count("Bucketed: true") == 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stream_scores_as_one_plan(spark, scratch):
    from tunelift.operators import model
    from tunelift.plans.flows import score_requests, scoring_training_view, wide_features

    r = Roles.from_test_tables(spark, SF_SMALL)
    features = materialize(serving_features(r), "features-scores")
    wide = scoring_training_view(wide_features(r))
    fitted = model.train_forest(model.prepare(wide, lookup.FEATURES), lookup.FEATURES, num_trees=5, max_depth=4)
    levels = lookup.bucketed_levels(features)
    got, _ = scoring.replay(r.requests, lambda s: scoring.stream_scores(s, levels, fitted), scratch)
    cols = ["request_id", "match_level", "prediction", "prediction_int", "reject_reason"]
    want = score_requests(r.requests, features, fitted)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
