"""End-to-end jobs: the flows with their file inputs and outputs.

Each job mirrors one entry point of the original project: write the serving features and
their means, write the wide training table, train and evaluate a forest (metrics,
predictions, model), score a file of request lines from those stored outputs, and the
exploration report.  Paths may be any Hadoop-compatible URI (shared storage on a
cluster).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, explore, lookup, model
from ..session import intermediates, materialize
from ..sources import readers, writers
from . import flows as P

SERVING_SCHEMA = ("artist_name string, title string, td_confidence int, artist_hotness double, "
                  "song_hotness double, td_meanPrice double, has_download_record boolean")
MEANS_SCHEMA = ("mean_artist_hotness double, mean_song_hotness double, "
                "mean_td_meanPrice double, mean_td_confidence double")
WIDE_SCHEMA = ", ".join(f"{c} {'int' if c == 'td_confidence' else 'double'}"
                        for c in model.WIDE_COLUMNS) + ", artist_key string"


def _p(base: str, name: str) -> str:
    return os.path.join(base, name)


def _write_counts(spark: SparkSession, observations: dict, path: str) -> dict[str, int]:
    """The stage row counts observed during the job's write, as a small table."""
    counts = audit.observed_counts(observations)
    writers.write_features_csv(audit.counts_table(spark, counts), path, single_file=True)
    return counts


def serving_job(roles: P.Roles, out_dir: str) -> dict[str, str]:
    """Q1 + K1 + A6/K2 + A7: the serving features, their one-row means, and the row
    count of each stage (observed during the features write, no extra job)."""
    feats_path, means_path = _p(out_dir, "features"), _p(out_dir, "means")
    spark = roles.song_info.sparkSession
    observations: dict = {}
    with intermediates(spark):
        writers.write_features_csv(P.serving_features(roles, observe=observations), feats_path)
        _write_counts(spark, observations, _p(out_dir, "serving_stage_counts"))
        writers.write_means(lookup.global_means(read_serving(spark, feats_path)), means_path)
    return {"features": feats_path, "means": means_path,
            "stage_counts": _p(out_dir, "serving_stage_counts")}


def wide_job(roles: P.Roles, out_dir: str, sort: bool = True) -> str:
    """Q2 (+ T2) + K1 + A7: the wide training table with its artist key, sorted by
    artist, and the row count of each stage.  The counts are observed while the unsorted
    table is stored (a sort samples its input, which would count rows twice)."""
    path = _p(out_dir, "wide")
    spark = roles.song_info.sparkSession
    observations: dict = {}
    with intermediates(spark):
        wide = materialize(audit.observed(P.wide_features_with_artist(roles, observe=observations),
                                          "wide", observations), "wide")
        _write_counts(spark, observations, _p(out_dir, "wide_stage_counts"))
        if sort:
            wide = wide.orderBy("artist_key", "td_meanPrice", "td_downloads")
        writers.write_features_csv(wide, path)
    return path


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """Stored serving features; a malformed row is a fault (this library wrote the file)."""
    return readers.read_delimited(spark, path, SERVING_SCHEMA, ",", mode="FAILFAST")


def read_means(spark: SparkSession, path: str) -> DataFrame:
    return readers.read_delimited(spark, path, MEANS_SCHEMA, ",", mode="FAILFAST")


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    return readers.read_delimited(spark, path, WIDE_SCHEMA, ",", mode="FAILFAST")


def training_job(wide: DataFrame, out_dir: str,
                 feature_indexes: Sequence[int] = model.DEFAULT_FEATURE_INDEXES,
                 num_trees: int = 30, max_depth: int = 8, test_percent: int = 30,
                 test: DataFrame | None = None) -> dict[str, str]:
    """Q3 + K3/K4/K5: metrics per split, integer predictions per split, the model.
    With ``test``, ``wide`` is the training table and ``test`` the held-out one."""
    paths = {k: _p(out_dir, k) for k in ("metrics", "predictions", "model")}
    with intermediates(wide.sparkSession):
        fitted, preds, metrics = P.train_and_evaluate(wide, feature_indexes, num_trees, max_depth,
                                                      test_percent, test=test)
        writers.write_metrics(model.metrics_long(metrics), paths["metrics"])
        writers.write_predictions(model.prediction_table(preds), paths["predictions"])
        writers.save_model(fitted, paths["model"])
    return paths


def scoring_job(spark: SparkSession, requests_path: str, features_path: str, means_path: str,
                model_path: str) -> tuple[DataFrame, DataFrame]:
    """Q4 from stored outputs: request lines -> lookup -> score.

    Returns (scores, rejected lines).  The model must have been trained on the four
    serving features (see ``scoring_model``)."""
    accepted, rejected = readers.read_requests(spark, requests_path)
    accepted = accepted.withColumn("request_line", F.concat_ws(";", "artist", "title"))
    features, means = read_serving(spark, features_path), read_means(spark, means_path)
    fitted = writers.load_model(model_path)
    scores = P.score_requests(accepted, features, fitted, means)
    return scores, rejected


def scoring_model(wide: DataFrame, model_path: str, num_trees: int = 30,
                  max_depth: int = 8) -> str:
    """Train the forest on the four serving features (confidence, artist hotness, song
    hotness, mean price) and save it for ``scoring_job``."""
    cols = ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]
    data = model.prepare(P.scoring_training_view(wide), cols)
    writers.save_model(model.train_forest(data, cols, num_trees, max_depth), model_path)
    return model_path


def explore_job(wide: DataFrame, bins: int = 20) -> dict[str, DataFrame]:
    """Q5: per-feature summary (mean, median, r), download clusters, 2-D histograms."""
    # one stored copy of the view serves every part of the report
    v = materialize(P.explore_view(wide).select(*P.EXPLORE_COLUMNS, model.LABEL), "explore")
    return {
        "summary": explore.feature_summary(v, P.EXPLORE_COLUMNS, model.LABEL, stored=True),
        "clusters": explore.kmeans_centers(v, model.LABEL),
        "scatter": explore.binned_scatter(v, P.EXPLORE_COLUMNS, model.LABEL, bins, stored=True),
    }
