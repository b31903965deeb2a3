"""Composite flows: serving features, wide features, training, scoring, exploration.

Each flow is one lazy plan over its inputs (role tables); Catalyst prunes columns and
pushes filters down to the parquet scans of the roles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (non_numeric_to_zero, popularity_log10, reorder,
                                 threshold_filter, to_double)
from ..operators import audit, enrich, explore, lookup, model, terms
from ..operators.skew import heavy_keys
from ..session import materialize, materialize_bucketed
from . import bindings

SERVING_COLUMNS = ["artist_name", "title", "td_confidence", "artist_hotness",
                   "song_hotness", "td_meanPrice", "has_download_record"]
# Song-info columns the flows read (the file may hold more).
SONG_INFO_COLUMNS = ["song_id", "track_id", "artist_id", "artist_name", "title",
                     "artist_hotttnesss", "artist_familiarity", "loudness", "tempo", "duration",
                     "song_hotttnesss", "year"]


@dataclass
class Roles:
    """The six input tables of the flows (plus requests); the last three fields are set by
    ``with_shared``."""
    song_info: DataFrame
    play_count: DataFrame
    similar_artists: DataFrame
    artist_terms: DataFrame
    term_scores: DataFrame
    likes: DataFrame
    downloads: DataFrame
    requests: DataFrame
    genre: DataFrame | None = None
    genre_k: int = 0
    songs_stored: bool = False

    @classmethod
    def from_files(cls, spark: SparkSession, song_info: str, artist_terms: str,
                   similar_artists: str, play_count: str, likes: str, downloads: str,
                   requests: str | None = None, store: bool = True) -> "Roles":
        """The roles from the original delimited input files.

        Header-named files (``;`` song info and similar artists, ``,`` play counts and
        likes) are read by column name; artist terms and download records are read by
        position, every copy of their header line dropped.  Counts are cast once here.
        With ``store`` each parsed file is stored once as parquet, which the flows then
        read column by column instead of parsing the text again in every branch.
        """
        from ..sources import readers as R

        songs = R.read_delimited(spark, song_info, None, ";").select(*SONG_INFO_COLUMNS)
        plays = R.read_delimited(spark, play_count, None, ",").select(
            "play_song_id", "play_track_id", F.col("play_count").try_cast("long").alias("play_count"))
        similar = R.read_delimited(spark, similar_artists, None, ";").select(
            "artist_id", "similar_artist")
        lk = R.read_delimited(spark, likes, None, ",").select(
            "track", F.col("likes").try_cast("long").alias("likes"))
        terms_rows = R.fields_to_columns(
            R.read_split_lines(spark, artist_terms, ";", R.first_line(spark, artist_terms)),
            ["artist_id", "artist_term", "weight", "freq"])
        dl = R.fields_to_columns(
            R.read_split_lines(spark, downloads, ";", R.first_line(spark, downloads), n_fields=5),
            ["artist", "title", "mean_price", "downloads", "confidence"])
        if requests is not None:
            req, _ = R.read_requests(spark, requests)
            req = req.withColumn("request_line", F.concat_ws(";", "artist", "title"))
        else:
            req = spark.createDataFrame([], "artist string, title string")
        if store:
            songs, plays, similar, lk, terms_rows, dl = (
                materialize(df, name) for df, name in (
                    (songs, "song-info"), (plays, "play-count"), (similar, "similar-artists"),
                    (lk, "likes"), (terms_rows, "artist-terms"), (dl, "downloads")))
        return cls(songs, plays, similar, terms_rows.select("artist_id", "artist_term"),
                   terms_rows, lk, dl, req)

    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str) -> "Roles":
        b = bindings
        return cls(b.song_info(spark, sf_dir), b.play_count(spark, sf_dir),
                   b.similar_artists(spark, sf_dir), b.artist_terms(spark, sf_dir),
                   b.term_scores(spark, sf_dir), b.likes(spark, sf_dir),
                   b.downloads(spark, sf_dir), b.requests(spark, sf_dir))


# ---- what both feature flows read -----------------------------------------------------

# The two rankings of terms: flow A counts a hotness that is no number as 0, flow B skips it.
GENRE_MEASURES = {"genre_zero": non_numeric_to_zero, "genre_skip": to_double}


def genre_table(r: Roles, top_k: int = terms.DEFAULT_TOP_K) -> DataFrame:
    """Per artist, the genre match of either flow: the term rows are read and ranked once."""
    songs = r.song_info.select("artist_id", *[f("artist_hotttnesss").alias(m) for m, f in GENRE_MEASURES.items()])
    return terms.genre_counts(terms.term_pairs(r.artist_terms), songs, list(GENRE_MEASURES), top_k)


SONG_KEYS = ["song_id", "track_id"]


def with_shared(r: Roles, top_k: int = terms.DEFAULT_TOP_K) -> Roles:
    """``r`` for callers that run both feature flows: what both read (songs, play, download and
    similar-artist rows, and the genre match of either ranking) is stored once.

    Both flows join the songs with the plays by song and track id: the songs are stored in buckets
    of those, which spares them that shuffle.  Should such a key be hot (a sketch tells), they
    are stored plainly instead, for a join that can split it."""
    if heavy_keys(r.song_info, SONG_KEYS).isEmpty():
        songs = materialize_bucketed(r.song_info, "song-info", SONG_KEYS)
    else:
        songs = materialize(r.song_info, "song-info")
    return replace(
        r, song_info=songs, play_count=materialize(r.play_count, "play-count"),
        downloads=materialize(r.downloads, "downloads"),
        similar_artists=materialize(r.similar_artists, "similar-artists"),
        genre=materialize(genre_table(r, top_k), "genre"), genre_k=top_k, songs_stored=True)


def _stored_songs(r: Roles, clean: Callable[[DataFrame], DataFrame], name: str, observe: dict | None) -> DataFrame:
    """The cleaned songs, which several parts of a plan read: stored, unless the songs already are
    (cleaning them again is cheap and keeps their buckets) and nothing is to be counted.

    Cleaning is dear for the bytes it reads, and a small file of very many songs is read by few
    tasks: the rows are dealt out before they are cleaned."""
    if r.songs_stored and observe is None:
        return clean(r.song_info)
    dealt = r.song_info.repartition(*SONG_KEYS)
    return materialize(audit.observed(clean(dealt), "songs", observe), name)


def _genre_match(r: Roles, measure: str, top_k: int, songs: DataFrame, hotness_col: str) -> DataFrame:
    if r.genre is not None and r.genre_k == top_k:
        return r.genre.select("artist_id", F.col(measure).alias("genre_match_count"))
    return terms.genre_match_from_songs(r.artist_terms, songs, hotness_col, top_k)


# ---- Q1 ------------------------------------------------------------------------------

def serving_songs(r: Roles, top_k: int = terms.DEFAULT_TOP_K,
                  observe: dict | None = None) -> DataFrame:
    """Flow A up to the genre join: songs + plays + similar count + genre match.

    The cleaned songs and the per-artist table are stored: each is read by several parts
    of the plan, and the join of the two can split an artist with very many songs.
    ``observe`` (a dict) collects a row count per stage, here and in the caller's action."""
    songs = _stored_songs(r, enrich.clean_song_info_serving, "serving-songs", observe)
    s = enrich.left_join_play_count(songs, r.play_count)
    # Flow A ranks terms on the cleaned hotness ('NA' counted as 0).
    genre = _genre_match(r, "genre_zero", top_k, songs, "artist_hotness")
    per_artist = enrich.artist_features(
        genre, song_counts=enrich.artist_song_count(songs),
        similar_counts=enrich.similar_artist_count(r.similar_artists))
    # J2 + J3 as one join of the songs with the combined per-artist table
    per_artist = materialize(per_artist, "per-artist")
    out = terms.inner_join_genre_match(s, per_artist).drop("song_count")
    return audit.observed(out, "with_genre", observe)


def serving_features(r: Roles, top_k: int = terms.DEFAULT_TOP_K,
                     observe: dict | None = None) -> DataFrame:
    """Q1: six feature columns per (song x matching download record), plus
    ``has_download_record``."""
    # stored: the join looks for hot keys in it first
    records = materialize(audit.observed(enrich.clean_downloads(r.downloads, require_numeric_price=True),
                                         "download_records", observe), "download-records")
    out = enrich.left_join_downloads(serving_songs(r, top_k, observe), records)
    return audit.observed(out.select(*SERVING_COLUMNS), "serving_features", observe)


# ---- Q2 ------------------------------------------------------------------------------

def wide_songs(r: Roles, top_k: int = terms.DEFAULT_TOP_K,
               observe: dict | None = None) -> DataFrame:
    """Flow B up to the genre join (``observe``: row count per stage, see above)."""
    ob = audit.observed
    songs = _stored_songs(r, enrich.clean_song_info_wide, "wide-songs", observe)
    # Song-keyed joins first, then one join with all per-artist features.
    s = ob(enrich.left_join_play_count(songs, r.play_count), "with_plays", observe)
    s = ob(enrich.left_join_likes(s, r.likes), "with_likes", observe)
    # Flow B ranks terms on the raw hotness: non-numbers are skipped by the mean.
    raw = r.song_info.select("artist_id", to_double("artist_hotttnesss").alias("raw_hotness"))
    genre = _genre_match(r, "genre_skip", top_k, raw, "raw_hotness")
    per_artist = enrich.artist_features(
        genre, song_counts=enrich.artist_song_count(songs),
        weight_freq=enrich.artist_weight_freq(r.term_scores),
        similar_counts=enrich.similar_artist_count(r.similar_artists))
    # J6, J7, J2 and J3 as one join of the songs with the combined per-artist table
    per_artist = materialize(per_artist, "per-artist")
    return ob(terms.inner_join_genre_match(s, per_artist), "with_genre", observe)


def wide_features(r: Roles, top_k: int = terms.DEFAULT_TOP_K, sort: bool = False) -> DataFrame:
    """Q2: the 17-column training table in contract order (label last).

    ``sort=True`` adds the reference's global sort by artist (T2) to a stored copy, since
    range sampling reads its input twice; the table is unordered otherwise.
    """
    records = enrich.clean_downloads(r.downloads, require_numeric_price=False)
    j = enrich.inner_join_downloads(wide_songs(r, top_k), records)
    j = j.withColumn("popularity", popularity_log10(
        "artist_familiarity", "song_count", "similar_artist_count"))
    if sort:
        j = enrich.sort_by_artist(materialize(j, "unsorted"))
    return reorder(j.withColumn("year", non_numeric_to_zero("year")), model.WIDE_COLUMNS)


# ---- Q3 ------------------------------------------------------------------------------

def train_and_evaluate(wide: DataFrame, feature_indexes=model.DEFAULT_FEATURE_INDEXES,
                       num_trees: int = 30, max_depth: int = 8, test_percent: int = 30,
                       split_key: str = "artist_key", test: DataFrame | None = None):
    """Q3: artist-disjoint split, forest on the training rows, metrics per split.

    ``wide`` must carry ``split_key`` (an artist key) beside the contract columns, and is
    split by a hash of it; or, with ``test``, ``wide`` is the training table and ``test``
    the held-out one (split beforehand, as two files).
    Returns (model, predictions, metrics).  The predictions (split key, split, label,
    prediction) are stored once, and the metrics computed from the stored table.  Rows
    without a label or a feature are not learned from; they have no prediction, and the
    metrics count them as ``left_out``.
    """
    cols = model.feature_names(feature_indexes)
    if test is None:
        labelled = model.artist_disjoint_split(wide, split_key, test_percent)
    else:
        keep = [c for c in wide.columns if c in test.columns]
        labelled = (wide.select(*keep).withColumn("split", F.lit("train"))
                    .unionByName(test.select(*keep).withColumn("split", F.lit("test"))))
    # The forest reads its input several times (split candidates, binning) and the
    # predictions read it again: store the split table once instead of recomputing Q2.
    split = materialize(labelled, "q3-input")
    data = model.prepare(split, cols)
    fitted = model.train_forest(data.where(F.col("split") == "train"), cols,
                                num_trees=num_trees, max_depth=max_depth)
    kept = [c for c in (split_key, "split", "label") if c in data.columns]
    preds = materialize(model.predict_batch(fitted, data).select(*kept, "prediction"), "predictions")
    # A11 per split, plus the squared error averaged directly (A12), as both are reported
    metrics = model.evaluate_splits(preds).join(
        model.mean_squared_error(preds, by=["split"]).withColumnRenamed("mse", "mse_direct"),
        "split")
    return fitted, preds, metrics


def wide_features_with_artist(r: Roles, top_k: int = terms.DEFAULT_TOP_K,
                              observe: dict | None = None) -> DataFrame:
    """Q2 plus the artist key, for the artist-disjoint split of Q3."""
    records = enrich.clean_downloads(r.downloads, require_numeric_price=False)
    j = audit.observed(enrich.inner_join_downloads(wide_songs(r, top_k, observe), records),
                       "with_downloads", observe)
    j = j.withColumn("popularity", popularity_log10(
        "artist_familiarity", "song_count", "similar_artist_count"))
    j = j.withColumn("year", non_numeric_to_zero("year"))
    return j.select(*model.WIDE_COLUMNS, F.col("td_artist").alias("artist_key"))


# ---- Q4 ------------------------------------------------------------------------------

def score_requests(requests: DataFrame, features: DataFrame, fitted,
                   means: DataFrame | None = None) -> DataFrame:
    """Q4: requests -> feature lookup -> forest score truncated toward zero."""
    looked = lookup.lookup_cascade(requests, features, means)
    cols = ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]
    ready = model.mark_categorical(looked, "td_confidence")
    for c in cols[1:]:
        ready = ready.withColumn(c, F.col(c).cast("double"))
    return model.predict_batch(fitted, ready).drop("features")


def scoring_training_view(wide: DataFrame) -> DataFrame:
    """The wide table under the serving feature names, for the scoring model."""
    return wide.select(
        F.col("td_confidence"), F.col("artist_hotttnesss").alias("artist_hotness"),
        F.col("song_hotttnesss").alias("song_hotness"), F.col("td_meanPrice"),
        F.col("td_downloads"))


# ---- Q5 ------------------------------------------------------------------------------

EXPLORE_COLUMNS = [c for c in model.WIDE_COLUMNS if c != model.LABEL]


def explore_view(wide: DataFrame) -> DataFrame:
    """P13 then P16: rows with confidence > 1, natural-log popularity in place of the
    log10 one (as the exploration script does)."""
    f = threshold_filter(wide, "td_confidence", explore.CONFIDENCE_THRESHOLD)
    return explore.with_popularity_ln(f).withColumn("popularity", F.col("popularity_ln")) \
                  .drop("popularity_ln")


def explore_features(wide: DataFrame) -> DataFrame:
    """Q5: mean, median and correlation with downloads for each feature, one row each."""
    return explore.feature_summary(explore_view(wide), EXPLORE_COLUMNS, model.LABEL)
