"""Song enrichment: per-artist aggregates and the equi-joins that attach them.

Every per-artist aggregate is a ``groupBy`` with partial (map-side) aggregation, so a hot
artist costs one partial row per input partition, never a whole group in one task.  The
joins of songs with such an aggregate store it first: both sides are then plain shuffles,
so AQE broadcasts the aggregate if it is small and splits a hot artist's songs otherwise
(it splits no partition of a join that reads an aggregate's own output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (clean_key, fill_missing, is_number, lower_text,
                                 non_numeric_to_zero, ordinal_encode, to_double,
                                 weight_times_freq)
from ..session import materialize
from .skew import salted_join

SONG_NUMERIC = ["artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
                "duration", "song_hotttnesss"]


# ---- song and download cleaning ----------------------------------------------------

def clean_song_info_serving(songs: DataFrame) -> DataFrame:
    """Songs for the serving flow: cleaned keys, numbers (non-numbers as 0)."""
    return songs.select(
        clean_key("artist_name").alias("artist_name"),
        clean_key("title").alias("title"),
        non_numeric_to_zero("song_hotttnesss").alias("song_hotness"),
        non_numeric_to_zero("artist_hotttnesss").alias("artist_hotness"),
        non_numeric_to_zero("tempo").alias("tempo"),
        "artist_id", "song_id", "track_id")


def clean_song_info_wide(songs: DataFrame) -> DataFrame:
    """Songs for the wide flow: lower-cased and cleaned keys, six numbers (else 0)."""
    return songs.select(
        "song_id", "track_id", "artist_id",
        clean_key(lower_text("artist_name")).alias("artist_name"),
        clean_key(lower_text("title")).alias("title"),
        *[non_numeric_to_zero(c).alias(c) for c in SONG_NUMERIC],
        "year")


def clean_downloads(raw: DataFrame, require_numeric_price: bool = True) -> DataFrame:
    """Download records with cleaned (artist, title) keys and an ordinal confidence.

    ``require_numeric_price`` drops records whose mean price is not a number (the
    serving flow does, the wide flow does not).
    """
    df = raw.where(is_number("mean_price")) if require_numeric_price else raw
    return df.select(
        clean_key("artist").alias("td_artist"),
        clean_key("title").alias("td_title"),
        to_double("mean_price").alias("td_meanPrice"),
        to_double("downloads").alias("td_downloads"),
        ordinal_encode("confidence").alias("td_confidence"))


# ---- aggregates (A1, A2, A4) ----------------------------------------------------------

def similar_artist_count(similar: DataFrame) -> DataFrame:
    """A1: non-null similar artists per artist."""
    return similar.groupBy("artist_id").agg(
        F.count("similar_artist").alias("similar_artist_count"))


def artist_song_count(songs: DataFrame) -> DataFrame:
    """A2: songs per artist (non-null song ids)."""
    return songs.groupBy("artist_id").agg(F.count("song_id").alias("song_count"))


def artist_weight_freq(term_scores: DataFrame) -> DataFrame:
    """A4: sum(weight * freq) per artist over rows where both are numbers."""
    return (term_scores.where(is_number("weight") & is_number("freq"))
            .groupBy("artist_id")
            .agg(F.sum(weight_times_freq("weight", "freq")).alias("weight_dot_freq")))


# ---- joins (J1, J2, J6, J7, J8) ---------------------------------------------------------

def left_join_play_count(songs: DataFrame, plays: DataFrame) -> DataFrame:
    """Songs left join plays on (song_id, track_id); no play record -> 0."""
    p = plays.select("play_song_id", "play_track_id", "play_count")
    cond = [songs["song_id"] == p["play_song_id"], songs["track_id"] == p["play_track_id"]]
    out = songs.join(p, cond, "left").drop("play_song_id", "play_track_id")
    return fill_missing(out, {"play_count": 0})


def left_join_similar_count(songs: DataFrame, similar_counts: DataFrame) -> DataFrame:
    """Songs left join per-artist similar-artist count; missing -> 0."""
    counts = materialize(similar_counts, "similar-counts")
    return fill_missing(songs.join(counts, "artist_id", "left"), {"similar_artist_count": 0})


def inner_join_song_count(songs: DataFrame, song_counts: DataFrame | None = None) -> DataFrame:
    """Songs inner join their own per-artist song count.

    A ``groupBy`` + join rather than a window: a window puts a whole artist in one task,
    while the aggregate combines map-side and, stored, lets AQE split a hot artist.
    """
    counts = song_counts if song_counts is not None else artist_song_count(songs)
    return songs.join(materialize(counts, "song-counts"), "artist_id", "inner")


def left_join_weight_freq(songs: DataFrame, weight_freq: DataFrame) -> DataFrame:
    """Songs left join per-artist weight*freq sum; missing -> 0."""
    sums = materialize(weight_freq, "weight-freq")
    return fill_missing(songs.join(sums, "artist_id", "left"), {"weight_dot_freq": 0.0})


def left_join_likes(songs: DataFrame, likes: DataFrame) -> DataFrame:
    """Songs left join likes on track id; missing -> 0."""
    lk = likes.select("track", "likes")
    out = songs.join(lk, songs["track_id"] == lk["track"], "left").drop("track")
    return fill_missing(out, {"likes": 0})


def artist_features(genre: DataFrame, song_counts: DataFrame | None = None,
                    weight_freq: DataFrame | None = None,
                    similar_counts: DataFrame | None = None) -> DataFrame:
    """The per-artist tables combined into one row per artist, before touching songs.

    Same semantics as joining them to the songs one by one (genre match and song count
    are inner joins, weight*freq and similar count left joins filled with 0), but the
    combining joins run between small per-artist tables that share their partitioning,
    and the songs then take a single artist-keyed join with the stored result.
    """
    t = genre
    if song_counts is not None:
        t = t.join(song_counts, "artist_id", "inner")
    if weight_freq is not None:
        t = fill_missing(t.join(weight_freq, "artist_id", "left"), {"weight_dot_freq": 0.0})
    if similar_counts is not None:
        t = fill_missing(t.join(similar_counts, "artist_id", "left"),
                         {"similar_artist_count": 0})
    return t


# ---- download joins (J4, J5) -------------------------------------------------------------

DOWNLOAD_KEYS = [("title", "td_title"), ("artist_name", "td_artist")]


def left_join_downloads(songs: DataFrame, records: DataFrame,
                        tasks: int | None = None) -> DataFrame:
    """Songs left join download records on cleaned (title, artist).

    Many-to-many fan-out is kept.  Songs without a record get confidence 0 and price 0
    (the same code as 'terrible'), so ``has_download_record`` tells them apart.  A
    (title, artist) with more records than the fair share of a task is salted
    (``skew.salted_join``); ``records`` should be a stored table.
    """
    rec = records.select("td_artist", "td_title", "td_confidence", "td_meanPrice")
    out = (salted_join(songs, rec, DOWNLOAD_KEYS, "left", tasks)
                .withColumn("has_download_record", F.col("td_artist").isNotNull())
                .drop("td_artist", "td_title"))
    return fill_missing(out, {"td_confidence": 0, "td_meanPrice": 0.0})


def inner_join_downloads(songs: DataFrame, records: DataFrame) -> DataFrame:
    """J5 (join part): download records inner join songs on (title, artist).

    An inner join needs no salting: AQE's skew handling may split a skewed partition on
    either side of an inner join (it cannot for the right side of a left join, hence
    the salted path of J4)."""
    cond = [records["td_title"] == songs["title"], records["td_artist"] == songs["artist_name"]]
    return records.join(songs, cond, "inner")


def sort_by_artist(df: DataFrame, artist_col: str = "td_artist",
                   tie_cols: tuple[str, ...] = ("td_title", "song_id")) -> DataFrame:
    """Global sort by artist.

    The extra sort keys let the range partitioner cut one very large artist into several
    partitions; a sort on the artist alone would put that whole artist in one task.
    """
    keys = [F.col(artist_col)] + [F.col(c) for c in tie_cols]
    return df.orderBy(*keys)
