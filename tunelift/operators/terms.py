"""Artist terms: term hotness, top terms and the per-artist genre match count.

The reference joins every (artist, term) row with every song of that artist and then
averages per term; an artist with n songs thus weighs n times.  Here the songs are first
reduced to one row per artist (hotness sum and count), so the term join emits one row per
(term, artist) instead of one per (term, song) - same means, no fan-out.

What is ranked and what is counted both read the term rows: they are stored once, as one row
per (artist, term) with the number of its repeats, in buckets of terms (``term_pairs``).  Several
hotness measures (the two flows treat missing values differently) share one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..session import materialize, materialize_bucketed

# --- fixed values that must equal the reference ----------------------------------
# Number of top terms an artist's terms are matched against.
DEFAULT_TOP_K = 1000
# ---------------------------------------------------------------------------------
# Hotness is summed as a decimal of this type, so a sum does not depend on the order of
# its rows and means that are equal rank as equal.
EXACT = "decimal(38,15)"


def artist_hotness_totals(songs: DataFrame, hotness_col: str) -> DataFrame:
    """Per artist: songs, exact sum and count of hotness (pre-aggregation for J9).  NaN and
    infinite values count as missing."""
    h = nan_to_null(hotness_col)
    exact = F.when(F.abs(h) < F.lit(float("inf")), h.try_cast(EXACT))
    return songs.groupBy("artist_id").agg(
        F.count(F.lit(1)).alias("songs"),
        F.sum(exact).alias("hotness_sum"),
        F.count(exact).alias("hotness_n"))


def inner_join_term_hotness(terms: DataFrame, songs: DataFrame, hotness_col: str) -> DataFrame:
    """Terms inner join songs on artist_id, one row per (term row, artist) carrying the
    artist's song count and hotness totals (the per-song rows are summed, not emitted).

    The totals are stored, so both sides of the join are plain shuffles and AQE can split
    an artist with very many terms."""
    totals = materialize(artist_hotness_totals(songs, hotness_col), "artist-hotness")
    return terms.select("artist_id", "artist_term").join(totals, "artist_id", "inner")


def term_mean_hotness(terms: DataFrame, songs: DataFrame, hotness_col: str) -> DataFrame:
    """A3: mean artist hotness per term, over all (term row, song) pairs of J9."""
    j = inner_join_term_hotness(terms, songs, hotness_col)
    return j.groupBy("artist_term").agg(
        F.try_divide(F.sum("hotness_sum").cast("double"), F.sum("hotness_n")).alias("artist_hotness"))


def top_terms(term_hotness: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The k terms of highest mean hotness (ties broken by term; nulls last)."""
    return (term_hotness.orderBy(F.col("artist_hotness").desc_nulls_last(),
                                 F.col("artist_term").asc())
                        .limit(k))


def artist_genre_match(terms: DataFrame, top: DataFrame) -> DataFrame:
    """Per artist, how many of its distinct terms are in the top-k table.

    Artists with no top term keep a 0.  The distinct and the count combine map-side; AQE
    broadcasts the top-k table if it has measured it to be small.
    """
    t = top.select("artist_term").distinct().withColumn("in_top", F.lit(1))
    pairs = terms.select("artist_id", "artist_term").distinct()
    return (pairs.join(t, "artist_term", "left")
                 .groupBy("artist_id")
                 .agg(F.count("in_top").cast("int").alias("genre_match_count")))


def term_pairs(terms: DataFrame) -> DataFrame:
    """(artist_id, artist_term, repeats), one row per pair, stored in buckets of terms.

    A term that very many rows share has a row per artist at most, which bounds its bucket.
    Grouping by term, by (artist, term), or joining on the term then needs no shuffle of it."""
    pairs = terms.groupBy("artist_id", "artist_term").agg(F.count(F.lit(1)).alias("repeats"))
    # hash aggregates and a broadcast top-k table need no order
    return materialize_bucketed(pairs, "term-pairs", ["artist_term"], sort=False)


def hotness_totals(songs: DataFrame, measures: Sequence[str]) -> DataFrame:
    """``artist_hotness_totals`` of several hotness columns at once: per artist the exact sum
    (``<measure>_sum``) and count (``<measure>_n``) of each."""
    aggs = []
    for m in measures:
        h = nan_to_null(m)
        exact = F.when(F.abs(h) < F.lit(float("inf")), h.try_cast(EXACT))
        aggs += [F.sum(exact).alias(f"{m}_sum"), F.count(exact).alias(f"{m}_n")]
    return songs.groupBy("artist_id").agg(*aggs)


def term_hotness(pairs: DataFrame, totals: DataFrame, measures: Sequence[str]) -> DataFrame:
    """A3 for several measures in one aggregate over ``term_pairs``: one row per term, its mean
    of each measure.  A repeated pair weighs as often as it occurs."""
    # a product of two decimals of 38 digits would lose decimals; of 27 and 10 it does not
    def weighed(m: str) -> F.Column:
        several = F.col(f"{m}_sum").cast("decimal(27,15)") * F.col("repeats").cast("decimal(10,0)")
        return F.when(F.col("repeats") == 1, F.col(f"{m}_sum")).otherwise(several.cast(EXACT))

    return pairs.join(totals, "artist_id").groupBy("artist_term").agg(*[
        F.try_divide(F.sum(weighed(m)).cast("double"), F.sum(F.col("repeats") * F.col(f"{m}_n"))).alias(m)
        for m in measures])


def genre_counts(pairs: DataFrame, songs: DataFrame, measures: Sequence[str],
                 k: int = DEFAULT_TOP_K) -> DataFrame:
    """A3 -> T1 -> A5 for several measures: per artist, for each measure, how many of its terms
    are among the k terms of highest mean (0 kept).  The pairs are read twice, once to rank them
    and once to count them, whatever the number of measures."""
    totals = materialize(hotness_totals(songs, measures), "artist-hotness")
    ranked = materialize(term_hotness(pairs, totals, measures), "term-hotness")
    counted = pairs.select("artist_id", "artist_term")
    for m in measures:
        top = top_terms(ranked.select("artist_term", F.col(m).alias("artist_hotness")), k)
        counted = counted.join(top.select("artist_term", F.lit(1).alias(m)), "artist_term", "left")
    return counted.groupBy("artist_id").agg(*[F.count(m).cast("int").alias(m) for m in measures])


def genre_match_from_songs(terms: DataFrame, songs: DataFrame, hotness_col: str,
                           k: int = DEFAULT_TOP_K) -> DataFrame:
    """A3 -> T1 -> A5 over one hotness column.  The ranking uses every term row (a repeated row
    weighs twice, as in the original flow); the match count uses distinct terms."""
    measured = songs.select("artist_id", F.col(hotness_col).alias("genre_match_count"))
    return genre_counts(term_pairs(terms), measured, ["genre_match_count"], k)


def inner_join_genre_match(songs: DataFrame, genre: DataFrame) -> DataFrame:
    """Songs inner join the genre match (or the combined per-artist table); songs
    whose artist has no terms are dropped.

    ``genre`` should be a stored table: both sides are then plain shuffles, and AQE can
    split an artist that holds a large share of all songs."""
    return songs.join(genre, "artist_id", "inner")
