"""Feature lookup for (artist, title) requests with artist, title and global fallbacks.

The reference runs two to six Spark jobs per request.  Here a whole request table is
resolved at once: the feature table is reduced to sums and counts per (artist, title), the
artist, title and global levels are rolled up from that one aggregate, the stored levels are
left-joined to the distinct requests, and the first level that matched wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AVERAGED_CONFIDENCE, clean_key, mean_of, nan_to_null
from ..session import materialize, materialize_bucketed

FEATURES = ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]
NUMERIC_FEATURES = ["artist_hotness", "song_hotness", "td_meanPrice"]
LEVELS = ["exact", "artist", "title", "global"]
# Stands for a missing key in the join back (a cleaned key holds only [a-z0-9]).
NULL_KEY = "\u0000"


def global_means(features: DataFrame) -> DataFrame:
    """One row of feature means, with the constant averaged confidence."""
    return features.agg(
        mean_of("artist_hotness").alias("mean_artist_hotness"),
        mean_of("song_hotness").alias("mean_song_hotness"),
        mean_of("td_meanPrice").alias("mean_td_meanPrice"),
    ).withColumn("mean_td_confidence", F.lit(AVERAGED_CONFIDENCE))


def _totals(features: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: rows, largest confidence, and per feature the largest value (that of a
    single row), the sum and the count (both skip NaN)."""
    return features.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("td_confidence").cast("double")).alias("c"),
        *[x for c in NUMERIC_FEATURES for x in (
            F.max(F.col(c).cast("double")).alias(f"max_{c}"), F.sum(nan_to_null(c)).alias(f"sum_{c}"),
            F.count(nan_to_null(c)).alias(f"n_{c}"))])


def _rolled_up(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Totals by fewer keys (none: one row)."""
    return totals.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("c").alias("c"),
        *[x for c in NUMERIC_FEATURES for x in (F.max(f"max_{c}").alias(f"max_{c}"),
                                                F.sum(f"sum_{c}").alias(f"sum_{c}"),
                                                F.sum(f"n_{c}").alias(f"n_{c}"))])


def _mean_or_single(totals: DataFrame, keys: list[str]) -> DataFrame:
    one = F.col("n") == 1
    return totals.select(
        *keys, F.col("n").alias("n_matches"),
        F.when(one, F.col("c")).otherwise(F.lit(AVERAGED_CONFIDENCE)).alias("td_confidence"),
        *[F.when(one, F.col(f"max_{c}")).otherwise(F.try_divide(f"sum_{c}", f"n_{c}")).alias(c)
          for c in NUMERIC_FEATURES])


def group_mean_or_single(features: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the single row as is, or the means with confidence 3 when several
    (means skip NaN; a single row keeps its own values)."""
    return _mean_or_single(_totals(features, keys), keys)


def _level_struct(prefix: str, level: str) -> F.Column:
    return F.struct(F.lit(level).alias("match_level"),
                    *[F.col(f"{prefix}{c}").alias(c) for c in FEATURES])


def level_tables(features: DataFrame) -> dict[str, DataFrame]:
    """The three per-level aggregates (A8 by pair, artist, title) and the global means, all
    stored: ``features`` is read once, and the joins with stored tables can be split."""
    pair = ["artist_name", "title"]
    totals = materialize(_totals(features, pair), "pair-totals")
    out = {"exact": _mean_or_single(totals, pair)}
    for name, key in (("artist", "artist_name"), ("title", "title")):
        out[name] = materialize(_mean_or_single(_rolled_up(totals, [key]), [key]), f"{name}-level")
    every = _rolled_up(totals, [])
    out["means"] = materialize(every.select(
        *[F.try_divide(f"sum_{c}", f"n_{c}").alias(f"mean_{c}") for c in NUMERIC_FEATURES],
        F.lit(AVERAGED_CONFIDENCE).alias("mean_td_confidence")), "global-level")
    return out


def _global_row(means: DataFrame) -> F.Column:
    """The global level as a struct: a scalar subquery over the one row of means."""
    return means.select(F.struct(
        F.lit("global").alias("match_level"),
        F.col("mean_td_confidence").alias("td_confidence"),
        F.col("mean_artist_hotness").alias("artist_hotness"),
        F.col("mean_song_hotness").alias("song_hotness"),
        F.col("mean_td_meanPrice").alias("td_meanPrice"))).scalar()


def _with_levels(keyed: DataFrame, levels: dict[str, DataFrame], means: DataFrame | None) -> tuple[DataFrame, F.Column]:
    """``keyed`` (cleaned ``_k_artist``, ``_k_title``) left-joined with the three levels, and the
    struct of the first level that matched."""
    def level(name: str, prefix: str) -> DataFrame:
        agg = levels[name]
        return agg.select(*[F.col(c).alias(f"{prefix}{c}") for c in agg.columns])

    j = (keyed.join(level("exact", "e_"), (F.col("_k_artist") == F.col("e_artist_name"))
                    & (F.col("_k_title") == F.col("e_title")), "left")
              .join(level("artist", "a_"), F.col("_k_artist") == F.col("a_artist_name"), "left")
              .join(level("title", "t_"), F.col("_k_title") == F.col("t_title"), "left"))
    return j, F.coalesce(
        F.when(F.col("e_n_matches").isNotNull(), _level_struct("e_", "exact")),
        F.when(F.col("a_n_matches").isNotNull(), _level_struct("a_", "artist")),
        F.when(F.col("t_n_matches").isNotNull(), _level_struct("t_", "title")),
        _global_row(means if means is not None else levels["means"]))


def _keyed(requests: DataFrame) -> DataFrame:
    return requests.withColumn("_k_artist", clean_key("artist")).withColumn("_k_title", clean_key("title"))


def bucketed_levels(features: DataFrame, buckets: int | None = None) -> dict[str, DataFrame]:
    """``level_tables`` stored in buckets by their keys, which are unique in each, for requests
    that come again and again: their joins shuffle the requests alone."""
    levels = level_tables(features)
    keys = {"exact": ["artist_name", "title"], "artist": ["artist_name"], "title": ["title"]}
    return {"means": levels["means"],
            **{name: materialize_bucketed(levels[name], f"{name}-level", k, buckets) for name, k in keys.items()}}


def join_levels(requests: DataFrame, levels: dict[str, DataFrame], means: DataFrame | None = None) -> DataFrame:
    """J10 as one plan without any action, so ``requests`` may be a stream: every request row is
    joined with the stored levels (``level_tables`` or ``bucketed_levels``).

    Same rows as ``lookup_cascade``.  That one resolves each distinct pair once and can split a
    pair that holds a large share of all requests; here such a pair is one task's work, so a
    stream bounds it by the size of its triggers."""
    joined, chosen = _with_levels(_keyed(requests), levels, means)
    return (joined.withColumn("_m", chosen)
            .select(*requests.columns, F.col("_m.match_level").alias("match_level"),
                    *[F.col(f"_m.{c}").alias(c) for c in FEATURES]))


def lookup_cascade(requests: DataFrame, features: DataFrame | None,
                   means: DataFrame | None = None,
                   levels: dict[str, DataFrame] | None = None) -> DataFrame:
    """One output row per request with the features of the first matching level.

    ``requests`` needs ``artist`` and ``title`` (raw text) plus any id columns, which are
    carried through.  ``features`` needs cleaned ``artist_name``, ``title`` and the four
    feature columns; it is read once (``level_tables``), or pass the stored ``levels``.
    The global level is a scalar subquery over ``means`` (one row).

    Each distinct cleaned (artist, title) is resolved once.  The resolved pairs are stored
    and joined back to the requests: there too both sides are plain shuffles, so a pair
    with a large share of all requests can be split.  A streaming request table takes
    ``join_levels``, or this one micro-batch by micro-batch (``streaming.scoring``).
    """
    levels = levels or level_tables(features)
    r = _keyed(requests)
    j, chosen = _with_levels(r.select("_k_artist", "_k_title").distinct(), levels, means)
    keep = list(requests.columns)
    picked = [F.col("_m.match_level").alias("match_level"),
              *[F.col(f"_m.{c}").alias(c) for c in FEATURES]]
    # Null keys are mapped to a sentinel so that the join back is a plain equi-join (every
    # request has exactly one resolved row).
    def key(c: str) -> F.Column:
        return F.coalesce(c, F.lit(NULL_KEY))

    resolved = materialize(j.select(key("_k_artist").alias("_ra"), key("_k_title").alias("_rt"),
                                    chosen.alias("_m")).select("_ra", "_rt", *picked), "resolved-requests")
    rq = r.withColumn("_ba", key("_k_artist")).withColumn("_bt", key("_k_title"))
    back = rq.join(resolved, (F.col("_ba") == F.col("_ra")) & (F.col("_bt") == F.col("_rt")))
    return back.select(*keep, "match_level", *FEATURES)
