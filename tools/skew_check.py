"""Measure the joins when one key holds a third of the rows.

Variants of the given tables in which one artist owns every third song (term, request), one
(title, artist) owns every third download record, and one request pair makes every third
request.  Broadcasts are switched off (as for large tables on a cluster), and the rows
handled by each task of the join stage are counted with ``spark_partition_id()`` there.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tunelift.operators import enrich, lookup, terms  # noqa: E402
from tunelift.plans import flows as P  # noqa: E402
from tunelift.session import build_session, materialize  # noqa: E402

SESSION = {"spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
           "spark.sql.files.maxPartitionBytes": "1m"}


def largest_task_share(df) -> tuple[float, int]:
    """All columns are read, as AQE goes by bytes."""
    rows = df.select(F.spark_partition_id().alias("p"), F.xxhash64(*df.columns).alias("h"))
    counts = sorted(r["n"] for r in rows.groupBy("p").agg(F.count("h").alias("n"), F.max("h")).collect())
    return counts[-1] / sum(counts), sum(counts)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 64, extra=SESSION)
    r = P.Roles.from_test_tables(spark, sf)
    hot = F.when(F.col("song_id") % 3 == 0, F.lit("Brand#11")).otherwise(
        F.concat(F.col("artist_id"), F.lit(" "), F.col("song_id") % 400))
    info = materialize(r.song_info.withColumn("artist_id", hot).withColumn("artist_name", hot).repartition(24), "info")
    songs = materialize(enrich.clean_song_info_wide(info).repartition(24), "songs")
    per = songs.groupBy("artist_id").agg(F.count("song_id").alias("similar_artist_count"))
    term_rows = materialize(songs.select("artist_id", F.col("title").alias("artist_term"), "song_id").repartition(24), "terms")

    def third(df, keys: dict):
        """``df`` with every third row given the keys."""
        df = materialize(df.withColumn("_i", F.monotonically_increasing_id()), "numbered")
        for c, v in keys.items():
            df = df.withColumn(c, F.when(F.col("_i") % 3 == 0, F.lit(v)).otherwise(F.col(c)))
        return materialize(df.drop("_i").repartition(24), "third")

    first = enrich.clean_song_info_serving(r.song_info).select("title", "artist_name").first()
    records = third(enrich.clean_downloads(r.downloads), {"td_title": first["title"], "td_artist": first["artist_name"]})
    serving = materialize(enrich.clean_song_info_serving(r.song_info), "serving")
    feats = materialize(P.serving_features(r).withColumn("artist_name", F.lit("hot")), "feats")
    known = third(r.requests, {"artist": "hot", "title": "hot song"})
    unknown = third(r.requests.withColumn("title", F.concat("title", F.lit(" "), F.col("request_id"))), {"artist": "hot"})
    for name, df in [
            ("J2 similar count (hot artist)", enrich.left_join_similar_count(songs, per)),
            ("J6 song count (hot artist)", enrich.inner_join_song_count(songs)),
            ("J7 weight*freq (hot artist)", enrich.left_join_weight_freq(
                songs, per.select("artist_id", F.lit(1.0).alias("weight_dot_freq")))),
            ("J3 per-artist table (hot artist)", terms.inner_join_genre_match(songs, materialize(per, "per"))),
            ("J9 terms (hot artist)", terms.inner_join_term_hotness(term_rows, info.withColumn("h", F.lit(0.5)), "h")),
            ("J4 downloads (hot record key)", enrich.left_join_downloads(serving, records)),
            ("J10 join back (hot request pair)", lookup.lookup_cascade(known, feats)),
            ("J10 levels (hot artist, many titles)", lookup.lookup_cascade(unknown, feats))]:
        share, n = largest_task_share(df)
        print(f"{name:40s}: largest task holds {share:6.1%} of {n} rows", flush=True)


if __name__ == "__main__":
    main()
