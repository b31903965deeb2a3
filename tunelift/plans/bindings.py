"""Input roles of the song flows, derived from the driver's test tables.

The reference reads six delimited files (song info, artist terms, similar artists,
play counts, likes, download records).  The test data is a TPC-H-like star schema, so
each role is *derived* from it by Spark (filters, joins, aggregates), and its size grows
with the tables.  Every role has a Spark builder and an equivalent SQL text (used only
by the DuckDB oracle in ``__spark_entry__.oracle_sql``).

Binding (our own choice, documented in README):

=================  =========================================================================
role               definition
=================  =========================================================================
song_info          one song per part: song_id = track_id = p_partkey, artist = p_brand,
                   title = p_name, artist_hotttnesss = p_size/50 as text, 'NA' when
                   p_partkey % 7 = 0, tempo = p_size, song_hotttnesss = p_retailprice/1000,
                   artist_familiarity = p_retailprice/2000, loudness = -p_size/5,
                   duration = p_retailprice/4, year = 1990 + p_partkey % 20 (text)
play_count         all of lineitem: rows per 2 * l_partkey (so odd songs have no plays, and
                   the larger half of the keys no song)
similar_artists    distinct (artist, l_suppkey) of lineitem x part, the artist being the brand
                   number plus 11 (some of those artists have no song, some songs no artist)
artist_terms       distinct (artist, lower-case word) of the whole texts of documents; the
                   artist's two digits come from doc_id, and include digits that no brand has
                   while brands that end in 5 have no terms
term_scores        lineitem x part: (p_brand, p_type, weight = l_discount as text, 'NA' when
                   l_linenumber % 5 = 0, freq = l_quantity)
likes              all of events: rows per 3 * user_id (as track id)
downloads          lineitem x part x orders, per (p_brand, title): mean l_extendedprice, row
                   count, and as confidence the label of the largest order's priority; the
                   title of every third part carries a suffix that no song has
requests           one per part; p_partkey % 4 picks: exact pair, unknown title,
                   unknown artist, both unknown
=================  =========================================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed binding values (our own; the label words are the reference's) ---------
# Order priority of the test data -> confidence label text of a download record.
PRIORITY_LABELS = {
    "1-URGENT": "excellent",
    "2-HIGH": "very good",
    "3-MEDIUM": "good",
    "4-NOT SPECIFIED": "average",
    "5-LOW": "poor",
}
UNKNOWN_ARTIST_PREFIX = "Unknown "
UNKNOWN_TITLE_SUFFIX = " remix"
LIVE_TITLE_SUFFIX = " live"
# Second digit of the artist of a document, by doc_id: no 5, so brands ending in 5 have no
# terms; 6 and 7 are no brand's.
TERM_DIGITS = "123467"
# ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def song_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_partkey").alias("track_id"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("NA"))
         .otherwise((F.col("p_size") / 50).cast("string")).alias("artist_hotttnesss"),
        (F.col("p_retailprice") / 2000).alias("artist_familiarity"),
        (-F.col("p_size") / 5).alias("loudness"),
        F.col("p_size").cast("double").alias("tempo"),
        (F.col("p_retailprice") / 4).alias("duration"),
        (F.col("p_retailprice") / 1000).alias("song_hotttnesss"),
        (F.lit(1990) + F.col("p_partkey") % 20).cast("string").alias("year"),
    )


def play_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey") * 2
    return (li.groupBy(key.alias("play_song_id")).agg(F.count(F.lit(1)).alias("play_count"))
              .select("play_song_id", F.col("play_song_id").alias("play_track_id"), "play_count"))


def similar_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # the pattern is matched once a part, not once a line item
    p = table(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_brand", "([0-9]+)$", 1).alias("number"))
    artist = F.concat(F.lit("Brand#"), (F.col("number").cast("int") + 11).cast("string"))
    return (li.join(p, li.l_partkey == p.p_partkey)
              .select(artist.alias("artist_id"), F.col("l_suppkey").alias("similar_artist"))
              .distinct())


def artist_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    second = F.substring(F.lit(TERM_DIGITS), (F.floor(F.col("doc_id") / 5) % 6 + 1).cast("int"), F.lit(1))
    artist = F.concat(F.lit("Brand#"), (F.col("doc_id") % 5 + 1).cast("string"), second)
    # a split at one plain character is several times cheaper than a pattern
    words = F.array_remove(F.split(F.translate(F.lower("text"), "\n", " "), " "), "")
    return doc.select(artist.alias("artist_id"), F.explode(F.array_distinct(words)).alias("artist_term")).distinct()


def term_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .select(F.col("p_brand").alias("artist_id"),
                      F.col("p_type").alias("artist_term"),
                      F.when(F.col("l_linenumber") % 5 == 0, F.lit("NA"))
                       .otherwise(F.col("l_discount").cast("string")).alias("weight"),
                      F.col("l_quantity").alias("freq")))


def likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy((F.col("user_id") * 3).alias("track")).agg(F.count(F.lit(1)).alias("likes"))


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    title = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(LIVE_TITLE_SUFFIX))).otherwise(F.col("p_name"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("artist"), title.alias("title"))
    # The label travels as its place in the list: numbers keep the aggregate a hash aggregate.
    texts = list(PRIORITY_LABELS)
    place = F.create_map(*[x for i, k in enumerate(texts) for x in (F.lit(k), F.lit(i))])
    labels = F.create_map(*[x for i, k in enumerate(texts) for x in (F.lit(i), F.lit(PRIORITY_LABELS[k]))])
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.element_at(place, F.col("o_orderpriority")).alias("place"))
    # the orders first: the line items are dealt out by order before they carry any text
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .groupBy("artist", "title")
              .agg(F.avg("l_extendedprice").alias("mean_price"),
                   F.count(F.lit(1)).alias("downloads"),
                   F.max_by("place", "l_orderkey").alias("place"))
              .select("artist", "title", "mean_price", "downloads",
                      F.element_at(labels, F.col("place")).alias("confidence")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    kind = F.col("p_partkey") % 4
    return p.select(
        F.col("p_partkey").alias("request_id"),
        F.when(kind < 2, F.col("p_brand"))
         .otherwise(F.concat(F.lit(UNKNOWN_ARTIST_PREFIX), F.col("p_brand"))).alias("artist"),
        F.when(kind % 2 == 0, F.col("p_name"))
         .otherwise(F.concat(F.col("p_name"), F.lit(UNKNOWN_TITLE_SUFFIX))).alias("title"),
    )


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request text lines ``artist;title``; some are malformed on purpose: a trailing
    separator (kept), a third field (rejected), or no separator (rejected)."""
    r = requests(spark, sf_dir)
    rid = F.col("request_id")
    line = (F.when(rid % 9 == 0, F.concat_ws(";", "artist", "title", F.lit("x")))
             .when(rid % 13 == 0, F.col("artist"))
             .when(rid % 5 == 0, F.concat(F.col("artist"), F.lit(";"), F.col("title"), F.lit(";")))
             .otherwise(F.concat_ws(";", "artist", "title")))
    return r.select(rid, line.alias("value"))


# ------------------------------------------------------------------------------
# The same roles as SQL, for the DuckDB oracle.  Names and columns match the
# builders above.
# ------------------------------------------------------------------------------

def _sql_map(mapping: dict[str, str], col: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} END"


ROLE_SQL: dict[str, str] = {
    "song_info": """
        SELECT p_partkey AS song_id, p_partkey AS track_id, p_brand AS artist_id,
               p_brand AS artist_name, p_name AS title,
               CASE WHEN p_partkey % 7 = 0 THEN 'NA'
                    ELSE CAST(p_size / 50 AS VARCHAR) END AS artist_hotttnesss,
               p_retailprice / 2000 AS artist_familiarity,
               -p_size / 5 AS loudness,
               CAST(p_size AS DOUBLE) AS tempo,
               p_retailprice / 4 AS duration,
               p_retailprice / 1000 AS song_hotttnesss,
               CAST(1990 + p_partkey % 20 AS VARCHAR) AS year
        FROM part""",
    "play_count": """
        SELECT 2 * l_partkey AS play_song_id, 2 * l_partkey AS play_track_id,
               count(*) AS play_count
        FROM lineitem GROUP BY l_partkey""",
    "similar_artists": """
        SELECT DISTINCT 'Brand#' || (CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) + 11)
               AS artist_id, l_suppkey AS similar_artist
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "artist_terms": f"""
        SELECT DISTINCT 'Brand#' || (doc_id % 5 + 1)
                        || substr('{TERM_DIGITS}', (doc_id // 5) % 6 + 1, 1) AS artist_id,
               unnest(regexp_extract_all(lower(text), '[^ \\n]+')) AS artist_term
        FROM documents""",
    "term_scores": """
        SELECT p_brand AS artist_id, p_type AS artist_term,
               CASE WHEN l_linenumber % 5 = 0 THEN 'NA'
                    ELSE CAST(l_discount AS VARCHAR) END AS weight,
               l_quantity AS freq
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "likes": """
        SELECT 3 * user_id AS track, count(*) AS likes FROM events GROUP BY user_id""",
    "downloads": f"""
        SELECT artist, title, avg(l_extendedprice) AS mean_price, count(*) AS downloads,
               {_sql_map(PRIORITY_LABELS, 'max_by(o_orderpriority, l_orderkey)')} AS confidence
        FROM (SELECT p_brand AS artist,
                     CASE WHEN p_partkey % 3 = 0 THEN p_name || '{LIVE_TITLE_SUFFIX}'
                          ELSE p_name END AS title, l_extendedprice, l_orderkey, o_orderpriority
              FROM lineitem JOIN part ON l_partkey = p_partkey
                   JOIN orders ON l_orderkey = o_orderkey)
        GROUP BY artist, title""",
    "requests": f"""
        SELECT p_partkey AS request_id,
               CASE WHEN p_partkey % 4 < 2 THEN p_brand
                    ELSE '{UNKNOWN_ARTIST_PREFIX}' || p_brand END AS artist,
               CASE WHEN p_partkey % 4 % 2 = 0 THEN p_name
                    ELSE p_name || '{UNKNOWN_TITLE_SUFFIX}' END AS title
        FROM part""",
}
