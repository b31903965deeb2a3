"""Registered queries: one per operator key, each with its DuckDB oracle SQL (or none).

Every query reads the given tables (or data Spark derives from them) in full.  Double
columns are rounded to 6 decimals on both sides so that summation order does not
change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import columns as C
from ..operators import audit, enrich, explore, lookup, model, terms
from ..session import apply_session_settings, materialize, scratch_path
from ..sources import readers, writers
from ..streaming import scoring
from . import bindings as B
from . import flows as P
from .oracle import WIDE, clean, num0, ordinal, rounded, split_bucket, with_fragments

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    over = overrides or {}
    return df.select(*[C.fixed_round(f.name, over.get(f.name, digits)).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def query(key: str, sql: str | None = None, round_output: bool = True,
          digits: dict | None = None):
    """Register ``fn`` under ``key``; ``digits`` overrides the 6 decimals per column
    (large values keep fewer decimals, as doubles hold ~15 significant digits)."""
    def deco(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_settings(spark)
            df = fn(spark, sf_dir)
            return round_doubles(df, 6, digits) if round_output else df
        run.__name__ = key
        run.__doc__ = fn.__doc__
        REGISTRY[key] = (run, with_fragments(sql) if sql else None)
        return run
    return deco


def roles(spark: SparkSession, sf_dir: str) -> P.Roles:
    return P.Roles.from_test_tables(spark, sf_dir)


def tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return B.table(spark, sf_dir, name)


def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem numbers as text, with 'NA' and '' placed by line number."""
    li = tbl(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.when(F.col("l_linenumber") % 5 == 0, F.lit("NA"))
         .otherwise(F.col("l_extendedprice").cast("string")).alias("price_text"),
        F.when(F.col("l_linenumber") % 5 == 1, F.lit(""))
         .otherwise(F.col("l_discount").cast("string")).alias("discount_text"))


def lineitem_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a fixed prediction (l_quantity * 1500) against l_extendedprice,
    split by the artist-disjoint rule on the supplier."""
    li = tbl(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * 1500).alias("prediction"))
    return model.artist_disjoint_split(li, "l_suppkey", 30)


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string",
              "p_size": "int", "p_retailprice": "double"}
PART_SCHEMA = ", ".join(f"{c} {t}" for c, t in PART_TYPES.items())
PART_SQL = f"SELECT {', '.join(PART_COLS)} FROM part"
SERVING_DOUBLES = ["artist_hotness", "song_hotness", "td_meanPrice"]
WIDE_DOUBLES = ["artist_hotttnesss", "artist_familiarity", "loudness", "tempo", "duration",
                "song_hotttnesss", "year", "weight_dot_freq", "td_meanPrice", "popularity",
                "td_downloads"]
EXPLORE_COLS = [c for c in WIDE if c != "td_downloads"]


# =============================== sources ===============================================

@query("read_delimited", rounded(PART_SQL, ["p_retailprice"]))
def _s1(spark, d):
    """Part written as ';' CSV with headers, plus rows of the wrong width; read back."""
    path = scratch_path(spark, "s1")
    part = tbl(spark, d, "part").select(*PART_COLS)
    part.write.option("header", "true").option("sep", ";").csv(path)
    short = part.where(F.col("p_size") > 40).select("p_partkey", "p_name")
    short.write.mode("append").option("header", "true").option("sep", ";").csv(path)
    wide = part.where(F.col("p_size") < 5).withColumn("extra", F.lit("x"))
    wide.write.mode("append").option("header", "true").option("sep", ";").csv(path)
    return readers.read_delimited(spark, path, PART_SCHEMA, ";")


HEADER_LINE = ";".join(PART_COLS)


def _part_lines(spark, d, sep=";", pad=""):
    part = tbl(spark, d, "part").select(*PART_COLS)
    j = f"{pad}{sep}{pad}"
    body = part.select(F.concat_ws(j, *[F.col(c).cast("string") for c in PART_COLS]).alias("value"))
    header = part.where(F.col("p_size") == 1).select(F.lit(HEADER_LINE).alias("value"))
    return body.unionByName(header)


@query("read_split_lines", rounded(PART_SQL, ["p_retailprice"]))
def _s2(spark, d):
    """Part as ';' text lines with repeated header lines; split and typed."""
    path = scratch_path(spark, "s2")
    _part_lines(spark, d).write.text(path)
    lines = readers.read_split_lines(spark, path, ";", header=HEADER_LINE, n_fields=5)
    return readers.fields_to_columns(lines, PART_COLS, types=PART_TYPES)


@query("read_trimmed_rows", rounded(PART_SQL, ["p_retailprice"]))
def _s3(spark, d):
    """S3: part as padded ' ; ' lines; each field trimmed."""
    path = scratch_path(spark, "s3")
    _part_lines(spark, d, pad="  ").write.text(path)
    return readers.read_trimmed_rows(spark, path, PART_COLS, ";", types=PART_TYPES,
                                     header=HEADER_LINE)


SERVING_TYPES = {"artist_name": "string", "title": "string", "td_confidence": "int",
                 "artist_hotness": "double", "song_hotness": "double",
                 "td_meanPrice": "double", "has_download_record": "boolean"}
SHUFFLED = ["title", "artist_name", "td_meanPrice", "song_hotness", "artist_hotness",
            "td_confidence", "has_download_record"]


@query("read_gzip_features", rounded("SELECT * FROM q1", SERVING_DOUBLES))
def _s4(spark, d):
    """Q1 written as gzip CSV in another column order; read back by position."""
    path = scratch_path(spark, "s4")
    q1 = P.serving_features(roles(spark, d))
    q1.select(*SHUFFLED).write.option("header", "true").option("compression", "gzip").csv(path)
    positions = [SHUFFLED.index(c) for c in P.SERVING_COLUMNS]
    return readers.read_gzip_features(spark, path, P.SERVING_COLUMNS, positions, SERVING_TYPES)


REQ_LINE_SQL = """
    SELECT CASE WHEN request_id % 9 = 0 THEN artist || ';' || title || ';x'
                WHEN request_id % 13 = 0 THEN artist
                WHEN request_id % 5 = 0 THEN artist || ';' || title || ';'
                ELSE artist || ';' || title END AS value
    FROM requests"""


@query("read_requests", f"""
    WITH req_lines AS ({REQ_LINE_SQL}),
         parsed AS (SELECT string_split(regexp_replace(value, ';+$', ''), ';') AS f
                    FROM req_lines)
    SELECT f[1] AS artist, f[2] AS title FROM parsed WHERE len(f) = 2""")
def _s6(spark, d):
    """Request lines (some malformed) written as text, parsed back."""
    path = scratch_path(spark, "s6")
    B.request_lines(spark, d).select("value").write.text(path)
    accepted, _ = readers.read_requests(spark, path)
    return accepted


# =============================== sinks =================================================

@query("write_features_csv", rounded("SELECT * FROM q1", SERVING_DOUBLES))
def _k1(spark, d):
    """K1: Q1 written as CSV (distributed), read back with its schema."""
    path = scratch_path(spark, "k1")
    writers.write_features_csv(P.serving_features(roles(spark, d)), path)
    schema = ", ".join(f"{c} {t}" for c, t in SERVING_TYPES.items())
    return readers.read_delimited(spark, path, schema, ",")


MEANS_SQL = """
    SELECT avg(artist_hotness) AS mean_artist_hotness, avg(song_hotness) AS mean_song_hotness,
           avg(td_meanPrice) AS mean_td_meanPrice, 3.0 AS mean_td_confidence FROM q1"""
MEANS_DOUBLES = ["mean_artist_hotness", "mean_song_hotness", "mean_td_meanPrice",
                 "mean_td_confidence"]


@query("write_means", rounded(MEANS_SQL, MEANS_DOUBLES))
def _k2(spark, d):
    """K2: global means written with a header, read back."""
    path = scratch_path(spark, "k2")
    writers.write_means(lookup.global_means(P.serving_features(roles(spark, d))), path)
    schema = ", ".join(f"{c} double" for c in ["mean_artist_hotness", "mean_song_hotness",
                                                 "mean_td_meanPrice", "mean_td_confidence"])
    return readers.read_delimited(spark, path, schema, ",")


def _metrics_sql(by_split: bool) -> str:
    g = "split, " if by_split else ""
    grp = "GROUP BY split" if by_split else ""
    return f"""
        SELECT {g}count(label - prediction) AS n, count(*) - count(label - prediction) AS left_out,
               sum((label - prediction) * (label - prediction)) / count(*) AS mse,
               sqrt(sum((label - prediction) * (label - prediction)) / count(*)) AS rmse,
               1 - sum((label - prediction) * (label - prediction))
                   / (var_pop(label) * count(*)) AS r2,
               avg(abs(label - prediction)) AS mae,
               var_pop(prediction) + pow(avg(prediction) - avg(label), 2) AS explained_variance
        FROM li_pred {grp}"""


METRIC_DOUBLES = {"mse": 2, "rmse": 6, "r2": 6, "mae": 6, "explained_variance": 2}


@query("write_metrics", rounded(f"""
    WITH m AS ({_metrics_sql(True)})
    SELECT split, 'mse' AS metric, mse AS value FROM m UNION ALL
    SELECT split, 'rmse', rmse FROM m UNION ALL SELECT split, 'r2', r2 FROM m UNION ALL
    SELECT split, 'mae', mae FROM m UNION ALL
    SELECT split, 'explained_variance', explained_variance FROM m""", {"value": 2}),
    digits={"value": 2})
def _k3(spark, d):
    """K3: per-split metrics as split;metric;value lines, read back."""
    path = scratch_path(spark, "k3")
    m = model.evaluate_splits(lineitem_predictions(spark, d))
    writers.write_metrics(model.metrics_long(m), path)
    return readers.read_delimited(spark, path, "split string, metric string, value double",
                                  ";", header=False)


@query("write_predictions", """
    SELECT split, CAST(trunc(label) AS INTEGER) AS label_int,
           CAST(trunc(prediction) AS INTEGER) AS prediction_int,
           abs(CAST(trunc(label) AS INTEGER) - CAST(trunc(prediction) AS INTEGER)) AS abs_diff
    FROM li_pred""")
def _k4(spark, d):
    """K4: integer (label, prediction, |diff|) rows written partitioned by split."""
    path = scratch_path(spark, "k4")
    writers.write_predictions(model.prediction_table(lineitem_predictions(spark, d)), path)
    back = spark.read.parquet(path)
    return back.select("split", "label_int", "prediction_int", "abs_diff")


def _orders_training(spark, d):
    li = tbl(spark, d, "lineitem")
    o = tbl(spark, d, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_suppkey",
                    F.col("l_quantity").cast("double").alias("l_quantity"),
                    F.col("l_discount").cast("double").alias("l_discount"),
                    F.col("o_totalprice").cast("double").alias("o_totalprice"),
                    F.col("l_extendedprice").alias("label"))


TRAIN_FEATURES = ["l_quantity", "l_discount", "o_totalprice"]


@query("save_load_model", f"""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN {split_bucket('l_suppkey')} < 30 THEN 'test' ELSE 'train' END AS split,
           true AS loaded_equals_original
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _k5(spark, d):
    """K5: forest saved and loaded back; per row, whether both give the same score."""
    data = model.artist_disjoint_split(_orders_training(spark, d), "l_suppkey")
    fitted = model.train_forest(data.where(F.col("split") == "train"), TRAIN_FEATURES,
                                num_trees=10, max_depth=5)
    path = scratch_path(spark, "k5")
    writers.save_model(fitted, path)
    loaded = writers.load_model(path)
    first = model.predict_batch(fitted, data).drop("features").withColumnsRenamed(
        {"prediction": "first_score", "prediction_int": "first_int", "reject_reason": "first_reason"})
    again = model.predict_batch(loaded, first)
    same = (F.col("prediction").eqNullSafe(F.col("first_score"))
            & F.col("prediction_int").eqNullSafe(F.col("first_int")))
    return again.select("l_orderkey", "l_linenumber", "split", same.alias("loaded_equals_original"))


# =============================== projections & scalar functions ========================

@query("project_rename", "SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_name FROM part")
def _p1(spark, d):
    """Part columns renamed to song columns."""
    return C.project_rename(tbl(spark, d, "part"),
                            {"p_partkey": "song_id", "p_name": "title", "p_brand": "artist_name"})


@query("lower_text", "SELECT doc_id, lower(text) AS text_lower, lower(source) AS source_lower FROM documents")
def _p2(spark, d):
    """Lower-case of whole document texts."""
    doc = tbl(spark, d, "documents")
    return doc.select("doc_id", C.lower_text("text").alias("text_lower"),
                      C.lower_text("source").alias("source_lower"))


@query("clean_key", f"""
    SELECT doc_id, {clean('text')} AS text_key, {clean('lang')} AS lang_key FROM documents
    UNION ALL SELECT p_partkey, {clean('p_name')}, {clean('p_brand')} FROM part""")
def _p3(spark, d):
    """Join-key cleaning of whole document texts and part names/brands."""
    doc = tbl(spark, d, "documents").select(
        "doc_id", C.clean_key("text").alias("text_key"), C.clean_key("lang").alias("lang_key"))
    part = tbl(spark, d, "part").select(
        F.col("p_partkey").alias("doc_id"), C.clean_key("p_name").alias("text_key"),
        C.clean_key("p_brand").alias("lang_key"))
    return doc.unionByName(part)


@query("is_number", """
    SELECT l_orderkey, l_linenumber, TRY_CAST(price_text AS DOUBLE) IS NOT NULL AS price_is_number,
           TRY_CAST(discount_text AS DOUBLE) IS NOT NULL AS discount_is_number FROM li_text""")
def _p4(spark, d):
    """Number test on lineitem text with 'NA' and '' values."""
    t = lineitem_text(spark, d)
    return t.select("l_orderkey", "l_linenumber",
                    C.is_number("price_text").alias("price_is_number"),
                    C.is_number("discount_text").alias("discount_is_number"))


@query("non_numeric_to_zero", rounded(f"""
    SELECT l_orderkey, l_linenumber, {num0('price_text')} AS price,
           {num0('discount_text')} AS discount FROM li_text""", ["price", "discount"]))
def _p5(spark, d):
    """P5: non-numbers to 0 on lineitem text."""
    t = lineitem_text(spark, d)
    return t.select("l_orderkey", "l_linenumber",
                    C.non_numeric_to_zero("price_text").alias("price"),
                    C.non_numeric_to_zero("discount_text").alias("discount"))


# One priority is left out of the label map, so it keeps its raw text and encodes as -1.
P6_LABELS = {k: v for k, v in B.PRIORITY_LABELS.items() if k != "5-LOW"}


@query("ordinal_encode", f"""
    WITH o AS (SELECT o_orderkey, coalesce(CASE o_orderpriority
                  {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in P6_LABELS.items())} END,
                  o_orderpriority) AS confidence FROM orders)
    SELECT o_orderkey, confidence, {ordinal('confidence')} AS code FROM o""")
def _p6(spark, d):
    """Ordinal codes of confidence labels derived from order priorities."""
    o = tbl(spark, d, "orders")
    m = F.create_map(*[x for k, v in P6_LABELS.items() for x in (F.lit(k), F.lit(v))])
    lab = o.select("o_orderkey", F.coalesce(F.element_at(m, F.col("o_orderpriority")),
                                            F.col("o_orderpriority")).alias("confidence"))
    return lab.withColumn("code", C.ordinal_encode("confidence"))


@query("field_count_filter", """
    SELECT page_id, url FROM pages
    WHERE len(string_split(regexp_replace(url, '/+$', ''), '/')) = 5""")
def _p7(spark, d):
    """Pages whose url splits by '/' into exactly 5 fields."""
    return C.field_count_filter(tbl(spark, d, "pages").select("page_id", "url"), "url", "/", 5)


@query("numeric_row_filter", """
    SELECT l_orderkey, l_linenumber, price_text, discount_text FROM li_text
    WHERE TRY_CAST(price_text AS DOUBLE) IS NOT NULL
      AND TRY_CAST(discount_text AS DOUBLE) IS NOT NULL""")
def _p8(spark, d):
    """Lineitem text rows whose two numeric fields are numbers."""
    t = lineitem_text(spark, d).select("l_orderkey", "l_linenumber", "price_text", "discount_text")
    return C.numeric_row_filter(t, ["price_text", "discount_text"])


@query("digits_only", """
    SELECT p_partkey, regexp_full_match(substr(p_brand, 7), '[0-9]*') AS brand_digits,
           regexp_full_match(p_name, '[0-9]*') AS name_digits FROM part""")
def _p9(spark, d):
    """Digit-only test on brand numbers (true) and part names (false)."""
    p = tbl(spark, d, "part")
    return p.select("p_partkey", C.digits_only(F.expr("substring(p_brand, 7)")).alias("brand_digits"),
                    C.digits_only("p_name").alias("name_digits"))


@query("trim_fields", """
    SELECT p_partkey, trim('  ' || p_name || ' ') AS p_name, trim(p_brand || '   ') AS p_brand,
           trim(text) AS text
    FROM part LEFT JOIN documents ON p_partkey = doc_id""")
def _p10(spark, d):
    """P10: trim of padded part fields and whole document texts."""
    p = tbl(spark, d, "part")
    doc = tbl(spark, d, "documents").select("doc_id", "text")
    j = p.join(doc, p.p_partkey == doc.doc_id, "left").select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("p_name"),
        F.concat(F.col("p_brand"), F.lit("   ")).alias("p_brand"), "text")
    return C.trim_fields(j, ["p_name", "p_brand", "text"])


@query("fill_missing", """
    SELECT p_partkey, coalesce(play_count, 0) AS play_count, coalesce(likes, 0) AS likes
    FROM part LEFT JOIN play_count ON p_partkey = play_song_id
              LEFT JOIN likes ON p_partkey = track""")
def _p11(spark, d):
    """Missing play counts and likes of parts filled with 0."""
    p = tbl(spark, d, "part").select("p_partkey")
    pc = B.play_count(spark, d).select("play_song_id", "play_count")
    lk = B.likes(spark, d)
    j = (p.join(pc, p.p_partkey == pc.play_song_id, "left")
          .join(lk, p.p_partkey == lk.track, "left")
          .select("p_partkey", "play_count", "likes"))
    return C.fill_missing(j, {"play_count": 0, "likes": 0})


@query("equality_lookup", rounded(f"""
    SELECT * FROM q1 WHERE artist_name = {clean("'Brand#13'")}""", SERVING_DOUBLES))
def _p12(spark, d):
    """Serving features of one artist from a store clustered by artist, key cleaned like it."""
    path = scratch_path(spark, "feature-store")
    writers.write_feature_store(P.serving_features(roles(spark, d)), path)
    return readers.read_feature_store(spark, path, artist_name="Brand#13")


@query("threshold_filter", rounded("SELECT * FROM q2 WHERE td_confidence > 1", WIDE_DOUBLES))
def _p13(spark, d):
    """Wide rows with confidence > 1."""
    return C.threshold_filter(P.wide_features(roles(spark, d)), "td_confidence", 1)


@query("select_by_index", rounded("SELECT td_confidence, td_meanPrice FROM q2", ["td_meanPrice"]))
def _p14(spark, d):
    """Columns 13, 0, 0 of the wide table, in table order."""
    return C.select_by_index(P.wide_features(roles(spark, d)), [13, 0, 0])


LP_X = "((p_retailprice / 2000 - 0.46) * p_size * l_quantity)"


@query("popularity_log10", rounded(f"""
    SELECT l_orderkey, l_linenumber, log10(greatest({LP_X}, 0.0) + 1) AS popularity
    FROM lineitem JOIN part ON l_partkey = p_partkey""", ["popularity"]))
def _p15(spark, d):
    """log10 popularity over lineitem x part (negative products clamp to 0)."""
    j = _li_part(spark, d)
    return j.select("l_orderkey", "l_linenumber",
                    C.popularity_log10("fam", "p_size", "l_quantity").alias("popularity"))


@query("popularity_ln", rounded(f"""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN {LP_X} > -1 THEN ln(1 + {LP_X}) END AS popularity_ln
    FROM lineitem JOIN part ON l_partkey = p_partkey""", ["popularity_ln"]))
def _p16(spark, d):
    """Natural-log popularity, null where the product is <= -1."""
    j = _li_part(spark, d)
    return j.select("l_orderkey", "l_linenumber",
                    C.popularity_ln("fam", "p_size", "l_quantity").alias("popularity_ln"))


def _li_part(spark, d):
    li = tbl(spark, d, "lineitem")
    p = tbl(spark, d, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "p_size", "l_quantity",
        (F.col("p_retailprice") / 2000 - 0.46).alias("fam"))


@query("weight_times_freq", rounded("""
    SELECT artist_id, artist_term, TRY_CAST(weight AS DOUBLE) * TRY_CAST(freq AS DOUBLE) AS wf
    FROM term_scores WHERE TRY_CAST(weight AS DOUBLE) IS NOT NULL""", ["wf"]))
def _p17(spark, d):
    """Weight * freq per term-score row (numeric rows)."""
    t = C.numeric_row_filter(B.term_scores(spark, d), ["weight", "freq"])
    return t.select("artist_id", "artist_term", C.weight_times_freq("weight", "freq").alias("wf"))


@query("reorder_drop", rounded("SELECT * FROM q2", WIDE_DOUBLES))
def _p18(spark, d):
    """Wide table with the artist key, re-ordered into the contract (key dropped)."""
    return C.reorder(P.wide_features_with_artist(roles(spark, d)), model.WIDE_COLUMNS)


@query("row_to_text", """
    SELECT p_partkey, concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand,
                                CAST(p_size AS VARCHAR), p_type) AS line FROM part""")
def _p19(spark, d):
    """Part rows as comma-joined text."""
    p = tbl(spark, d, "part")
    return p.select("p_partkey", C.row_to_text(["p_partkey", "p_name", "p_brand", "p_size",
                                                "p_type"]).alias("line"))


@query("truncate_to_int", """
    SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice / 7) AS INTEGER) AS price_int,
           CAST(trunc(greatest(least(l_extendedprice * 1e5 * (l_linenumber - 3), 2147483647.0),
                               -2147483648.0)) AS INTEGER) AS clamped_int,
           CAST(trunc((l_discount - 0.05) * 1000 / 7) AS INTEGER) AS signed_int,
           abs(CAST(trunc(l_extendedprice / 7) AS INTEGER)
               - CAST(trunc(l_quantity * 1500 / 7) AS INTEGER)) AS abs_diff
    FROM lineitem""")
def _p20(spark, d):
    """P20: truncation toward zero of positive and negative values, and |a - b|."""
    li = tbl(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        C.truncate_to_int(F.col("l_extendedprice") / 7).alias("price_int"),
        C.truncate_to_int(F.col("l_extendedprice") * 1e5 * (F.col("l_linenumber") - 3)).alias("clamped_int"),
        C.truncate_to_int((F.col("l_discount") - 0.05) * 1000 / 7).alias("signed_int"),
        C.abs_int_difference(F.col("l_extendedprice") / 7,
                             F.col("l_quantity") * 1500 / 7).alias("abs_diff"))


@query("constant_column", rounded("""
    SELECT artist_name, title, 3.0 AS td_confidence, avg(artist_hotness) AS artist_hotness
    FROM q1 GROUP BY artist_name, title HAVING count(*) > 1""", ["td_confidence", "artist_hotness"]))
def _p21(spark, d):
    """Averaged feature rows carry the constant confidence 3."""
    q1 = P.serving_features(roles(spark, d))
    g = q1.groupBy("artist_name", "title").agg(F.count(F.lit(1)).alias("n"),
                                               C.mean_of("artist_hotness").alias("artist_hotness"))
    return g.where(F.col("n") > 1).select("artist_name", "title",
                                          C.constant_column().alias("td_confidence"),
                                          "artist_hotness")


@query("string_to_double", rounded("""
    SELECT l_returnflag, avg(TRY_CAST(price_text AS DOUBLE)) AS mean_price
    FROM li_text GROUP BY l_returnflag""", ["mean_price"]))
def _p22(spark, d):
    """Mean of a text column via an explicit non-raising cast."""
    t = lineitem_text(spark, d)
    return t.groupBy("l_returnflag").agg(C.mean_of(C.string_to_double("price_text")).alias("mean_price"))


# =============================== joins =================================================

@query("left_join_play_count", """
    SELECT s.song_id, coalesce(p.play_count, 0) AS play_count
    FROM songs_a s LEFT JOIN play_count p ON s.song_id = p.play_song_id AND s.track_id = p.play_track_id""")
def _j1(spark, d):
    """Serving songs left join play counts on (song_id, track_id); missing -> 0."""
    r = roles(spark, d)
    s = enrich.left_join_play_count(enrich.clean_song_info_serving(r.song_info), r.play_count)
    return s.select("song_id", "play_count")


@query("left_join_similar_count", """
    SELECT s.song_id, s.artist_id, coalesce(c.similar_artist_count, 0) AS similar_artist_count
    FROM songs_a s LEFT JOIN sim_count c ON s.artist_id = c.artist_id""")
def _j2(spark, d):
    """Songs left join per-artist similar-artist counts; missing -> 0."""
    r = roles(spark, d)
    s = enrich.left_join_similar_count(enrich.clean_song_info_serving(r.song_info),
                                       enrich.similar_artist_count(r.similar_artists))
    return s.select("song_id", "artist_id", "similar_artist_count")


@query("inner_join_genre_match", "SELECT song_id, genre_match_count FROM serving_songs")
def _j3(spark, d):
    """Serving songs inner join the per-artist genre match (artists without terms dropped)."""
    return P.serving_songs(roles(spark, d)).select("song_id", "genre_match_count")


@query("left_join_downloads", rounded("""
    SELECT s.song_id, coalesce(d.td_confidence, 0) AS td_confidence,
           coalesce(d.td_meanPrice, 0.0) AS td_meanPrice,
           d.td_artist IS NOT NULL AS has_download_record
    FROM serving_songs s LEFT JOIN dl_a d ON s.title = d.td_title AND s.artist_name = d.td_artist""",
    ["td_meanPrice"]))
def _j4(spark, d):
    """Serving songs left join download records on cleaned (title, artist), fan-out kept."""
    r = roles(spark, d)
    rec = enrich.clean_downloads(r.downloads, require_numeric_price=True)
    out = enrich.left_join_downloads(P.serving_songs(r), rec)
    return out.select("song_id", "td_confidence", "td_meanPrice", "has_download_record")


@query("inner_join_downloads_sorted", rounded(
    "SELECT artist_key AS td_artist, td_title, song_id, td_downloads FROM q2w", ["td_downloads"]))
def _j5(spark, d):
    """Download records inner join wide songs, globally sorted by artist."""
    r = roles(spark, d)
    rec = enrich.clean_downloads(r.downloads, require_numeric_price=False)
    j = enrich.sort_by_artist(enrich.inner_join_downloads(P.wide_songs(r), rec))
    return j.select("td_artist", "td_title", "song_id", "td_downloads")


@query("inner_join_song_count", """
    SELECT s.song_id, s.artist_id, c.song_count FROM songs_b s JOIN song_count_b c
    ON s.artist_id = c.artist_id""")
def _j6(spark, d):
    """Songs inner join their own per-artist song count."""
    s = enrich.clean_song_info_wide(roles(spark, d).song_info)
    return enrich.inner_join_song_count(s).select("song_id", "artist_id", "song_count")


@query("left_join_weight_freq", rounded("""
    SELECT s.song_id, coalesce(w.weight_dot_freq, 0.0) AS weight_dot_freq
    FROM songs_b s LEFT JOIN wf_b w ON s.artist_id = w.artist_id""", ["weight_dot_freq"]))
def _j7(spark, d):
    """Songs left join per-artist weight*freq sums; missing -> 0."""
    r = roles(spark, d)
    s = enrich.left_join_weight_freq(enrich.clean_song_info_wide(r.song_info),
                                     enrich.artist_weight_freq(r.term_scores))
    return s.select("song_id", "weight_dot_freq")


@query("left_join_likes", """
    SELECT s.song_id, coalesce(lk.likes, 0) AS likes FROM songs_b s
    LEFT JOIN likes lk ON s.track_id = lk.track""")
def _j8(spark, d):
    """Songs left join likes on track id; missing -> 0."""
    r = roles(spark, d)
    s = enrich.left_join_likes(enrich.clean_song_info_wide(r.song_info), r.likes)
    return s.select("song_id", "likes")


@query("inner_join_term_hotness", rounded("""
    SELECT t.artist_term, t.artist_id, count(*) AS songs, sum(s.artist_hotness) AS hotness_sum,
           count(s.artist_hotness) AS hotness_n
    FROM artist_terms t JOIN songs_a s ON t.artist_id = s.artist_id
    GROUP BY t.artist_term, t.artist_id""", ["hotness_sum"]))
def _j9(spark, d):
    """Term rows inner join per-artist song totals (one row per term and artist)."""
    r = roles(spark, d)
    songs = enrich.clean_song_info_serving(r.song_info)
    return terms.inner_join_term_hotness(r.artist_terms, songs, "artist_hotness").select(
        "artist_term", "artist_id", "songs", F.col("hotness_sum").cast("double").alias("hotness_sum"),
        "hotness_n")


LOOKUP_SQL = f"""
    WITH ex AS (SELECT artist_name, title, count(*) AS n,
                       CASE WHEN count(*) = 1 THEN CAST(max(td_confidence) AS DOUBLE) ELSE 3.0 END AS c,
                       avg(artist_hotness) AS ah, avg(song_hotness) AS sh, avg(td_meanPrice) AS mp
                FROM q1 GROUP BY artist_name, title),
         ar AS (SELECT artist_name, count(*) AS n,
                       CASE WHEN count(*) = 1 THEN CAST(max(td_confidence) AS DOUBLE) ELSE 3.0 END AS c,
                       avg(artist_hotness) AS ah, avg(song_hotness) AS sh, avg(td_meanPrice) AS mp
                FROM q1 GROUP BY artist_name),
         ti AS (SELECT title, count(*) AS n,
                       CASE WHEN count(*) = 1 THEN CAST(max(td_confidence) AS DOUBLE) ELSE 3.0 END AS c,
                       avg(artist_hotness) AS ah, avg(song_hotness) AS sh, avg(td_meanPrice) AS mp
                FROM q1 GROUP BY title),
         gm AS (SELECT 3.0 AS c, avg(artist_hotness) AS ah, avg(song_hotness) AS sh,
                       avg(td_meanPrice) AS mp FROM q1),
         rq AS (SELECT request_id, artist, title, {clean('artist')} AS ka, {clean('title')} AS kt
                FROM requests),
         j AS (SELECT rq.request_id, rq.artist, rq.title,
                      CASE WHEN ex.n IS NOT NULL THEN 'exact' WHEN ar.n IS NOT NULL THEN 'artist'
                           WHEN ti.n IS NOT NULL THEN 'title' ELSE 'global' END AS match_level,
                      ex.c AS ec, ex.ah AS eah, ex.sh AS esh, ex.mp AS emp,
                      ar.c AS ac, ar.ah AS aah, ar.sh AS ash, ar.mp AS amp,
                      ti.c AS tc, ti.ah AS tah, ti.sh AS tsh, ti.mp AS tmp,
                      gm.c AS gc, gm.ah AS gah, gm.sh AS gsh, gm.mp AS gmp
               FROM rq LEFT JOIN ex ON rq.ka = ex.artist_name AND rq.kt = ex.title
                       LEFT JOIN ar ON rq.ka = ar.artist_name
                       LEFT JOIN ti ON rq.kt = ti.title
                       CROSS JOIN gm)
    SELECT request_id, artist, title, match_level,
           {', '.join(f"CASE match_level WHEN 'exact' THEN e{x} WHEN 'artist' THEN a{x} WHEN 'title' THEN t{x} ELSE g{x} END AS {name}"
                      for x, name in [('c', 'td_confidence'), ('ah', 'artist_hotness'),
                                      ('sh', 'song_hotness'), ('mp', 'td_meanPrice')])}
    FROM j"""


@query("lookup_cascade", rounded(LOOKUP_SQL, ["td_confidence", "artist_hotness", "song_hotness",
                                              "td_meanPrice"]))
def _j10(spark, d):
    """Every request resolved by the exact/artist/title/global cascade."""
    r = roles(spark, d)
    features = materialize(P.serving_features(r), "features")
    return lookup.lookup_cascade(r.requests, features)


@query("stream_lookup", rounded(f"SELECT * FROM ({LOOKUP_SQL}) AS looked", [
    "td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]))
def _j10s(spark, d):
    """J10 as a stream-static join: the requests arrive in two lots of files, each in two triggers
    or more, the second after a restart from the checkpoint."""
    r = roles(spark, d)
    levels = lookup.bucketed_levels(materialize(P.serving_features(r), "features"))
    return scoring.replay(r.requests, lambda stream: scoring.stream_lookup(stream, levels), scratch_path(spark, "stream"))[0]


@query("set_intersection_size", "SELECT artist_id, genre_match_count FROM genre_b")
def _j11(spark, d):
    """Per artist, distinct terms in the top 1000 of the wide flow (0 kept)."""
    r = roles(spark, d)
    raw = r.song_info.select("artist_id", C.to_double("artist_hotttnesss").alias("h"))
    return terms.genre_match_from_songs(r.artist_terms, raw, "h")


# =============================== aggregations ==========================================

@query("similar_artist_count", "SELECT * FROM sim_count")
def _a1(spark, d):
    """A1: similar artists counted per artist."""
    return enrich.similar_artist_count(B.similar_artists(spark, d))


@query("artist_song_count", "SELECT * FROM song_count_b")
def _a2(spark, d):
    """A2: songs counted per artist."""
    return enrich.artist_song_count(enrich.clean_song_info_wide(B.song_info(spark, d)))


@query("term_mean_hotness", rounded("""
    SELECT a.artist_term, a.artist_hotness AS hotness_zero, b.artist_hotness AS hotness_null
    FROM term_hot_a a JOIN term_hot_b b ON a.artist_term = b.artist_term""",
    ["hotness_zero", "hotness_null"]))
def _a3(spark, d):
    """A3: per-term mean hotness, with 'NA' as 0 (serving flow) and skipped (wide flow), both in
    one aggregate over the term rows."""
    r = roles(spark, d)
    songs = r.song_info.select("artist_id", C.non_numeric_to_zero("artist_hotttnesss").alias("hotness_zero"),
                               C.to_double("artist_hotttnesss").alias("hotness_null"))
    measures = ["hotness_zero", "hotness_null"]
    totals = materialize(terms.hotness_totals(songs, measures), "artist-hotness")
    return terms.term_hotness(terms.term_pairs(r.artist_terms), totals, measures)


@query("artist_weight_freq", rounded("SELECT * FROM wf_b", ["weight_dot_freq"]))
def _a4(spark, d):
    """A4: sum of weight * freq per artist over numeric rows."""
    return enrich.artist_weight_freq(B.term_scores(spark, d))


@query("artist_genre_match", "SELECT * FROM genre_a")
def _a5(spark, d):
    """A5: per artist, distinct terms among the top 1000 terms (0 kept)."""
    r = roles(spark, d)
    return terms.genre_match_from_songs(r.artist_terms, enrich.clean_song_info_serving(r.song_info),
                                        "artist_hotness")


@query("global_means", rounded(MEANS_SQL, MEANS_DOUBLES))
def _a6(spark, d):
    """One-row means of the serving features, confidence constant 3."""
    return lookup.global_means(P.serving_features(roles(spark, d)))


@query("stage_row_counts", """
    SELECT 0 AS stage_no, 'songs' AS stage, count(*) AS rows FROM songs_a UNION ALL
    SELECT 1, 'with_genre', count(*) FROM serving_songs UNION ALL
    SELECT 2, 'download_records', count(*) FROM dl_a UNION ALL
    SELECT 3, 'serving_features', count(*) FROM q1""")
def _a7(spark, d):
    """Row counts after each stage of the serving flow, observed while it is written once."""
    seen: dict = {}
    materialize(P.serving_features(roles(spark, d), observe=seen), "counted-features")
    counts = audit.observed_counts(seen)
    return audit.counts_table(spark, {stage: counts[stage] for stage in (
        "songs", "with_genre", "download_records", "serving_features")})


@query("group_mean_or_single", rounded("""
    SELECT artist_name, count(*) AS n_matches,
           CASE WHEN count(*) = 1 THEN CAST(max(td_confidence) AS DOUBLE) ELSE 3.0 END AS td_confidence,
           avg(artist_hotness) AS artist_hotness, avg(song_hotness) AS song_hotness,
           avg(td_meanPrice) AS td_meanPrice
    FROM q1 GROUP BY artist_name""", ["td_confidence", "artist_hotness", "song_hotness", "td_meanPrice"]))
def _a8(spark, d):
    """Per artist, the single row as is or the means with confidence 3."""
    return lookup.group_mean_or_single(P.serving_features(roles(spark, d)), ["artist_name"])


def _mm_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, "
             f"CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) AS median FROM explore_v"
             for c in EXPLORE_COLS]
    return " UNION ALL ".join(parts)


@query("mean_median", rounded(_mm_sql(), ["mean", "median"]))
def _a9(spark, d):
    """Mean and exact median of each feature of the exploration view."""
    return explore.mean_median(P.explore_view(P.wide_features(roles(spark, d))), EXPLORE_COLS)


def _corr_sql(src: str) -> str:
    parts = [f"SELECT '{c}' AS feature, covar_pop(CAST({c} AS DOUBLE), td_downloads) / "
             f"nullif(stddev_pop(CAST({c} AS DOUBLE)) * stddev_pop(td_downloads), 0) AS r FROM {src}"
             for c in EXPLORE_COLS]
    return " UNION ALL ".join(parts)


@query("correlation_with_label", rounded(_corr_sql("explore_v"), ["r"]))
def _a10(spark, d):
    """A10: Pearson r of each feature against downloads (null for constant columns)."""
    v = P.explore_view(P.wide_features(roles(spark, d)))
    return explore.correlation_with_label(v, EXPLORE_COLS, model.LABEL)


@query("regression_metrics", rounded(_metrics_sql(False), METRIC_DOUBLES), digits=METRIC_DOUBLES)
def _a11(spark, d):
    """Metrics of a fixed prediction over all of lineitem."""
    return model.regression_metrics(lineitem_predictions(spark, d))


@query("mean_squared_error", rounded("""
    SELECT split, avg(pow(label - prediction, 2)) AS mse FROM li_pred GROUP BY split""", {"mse": 2}),
    digits={"mse": 2})
def _a12(spark, d):
    """Mean squared error per split, computed directly."""
    return model.mean_squared_error(lineitem_predictions(spark, d), by=["split"])


# =============================== sorts / top-k =========================================

@query("top_terms", rounded("SELECT * FROM top_a", ["artist_hotness"]))
def _t1(spark, d):
    """The 1000 terms of highest mean hotness."""
    r = roles(spark, d)
    th = terms.term_mean_hotness(r.artist_terms, enrich.clean_song_info_serving(r.song_info),
                                 "artist_hotness")
    return terms.top_terms(th)


@query("global_sort_by_artist", rounded("SELECT * FROM q2", WIDE_DOUBLES))
def _t2(spark, d):
    """The wide table globally sorted by artist."""
    return P.wide_features(roles(spark, d), sort=True)


@query("first_row", rounded("""
    SELECT * FROM q1 ORDER BY td_meanPrice DESC, artist_name, title, td_confidence,
                             artist_hotness, song_hotness LIMIT 1""", SERVING_DOUBLES))
def _t3(spark, d):
    """The first serving row by price (full ordering, so the row is unique)."""
    q1 = P.serving_features(roles(spark, d))
    return q1.orderBy(F.col("td_meanPrice").desc(), "artist_name", "title", "td_confidence",
                      "artist_hotness", "song_hotness").limit(1)


# =============================== machine learning ======================================

def _scoring_wide(spark, d):
    return P.wide_features_with_artist(roles(spark, d))


@query("assemble_features", rounded("""
    SELECT CAST(td_downloads AS DOUBLE) AS label,
           CASE WHEN td_confidence >= 0 AND td_confidence < 6 THEN CAST(td_confidence AS DOUBLE)
                ELSE 6.0 END AS f0,
           artist_hotttnesss AS f1, song_hotttnesss AS f2, td_meanPrice AS f3
    FROM q2""", ["label", "f0", "f1", "f2", "f3"]))
def _m1(spark, d):
    """M1: label + feature vector of the shipped feature choice (positions 0, 1, 6, 13),
    the vector read back as its components f0..f3."""
    from pyspark.ml.functions import vector_to_array
    cols = model.feature_names(model.DEFAULT_FEATURE_INDEXES)
    a = model.assemble_features(model.prepare(P.wide_features(roles(spark, d)), cols), cols)
    arr = vector_to_array("features")
    return a.select("label", *[arr[i].alias(f"f{i}") for i in range(len(cols))])


@query("mark_categorical", """
    SELECT CASE WHEN td_confidence >= 0 AND td_confidence < 6 THEN CAST(td_confidence AS DOUBLE)
                ELSE 6.0 END AS td_confidence, td_downloads FROM q2""")
def _m2(spark, d):
    """M2: confidence as a nominal feature (codes 0..5, 6 for unknown)."""
    w = P.wide_features(roles(spark, d))
    return model.mark_categorical(w).select("td_confidence", "td_downloads")


# A tree without bootstrap, deep enough to tell all cells of two coarse features apart, predicts
# the mean label of the training rows of each cell, which SQL can state.
CELL_FEATURES = ["line_number", "l_discount"]
CELL_SQL = f"""
    WITH rows_ AS (SELECT l_orderkey, l_linenumber, l_discount, l_extendedprice AS label,
                          CASE WHEN {split_bucket('l_suppkey')} < 30 THEN 'test' ELSE 'train' END AS split
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
         cells AS (SELECT l_linenumber AS line, l_discount AS discount, avg(label) AS prediction, count(*) AS n
                   FROM rows_ WHERE split = 'train' GROUP BY 1, 2)"""


def _cell_tree(spark, d):
    data = model.artist_disjoint_split(_orders_training(spark, d), "l_suppkey").withColumn(
        "line_number", F.col("l_linenumber").cast("double"))
    train = materialize(data.where(F.col("split") == "train"), "cell-training")
    return data, train, model.train_forest(train, CELL_FEATURES, num_trees=1, max_depth=30, bootstrap=False)


@query("train_forest", rounded(f"""
    {CELL_SQL} SELECT prediction, CAST(sum(n) AS BIGINT) AS n, prediction AS mean_label FROM cells GROUP BY prediction""",
    {"prediction": 3, "mean_label": 3}), digits={"prediction": 3, "mean_label": 3})
def _m3(spark, d):
    """M3: an unbootstrapped tree on the training split: by predicted value, the training rows
    that get it and their mean label, which is that value."""
    _, train, fitted = _cell_tree(spark, d)
    return model.predict_batch(fitted, train).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean_label"))


@query("predict_batch", rounded(f"""
    {CELL_SQL} SELECT l_orderkey, l_linenumber, split, CASE WHEN l_linenumber <> 7 THEN prediction END AS prediction,
                      CASE WHEN l_linenumber <> 7 THEN CAST(CAST(trunc(prediction) AS INTEGER) AS VARCHAR) END AS printed,
                      CASE WHEN l_linenumber = 7 THEN 'missing feature' END AS reject_reason
               FROM rows_ LEFT JOIN cells ON l_linenumber = line AND l_discount = discount""",
    {"prediction": 3}), digits={"prediction": 3})
def _m4(spark, d):
    """M4: the tree of M3 applied to every row of both splits, with the score and the integer that
    is printed.  Every row comes back; those of line 7 lost a feature and have no score."""
    data, _, fitted = _cell_tree(spark, d)
    holed = data.withColumn("l_discount", F.when(F.col("l_linenumber") != 7, F.col("l_discount")))
    return model.predict_batch(fitted, holed).select(
        "l_orderkey", "l_linenumber", "split", "prediction", F.col("prediction_int").cast("string").alias("printed"),
        "reject_reason")


@query("evaluate_splits", rounded(_metrics_sql(True), METRIC_DOUBLES), digits=METRIC_DOUBLES)
def _m5(spark, d):
    """M5: regression metrics per split of a fixed prediction."""
    return model.evaluate_splits(lineitem_predictions(spark, d))


@query("artist_disjoint_split", f"""
    SELECT l_orderkey, l_linenumber, l_suppkey,
           CASE WHEN {split_bucket('l_suppkey')} < 30 THEN 'test' ELSE 'train' END AS split
    FROM lineitem""")
def _m6(spark, d):
    """M6: supplier-disjoint split of lineitem."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return model.artist_disjoint_split(li, "l_suppkey", 30)


KMEANS_SQL = f"""
    WITH v AS (SELECT event_id, value, CAST(value AS DECIMAL(38, 10)) AS e FROM events WHERE value IS NOT NULL),
         h AS (SELECT value AS x, sum(e) AS s, count(*) AS n FROM v GROUP BY value),
         ranked AS (SELECT value AS x, row_number() OVER (ORDER BY value) - 1 AS p, count(*) OVER () AS n,
                           min(value) OVER () AS lo, max(value) OVER () AS hi FROM v),
         c0 AS (SELECT list((x + (lo + (hi - lo) * (2 * i + 1) / {2 * explore.KMEANS_K})) / 2 ORDER BY i) AS c
                FROM range({explore.KMEANS_K}) AS shares(i) JOIN ranked ON p = (2 * i + 1) * n // {2 * explore.KMEANS_K}),
         {', '.join(f"""
         c{r} AS (SELECT [{', '.join(f'coalesce(CAST(sum(s) FILTER (WHERE k = {i}) AS DOUBLE) / sum(n) FILTER (WHERE k = {i}), any_value(c)[{i + 1}])'
                                     for i in range(explore.KMEANS_K))}] AS c
                  FROM (SELECT s, n, c, {' + '.join(f'CAST(x > (c[{i}] + c[{i + 1}]) / 2 AS INTEGER)' for i in range(1, explore.KMEANS_K))} AS k
                        FROM h, c{r - 1}))""" for r in range(1, explore.KMEANS_ROUNDS + 1))},
         labelled AS (SELECT event_id, value, CASE WHEN value IS NOT NULL THEN
                             {' + '.join(f'CAST(value > (c[{i}] + c[{i + 1}]) / 2 AS INTEGER)' for i in range(1, explore.KMEANS_K))} END AS cluster
                      FROM events, c{explore.KMEANS_ROUNDS})"""


@query("kmeans_label", rounded(f"{KMEANS_SQL} SELECT event_id, value, cluster FROM labelled", ["value"]))
def _m7(spark, d):
    """M7: k-means (k = 8) of all event values: the cluster of each, counted by their centres."""
    events = tbl(spark, d, "events").select("event_id", "value")
    return explore.kmeans_1d(events, "value")[0]


@query("kmeans_centers", rounded(f"""
    {KMEANS_SQL} SELECT CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS cluster, unnest(c) AS center
    FROM c{explore.KMEANS_ROUNDS}""", ["center"]))
def _m7c(spark, d):
    """M7 as the exploration script prints it: the centres of the clusters."""
    _, centers = explore.kmeans_1d(tbl(spark, d, "events").select("value"), "value")
    return spark.createDataFrame(list(enumerate(centers)), "cluster int, center double")


def _scatter_sql() -> str:
    stacked = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CAST(td_downloads AS DOUBLE) AS y "
        f"FROM explore_v" for c in EXPLORE_COLS)
    return f"""
        WITH st AS (SELECT * FROM ({stacked}) WHERE x IS NOT NULL AND y IS NOT NULL),
             ed AS (SELECT feature, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min,
                           max(y) AS y_max FROM st GROUP BY feature),
             b AS (SELECT st.feature,
                    CAST(coalesce(least(floor((x - x_min) / nullif((x_max - x_min) / 20, 0)), 19), 0) AS INTEGER) AS x_bin,
                    CAST(coalesce(least(floor((y - y_min) / nullif((y_max - y_min) / 20, 0)), 19), 0) AS INTEGER) AS y_bin
                   FROM st JOIN ed ON st.feature = ed.feature)
        SELECT feature, x_bin, y_bin, count(*) AS n,
               count(*) / sum(count(*)) OVER (PARTITION BY feature) AS frac
        FROM b GROUP BY feature, x_bin, y_bin"""


@query("binned_scatter", rounded(_scatter_sql(), ["frac"]))
def _m8(spark, d):
    """M8: 20 x 20 histogram of each feature against downloads."""
    v = P.explore_view(P.wide_features(roles(spark, d)))
    return explore.binned_scatter(v, EXPLORE_COLS, model.LABEL, bins=20)


# =============================== composite flows =======================================

@query("serving_features", rounded("SELECT * FROM q1", SERVING_DOUBLES))
def _q1(spark, d):
    """Q1: serving feature table."""
    return P.serving_features(roles(spark, d))


@query("wide_features", rounded("SELECT * FROM q2", WIDE_DOUBLES))
def _q2(spark, d):
    """Q2: 17-column wide feature table."""
    return P.wide_features(roles(spark, d))


@query("train_and_evaluate", f"""
    SELECT CASE WHEN {split_bucket('artist_key')} < 30 THEN 'test' ELSE 'train' END AS split,
           count(*) AS n, 0::BIGINT AS left_out, true AS metrics_agree, true AS better_than_mean
    FROM q2w GROUP BY 1""")
def _q3(spark, d):
    """Q3: artist-disjoint split, forest, per-split metrics: rows per split, whether the
    metrics agree with those recomputed from the stored predictions, and whether the forest
    beats the mean on the rows it has learned from."""
    _, preds, metrics = P.train_and_evaluate(_scoring_wide(spark, d), num_trees=30, max_depth=8)
    e = F.col("label") - F.col("prediction")
    again = preds.groupBy("split").agg(F.avg(e * e).alias("mse2"), F.avg(F.abs(e)).alias("mae2"),
                                       F.var_pop("label").alias("spread"))

    def close(a: str, b: str) -> F.Column:
        return F.abs(F.col(a) - F.col(b)) <= 1e-9 * F.greatest(F.abs(F.col(a)), F.lit(1.0))

    agree = (close("mse", "mse2") & close("mse_direct", "mse2") & close("mae", "mae2")
             & (F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) <= 1e-6 * (1 + F.col("mse"))))
    return metrics.join(again, "split").select(
        "split", "n", "left_out", agree.alias("metrics_agree"),
        ((F.col("split") == "test") | (F.col("mse") <= F.col("spread"))).alias("better_than_mean"))


@query("score_requests", f"""
    SELECT request_id, match_level, true AS score_present FROM ({LOOKUP_SQL}) AS looked""")
def _q4(spark, d):
    """Q4: every request scored by a forest trained on the wide table."""
    scored = _scored_requests(spark, d)
    present = F.col("prediction").isNotNull() & F.col("prediction_int").isNotNull()
    return scored.select("request_id", "match_level", present.alias("score_present"))


def _scored_requests(spark, d):
    r = P.with_shared(roles(spark, d))
    wide = materialize(P.scoring_training_view(P.wide_features(r)), "q4-train")
    fitted = model.train_forest(model.prepare(wide, lookup.FEATURES), lookup.FEATURES, num_trees=30, max_depth=8)
    features = materialize(P.serving_features(r), "features")
    return P.score_requests(r.requests, features, fitted)


@query("request_scores")
def _q4v(spark, d):
    """Q4 with its numbers: the forest's score of every request and the integer that the flow
    prints.  SQL cannot grow the forest; the tests walk its stored trees."""
    return _scored_requests(spark, d).select("request_id", "match_level", *lookup.FEATURES, "prediction", "prediction_int",
                                             "reject_reason")


@query("explore_features", rounded(f"""
    WITH mm AS ({_mm_sql()}), rr AS ({_corr_sql('explore_v')})
    SELECT mm.feature, mean, median, r FROM mm JOIN rr ON mm.feature = rr.feature""",
    ["mean", "median", "r"]))
def _q5(spark, d):
    """Q5: mean, median and correlation per feature of the exploration view."""
    return P.explore_features(P.wide_features(roles(spark, d)))
