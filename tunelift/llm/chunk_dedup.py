"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so: after at least ``min_chars`` characters, at
the first word that ends in one of a set of letter triples, or after ``max_chars``.  Equal
texts are cut alike, and an edit moves only the cuts near it.  Every chunk gets a 64-bit
identifier.  The dictionary of chunks (each distinct chunk moved once, after a map-side
distinct) verifies the identifiers: those that stand for one content only are proven, and
the others are listed.  A document is then its ordered list of identifiers, about one
hundredth of its text, and only these lists are grouped.  Lists that hold an unproven
identifier are split once more by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelift.llm.common import read_table, text_or_empty
from tunelift.session import materialize

MIN_CHARS, MAX_CHARS = 256, 4096
# about one word end in fifty of Latin text; other text is cut at MAX_CHARS
BOUNDARY = r"[aeiouAEIOU][dlnrtDLNRT][aeghsyAEGHSY]\W"


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """Content-defined chunks; their concatenation is the text, an empty text has none."""
    pattern = f"(?s).{{{min_chars},{max_chars - 4}}}?{BOUNDARY}|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def dedup_exact(docs: DataFrame, chunk_id: Callable[[Column], Column] = lambda c: F.xxhash64(c),
                min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Groups of documents with identical texts; the row with the largest doc_id stays.

    Input columns doc_id, text (others are ignored).  Returns one row per input row:
    doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are one group.  Texts are compared as
    they are.  A null doc_id is smaller than any other: such a row stays only if its whole
    group has no id (keep_id is null then).  Rows that repeat the kept doc_id and its text
    cannot be told apart and are all marked kept.  An empty table gives an empty result.
    ``chunk_id`` may be any function of a chunk to a long; results are exact with a poor
    one too, since colliding identifiers are found and resolved by text."""
    pieces = chunks(text_or_empty(), min_chars, max_chars)
    recipes = materialize(docs.select(
        "doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256"),
        F.transform(pieces, chunk_id).alias("recipe")), "recipes")
    dictionary = (docs.select(F.explode(pieces).alias("chunk"))
                  .select(chunk_id(F.col("chunk")).alias("id"), "chunk").distinct())
    unproven = materialize(dictionary.groupBy("id").count().where("count > 1").select("id"),
                           "unproven")
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"),
                                           F.count(F.lit(1)).alias("group_size"))
    # stored: both sides of the join below are plain exchanges, so a hot list can be split
    groups = materialize(groups, "recipe-groups")
    if unproven.isEmpty():
        found = recipes.join(groups, "recipe")
    else:
        open_lists = materialize(
            groups.where("group_size > 1").select("recipe", F.explode("recipe").alias("id"))
            .join(unproven, "id", "left_semi").select("recipe").distinct(), "open-lists")
        texts = docs.select("doc_id", text_or_empty().alias("text"),
                            F.sha2(text_or_empty(), 256).alias("text_sha256"),
                            F.transform(pieces, chunk_id).alias("recipe"))
        again = materialize(texts.join(open_lists, "recipe", "left_semi"), "open-texts")
        by_text = materialize(again.groupBy("text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "text-groups")
        cols = ["doc_id", "keep_id", "group_size", "text_sha256"]
        found = (recipes.join(open_lists, "recipe", "left_anti").join(groups, "recipe").select(*cols)
                 .unionByName(again.join(by_text, "text").select(*cols)))
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op6_chunk_recipe_dedup(spark, sf_dir):
    """Exact dedup of all documents over their whole texts."""
    return dedup_exact(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
