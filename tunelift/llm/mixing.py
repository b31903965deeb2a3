"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the budget in proportion to its weight.  A source cannot
give more than ``max_epochs`` times its own size, so the sources with the smallest
cap-to-weight ratio are clamped and what they leave is shared again among the others by
weight, until no source is above its cap.  In ratio order that fixed point has a closed
form, which needs prefix sums over the table of sources (one row per source) and no loop.

The documents of a source are then repeated ``floor(target / source size)`` times as a
whole, and the fractional rest is taken from a seeded order: the documents of a source
are dealt by hash into blocks of about ``block_rows``, each block takes its documents
whole until its share of the rest is reached, and cuts the last one.  A block is a window
of bounded size, so a source that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunelift.llm.common import free_names, read_table, text_or_empty, word_count

BLOCK_ROWS = 1000


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3),
                   max_epochs: int = 3) -> DataFrame:
    """Targets of sources.  ``sizes``: (source, source_size long, source_rows long).

    Weights repeat over the sources in code point order, null last.  The budget is the sum
    of all sizes.  Returns source, source_size, source_rows, target double.  The window
    without partitions below ranks sources, never documents."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") - 1) % len(weights))
    s = (sizes.withColumn("rank", F.row_number().over(by_name))
         .withColumn("weight", weight.cast("long"))
         .withColumn("cap", F.lit(int(max_epochs)) * F.col("source_size"))
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("left_budget", F.sum("source_size").over(everything)
                     - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(everything)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", F.col("left_budget") / F.col("left_weight"))
         # the first source (by ratio) that stays under its cap fixes the water level
         .withColumn("water", F.min(F.when(F.col("level") <= F.col("ratio"),
                                           F.struct("ratio", "rank", "level")))
                     .over(everything)))
    full = F.struct("ratio", "rank") < F.struct("water.ratio", "water.rank")
    target = F.when(full, F.col("cap").cast("double")).otherwise(
        F.least(F.col("water.level") * F.col("weight"), F.col("cap").cast("double")))
    return s.select("source", "source_size", "source_rows", target.alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3,
             seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """How many words of each document the mix takes.

    Input columns doc_id, text, source (others are ignored, whatever their names).
    Returns one row per input row: doc_id, source, size, source_size, target,
    repeats (whole copies), extra (words of a last, cut copy), taken.

    Null or empty text has size 0 and takes 0 words; a source whose texts are all empty has
    target 0; a null source is a source of its own, ranked last; rows with a null or
    repeated doc_id are rows of their own (ties in the seeded order fall to the smaller
    size, and rows alike in id and size are interchangeable); an empty table gives an empty
    plan.  The order depends on seed and doc_id alone, so reruns agree."""
    rows = docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("source_rows"))
    targets = source_targets(sizes, weights, max_epochs).withColumnRenamed("source", "of_source")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                      F.lit("")).cast("string")))
    blocks = F.ceil(F.col("source_rows") / F.lit(block_rows)).cast("long")
    j = (rows.withColumn("key", key)
         .join(targets, F.col("source").eqNullSafe(F.col("of_source")), "inner")
         .withColumn("block", F.conv(F.substring("key", 1, 12), 16, 10).cast("long") % blocks))
    block = W.partitionBy("source", "block")
    order = block.orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    share = F.floor((F.col("epochs") - F.col("repeats")) * F.sum("size").over(block)).cast("long")
    taken_before = F.coalesce(F.sum("size").over(order), F.lit(0))
    return (j.withColumn("epochs", epochs)
            .withColumn("repeats", F.floor("epochs").cast("long"))
            .withColumn("extra", F.greatest(F.lit(0).cast("long"),
                                            F.least(F.col("size"), share - taken_before)))
            .withColumn("taken", F.col("repeats") * F.col("size") + F.col("extra"))
            .select("doc_id", "source", "size", "source_size", "target", "repeats", "extra", "taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3,
                    seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The mix itself, with the columns of ``docs`` (whatever their names): a row for each whole repetition, and
    one with the first ``extra`` words of the text for a cut one.

    A document of which no word is taken has no row; so a null or empty text goes, as it
    has no words.  Rows alike in doc_id and text share one decision.  Whole texts are mixed, very long
    ones like others; an empty table gives an empty mix."""
    id_, source_, size_, repeats_, extra_, rows_, words_ = free_names(
        docs.columns, "__id", "__source", "__size", "__repeats", "__extra", "__rows", "__words")
    plan = (mix_plan(docs, weights, max_epochs, seed, block_rows).where("taken > 0")
            .select(F.col("doc_id").alias(id_), F.col("source").alias(source_),
                    F.col("size").alias(size_), F.col("repeats").alias(repeats_),
                    F.col("extra").alias(extra_))
            # repeated rows of one id, source and size: one plan row each, numbered
            .groupBy(id_, source_, size_)
            .agg(F.max(repeats_).alias(repeats_), F.sum(extra_).alias(extra_),
                 F.count(F.lit(1)).alias(rows_)))
    sized = docs.withColumn(words_, word_count(text_or_empty()))
    j = sized.join(plan, F.col("doc_id").eqNullSafe(F.col(id_))
                   & F.col("source").eqNullSafe(F.col(source_))
                   & (F.col(words_) == F.col(size_)), "inner")
    # repeated rows share the cut part evenly
    part = F.floor(F.col(extra_) / F.col(rows_)).cast("int")
    words = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    words = F.filter(words, lambda w: F.length(w) > 0)
    lead = F.when(F.regexp_like(F.get(words, F.lit(0)), F.lit(r"^[\x20\x09-\x0D]")), 1).otherwise(0)
    cut = F.array_join(F.slice(words, F.lit(1), part + lead), "")
    copies = F.concat(F.array_repeat(F.col("text"), F.col(repeats_).cast("int")),
                      F.when(part >= F.col(size_), F.array("text"))
                      .when(part > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    kept = [c for c in docs.columns if c != "text"]
    out = j.select(*[F.col(f"`{c}`") for c in kept], F.explode(copies).alias("text"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_water_filling_mix(spark, sf_dir):
    """Mix of all documents, budget 100% of all words, at most 3 epochs a source."""
    plan = mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source",
                       "repeats", "extra")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_rows FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM s),
w AS (SELECT *, ((rank - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap FROM r),
q AS (SELECT *, cap::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *,
    ((SELECT sum(source_size) FROM q) - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / ((SELECT sum(weight) FROM q) - coalesce(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM q),
f AS (SELECT ratio AS r0, rank AS k0, level AS l0 FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
t AS (SELECT l.source, source_size, source_rows,
    CASE WHEN ratio < r0 OR (ratio = r0 AND rank < k0) THEN cap::DOUBLE
         ELSE least(l0 * weight, cap::DOUBLE) END AS target
  FROM l, f),
j AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS epochs,
    md5('7:' || coalesce(d.doc_id::VARCHAR, '')) AS key, t.source_rows
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, floor(epochs)::BIGINT AS repeats,
    ('0x' || substr(key, 1, 12))::BIGINT % ceil(source_rows / 1000.0)::BIGINT AS block FROM j),
x AS (SELECT *, greatest(0::BIGINT, least(size,
    floor((epochs - repeats) * sum(size) OVER (PARTITION BY source, block))::BIGINT
    - coalesce(sum(size) OVER (PARTITION BY source, block ORDER BY key, doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)) AS extra FROM b)
SELECT doc_id, size, source_size, target, (repeats * size + extra)::BIGINT AS taken, source, repeats,
  extra::BIGINT AS extra
FROM x
"""
