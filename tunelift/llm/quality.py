"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is counted in hashed byte trigrams and hashed runs of character classes.  Counts
become square roots of shares, weighted by the inverse document frequency over all
documents, and are projected on the leading singular directions of a bounded sample of
labelled rows.  The labelled vectors (at most ``per_class`` a label, so of bounded size)
are broadcast; every document is compared with all of them, block by block, by exact
cosine products, and the labels of its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelift.llm.common import id_remainder, read_table
from tunelift.session import materialize

BUCKETS = 1024             # of each of the two families of features
DIMENSIONS = 64            # of the latent space
STRATA = 32                # hash strata from which the sample of a label is drawn
PER_CLASS = 2048           # labelled rows sampled for each label, in all strata
NEIGHBOURS = 15
SHARPNESS = 4.0            # a neighbour votes with similarity ** SHARPNESS
THRESHOLD = 0.3
BLOCK_DOCS = 1024


def _classes() -> np.ndarray:
    """Class of each byte: vowels, other lower case, upper case, digits, bytes of other
    letters, white space, line end; every other byte is a class of its own."""
    of = np.arange(256) + 8
    of[[ord(c) for c in "aeiouy"]] = 0
    of[[ord(c) for c in "bcdfghjklmnpqrstvwxz"]] = 1
    of[65:91], of[48:58], of[128:256] = 2, 3, 4
    of[[32, 9, 11, 12, 13]], of[10] = 5, 6
    return of.astype(np.uint32)


CLASS_OF = _classes()


def _buckets(x: np.ndarray, width: int) -> np.ndarray:
    n = max(0, len(x) - width + 1)
    h = np.zeros(n, dtype=np.uint32)
    for i in range(width):
        h = (h + x[i:i + n]) * np.uint32(0x9E3779B1) if n else h
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(22)  # 10 bits: BUCKETS


def features(text: str | None) -> np.ndarray:
    """Counts of a text, 2 x BUCKETS; a null, empty or very short text has none."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    a = np.bincount(_buckets(raw.astype(np.uint32), 3), minlength=BUCKETS)
    b = np.bincount(_buckets(CLASS_OF[raw], 5), minlength=BUCKETS)
    return np.r_[a, b]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = np.sqrt(counts / total).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """idf, projection, labelled vectors and their labels; about 1.6 MB at the defaults."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each bucket over all documents; a task sends one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(2 * BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen += features(text.as_py()) > 0
                n += 1
        yield pa.record_batch([pa.array(np.arange(2 * BUCKETS + 1), pa.int32()),
                               pa.array(np.r_[seen, n], pa.int64())], names=["bucket", "n"])

    rows = (docs.select("text").mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # 2 x BUCKETS + 1 rows
    n = np.zeros(2 * BUCKETS + 1)
    for r in rows:
        n[r["bucket"]] = r["n"]
    return (np.log((n[-1] + 1) / (n[:-1] + 1)) + 0.1).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
        dimensions: int = DIMENSIONS, seed: int = 5) -> Model:
    """Learn from ``labels`` (doc_id, quality 0/1; other values and nulls teach nothing).

    The sample is bounded: of each of STRATA hash strata of a label the rows with the
    smallest hash of doc_id, at most ``per_class`` of either label in all.  Statistics (idf) are over all documents."""
    idf = inverse_frequencies(docs)
    rank = F.row_number().over(W.partitionBy("quality", F.pmod("at", F.lit(STRATA))).orderBy("at", "doc_id"))
    usable = (labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
              .join(docs.select("doc_id"), "doc_id", "left_semi"))
    chosen = materialize(usable.withColumn("at", F.xxhash64("doc_id")).withColumn("rank", rank)
                         .where(F.col("rank") <= max(1, per_class // STRATA)).select("doc_id", "quality").distinct(),
                         "quality-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [weighted(features(t.as_py())[None], idf)[0].astype("<f2").tobytes() for t in batch["text"]]
            yield pa.record_batch([batch["doc_id"], batch["quality"], pa.array(x, pa.binary())],
                                  names=["doc_id", "quality", "x"])

    # at most 2 x per_class rows (ids that occur once) of 4 KB
    rows = (docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "quality", "text")
            .mapInArrow(run, "doc_id long, quality int, x binary").dropDuplicates(["doc_id", "quality"]).collect())
    rows.sort(key=lambda r: (r["doc_id"], r["quality"]))
    x = np.array([np.frombuffer(r["x"], dtype="<f2") for r in rows], dtype=np.float32).reshape(-1, 2 * BUCKETS)
    y = np.array([r["quality"] for r in rows], dtype=np.float32)
    # randomised range finder with power iterations
    k = max(1, min(dimensions, len(x)))
    q = np.random.default_rng(seed).standard_normal((2 * BUCKETS, k + 8)).astype(np.float32)
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0].astype(np.float32) if len(x) else q
    basis = np.linalg.svd(x @ q, full_matrices=False)[2][:k] @ q.T if len(x) else q.T[:k]
    return Model(idf, basis.T.astype(np.float32).copy(), _unit(x @ basis.T).astype(np.float32), y,
                 float(y.mean()) if len(y) else 1.0)


def vote(x: np.ndarray, model: Model, neighbours: int = NEIGHBOURS,
         sharpness: float = SHARPNESS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors.  A vector of
    zeros, or one like none of them, gets the share of label 1 in the sample."""
    if not len(model.labels):
        return np.full(len(x), model.prior)
    cos = _unit(x @ model.basis) @ model.vectors.T
    k = min(neighbours, cos.shape[1])
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(cos, near, axis=1), 0) ** sharpness
    total = w.sum(axis=1)
    return np.where(total > 1e-9, (w * model.labels[near]).sum(axis=1) / np.maximum(total, 1e-9), model.prior)


def score(docs: DataFrame, model: Model, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Every row of ``docs`` with a column ``quality_score`` (0 to 1), all its columns kept
    (a column of that name is replaced).  Null and empty texts get the sample's share of
    label 1; repeated rows and null ids are scored like others."""
    cols = [c for c in docs.columns if c != "quality_score"]
    docs = docs.select(*[F.col(f"`{c}`") for c in cols])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                counts = np.array([features(t.as_py()) for t in part["text"]])
                s = np.clip(vote(weighted(counts, m.idf), m, neighbours), 0, 1)
                yield pa.record_batch([*part.columns, pa.array(s, pa.float64())],
                                      names=[*part.schema.names, "quality_score"])

    return docs.mapInArrow(run, schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """The rows that may teach: crc32 of doc_id, modulo 5, is not 0."""
    return labels.where(id_remainder("doc_id", 5) != 0)


def op9_knn_quality(spark, sf_dir):
    """Quality score of all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, training_labels(read_table(spark, sf_dir, "labels")))
    return score(docs, model).select(
        "doc_id", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
