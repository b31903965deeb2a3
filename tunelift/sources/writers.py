"""Sinks: feature CSV, means, metrics, predictions, and model persistence.

Writes are distributed (one file per task) unless ``single_file`` asks for one file,
which funnels every row through one task and is only meant for small outputs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# The columns that a feature store is clustered and looked up by.
STORE_KEYS = ("artist_name", "title")


def _writer(df: DataFrame, single_file: bool):
    return (df.coalesce(1) if single_file else df).write.mode("overwrite")


def write_features_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                       single_file: bool = False) -> None:
    """K1: feature table as delimited text (no brackets, one line per row)."""
    _writer(df, single_file).option("header", str(header).lower()).option("sep", sep).csv(path)


def write_feature_store(features: DataFrame, path: str, files: int | None = None) -> None:
    """Features for look-ups by key: clustered by (artist, title), with bloom filters on both, and
    an index of the artists in each file (``readers.read_feature_store``).

    The rows are stored before they are ranged, as range sampling reads its input a second
    time.  The title is a range key too, so that an artist with very many rows fills several files
    instead of one task.  ``files`` defaults to the shuffle partitions."""
    spark = features.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = (materialize(features, "unclustered").repartitionByRange(files, *STORE_KEYS)
              .sortWithinPartitions(*STORE_KEYS).write.mode("overwrite"))
    for key in STORE_KEYS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(f"{path}/rows")
    (spark.read.parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min(STORE_KEYS[0]).alias("first"), F.max(STORE_KEYS[0]).alias("last"), F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(f"{path}/files"))


def write_means(means: DataFrame, path: str) -> None:
    """K2: the one-row means table with a header (one row: one file)."""
    _writer(means, True).option("header", "true").csv(path)


def write_metrics(metrics_long: DataFrame, path: str, header: bool = False) -> None:
    """K3: ``name;value`` style metrics (here split;metric;value)."""
    _writer(metrics_long, True).option("header", str(header).lower()).option("sep", ";").csv(path)


def write_predictions(table: DataFrame, path: str) -> None:
    """K4: (label, prediction, |difference|) as integers, partitioned by split."""
    table.write.mode("overwrite").partitionBy("split").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """K5: persist the fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """K5: load a persisted pipeline."""
    return PipelineModel.load(path)
