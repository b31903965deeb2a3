"""Streaming request scoring: requests arriving as files are looked up against stored feature
aggregates and optionally scored.  There are two ways:

* ``stream_lookup`` / ``stream_scores`` with ``start_file_sink``: one streaming plan, a
  stream-static join with the stored levels and Spark's own file sink, whose log makes restarts
  exactly-once.  With bucketed levels a trigger shuffles its requests and nothing else.
* ``batch_lookup`` / ``batch_scores`` with ``start_sink``: each micro-batch goes through the
  batch lookup, with its balanced joins, and is written to a folder of its own, which a
  repeated batch overwrites.

Bad lines go to their own sink instead of ending the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import lookup, model
from ..session import intermediates
from ..sources.readers import parse_requests


def request_stream(spark: SparkSession, request_dir: str, sep: str = ";",
                   max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted requests, rejected lines) as streaming DataFrames over a folder."""
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_requests(reader.text(request_dir), sep)


def batch_lookup(features: DataFrame, means: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """J10 for micro-batches: the level tables are aggregated and stored once, here."""
    levels = lookup.level_tables(features)
    return lambda requests: lookup.lookup_cascade(requests, None, means, levels)


def batch_scores(features: DataFrame, fitted: PipelineModel,
                 means: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """Q4 for micro-batches: lookup, then forest score truncated toward zero."""
    look = batch_lookup(features, means)
    return lambda requests: model.predict_batch(
        fitted, model.mark_categorical(look(requests), "td_confidence")).drop("features")


def stream_lookup(requests: DataFrame, levels: dict[str, DataFrame], means: DataFrame | None = None) -> DataFrame:
    """J10 over a streaming request table, as one plan: a stream-static left join with each level."""
    return lookup.join_levels(requests, levels, means)


def stream_scores(requests: DataFrame, levels: dict[str, DataFrame], fitted: PipelineModel,
                  means: DataFrame | None = None) -> DataFrame:
    """Q4 over a streaming request table, as one plan: lookup, then the forest's score."""
    looked = model.mark_categorical(stream_lookup(requests, levels, means), "td_confidence")
    return model.predict_batch(fitted, looked).drop("features")


def start_file_sink(df: DataFrame, path: str, checkpoint_location: str,
                    available_now: bool = True) -> StreamingQuery:
    """Append a streaming plan's rows to parquet files at ``path``.  Read them back as a folder
    (not file by file): the sink's log names the files of the triggers that ended."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", path)
    w = w.option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_sink(df: DataFrame, path: str, checkpoint_location: str,
               transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
               available_now: bool = True) -> StreamingQuery:
    """Write ``transform`` of every micro-batch to ``path``/batch_id=N as parquet."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with intermediates(batch.sparkSession):
            transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def replay(table: DataFrame, plan: Callable[[DataFrame], DataFrame], base: str, lots: int = 2,
           triggers: int = 2) -> tuple[DataFrame, list[int]]:
    """Run ``table`` through a streaming plan as it would arrive: in ``lots`` of files under
    ``base``, each read in ``triggers`` or so, every later lot by a query that starts anew from the
    checkpoint.  Returns what the sink holds and the triggers that had ended after each lot.

    A row belongs to one lot by its hash, so that all rows arrive, each once."""
    spark = table.sparkSession
    files = max(triggers, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lot = F.pmod(F.xxhash64(*table.columns), F.lit(lots))
    ended = []
    for i in range(lots):
        table.where(lot == i).repartition(files).write.mode("append").parquet(f"{base}/in")
        stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, files // triggers))
                  .parquet(f"{base}/in"))
        query = start_file_sink(plan(stream), f"{base}/out", f"{base}/checkpoint")
        query.awaitTermination()
        ended.append((query.lastProgress or {"batchId": -1})["batchId"] + 1)
    return spark.read.parquet(f"{base}/out"), ended
