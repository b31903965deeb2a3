"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tunelift

# A word of the contracts: a run of characters other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"


def let_workers_import(spark: SparkSession) -> None:
    """Add this checkout to the Python path of the session's workers.  On a cluster the
    package is installed on the executors, or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(tunelift.__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of WORD matches, as a long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def id_remainder(col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null ids: null)."""
    return F.crc32(F.col(col).cast("string")) % n


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores after it until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """``free_name`` of each of several names."""
    columns = list(columns)
    return [free_name(columns, name) for name in names]
