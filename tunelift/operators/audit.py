"""Row counts after each stage of a flow, as one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def stage_row_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, rows) for each named DataFrame; one lazy union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
               .select(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "rows")
             for i, (name, df) in enumerate(stages)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(df: DataFrame, name: str, observations: dict | None) -> DataFrame:
    """Attach a row count named ``name`` to ``df`` when ``observations`` is a dict.

    The count is collected by whatever action later runs over ``df`` (no job of its
    own); read it with ``observed_counts`` after that action.
    """
    if observations is None:
        return df
    obs = Observation(name)
    observations[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def observed_counts(observations: dict) -> dict[str, int]:
    """Stage -> rows, once an action has run over the observed DataFrames."""
    return {name: int(obs.get["rows"]) for name, obs in observations.items()}


def counts_table(spark, counts: dict[str, int]) -> DataFrame:
    """The A7 audit table (stage_no, stage, rows) from observed counts."""
    rows = [(i, name, n) for i, (name, n) in enumerate(counts.items())]
    return spark.createDataFrame(rows, "stage_no int, stage string, rows long")
