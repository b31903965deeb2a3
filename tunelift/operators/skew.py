"""Left joins that stay balanced when one key holds a large share of the right rows.

AQE splits a skewed partition only on the side it may duplicate safely: either side of an
inner join, the left side of a left outer join.  A join of a large table with a stored
per-key table therefore needs nothing but that table to be stored (both sides are then
plain shuffles).  A many-to-many *left* join whose right side is dominated by one key would
still give that key to one task.  ``salted_join`` spreads the right rows of such keys over
several tasks and replicates the matching left rows; every other key takes the plain join.
The result equals the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key (``_rows``); a partial aggregate, so a hot key costs one row per input
    partition."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Keys that hold more than the fair share of one of ``tasks`` tasks (default: the
    shuffle partitions), with the number of tasks they are worth (``_salts``).

    The shares add up to ``tasks``, so there are fewer hot keys than tasks, whatever the
    size of the table: that bounds the broadcast list and the replication."""
    tasks = tasks or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.col("_rows") * F.lit(tasks) / counts.agg(F.sum("_rows").alias("total")).scalar()
    return (counts.withColumn("_salts", F.ceil(share).cast("int")).where(share > 1)
            .select(*keys, "_salts"))


# Sketches of input partitions are first merged in this many tasks, then those into one.
SKETCH_GROUPS = 32
# Most tasks that are told apart: a key below 1/100,000 of the rows is never hot.
MOST_TASKS = 100_000


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``hot_keys`` of ``df`` without shuffling its keys.

    A frequent-items sketch (mergeable, 8 counters a task) of the keys' hashes misses no key above
    the fair share: a hash that occurs in more than two thirds of it is kept for certain, and at
    most two candidates a task are taken.  Only the candidates' rows are then counted exactly,
    by their keys, so hashes that collide or shares that are estimated too high change nothing."""
    tasks = min(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_TASKS)
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    groups = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g")).agg(
        F.expr(f"approx_top_k_accumulate(_h, {8 * tasks})").alias("_s"), F.count(F.lit(1)).alias("_n"))
    # by a constant: a global aggregate would ask partitions without a sketch for one
    merged = groups.groupBy(F.lit("all")).agg(F.expr("approx_top_k_combine(_s)").alias("_s"), F.sum("_n").alias("_total"))
    candidates = (merged.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {2 * tasks})")).alias("_c"), "_total")
                  .select(F.col("_c.item").alias("_h"), "_total"))
    # 2 x tasks rows at most
    counts = (hashed.join(F.broadcast(candidates), "_h").groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("_rows"), F.max("_total").alias("_total")))
    share = F.col("_rows") * F.lit(tasks) / F.col("_total")
    return (counts.withColumn("_salts", F.ceil(share).cast("int")).where(share > 1)
            .select(*keys, "_salts"))


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                how: str = "inner", tasks: int | None = None) -> DataFrame:
    """``left.join(right, left.l == right.r for (l, r) in on, how)`` for how in
    {'inner', 'left'}, with the right rows of hot keys spread over as many tasks as they
    are worth.

    ``right`` is read three times (its keys are sketched, then candidates counted), so it should
    be a stored table.  Neither pass shuffles its keys.
    Its rows of a hot key get a salt below the key's number of tasks; the left rows of that
    key are replicated once per salt; all other rows use salt 0.  Each (left, right) pair
    meets in exactly one task.  In a left join, a replica whose salt holds no right row is
    dropped: the key has right rows, so the left row is matched under some other salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    rkeys = [rk for _, rk in on]
    hot = F.broadcast(heavy_keys(right, rkeys, tasks))  # fewer rows than tasks
    hot_l = hot.select(*[F.col(rk).alias(f"_hk_{i}") for i, rk in enumerate(rkeys)], "_salts")
    lt = left.join(hot_l, [left[lk] == hot_l[f"_hk_{i}"] for i, (lk, _) in enumerate(on)],
                   "left").drop(*[f"_hk_{i}" for i in range(len(on))])
    rt = right.join(hot, rkeys, "left")
    # A random salt is safe under task retries: the replicated side meets every salt,
    # so any assignment gives the same result (and duplicates are spread too).
    spread = F.when(F.col("_salts").isNotNull(), F.floor(F.rand(17) * F.col("_salts")).cast("int")).otherwise(F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ls = lt.withColumn("_salt", every).withColumnRenamed("_salts", "_lsalts")
    rs = rt.withColumn("_salt", spread).drop("_salts")
    cond = [ls[lk] == rs[rk] for lk, rk in on] + [ls["_salt"] == rs["_salt"]]
    out = ls.join(rs, cond, how)
    if how == "left":
        out = out.where(~(F.col("_lsalts").isNotNull() & rs["_salt"].isNull()))
    return out.drop(ls["_salt"]).drop(rs["_salt"]).drop("_lsalts")
