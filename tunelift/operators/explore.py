"""Exploration of the wide feature table: means, medians, correlations, clusters, bins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean_of, nan_to_null, popularity_ln
from ..session import materialize

# --- fixed values that must equal the reference ----------------------------------
# Exploration keeps rows with confidence above this value.
CONFIDENCE_THRESHOLD = 1
# Cluster count of the k-means used (the library default of the original script).
KMEANS_K = 8
# ---------------------------------------------------------------------------------
# Relative error used by the approximate median (``exact=False``).
APPROX_ACCURACY = 100_000
# Exact median by sketches: quantiles taken from a sketch, the inverse of its rank error, and the
# number of values up to which the quantiles are the values themselves.
SKETCH_POINTS = 1024
SKETCH_ACCURACY = 10 * SKETCH_POINTS
SKETCH_ALL = SKETCH_POINTS // 2
# Rounds of the one-dimensional k-means.
KMEANS_ROUNDS = 30


def _long(one_row: DataFrame, cols: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One wide row (field_col per column) -> one row per column."""
    structs = [F.struct(F.lit(c).alias("feature"),
                        *[F.col(f"{name}__{c}").alias(name) for name in fields])
               for c in cols]
    return one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def mean_median(df: DataFrame, cols: Sequence[str], method: str = "select") -> DataFrame:
    """Mean and median of each column, one row per column.

    ``method``: ``"select"`` exact, by sketched brackets (bounded memory, a few
    scans of a stored copy of the columns); ``"percentile"`` exact, Spark's percentile
    aggregate (one pass, but its (value, count) map grows with the distinct values, all
    merged in one task); ``"approx"`` a percentile sketch.
    """
    return _summary(df, cols, None, method)


def _summary(df: DataFrame, cols: Sequence[str], label: str | None, method: str,
             stored: bool = False) -> DataFrame:
    y = F.col(label).cast("double") if label else None
    if method == "select":
        # One aggregate job gives the means and r; the result has one row per column,
        # built from it and the median selection.
        base = df if stored else materialize(
            df.select(*cols, *([label] if label else [])), "summary-input")
        aggs = []
        for c in cols:
            x = F.col(c).cast("double")
            aggs.append(mean_of(x).alias(f"mean__{c}"))
            if label:
                aggs.append(F.try_divide(F.covar_pop(x, y),
                                         F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r__{c}"))
        row = base.agg(*aggs).first()
        medians = select_medians(stack_columns(base, cols))
        rows = [(c, row[f"mean__{c}"], medians.get(c), *([row[f"r__{c}"]] if label else []))
                for c in cols]
        schema = "feature string, mean double, median double" + (", r double" if label else "")
        return base.sparkSession.createDataFrame(rows, schema)
    aggs, fields = [], {"mean": "", "median": ""}
    for c in cols:
        x = F.col(c).cast("double")
        med = F.median(x) if method == "percentile" else \
            F.percentile_approx(x, 0.5, APPROX_ACCURACY)
        aggs += [mean_of(x).alias(f"mean__{c}"), med.cast("double").alias(f"median__{c}")]
        if label:
            aggs.append(F.try_divide(F.covar_pop(x, y),
                                     F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r__{c}"))
    if label:
        fields["r"] = ""
    out = _long(df.agg(*aggs), cols, fields)
    return out.select("feature", "mean", "median", *(["r"] if label else []))


def stack_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, x) rows for the non-null values of the given columns."""
    return (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
        for c in cols])).alias("s")).select("s.*").where(F.col("x").isNotNull()
                                                          & ~F.isnan("x")))


def exact_median(df: DataFrame, cols: Sequence[str], stored: bool = False) -> DataFrame:
    """Exact median of each column: (feature, median).

    Quantile sketches with a proven rank error bracket the middle ranks (``select_medians``), and
    rows outside the bracket are only counted.  Unless ``stored`` says ``df`` is already a stored
    table, its columns are written once to the shared checkpoint folder, so the passes rescan a
    table instead of recomputing its plan.
    """
    spark = df.sparkSession
    base = df if stored else materialize(df.select(*cols), "median-input")
    st = stack_columns(base, cols)
    medians = select_medians(st)
    return spark.createDataFrame([(c, medians.get(c)) for c in cols],
                                 "feature string, median double")


INFINITE = float("inf")


def _bracket(points: Sequence[float], n: int, ranks: Sequence[int], margin: int) -> tuple[float, float]:
    """Two of a sketch's points between which the given ranks (from 0) of its n values lie."""
    slack = margin * (n // SKETCH_ACCURACY + 2)
    a = (min(ranks) - slack) * SKETCH_POINTS // n
    b = -(-(max(ranks) + 1 + slack) * SKETCH_POINTS // n)
    return points[max(a, 0)], points[min(b, SKETCH_POINTS)]


def select_ranks(st: DataFrame, wanted: Callable[[int], list[list[int]]]) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """Values of stacked (feature, x) rows at ranks (from 0) by sketches: the number of values of
    each feature, and {(feature, rank): value}.  ``wanted`` gives the ranks for a number of values,
    in groups that lie close together.

    A pass is one aggregate.  The first one sketches the finite values of each feature: SKETCH_POINTS
    quantiles, each off by at most 1 / SKETCH_ACCURACY of the ranks.  Up to SKETCH_ALL values those
    are the values themselves.  Otherwise two of the points bracket a group of ranks, and the next
    pass counts the values below the bracket and at its ends and sketches those strictly within,
    about a 300th of the values for a single rank.  So two passes do for some 100,000 values, four
    for 10 ** 11, whatever their range or ties.  The driver gets a row of points for each feature and
    group in a pass.  Should a bracket miss a rank after all, it is widened and taken again."""
    spark = st.sparkSession
    grid = [i / SKETCH_POINTS for i in range(SKETCH_POINTS + 1)]

    def sketch(x: F.Column) -> F.Column:
        return F.percentile_approx(x, grid, SKETCH_ACCURACY)

    finite = F.when(F.abs("x") < INFINITE, F.col("x"))
    first = st.groupBy("feature").agg(
        F.count(finite).alias("n"), F.count(F.when(F.col("x") == -INFINITE, 1)).alias("below"),
        F.count(F.when(F.col("x") == INFINITE, 1)).alias("above"), sketch(finite).alias("points")).collect()
    total = {r["feature"]: r["n"] + r["below"] + r["above"] for r in first}
    found: dict[tuple[str, int], float] = {}
    # open groups: (ranks sought, values below the sketched ones, their number, their points)
    open_: dict[tuple[str, int], tuple[list[int], int, int, list[float]]] = {}
    margin: dict[tuple[str, int], int] = {}

    def narrowed(key: tuple[str, int], ranks: list[int], seen: int, n: int, points: list[float]) -> None:
        """Take the ranks that ``points`` tell; keep the group open for the others."""
        margin[key] = 1
        if n and n <= SKETCH_ALL:
            found.update({(key[0], k): points[round((k - seen + 0.5) / n * SKETCH_POINTS)] for k in ranks})
        elif ranks:
            open_[key] = (ranks, seen, n, points)

    for r in first:
        for g, group in enumerate(wanted(total[r["feature"]])):
            f, top = r["feature"], r["below"] + r["n"]
            found.update({(f, k): -INFINITE for k in group if k < r["below"]})
            found.update({(f, k): INFINITE for k in group if k >= top})
            narrowed((f, g), [k for k in group if r["below"] <= k < top], r["below"], r["n"], r["points"])
    while open_:
        ends = {key: _bracket(points, n, [k - seen for k in ranks], margin[key])
                for key, (ranks, seen, n, points) in open_.items()}
        # a row for each open group
        ranges = F.broadcast(spark.createDataFrame([(*key, float(lo), float(hi)) for key, (lo, hi) in ends.items()],
                                                   "feature string, g int, lo double, hi double"))
        inner = F.when((F.col("x") > F.col("lo")) & (F.col("x") < F.col("hi")), F.col("x"))
        counted = st.join(ranges, "feature").groupBy("feature", "g").agg(
            F.count(F.when(F.col("x") < F.col("lo"), 1)).alias("below"),
            F.count(F.when(F.col("x") == F.col("lo"), 1)).alias("low"),
            F.count(F.when((F.col("x") == F.col("hi")) & (F.col("lo") < F.col("hi")), 1)).alias("high"),
            F.count(inner).alias("n"), sketch(inner).alias("points")).collect()
        for r in counted:
            key = r["feature"], r["g"]
            lo, hi = ends[key]
            ranks, seen, n, points = open_.pop(key)
            from_inner = r["below"] + r["low"]
            from_high = from_inner + r["n"]
            if ranks[0] < r["below"] or ranks[-1] >= from_high + r["high"]:
                margin[key] *= 4
                open_[key] = (ranks, seen, n, points)
                continue
            found.update({(key[0], k): lo for k in ranks if k < from_inner})
            found.update({(key[0], k): hi for k in ranks if k >= from_high})
            narrowed(key, [k for k in ranks if from_inner <= k < from_high], from_inner, r["n"], r["points"])
    return total, found


def select_medians(st: DataFrame) -> dict[str, float | None]:
    """Exact median of each feature of stacked (feature, x) rows."""
    total, found = select_ranks(st, lambda n: [sorted({(n - 1) // 2, n // 2})] if n else [])
    medians: dict[str, float | None] = {}
    for f, n in total.items():
        if n:
            a, c = found[f, (n - 1) // 2], found[f, n // 2]
            middle = a + (c - a) * 0.5
            # equal infinities, and two values further apart than a double can say
            medians[f] = a if a == c else a / 2 + c / 2 if abs(c - a) == INFINITE else middle
    return medians


def correlation_with_label(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """A10: Pearson r of each column against the label; null for a constant column.

    ``F.corr`` raises on zero variance under ANSI mode, so r is covar / (sd * sd) with a
    null-on-zero division.
    """
    y = F.col(label).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.try_divide(F.covar_pop(x, y),
                                 F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r__{c}"))
    return _long(df.agg(*aggs), cols, {"r": ""})


def feature_summary(df: DataFrame, cols: Sequence[str], label: str,
                    method: str = "select", stored: bool = False) -> DataFrame:
    """A9 + A10: (feature, mean, median, r) per column; means and r in one aggregate,
    over one stored copy of the columns shared with the median selection (``stored``:
    ``df`` already is one)."""
    return _summary(df, cols, label, method, stored)


def with_popularity_ln(df: DataFrame) -> DataFrame:
    """P16 on the wide table: the natural-log popularity."""
    return df.withColumn("popularity_ln", popularity_ln(
        "artist_familiarity", "song_count", "similar_artist_count"))


def kmeans_label(df: DataFrame, col: str, k: int = KMEANS_K, seed: int = 42,
                 out: str = "cluster") -> DataFrame:
    """M7: k-means on one numeric column (fits a model: an action); adds the cluster id.
    Fitted on the rows that have a value; every row is returned, one without (null or NaN)
    with a null cluster."""
    x = nan_to_null(F.col(col).cast("double"))
    vec = VectorAssembler(inputCols=[col], outputCol="_km_features", handleInvalid="keep")
    data = vec.transform(df.withColumn(col, x))
    model = KMeans(k=k, seed=seed, featuresCol="_km_features", predictionCol=out).fit(
        data.where(F.col(col).isNotNull()))
    return (model.transform(data).drop("_km_features")
            .withColumn(out, F.when(F.col(col).isNotNull(), F.col(out))))


def kmeans_centers(df: DataFrame, col: str, k: int = KMEANS_K, seed: int = 42) -> DataFrame:
    """M7 as the exploration script prints it: (cluster, center, size) of a k-means fit
    on one column."""
    labelled = kmeans_label(df.select(col), col, k, seed).where(F.col("cluster").isNotNull())
    return (labelled.groupBy("cluster")
                    .agg(F.avg(col).alias("center"), F.count(F.lit(1)).alias("size")))


def _places(centers: Sequence[float], x: F.Column) -> F.Column:
    """Index of the centre that is nearest to x (ascending centres; halfway: the lower one)."""
    out = F.lit(0)
    for a, b in zip(centers, centers[1:]):
        out = out + F.when(x > F.lit((a + b) / 2), 1).otherwise(0)
    return F.when(x.isNotNull(), out).cast("int")


def kmeans_1d(df: DataFrame, col: str, k: int = KMEANS_K, rounds: int = KMEANS_ROUNDS,
              out: str = "cluster") -> tuple[DataFrame, list[float]]:
    """M7 without chance, for one column: (``df`` with the cluster of each row, the centres).

    Clusters count from 0 by their centres.  Lloyd's rounds start halfway between the values in the
    middle of k equal shares of the ranks and the middles of k equal stretches of the range (the
    former alone leave a long tail too few centres, the latter too many).  A round is one aggregate of k rows over a stored copy of the column
    (sums are exact decimals, so the order of rows does not matter); the fit ends when no centre
    moves, or after ``rounds``.  A cluster without rows keeps its centre.  Null, NaN and infinite
    values, and those beyond a decimal(38,10), teach nothing; the first two have no cluster.
    Without any value there are no centres, and no row has a cluster."""
    x = nan_to_null(F.col(col).cast("double"))
    exact = F.when(F.abs(x) < INFINITE, x.try_cast("decimal(38,10)"))
    values = materialize(df.select(F.lit("x").alias("feature"), x.alias("x"), exact.alias("exact")).where("exact is not null"),
                         "kmeans-values")
    total, found = select_ranks(values.select("feature", "x"),
                                lambda n: [[0], [n - 1], *([(2 * i + 1) * n // (2 * k)] for i in range(k))] if n else [])
    n = total.get("x", 0)
    if not n:
        return df.withColumn(out, F.lit(None).cast("int")), []
    lo, hi = found["x", 0], found["x", n - 1]
    centers = [(found["x", (2 * i + 1) * n // (2 * k)] + (lo + (hi - lo) * (2 * i + 1) / (2 * k))) / 2 for i in range(k)]
    for _ in range(rounds):
        sums = values.groupBy(_places(centers, F.col("x")).alias("at")).agg(
            (F.sum("exact").cast("double") / F.count(F.lit(1))).alias("mean")).collect()  # k rows
        moved = list(centers)
        for r in sums:
            moved[r["at"]] = r["mean"]
        if moved == centers:
            break
        centers = moved
    return df.withColumn(out, _places(centers, x)), centers


def cluster_cost(df: DataFrame, col: str, cluster: str = "cluster") -> float:
    """Sum of squared distances of the values to the means of their clusters."""
    per = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        (F.var_pop(col) * F.count(col)).alias("cost"))
    return per.agg(F.sum("cost")).first()[0] or 0.0


def optimal_cost(df: DataFrame, col: str, k: int = KMEANS_K, most: int = 100_000) -> float:
    """The least ``cluster_cost`` that k clusters of one column can have, as a yardstick.

    In one dimension the best clusters are intervals, so a dynamic programme over the sorted
    distinct values finds them: prefix sums give the cost of any interval at once, and the best
    last cut moves only one way as values are added, which halves the cuts to try at each level.
    The histogram of distinct values goes to the driver; more than ``most`` raise a ValueError."""
    x = nan_to_null(F.col(col).cast("double"))
    rows = (df.select(x.alias("x")).where(F.abs("x") < INFINITE).groupBy("x").count()
            .orderBy("x").limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"more than {most} distinct values")
    v = np.array([r["x"] for r in rows])
    v, w = v - (v.mean() if len(v) else 0), np.array([r["count"] for r in rows], dtype=float)
    n, s, q = (np.r_[0.0, np.cumsum(a)] for a in (w, w * v, w * v * v))

    def cost(a: np.ndarray, b: int) -> np.ndarray:
        return np.maximum(q[b] - q[a] - (s[b] - s[a]) ** 2 / (n[b] - n[a]), 0)

    best = np.r_[0.0, np.full(len(v), np.inf)]
    for _ in range(k):
        after = np.full(len(v) + 1, np.inf)
        after[0] = 0.0
        todo = [(1, len(v), 0, len(v) - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            b = (lo + hi) // 2
            cuts = np.arange(left, min(right, b - 1) + 1)
            tried = best[cuts] + cost(cuts, b)
            at = int(cuts[tried.argmin()])
            after[b] = tried.min()
            todo += [(lo, b - 1, left, at), (b + 1, hi, at, right)]
        best = np.minimum(best, after)
    return float(best[-1])


def binned_scatter(df: DataFrame, x_cols: Sequence[str], y_col: str, bins: int = 20,
                   stored: bool = False) -> DataFrame:
    """M8: 2-D histogram of each column against the label: (feature, x_bin, y_bin, n,
    frac), frac being the cell's share of the feature's points.

    Two aggregates over one stored copy of the columns (``stored``: ``df`` already is
    one): the edges (smallest and largest finite value of each column over the points that
    have both values, one row in all), then the cells, binned before the shuffle, so a map
    task sends at most columns x bins x bins rows.  NaN is missing, like null; an infinite
    value falls in the first or last bin and does not move an edge.
    """
    base = df if stored else materialize(df.select(*x_cols, y_col), "scatter-input")
    # one row per point and column, the value missing in either leaving the point out
    y = nan_to_null(F.col(y_col).cast("double"))
    points = base.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c).cast("double")).alias("x"), y.alias("y"))
        for c in x_cols])).alias("s")).select("s.*").where("x is not null and y is not null")
    aggs = []
    for v in ("x", "y"):
        finite = F.when(F.abs(v) < INFINITE, F.col(v))
        aggs += [F.min(finite).alias(f"{v}_min"), F.max(finite).alias(f"{v}_max")]
    edges = {r["feature"]: r for r in points.groupBy("feature").agg(F.count(F.lit(1)).alias("rows"), *aggs).collect()}

    def bin_of(v: str) -> F.Column:
        def number(field: str) -> F.Column:  # the edges as literals: one row per column
            pairs = [z for f, r in edges.items() for z in (F.lit(f), F.lit(r[field]).cast("double"))]
            return F.element_at(F.create_map(*pairs), F.col("feature")) if pairs else F.lit(None).cast("double")

        lo, hi = number(f"{v}_min"), number(f"{v}_max")
        idx = F.try_divide(F.col(v) - lo, (hi - lo) / F.lit(bins))
        return (F.when(F.col(v) == INFINITE, F.lit(bins - 1)).when(F.col(v) == -INFINITE, F.lit(0))
                .otherwise(F.coalesce(F.least(F.floor(idx), F.lit(bins - 1)), F.lit(0)))).cast("int")

    cells = (points.groupBy("feature", bin_of("x").alias("x_bin"), bin_of("y").alias("y_bin"))
                   .agg(F.count(F.lit(1)).alias("n")))
    rows = F.element_at(F.create_map(*[z for f, r in edges.items() for z in (F.lit(f), F.lit(r["rows"]))]),
                        F.col("feature")) if edges else F.lit(1)
    return cells.select("feature", "x_bin", "y_bin", "n", (F.col("n") / rows).alias("frac"))
