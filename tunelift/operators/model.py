"""Model flow: artist-disjoint split, feature assembly, random forest, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, truncate_to_int

# --- fixed values that must equal the reference ----------------------------------
# Wide feature layout: position -> column (the label is last).
WIDE_COLUMNS = [
    "td_confidence", "artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
    "duration", "song_hotttnesss", "year", "play_count", "song_count", "weight_dot_freq",
    "similar_artist_count", "likes", "td_meanPrice", "genre_match_count", "popularity",
    "td_downloads",
]
LABEL = "td_downloads"
# Shipped feature choice: confidence, artist hotness, song hotness, mean price.
DEFAULT_FEATURE_INDEXES = [0, 1, 6, 13]
# Confidence is a category with codes 0..5 (position 0 of the layout).
CONFIDENCE_VALUES = 6
# Forest settings fixed by the reference (trees and depth are arguments there).
MAX_BINS = 100
SUBSET_STRATEGY = "auto"
IMPURITY = "variance"
# ---------------------------------------------------------------------------------
SEED = 42


def feature_names(indexes: Sequence[int], layout: Sequence[str] = WIDE_COLUMNS) -> list[str]:
    """Layout positions -> names, in layout order (order and repeats ignored), label excluded."""
    wanted = {int(i) for i in indexes}
    return [c for i, c in enumerate(layout) if i in wanted and c != LABEL]


def split_bucket(key: str) -> F.Column:
    """Bucket 0..99 from the first 32 bits of md5(key)."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(100))


def artist_disjoint_split(df: DataFrame, key: str = "artist_name",
                          test_percent: int = 30) -> DataFrame:
    """M6: add ``split`` ('test'/'train') so that no key value is in both splits."""
    return df.withColumn(
        "split", F.when(split_bucket(key) < test_percent, "test").otherwise("train"))


def mark_categorical(df: DataFrame, col: str = "td_confidence",
                     n_values: int = CONFIDENCE_VALUES) -> DataFrame:
    """M2: mark ``col`` as a nominal feature with codes 0..n_values-1, plus one extra
    code ``n_values`` for anything outside that range (unknown labels, -1)."""
    code = F.col(col).cast("double")
    fixed = F.when((code >= 0) & (code < n_values), code).otherwise(F.lit(float(n_values)))
    meta = {"ml_attr": {"type": "nominal", "name": col,
                        "vals": [str(i) for i in range(n_values + 1)]}}
    return df.withColumn(col, fixed.alias(col, metadata=meta))


def assembler(feature_cols: Sequence[str], output: str = "features") -> VectorAssembler:
    """M1: dense feature vector of the chosen columns.  Every row is kept; a missing
    feature is NaN in the vector (see ``usable`` and ``predict_batch``)."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output, handleInvalid="keep")


def complete(cols: Sequence[str]) -> F.Column:
    """True where no chosen feature is null or NaN."""
    out = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        out = out & x.isNotNull() & ~F.isnan(x)
    return out


def usable(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Rows that a forest can learn from: a label and every chosen feature (the original
    flow stops with a number-format error on any other row)."""
    return df.where(F.col("label").isNotNull() & ~F.isnan("label") & complete(feature_cols))


def skipped_rows(df: DataFrame, feature_cols: Sequence[str]) -> int:
    """How many rows of a prepared table ``train_forest`` leaves out (an action)."""
    return df.count() - usable(df, feature_cols).count()


def assemble_features(df: DataFrame, feature_cols: Sequence[str], label: str = LABEL) -> DataFrame:
    """M1: label plus feature vector."""
    out = assembler(feature_cols).transform(df)
    return out.withColumn("label", F.col(label).cast("double"))


def forest(num_trees: int, max_depth: int, label: str = "label", seed: int = SEED,
           bootstrap: bool = True) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, predictionCol="prediction",
        numTrees=num_trees, maxDepth=max_depth, maxBins=MAX_BINS,
        featureSubsetStrategy=SUBSET_STRATEGY, impurity=IMPURITY, seed=seed, bootstrap=bootstrap)


def prepare(df: DataFrame, feature_cols: Sequence[str], label: str = LABEL) -> DataFrame:
    """Cast features to double, mark confidence categorical, add ``label``."""
    out = df
    for c in feature_cols:
        if c == "td_confidence":
            out = mark_categorical(out, c)
        else:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out.withColumn("label", F.col(label).cast("double"))


def train_forest(train: DataFrame, feature_cols: Sequence[str], num_trees: int = 30,
                 max_depth: int = 8, seed: int = SEED, bootstrap: bool = True) -> PipelineModel:
    """M3: assembler + random-forest regression, fitted (an action) on the usable rows
    (``skipped_rows`` counts the others).  With ``bootstrap=False`` every tree sees each row once:
    a tree's prediction then is the mean label of the training rows that share it."""
    pipe = Pipeline(stages=[assembler(feature_cols),
                            forest(num_trees, max_depth, seed=seed, bootstrap=bootstrap)])
    return pipe.fit(usable(train, feature_cols))


def predict_batch(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M4: apply the model, one output row per input row; ``prediction_int`` is the score
    truncated toward zero.  A row with a missing feature has no score; ``reject_reason``
    says so (null otherwise)."""
    ok = complete(model.stages[0].getInputCols())
    out = model.transform(df)
    return (out.withColumn("prediction", F.when(ok, F.col("prediction")))
               .withColumn("prediction_int", truncate_to_int("prediction"))
               .withColumn("reject_reason", F.when(~ok, F.lit("missing feature"))))


def _both(label: str, prediction: str) -> tuple[F.Column, F.Column]:
    """Label and prediction, both null where either is missing."""
    y, p = nan_to_null(label), nan_to_null(prediction)
    ok = y.isNotNull() & p.isNotNull()
    return F.when(ok, y), F.when(ok, p)


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """N, MSE, RMSE, R^2, MAE and explained variance in one aggregate, over the rows
    that have both a label and a prediction (null and NaN are missing); ``left_out`` counts
    the others.

    Explained variance is mean((p - mean(y))^2) = var_pop(p) + (mean(p) - mean(y))^2, so
    no second pass over the data is needed.
    """
    y, p = _both(label, prediction)
    e = y - p
    n = F.count(e)
    sse = F.sum(e * e)
    mse = F.try_divide(sse, n)
    aggs = [
        n.alias("n"),
        (F.count(F.lit(1)) - n).alias("left_out"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(y) * n)).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
        (F.var_pop(p) + F.pow(F.avg(p) - F.avg(y), 2)).alias("explained_variance"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def mean_squared_error(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """Mean of squared errors, computed directly (over the rows that have both)."""
    y, p = _both(label, prediction)
    sq = F.avg(F.pow(y - p, 2))
    return df.groupBy(*by).agg(sq.alias("mse")) if by else df.agg(sq.alias("mse"))


def evaluate_splits(predictions: DataFrame, label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """M5: A11 for each split, each split on its own rows."""
    return regression_metrics(predictions, label, prediction, by=["split"])


def metrics_long(metrics: DataFrame) -> DataFrame:
    """Metrics in long form (split, metric, value) for the metrics sink."""
    names = [m for m in ["mse_direct", "mse", "rmse", "r2", "mae", "explained_variance"]
             if m in metrics.columns]
    return metrics.select(
        "split",
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                            for m in names])).alias("m")).select("split", "m.metric", "m.value")


def prediction_table(predictions: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """K4 rows: truncated label and prediction and their absolute difference."""
    li, pi = truncate_to_int(label), truncate_to_int(prediction)
    return predictions.select(
        "split", li.alias("label_int"), pi.alias("prediction_int"),
        F.abs(li - pi).alias("abs_diff"))
