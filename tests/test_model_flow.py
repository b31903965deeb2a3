"""Training flow: split, forest, per-split metrics, model round trip."""

import os

from pyspark.sql import functions as F

from tunelift.operators import model
from tunelift.plans import flows as P
from tunelift.sources import writers
from conftest import SF_SMALL


def test_train_evaluate_and_reload(spark, scratch):
    r = P.Roles.from_test_tables(spark, SF_SMALL)
    wide = P.wide_features_with_artist(r)
    fitted, preds, metrics = P.train_and_evaluate(wide, num_trees=5, max_depth=4)
    m = {row["split"]: row for row in metrics.collect()}
    assert set(m) == {"test", "train"}
    assert sum(row["n"] for row in m.values()) == wide.count()
    # the splits share no artist
    both = preds.groupBy("artist_key").agg(F.countDistinct("split").alias("k")).where("k > 1")
    assert both.count() == 0
    path = os.path.join(scratch, "model")
    writers.save_model(fitted, path)
    data = model.prepare(model.artist_disjoint_split(wide, "artist_key"), model.feature_names(model.DEFAULT_FEATURE_INDEXES))
    again = writers.load_model(path).transform(data)
    a = sorted(x[0] for x in preds.select("prediction").collect())
    b = sorted(x[0] for x in again.select("prediction").collect())
    assert a == b
    table = model.prediction_table(preds)
    writers.write_predictions(table, os.path.join(scratch, "pred"))
    assert spark.read.parquet(os.path.join(scratch, "pred")).count() == wide.count()


def test_forest_is_seeded(spark):
    """A fixed seed makes training on a stored table reproducible.  (A lazy input is
    recomputed per fit, and shuffle output order may differ between recomputations, so
    the flows store their training table before fitting.)"""
    from tunelift.session import materialize
    r = P.Roles.from_test_tables(spark, SF_SMALL)
    cols = model.feature_names(model.DEFAULT_FEATURE_INDEXES)
    data = model.prepare(materialize(P.wide_features(r), "seed-test"), cols)
    preds = [sorted(x[0] for x in model.train_forest(data, cols, num_trees=5, max_depth=4)
                    .transform(data).select("prediction").collect()) for _ in range(2)]
    assert preds[0] == preds[1]
