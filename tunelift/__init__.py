"""Song feature engineering and download prediction, built on Spark DataFrames.

Every public function maps DataFrame(s) to a DataFrame and triggers no action,
unless its name says it writes, trains or saves.

Main entry points::

    from tunelift import Roles, serving_features, wide_features, lookup_cascade
    roles = Roles.from_files(spark, song_info=..., artist_terms=..., similar_artists=...,
                             play_count=..., likes=..., downloads=...)
    features = serving_features(roles)
    scored = lookup_cascade(requests_df, features)
"""

__version__ = "0.1.0"

from .operators.explore import binned_scatter, exact_median, feature_summary  # noqa: E402,F401
from .operators.lookup import global_means, lookup_cascade  # noqa: E402,F401
from .operators.model import artist_disjoint_split, regression_metrics  # noqa: E402,F401
from .operators.skew import salted_join  # noqa: E402,F401
from .plans.flows import (Roles, explore_features, score_requests,  # noqa: E402,F401
                          serving_features, train_and_evaluate, wide_features)
from .session import build_session, cluster_settings, materialize  # noqa: E402,F401
