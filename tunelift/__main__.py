"""Command line: the flows as jobs over delimited input files.

  python -m tunelift features --song-info F --artist-terms F --similar-artists F \\
      --play-count F --likes F --downloads F --out DIR
  python -m tunelift train --wide DIR --out DIR [--trees 30] [--depth 8] [--features 0,1,6,13]
      [--test DIR]   (separate held-out table; otherwise an artist-hash split)
  python -m tunelift score --requests F --features DIR --means DIR --model DIR --out DIR
  python -m tunelift explore --wide DIR --out DIR
  python -m tunelift score-stream --requests-dir DIR --features DIR --means DIR --model DIR \
      --out DIR --checkpoint DIR [--available-now] [--one-plan]

Under spark-submit the master comes from the submit command (``--master`` here is for
local runs).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from .plans import jobs
from .plans.flows import Roles
from .session import build_session, intermediates
from .sources.readers import read_feature_index


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tunelift")
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("features", help="serving features, means and the wide table")
    for name in ("song-info", "artist-terms", "similar-artists", "play-count", "likes",
                 "downloads"):
        f.add_argument(f"--{name}", required=True)
    f.add_argument("--out", required=True)
    t = sub.add_parser("train", help="forest on an artist-disjoint split, metrics, model")
    t.add_argument("--wide", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--trees", type=int, default=30)
    t.add_argument("--depth", type=int, default=8)
    t.add_argument("--features", default="0,1,6,13", help="wide-table positions")
    t.add_argument("--features-file", default=None,
                   help="file whose first line lists the positions (instead of --features)")
    t.add_argument("--test-percent", type=int, default=30)
    t.add_argument("--test", default=None,
                   help="held-out wide table (then --wide is the training table)")
    s = sub.add_parser("score", help="score request lines artist;title")
    for name in ("requests", "features", "means", "model", "out"):
        s.add_argument(f"--{name}", required=True)
    ss = sub.add_parser("score-stream", help="score request files as they arrive (streaming)")
    for name in ("requests-dir", "features", "means", "model", "out", "checkpoint"):
        ss.add_argument(f"--{name}", required=True)
    ss.add_argument("--rejected", default=None,
                    help="folder of the rejected lines (default: beside --out)")
    ss.add_argument("--available-now", action="store_true",
                    help="process the files present now, then stop")
    ss.add_argument("--one-plan", action="store_true",
                    help="join the stream with bucketed levels in one streaming plan, instead of a "
                         "batch lookup for each micro-batch")
    e = sub.add_parser("explore", help="means, medians, correlations, clusters, histograms")
    e.add_argument("--wide", required=True)
    e.add_argument("--out", required=True)
    return ap


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, None if args.master is None else 8)
    if args.cmd == "features":
        with intermediates(spark):
            roles = Roles.from_files(spark, args.song_info, args.artist_terms, args.similar_artists,
                                     args.play_count, args.likes, args.downloads)
            out = jobs.serving_job(roles, args.out)
            out["wide"] = jobs.wide_job(roles, args.out)
        out["scoring_model"] = jobs.scoring_model(jobs.read_wide(spark, out["wide"]),
                                                  os.path.join(args.out, "scoring-model"))
    elif args.cmd == "train":
        idx = (read_feature_index(spark, args.features_file) if args.features_file else
               [int(x) for x in args.features.split(",") if x.strip()])
        test = jobs.read_wide(spark, args.test) if args.test else None
        out = jobs.training_job(jobs.read_wide(spark, args.wide), args.out, idx,
                                args.trees, args.depth, args.test_percent, test=test)
    elif args.cmd == "score":
        scores, rejected = jobs.scoring_job(spark, args.requests, args.features, args.means,
                                            args.model)
        out = {"scores": os.path.join(args.out, "scores"),
               "rejected": os.path.join(args.out, "rejected")}
        scores.select("request_line", "match_level", "prediction_int", "reject_reason") \
              .write.mode("overwrite").option("header", "true").csv(out["scores"])
        rejected.write.mode("overwrite").text(out["rejected"])
    elif args.cmd == "score-stream":
        from pyspark.sql import functions as F

        from .operators import lookup
        from .sources import writers
        from .streaming import scoring
        accepted, rejected = scoring.request_stream(spark, args.requests_dir)
        accepted = accepted.withColumn("request_line", F.concat_ws(";", "artist", "title"))
        features, means = jobs.read_serving(spark, args.features), jobs.read_means(spark, args.means)
        fitted = writers.load_model(args.model)
        out = {"scores": args.out, "rejected": args.rejected or args.out.rstrip("/") + "-rejected"}
        columns = ["request_line", "match_level", "prediction", "prediction_int", "reject_reason"]
        checkpoint = os.path.join(args.checkpoint, "scores")
        if args.one_plan:
            plan = scoring.stream_scores(accepted, lookup.bucketed_levels(features), fitted, means)
            first = scoring.start_file_sink(plan.select(*columns), out["scores"], checkpoint, args.available_now)
        else:
            score = scoring.batch_scores(features, fitted, means)
            first = scoring.start_sink(accepted, out["scores"], checkpoint, lambda batch: score(batch).select(*columns),
                                       available_now=args.available_now)
        running = [first, scoring.start_sink(rejected, out["rejected"], os.path.join(args.checkpoint, "rejected"),
                                             available_now=args.available_now)]
        for q in running:
            q.awaitTermination()
    else:
        report = jobs.explore_job(jobs.read_wide(spark, args.wide))
        out = {}
        for name, df in report.items():
            out[name] = os.path.join(args.out, name)
            df.write.mode("overwrite").option("header", "true").csv(out[name])
    print(json.dumps(out))
    return out


def cli() -> int:
    """Console-script entry: run ``main`` and exit 0 (``main`` returns the output paths)."""
    main(sys.argv[1:])
    return 0


if __name__ == "__main__":
    sys.exit(cli())
