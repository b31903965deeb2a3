"""The flows over hand-written input files in the original delimited layouts."""

import os

import pytest

from tunelift.plans import flows as P

SONG_INFO = """song_id;track_id;artist_id;artist_name;title;artist_hotttnesss;artist_familiarity;loudness;tempo;duration;song_hotttnesss;year;extra
S1;T1;A1;The Band!;Song One;0.5;0.6;-5;120;200;0.7;2001;x
S2;T2;A1;The Band!;Song Two;NA;0.6;-6;110;210;0.3;2002;x
S3;T3;A2;Solo;Alone;0.9;0.8;-4;100;190;NA;1999;x
S4;T4;A3;Nobody;Nothing;0.1;0.1;-9;90;180;0.1;1990;x
S5;T5;A1;broken row
"""
ARTIST_TERMS = """artist_id;term;weight;freq
A1;rock;0.5;2
A1;pop;1;1
A1;rock;0.5;2
A2;pop;NA;1
artist_id;term;weight;freq
"""
SIMILAR = """artist_id;similar_artist
A1;A2
A1;A3
A2;A1
"""
PLAYS = """play_song_id,play_track_id,play_count
S1,T1,10
S3,T3,4
"""
LIKES = """track,likes
T1,7
"""
DOWNLOADS = """artist;title;mean_price;downloads;confidence
the band;song one;1.5;100;excellent
THE BAND;Song-One;2.5;50;poor
Solo;Alone;NA;5;good
bad;line
"""


@pytest.fixture()
def roles(spark, scratch):
    files = {}
    for name, text in [("song_info", SONG_INFO), ("artist_terms", ARTIST_TERMS),
                       ("similar_artists", SIMILAR), ("play_count", PLAYS), ("likes", LIKES),
                       ("downloads", DOWNLOADS)]:
        path = os.path.join(scratch, f"{name}.csv")
        with open(path, "w") as f:
            f.write(text)
        files[name] = path
    return P.Roles.from_files(spark, **files)


def test_serving_features_from_files(roles):
    rows = sorted(tuple(r) for r in P.serving_features(roles).collect())
    # A3 has no terms: dropped by the genre join; the broken song row is dropped;
    # "The Band!/Song One" matches two download records (fan-out kept); Solo's record
    # has no numeric price and is left out of the serving flow.
    assert rows == sorted([
        ("theband", "songone", 5, 0.5, 0.7, 1.5, True),
        ("theband", "songone", 1, 0.5, 0.7, 2.5, True),
        ("theband", "songtwo", 0, 0.0, 0.3, 0.0, False),
        ("solo", "alone", 0, 0.9, 0.0, 0.0, False),
    ])


def test_wide_features_from_files(roles):
    got = {(r["td_meanPrice"], r["td_confidence"]): r for r in P.wide_features(roles).collect()}
    assert set(got) == {(1.5, 5), (2.5, 1), (None, 3)}
    one = got[(1.5, 5)]
    assert one["play_count"] == 10 and one["likes"] == 7 and one["song_count"] == 2  # S5 malformed
    assert one["similar_artist_count"] == 2
    assert one["weight_dot_freq"] == 3.0          # 0.5*2 + 1*1 + 0.5*2 (rows as given)
    assert one["genre_match_count"] == 2           # rock and pop, distinct
    solo = got[(None, 3)]
    assert solo["weight_dot_freq"] == 0.0 and solo["likes"] == 0 and solo["song_hotttnesss"] == 0.0


def _export_roles(spark, base):
    """The sf0.001 roles written as files in the original layouts."""
    from conftest import SF_SMALL
    r = P.Roles.from_test_tables(spark, SF_SMALL)
    out = {}
    for name, df, sep in [
        ("song_info", r.song_info, ";"), ("artist_terms", r.term_scores, ";"),
        ("similar_artists", r.similar_artists, ";"), ("play_count", r.play_count, ","),
        ("likes", r.likes, ","), ("downloads", r.downloads, ";")]:
        out[name] = os.path.join(base, name)
        df.write.option("header", "true").option("sep", sep).csv(out[name])
    return out, r


def test_command_line_jobs(spark, scratch):
    from tunelift.__main__ import main
    files, r = _export_roles(spark, os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    got = main(["features", *[a for n, p in files.items() for a in (f"--{n.replace('_', '-')}", p)],
                "--out", out])
    feats = spark.read.option("header", "true").csv(got["features"])
    assert feats.count() == P.serving_features(P.Roles.from_files(spark, **files)).count() > 0
    tr = main(["train", "--wide", got["wide"], "--out", os.path.join(scratch, "train"),
               "--trees", "5", "--depth", "4"])
    assert os.path.isdir(tr["model"])
    assert spark.read.option("sep", ";").csv(tr["metrics"]).count() == 12
    known = feats.first()
    req = os.path.join(scratch, "req.txt")
    with open(req, "w") as f:
        f.write(f"{known['artist_name']};{known['title']}\nnobody;x\njunk\n")
    sc = main(["score", "--requests", req, "--features", got["features"], "--means", got["means"],
               "--model", got["scoring_model"], "--out", os.path.join(scratch, "scores")])
    rows = {r["request_line"]: r for r in
            spark.read.option("header", "true").csv(sc["scores"]).collect()}
    assert rows[f"{known['artist_name']};{known['title']}"]["match_level"] == "exact"
    assert rows["nobody;x"]["match_level"] == "global"
    assert all(v["prediction_int"] is not None for v in rows.values())
    assert [x[0] for x in spark.read.text(sc["rejected"]).collect()] == ["junk"]
    req_dir = os.path.join(scratch, "req-stream")
    os.makedirs(req_dir)
    with open(os.path.join(req_dir, "batch1.txt"), "w") as f:
        f.write(f"{known['artist_name']};{known['title']}\nnobody;x\njunk\n")
    st = main(["score-stream", "--requests-dir", req_dir, "--features", got["features"],
               "--means", got["means"], "--model", got["scoring_model"],
               "--out", os.path.join(scratch, "stream-out"),
               "--checkpoint", os.path.join(scratch, "stream-ckpt"), "--available-now"])
    streamed = {r["request_line"]: r["prediction_int"] for r in spark.read.parquet(st["scores"]).collect()}
    assert streamed == {k: int(v["prediction_int"]) for k, v in rows.items()}
    ex = main(["explore", "--wide", got["wide"], "--out", os.path.join(scratch, "explore")])
    assert spark.read.option("header", "true").csv(ex["summary"]).count() == 16
