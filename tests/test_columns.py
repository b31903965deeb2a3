"""Edge cases of the column expressions and readers (hand-written rows)."""

import os

from pyspark.sql import functions as F

from tunelift.functions import columns as C
from tunelift.sources import readers


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_clean_key(spark):
    df = _one_col(spark, ["O'Brien — Été 99!", "", "###", None])
    got = [r[0] for r in df.select(C.clean_key("v")).collect()]
    assert got == ["obrient99", "", "", None]


def test_is_number(spark):
    df = _one_col(spark, ["1", " 1 ", "1e5", "NaN", "NA", "", None])
    got = [r[0] for r in df.select(C.is_number("v")).collect()]
    assert got == [True, True, True, True, False, False, False]


def test_non_numeric_to_zero(spark):
    df = _one_col(spark, ["NA", "0.5", None])
    assert [r[0] for r in df.select(C.non_numeric_to_zero("v")).collect()] == [0.0, 0.5, 0.0]


def test_ordinal_encode_is_case_sensitive(spark):
    labels = ["terrible", "poor", "average", "good", "very good", "excellent", "Good", "", None]
    got = [r[0] for r in _one_col(spark, labels).select(C.ordinal_encode("v")).collect()]
    assert got == [0, 1, 2, 3, 4, 5, -1, -1, -1]


def test_popularity_log10_clamps_negative(spark):
    df = spark.createDataFrame([(0.5, 2, 9), (-1.0, 1, 1)], "f double, s int, c int")
    got = [r[0] for r in df.select(C.popularity_log10("f", "s", "c")).collect()]
    assert abs(got[0] - 1.0) < 1e-12 and got[1] == 0.0


def test_popularity_ln_null_below_minus_one(spark):
    df = spark.createDataFrame([(1.0, 1, 1), (-2.0, 1, 1)], "f double, s int, c int")
    got = [r[0] for r in df.select(C.popularity_ln("f", "s", "c")).collect()]
    assert abs(got[0] - 0.6931471805599453) < 1e-12 and got[1] is None


def test_truncate_to_int(spark):
    values = [2.7, -2.7, 3e10, -3e10, float("nan"), float("inf"), float("-inf"), 2147483647.9, -2147483648.9, None]
    df = _one_col(spark, values, "double")
    big, small = 2 ** 31 - 1, -2 ** 31
    assert [r[0] for r in df.select(C.truncate_to_int("v")).collect()] == [2, -2, big, small, 0, big, small, big, small, None]


def test_select_by_index_keeps_table_order(spark):
    from tunelift.operators.model import WIDE_COLUMNS
    df = spark.createDataFrame([tuple(range(len(WIDE_COLUMNS)))],
                               ", ".join(f"{c} int" for c in WIDE_COLUMNS))
    assert C.select_by_index(df, [13, 0, 0]).columns == ["td_confidence", "td_meanPrice"]


def test_digits_only(spark):
    df = _one_col(spark, ["123", "", "12a"])
    assert [r[0] for r in df.select(C.digits_only("v")).collect()] == [True, True, False]


def test_field_count_drops_trailing_empties(spark):
    df = _one_col(spark, ["a;b", "a;b;", "a", "a;b;c", "a;;b"])
    got = [r[0] for r in df.select(C.field_count("v", ";")).collect()]
    assert got == [2, 2, 1, 3, 3]


def test_fill_missing_uses_column_type(spark):
    df = spark.createDataFrame([(None, None), ("x", 2)], "s string, n bigint")
    out = C.fill_missing(df, {"s": "0", "n": 0}).collect()
    assert [tuple(r) for r in out] == [("0", 0), ("x", 2)]


def test_fixed_round_has_one_rule(spark):
    df = _one_col(spark, [0.1234565, 1.5, -1.5, 2.0e13, 1e300, -1e300], "double")
    got = [r[0] for r in df.select(C.fixed_round("v", 0)).collect()]
    assert got == [0.0, 2.0, -2.0, 2.0e13, 1e300, -1e300]


def test_read_requests(spark, scratch):
    path = os.path.join(scratch, "req.txt")
    with open(path, "w") as f:
        f.write("a;b\na;b;\na\na;b;c\n")
    ok, bad = readers.read_requests(spark, path)
    assert sorted(tuple(r) for r in ok.collect()) == [("a", "b"), ("a", "b")]
    assert sorted(r[0] for r in bad.collect()) == ["a", "a;b;c"]


def test_read_delimited_drops_malformed(spark, scratch):
    path = os.path.join(scratch, "d.csv")
    with open(path, "w") as f:
        f.write("x;y;z\n1;2;3\n1;2\n1;2;3;4\n\"x;y\";5;6\n;;\n1;2;\n")
    df = readers.read_delimited(spark, path, "x string, y string, z string", ";")
    assert df.count() == 4
    assert df.select("x").count() == 4


def test_read_split_lines_drops_header_copies(spark, scratch):
    path = os.path.join(scratch, "l.txt")
    with open(path, "w") as f:
        f.write("h1;h2\n1;2\nh1;h2\n3;4;\n")
    df = readers.read_split_lines(spark, path, ";", header="h1;h2")
    got = sorted(r["fields"] for r in df.collect())
    assert got == [["1", "2"], ["3", "4"]]


def test_read_trimmed_rows(spark, scratch):
    path = os.path.join(scratch, "t.txt")
    with open(path, "w") as f:
        f.write(" a ; 1 ;x\nb;2\n")
    df = readers.read_trimmed_rows(spark, path, ["k", "n", "o"], ";", types={"n": "int"})
    assert sorted(tuple(r) for r in df.collect()) == [("a", 1, "x"), ("b", 2, None)]


def test_read_feature_index(spark, scratch):
    path = os.path.join(scratch, "feature.txt")
    with open(path, "w") as f:
        f.write("0,1,6,13")
    assert readers.read_feature_index(spark, path) == [0, 1, 6, 13]


def test_row_to_text(spark):
    df = spark.createDataFrame([(1, "a", None)], "a int, b string, c string")
    assert df.select(C.row_to_text(["a", "b", "c"])).first()[0] == "1,a,null"


def test_equality_lookup_cleans_key(spark):
    df = spark.createDataFrame([("brand13", "x"), ("brand14", "y")], "artist_name string, t string")
    assert C.equality_lookup(df, artist_name="Brand#13").select("t").first()[0] == "x"
    assert F is not None
