"""Column expressions: projections, predicates and scalar functions.

All of these are built-in Spark SQL expressions, so they stay inside whole-stage
codegen; none of them runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ---------------------------------
# Confidence labels and their ordinal codes; anything else (case-sensitive) is -1.
CONFIDENCE_CODES = {
    "terrible": 0,
    "poor": 1,
    "average": 2,
    "good": 3,
    "very good": 4,
    "excellent": 5,
}
UNKNOWN_CODE = -1
# Confidence used when several feature rows are averaged.
AVERAGED_CONFIDENCE = 3.0
# Characters kept by key cleaning.
KEY_DROP_PATTERN = "[^A-Za-z0-9]"
# ---------------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project_rename(df: DataFrame, mapping: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Keep only the given columns, renamed (source -> target)."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def lower_text(c: str | Column) -> Column:
    """Lower-case."""
    return F.lower(_col(c))


def clean_key(c: str | Column) -> Column:
    """Drop every character outside [A-Za-z0-9], then lower-case (join keys)."""
    return F.lower(F.regexp_replace(_col(c), KEY_DROP_PATTERN, ""))


def to_double(c: str | Column) -> Column:
    """Text or number to double; null when it is not a number (never raises)."""
    return _col(c).try_cast("double")


def nan_to_null(c: str | Column) -> Column:
    """NaN (a number to ``try_cast``) as a missing value."""
    x = _col(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def mean_of(c: str | Column) -> Column:
    """Mean that skips nulls and NaN (NaN counts as missing, not as a value)."""
    return F.avg(nan_to_null(c))


def is_number(c: str | Column) -> Column:
    """True when the value parses as a double (null input is not a number)."""
    return to_double(c).isNotNull()


def non_numeric_to_zero(c: str | Column) -> Column:
    """P5: the value as a double, 0.0 where it is not a number."""
    return F.coalesce(to_double(c), F.lit(0.0))


def ordinal_encode(c: str | Column, codes: Mapping[str, int] = CONFIDENCE_CODES,
                   unknown: int = UNKNOWN_CODE) -> Column:
    """Label text to its ordinal code; any other text (or null) to ``unknown``."""
    lookup = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(lookup, _col(c)).cast("int"), F.lit(unknown))


def strip_trailing(c: str | Column, sep: str) -> Column:
    """Remove trailing separators, as a JVM ``split`` drops trailing empty fields."""
    return F.regexp_replace(_col(c), _regex_quote(sep) + "+$", "")


def split_jvm(c: str | Column, sep: str) -> Column:
    """Split like a JVM ``String.split``: trailing empty fields are dropped, so a
    non-empty line of separators only has no fields; the empty line is one field."""
    x = _col(c)
    stripped = strip_trailing(x, sep)
    return F.when((stripped == F.lit("")) & (x != F.lit("")), F.array().cast("array<string>")) \
            .otherwise(F.split(stripped, _regex_quote(sep)))


def field_count(c: str | Column, sep: str) -> Column:
    """Number of fields of a line split by ``sep`` with trailing empties dropped."""
    return F.size(split_jvm(c, sep)).cast("int")


def field_count_filter(df: DataFrame, c: str, sep: str, n: int) -> DataFrame:
    """Keep rows whose text splits into exactly ``n`` fields."""
    return df.where(field_count(c, sep) == n)


def numeric_row_filter(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows whose chosen fields are all numbers."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & is_number(c)
    return df.where(cond)


def digits_only(c: str | Column) -> Column:
    """Every character is a digit (the empty text counts as digits)."""
    return _col(c).rlike("^[0-9]*$")


def trim_fields(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """P10: trim the chosen (default: all string) columns."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[F.trim(F.col(c)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Nulls of the given columns to a value of the column's own type."""
    out = df
    for c, v in values.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
    return out


def equality_lookup(df: DataFrame, **keys: str) -> DataFrame:
    """Rows whose key columns equal the cleaned given values (one key; many keys
    go through ``operators.lookup.lookup_cascade`` as joins)."""
    cond = F.lit(True)
    for c, v in keys.items():
        cond = cond & (F.col(c) == clean_key(F.lit(v)))
    return df.where(cond)


def threshold_filter(df: DataFrame, c: str, threshold: float) -> DataFrame:
    """Rows with ``c`` strictly greater than the threshold."""
    return df.where(F.col(c) > F.lit(threshold))


def select_by_index(df: DataFrame, indexes: Iterable[int]) -> DataFrame:
    """The chosen columns in table order; order and repeats of indexes ignored."""
    wanted = {int(i) for i in indexes}
    return df.select(*[c for i, c in enumerate(df.columns) if i in wanted])


def popularity_log10(familiarity: str | Column, song_count: str | Column,
                     similar_count: str | Column) -> Column:
    """log10(max(familiarity * song_count * similar_count, 0) + 1)."""
    x = to_double(familiarity) * to_double(song_count) * to_double(similar_count)
    return F.log10(F.greatest(x, F.lit(0.0)) + F.lit(1.0))


def popularity_ln(familiarity: str | Column, song_count: str | Column,
                  similar_count: str | Column) -> Column:
    """ln(familiarity * song_count * similar_count + 1), no clamp (null where the
    product is <= -1)."""
    x = to_double(familiarity) * to_double(song_count) * to_double(similar_count)
    return F.log1p(x)


def weight_times_freq(w: str | Column, f: str | Column) -> Column:
    """Product of two numeric fields."""
    return to_double(w) * to_double(f)


def reorder(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns in contract order; everything else is dropped."""
    return df.select(*[F.col(c) for c in order])


def row_to_text(cols: Sequence[str | Column], sep: str = ",") -> Column:
    """A row as separator-joined text, no brackets (nulls print as 'null')."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])


def truncate_to_int(c: str | Column) -> Column:
    """P20: double to int toward zero, as the JVM does it: values beyond the int range give
    its limits, NaN gives 0; null stays null."""
    x = _col(c).cast("double")
    return (F.when(F.isnan(x), F.lit(0))
            .when(x >= F.lit(2147483647.0), F.lit(2147483647))
            .when(x <= F.lit(-2147483648.0), F.lit(-2147483648))
            .otherwise(x.try_cast("int")))


def abs_int_difference(a: str | Column, b: str | Column) -> Column:
    """P20: |trunc(a) - trunc(b)|."""
    return F.abs(truncate_to_int(a) - truncate_to_int(b))


def constant_column(value: float = AVERAGED_CONFIDENCE) -> Column:
    """The constant confidence used for averaged features."""
    return F.lit(float(value))


def string_to_double(c: str | Column) -> Column:
    """Explicit, non-raising cast before a mean (ANSI mode rejects 'NA')."""
    return to_double(c)


def fixed_round(c: str | Column, digits: int) -> Column:
    """Round to ``digits`` decimals for comparisons between engines, in two steps: first to
    ``digits + 3`` decimals (absorbs floating-point summation noise), then to ``digits``.

    Each step is rint(x * 10^d) / 10^d, plain IEEE operations with one rule for values of
    any size (rint leaves integers, so also very large values, alone)."""
    x = _col(c)
    for d in (digits + 3, digits):
        x = F.rint(x * F.lit(float(10 ** d))) / F.lit(float(10 ** d))
    return x


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()/" else ch for ch in s)
