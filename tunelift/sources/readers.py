"""Sources: delimited files, split text lines, trimmed rows, gzip feature files, requests.

All readers are distributed scans with an explicit schema (no inference pass).  Text
parsing uses built-in ``split``/``trim`` expressions, never Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import clean_key, equality_lookup, field_count, split_jvm

def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None, sep: str,
                   header: bool = True, mode: str = "DROPMALFORMED") -> DataFrame:
    """Delimited file(s); rows of the wrong width are dropped.

    With a ``schema`` the columns are typed by position; without one they are all
    strings named by the header (no inference pass).  Column pruning of the CSV parser
    is switched off for this read so that the width check sees every column even when the
    caller projects a few.  ``mode="FAILFAST"`` is for files this library wrote itself,
    where a malformed row is a fault and not an outside file's noise.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return (reader.option("header", str(header).lower())
                  .option("sep", sep)
                  .option("mode", mode)
                  .option("columnPruning", "false")
                  .csv(path))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file (a header), read as one row."""
    row = spark.read.text(path).first()
    return row["value"] if row else None


def split_fields(lines: DataFrame, sep: str, col: str = "value") -> DataFrame:
    """Split text lines into an array column ``fields`` (trailing empty fields dropped,
    no quoting), keeping the other columns."""
    others = [c for c in lines.columns if c != col]
    return lines.select(*others, split_jvm(col, sep).alias("fields"))


def read_split_lines(spark: SparkSession, path: str, sep: str, header: str | None = None,
                     n_fields: int | None = None) -> DataFrame:
    """Text lines split by ``sep``; every line equal to ``header`` is dropped, and
    with ``n_fields`` only lines of exactly that many fields are kept (P7)."""
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.where(F.col("value") != F.lit(header))
    if n_fields is not None:
        lines = lines.where(field_count("value", sep) == n_fields)
    return split_fields(lines, sep)


def fields_to_columns(df: DataFrame, names: Sequence[str], positions: Sequence[int] | None = None,
                      types: dict[str, str] | None = None, trim: bool = False) -> DataFrame:
    """Positional fields -> named columns (missing positions give null); optional trim
    and ``try_cast`` to the given types."""
    positions = list(positions) if positions is not None else list(range(len(names)))
    cols = []
    for name, pos in zip(names, positions):
        v = F.get(F.col("fields"), pos)
        if trim:
            v = F.trim(v)
        if types and name in types:
            v = v.try_cast(types[name])
        cols.append(v.alias(name))
    return df.select(*cols)


def read_trimmed_rows(spark: SparkSession, path: str, names: Sequence[str], sep: str,
                      types: dict[str, str] | None = None, header: str | None = None) -> DataFrame:
    """S3: positional fields, each trimmed, into a typed table."""
    return fields_to_columns(read_split_lines(spark, path, sep, header), names,
                             types=types, trim=True)


def read_gzip_features(spark: SparkSession, path: str, names: Sequence[str],
                       positions: Sequence[int], types: dict[str, str] | None = None,
                       sep: str = ",", partitions: int | None = None) -> DataFrame:
    """Gzip CSV with a header; chosen positions re-ordered into named columns.

    A gzip file is one split, so the rows are spread with a round-robin repartition
    before anything else runs on them.
    """
    raw = spark.read.option("header", "true").option("sep", sep).csv(path)
    fields = raw.select(F.array(*[F.col(c) for c in raw.columns]).alias("fields"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fields_to_columns(fields.repartition(n), names, positions, types)


def read_feature_index(spark: SparkSession, path: str) -> list[int]:
    """The first line of a small config file as a list of column indexes."""
    first = spark.read.text(path).first()
    return [int(float(x)) for x in first["value"].split(",") if x.strip()] if first else []


def parse_requests(lines: DataFrame, sep: str = ";", col: str = "value"
                   ) -> tuple[DataFrame, DataFrame]:
    """S6 on a table of lines: (accepted artist/title requests, rejected lines).

    A line is a request when it has exactly two fields after trailing separators are
    dropped.  A bad line is rejected on its own; it does not end the input.
    """
    n = field_count(col, sep)
    others = [c for c in lines.columns if c != col]
    ok = split_fields(lines.where(n == 2), sep, col)
    accepted = ok.select(*others, F.get("fields", 0).alias("artist"),
                         F.get("fields", 1).alias("title"))
    rejected = lines.where(n != 2)
    return accepted, rejected


def read_requests(spark: SparkSession, path: str, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """Request lines ``artist;title`` from text files."""
    return parse_requests(spark.read.text(path), sep)


def read_feature_store(spark: SparkSession, path: str, artist_name: str | None = None,
                       title: str | None = None) -> DataFrame:
    """P12 on a clustered store (``writers.write_feature_store``): the rows of one artist, title or
    both, keys cleaned like the table.

    The store's index names the files that may hold the artist (one, or those of an artist that
    fills several); in each, the equality reaches the parquet reader, which skips row groups by
    their ranges and bloom filters.  Without an artist all files are asked."""
    rows = f"{path}/rows"
    schema = spark.read.parquet(rows).schema
    if artist_name is None:
        found = spark.read.schema(schema).parquet(rows)
    else:
        key = clean_key(F.lit(artist_name))
        files = [r["file"] for r in spark.read.parquet(f"{path}/files")
                 .where((F.col("first") <= key) & (F.col("last") >= key)).select("file").collect()]
        found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    wanted = {"artist_name": artist_name, "title": title}
    return equality_lookup(found, **{c: v for c, v in wanted.items() if v is not None})
