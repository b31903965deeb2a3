"""Every registered query against its DuckDB oracle (sf0.001), the driver's gate in small."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    return (1, repr(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                   "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    assert spark_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = rel.df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_core_query_has_an_oracle():
    from tunelift.plans.catalog import REGISTRY
    # SQL cannot grow the forest of request_scores; test_model_flow walks its trees instead
    assert [k for k, (_, sql) in REGISTRY.items() if not sql] == ["request_scores"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["artist_name", "title", "td_confidence", "artist_hotness",
                          "song_hotness", "td_meanPrice", "has_download_record"]


def test_entry_survives_a_missing_library():
    """A library that only the optional operators need takes none of the core queries with it."""
    import subprocess
    import sys

    from conftest import ROOT
    from tunelift.plans.catalog import REGISTRY
    code = ("import sys; sys.modules.update(tiktoken=None, zstandard=None, tokenizers=None); import __spark_entry__ as E; "
            "print(len(E.queries()), len(E.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(REGISTRY)), str(sum(1 for _, sql in REGISTRY.values() if sql))], out.stderr
