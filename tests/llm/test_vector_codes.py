"""Product codes against full scans in plain Python: ties, unused entries, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tunelift.llm import vector_codes as C


def brute(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector); codes and distances in the order of ``rows``, and the books."""
    dims = -(-max([len(x) for _, x in rows] + [1]) // parts) * parts
    width = dims // parts
    cut = [[(list(x) + [0] * dims)[p * width:(p + 1) * width] for p in range(parts)] for _, x in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for v in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p] for v, g in zip(cut, got) if g[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    return assign(), books


def coded(spark, rows, **settings_):
    df = spark.createDataFrame([(n, i, x) for n, (i, x) in enumerate(rows)], "n int, id long, x array<int>").repartition(3)
    out, books = C.encode(df, **settings_)
    return [[list(zip(r["far"], r["code"]))[p] for p in range(len(r["code"]))] for r in out.orderBy("n").collect()], books


@settings(max_examples=60, derandomize=True, deadline=None)
@given(st.integers(0, 2 ** 31), st.integers(1, 12), st.integers(1, 40))
def test_active_entries_give_the_codes_of_full_scans(seed, k, n):
    rng = np.random.default_rng(seed)
    x, before = rng.integers(-3, 4, (n, 2)).astype(float), rng.integers(-3, 4, (k, 2)).astype(float)
    moved = rng.random(k) < 0.4
    after = np.where(moved[:, None], rng.integers(-3, 4, (k, 2)), before)
    at, far = C.nearest(x, before)
    got_at, got_far, compared = C.reassigned(x, after, moved, at, far)
    want_at, want_far = C.nearest(x, after)
    assert (got_at == want_at).all() and (got_far == want_far).all()
    assert compared == moved[at].sum() * k + (~moved[at]).sum() * moved.sum() <= n * k


@pytest.mark.parametrize("rows", [
    [(i * 7 % 101, [int(v) for v in np.random.default_rng(i).integers(-50, 50, 8)]) for i in range(101)],
    [(i, [i % 3, i % 2, 0, 0]) for i in range(60)],                                     # ties, unused entries
    [(1, [5, 5, 5, 5])] * 20 + [(i, [i, -i, 2 * i, 1]) for i in range(10)],             # repeated rows
    [(None, [1, 2, 3]), (None, [9]), (2, []), (1, [-4, 4, -4, 4, -4]), (0, [7, 7, 7, 7, 7])],   # odd rows
], ids=["random", "ties", "repeats", "odd"])
def test_matches_brute_force(spark, rows):
    got, books = coded(spark, rows, entries=16)
    want, want_books = brute(rows, entries=16)
    assert [[tuple(p) for p in r] for r in got] == want
    assert books.astype(int).tolist() == want_books


def test_large_components_stay_exact(spark):
    rows = [(i, [2 ** 28 + i, -2 ** 28 + 3 * i, i, 2 ** 27]) for i in range(30)]
    got, books = coded(spark, rows, entries=4)
    assert [[tuple(p) for p in r] for r in got] == brute(rows, entries=4)[0]


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], "id long, x array<int>")
    out, books = C.encode(none)
    assert out.collect() == [] and out.columns == ["id", "x", "code", "far"] and books.shape[1] == 0
    df = spark.createDataFrame([(1, [1, 2, 3, 4], "a"), (2, None, "b")], "id long, x array<int>, part string")
    df = df.withColumns({c: F.lit("old") for c in ("code", "far", "entry", "n", "total", "i")})
    out = C.encode(df)[0].collect()
    assert [(r["id"], r["code"], r["far"], r["part"], r["n"]) for r in out] == [(1, [0] * 4, [0] * 4, "a", "old")]


def test_query_on_its_table(spark):
    rows = [r for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()
            if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    want, books = brute([(r["vec_id"], [math.floor(1024 * c) for c in r["embedding"]]) for r in rows])
    error = [sum(d for d, _ in w) for w in want]
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r["label"]] = by_label.get(r["label"], 0) + e
    digest = hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()
    got = C.op12_vector_codes(spark, SF_CHECK).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == sorted(
        (r["vec_id"], "".join(f"{k:02x}" for _, k in w), e, by_label[r["label"]], digest)
        for r, w, e in zip(rows, want, error))
