"""Exact dedup by chunk recipes against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tunelift.llm import chunk_dedup as C


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde ., é\n") for _ in range(n)) for n in (0, 1, 40, 300, 5000, 60000)]
    rows = [(i, rng.choice(base)) for i in range(40)]
    rows += [(100, base[4] + "!"), (101, "!" + base[4]), (102, base[4][:2500] + "?" + base[4][2500:]), (103, "x" * 20000),
             (104, "x" * 20001), (None, base[3]), (None, "only without id"), (None, "only without id"), (105, None),
             (106, "A b"), (107, "a b"), (108, "a b "), (3, base[5]), (3, base[5])]
    return rows


@pytest.mark.parametrize("chunk_id", [lambda c: F.xxhash64(c), lambda c: F.pmod(F.xxhash64(c), F.lit(2)).cast("long")])
def test_against_brute_force(make_docs, chunk_id):
    rows = rows_of()
    df = make_docs(rows, extra=("recipe", "id", "chunk", "keep_id"))
    got = [tuple(r) for r in C.dedup_exact(df, chunk_id, 64, 256).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_chunks_are_content_defined(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdehilorst") for _ in range(rng.randint(1, 9))) for _ in range(9000))
    one, two = (r[0] for r in spark.createDataFrame([(text,), ("inserted words. " + text,)], "t string")
                .select(C.chunks(F.col("t"))).collect())
    assert "".join(one) == text and all(len(c) <= C.MAX_CHARS for c in one) and len(one) > 20
    assert len(set(one) & set(two)) >= len(one) - 4  # an edit moves only the cuts near it


def test_empty_table_and_plan(make_docs):
    assert C.dedup_exact(make_docs([])).collect() == []
    plan = C.dedup_exact(make_docs(rows_of()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
