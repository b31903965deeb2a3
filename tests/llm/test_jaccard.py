"""N-gram Jaccard join against brute force."""

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tunelift.llm import components
from tunelift.llm import jaccard as J
from tunelift.llm import linking
from tunelift.llm.components import connected_components
from tunelift.session import materialize


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, k, percent):
    """component of each row: rows that have an id and words, linked pairwise."""
    sets = [shingles(t, k) if i is not None else set() for i, t in rows]
    of = list(range(len(rows)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                    of[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(doc_id, len(shingles(t, k)), None if doc_id is None else least[find(i)])
            for i, (doc_id, t) in enumerate(rows)]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def random_rows(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:  # a near copy: a few words replaced, dropped or added
            text = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choice([[], [rng.choice(words)], [text[at], rng.choice(words)]])
                text = text or ["x"]
            text = " ".join(text)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 30, 80, 300])))
        rows.append((i * 7 % 1009, text.upper() if rng.random() < 0.1 else text))
    return rows


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two"), (6, "one two"),
        (None, "one two"), (None, None), (7, "one two three"), (8, "one"), (9, "three one two"),
        (10, "a b c d " * 4000), (11, "a b c d " * 4000 + "e"), (12, "a b c d")]


def check(make_docs, rows, k, percent, **options):
    df = make_docs(rows, extra=("n", "tiles", "v", "rep", "label"))
    got = [tuple(r)[:3] for r in J.jaccard_components(df, k, percent, **options).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, k, percent), key=key)


def test_edge_cases(make_docs):
    check(make_docs, EDGE, 3, 90)


def test_empty_table(make_docs):
    assert J.jaccard_components(make_docs([])).collect() == []


def test_near_copies_90(make_docs):
    check(make_docs, random_rows(1, 220), 3, 90)


def test_near_copies_80_without_leaders(make_docs):
    check(make_docs, random_rows(2, 160), 5, 80, leader_rounds=0)


def test_tiles_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_ROWS", 4)
    check(make_docs, random_rows(3, 120, vocabulary=60), 3, 80, leader_rounds=1)


def test_bands_meet():
    bounds = J.size_bands(10 ** 6)
    for percent in (80, 90):
        for n in list(range(1, 3000)) + [10 ** 5, 10 ** 6]:
            band = sum(1 for b in bounds if b <= n) - 1
            own = {band, band + 1} if 100 * n >= percent * bounds[band + 1] else {band}
            partner = n * 100 // percent  # the largest set that can link with one of n
            assert sum(1 for b in bounds if b <= partner) - 1 in own


@settings(max_examples=60, derandomize=True, deadline=None)
@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 300)), st.sampled_from([80, 90]))
def test_bitmap_bound_never_loses(a, b, percent):
    import numpy as np
    x, y = (np.unique(J.mix(np.array(sorted(s), dtype=np.uint64))) for s in (a, b))
    if not a or not b:
        return
    exact = 100 * len(a & b) >= percent * len(a | b)
    assert J.linked(x, y, percent) == exact
    if exact:
        assert J.may_link(len(x), J.bitmap(x), len(y), J.bitmap(y), percent)


@settings(max_examples=60, derandomize=True, deadline=None)
@given(st.lists(st.text(alphabet="aA \té\n bC", max_size=30), max_size=6))
def test_shingle_sets_match_regex(texts):
    got = [len(x) for _, x in J.shingle_sets(pa.array(texts, pa.string()), 3)]
    assert got == [len(shingles(t, 3)) for t in texts]


@pytest.mark.parametrize("task_edges", [7, 250_000])
def test_components_of_a_long_path_and_a_star(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    random.Random(4).shuffle(edges)
    df = materialize(spark.createDataFrame(edges, "a long, b long"), "test-edges")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)}


def test_one_of_each_group_with_any_column_names(make_docs):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, None), (3, None), (None, "a b c d e f g h i j"), (4, "")]
    df = make_docs(rows, extra=("__id", "__t", "__hash", "__HASH_", "component_id", "n"))
    out = J.one_of_each_group(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, rows[0][1]), (1, rows[0][1]), (3, None), (4, "")]
    assert J.one_of_each_group(make_docs([])).collect() == []


def test_a_hot_tile_with_strangers_stays_linear(spark, monkeypatch):
    """Rows of one component never meet each other again; all others meet once."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(linking, "BLOCK_ROWS", 8)
    for hot, strangers in ((4000, 1), (400, 30), (5, 40), (8, 8)):
        v = spark.range(hot + strangers).withColumnRenamed("id", "v")
        members = v.select(F.lit(7).cast("long").alias("tile"), "v", F.when(F.col("v") < hot, -1).otherwise(F.col("v")).alias("label"))
        facts = v.select("v", F.array(F.lit(7).cast("long")).alias("tiles"), F.lit(0).alias("x"))
        rows = linking.meetings(members, facts, ["x"])
        blocks, main = -(-strangers // 8), -(-hot // 8)
        assert rows.count() == hot * blocks + strangers * (blocks + main)
        pairs = linking.open_pairs(members, facts, ["x"], lambda i, j, values: i >= 0)
        got = pairs.collect()
        assert len(got) == len(set(got)) == hot * strangers + strangers * (strangers - 1) // 2
