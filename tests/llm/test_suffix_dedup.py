"""Suffix-array dedup against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tunelift.llm import suffix_dedup as S


def brute(texts, span):
    """For each text: (kept bytes, spans)."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, b in enumerate(raw):
        for p in range(len(b) - span + 1):
            seen.setdefault(b[p:p + span], []).append((i, p))
    cover = [np.zeros(len(b), bool) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                cover[i][p:p + span] = True
    out = []
    for b, c in zip(raw, cover):
        edge = np.flatnonzero(np.diff(np.r_[0, c.astype(int), 0]))
        out.append((bytes(np.frombuffer(b, np.uint8)[~c]), [(int(x), int(y - x)) for x, y in zip(edge[::2], edge[1::2])]))
    return out


def check(make_docs, rows, span, gram):
    df = make_docs(rows, extra=("u", "z", "w", "a", "n", "ctx"))
    got = {r["u"]: (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in S.repeated_spans(df, span, gram).collect()}
    from pyspark.sql import functions as F
    ids = df.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("u")).collect()
    by_row = {(r["doc_id"], r["text"]): r["u"] for r in ids}
    want = brute([t for _, t in rows], span)
    for (i, t), (kept, spans) in zip(rows, want):
        assert got.get(by_row[i, t], ((t or "").encode(), [])) == (kept, spans), (i, t)


def random_rows(seed, n=50, length=(0, 90), alphabet="abcé", shared=3):
    rng = random.Random(seed)
    def text(a, b):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(a, b)))
    passages = [text(15, 60) for _ in range(shared)]
    rows = []
    for i in range(n):
        t = text(*length)
        if rng.random() < 0.5:
            t += rng.choice(passages)[rng.randint(0, 5):] + text(*length)
        if rng.random() < 0.15 and rows:
            t = rng.choice(rows)[1]
        rows.append((i, t))
    return rows


EDGE = [(1, None), (2, ""), (3, "x" * 11), (4, "x" * 12), (5, "y" * 13), (6, "abcdefghijkl"), (7, "--abcdefghijkl--"),
        (None, "abcdefghijklm"), (8, "é" * 7), (9, "same row again, same row again"), (9, "same row again, same row again"),
        (9, "another text"), (10, "0123456789" * 3000)]


def test_edge_cases(make_docs):
    check(make_docs, EDGE, 12, 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(make_docs, seed):
    check(make_docs, random_rows(seed, alphabet="abcé" if seed == 1 else "abcdefghijklmnop"), 12, 4)


def test_long_span(make_docs):
    check(make_docs, random_rows(3, 30, (0, 500), "abcdefgh é", 4) + [(99, "q" * 900)], 40, 24)


def test_salted_anchors_and_small_arrays(make_docs, monkeypatch):
    monkeypatch.setattr(S, "SHARD_CONTEXTS", 3)
    monkeypatch.setattr(S, "ARRAY_BYTES", 64)
    check(make_docs, random_rows(4, 60, (0, 30), "abcdef", 2), 12, 4)


@settings(max_examples=150, derandomize=True, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5))
def test_equal_windows_are_in_pieces_of_one_anchor(texts):
    by = {}
    for raw in (t.encode() for t in texts):
        offsets = np.array([0, len(raw)], dtype=np.int64)
        _, anchor, first, last, _ = S.contexts(np.frombuffer(raw, np.uint8), offsets, 12, 4)
        seen = []
        for a, b, e in zip(anchor.view(np.int64).tolist(), first.tolist(), last.tolist()):
            for x, y, key in S.pieces(raw, b, e, a, 12, 4):
                assert y - x < 3
                seen += range(x, y + 1)
                for w in range(x, y + 1):
                    assert by.setdefault(raw[w:w + 12], key) == key
        assert seen == list(range(max(0, len(raw) - 11)))  # each window once


@pytest.mark.parametrize("limit", [1024, 128, 16])
def test_rows_grow_in_step_with_contexts(make_docs, monkeypatch, limit):
    """Texts that share passages, twice as many of them: no step in the rows, whatever the limit."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(S, "SHARD_CONTEXTS", limit)
    rng = random.Random(6)

    def text(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    passages = [text(600) for _ in range(3)]
    made = []
    for n in (150, 300):
        docs = make_docs([(i, text(300) + rng.choice(passages) + text(300)) for i in range(n)])
        docs = docs.select(F.xxhash64("doc_id", "text").alias("u"), "text")
        texts = S._texts_with_contexts(docs, S.SPAN_BYTES, S.GRAM_BYTES)
        listed = texts.select(F.sum(F.size("w"))).first()[0]
        made.append((listed, S._repeats(S._distinct_contexts(texts, S.SPAN_BYTES, S.GRAM_BYTES), S.SPAN_BYTES).count()))
    assert made[1][1] <= 2.6 * made[0][1] and made[1][1] <= 12 * made[1][0]


def test_empty_table(make_docs):
    assert S.repeated_spans(make_docs([])).collect() == []


@settings(max_examples=150, derandomize=True, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 2 + 97 for x in b)), min_size=1, max_size=6),
       st.integers(1, 8))
def test_ranks_and_prefixes(texts, span):
    texts = sorted(set(texts))
    size = np.array([len(t) for t in texts])
    ends = np.cumsum(size)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    rank = S.suffix_ranks(raw, np.repeat(ends, size), int(size.max()))
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    order = sorted(range(len(suffixes)), key=lambda i: (suffixes[i], i))
    array = np.argsort(rank, kind="stable")
    assert array.tolist() == order and (np.diff(rank[array]) >= 0).all()
    common = S.common_prefixes(raw, ends - size, ends, array, span)
    for k in range(1, len(order)):
        x, y = suffixes[order[k - 1]], suffixes[order[k]]
        n = next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))
        assert common[k] == min(n, span)


@settings(max_examples=100, derandomize=True, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_minima(values, width):
    g = np.array(values, dtype=np.uint64)
    if width > len(g):
        return
    assert S.sliding_minima(g, width).tolist() == [min(values[i:i + width]) for i in range(len(g) - width + 1)]


@settings(max_examples=100, derandomize=True, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5))
def test_each_window_is_in_one_context(texts):
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(b) for b in raw])].astype(np.int64)
    of, anchor, first, last, _ = S.contexts(np.frombuffer(b"".join(raw), np.uint8), offsets, 12, 4)
    windows = [(int(t), w) for t, a, b in zip(of, first, last) for w in range(a, b + 1)]
    assert sorted(windows) == [(t, w) for t, b in enumerate(raw) for w in range(len(b) - 11)]
    assert all(b - a <= 12 - 4 for a, b in zip(first, last))
    # equal windows have equal anchors
    by = {}
    for t, x, a, b in zip(of, anchor, first, last):
        for w in range(a, b + 1):
            assert by.setdefault(raw[t][w:w + 12], x) == x


def listed_share(texts):
    """Share of the contexts whose anchor occurs several times."""
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(b) for b in raw])].astype(np.int64)
    _, anchor, _, _, several = S.contexts(np.frombuffer(b"".join(raw), np.uint8), offsets, S.SPAN_BYTES, S.GRAM_BYTES)
    _, at, n = np.unique(anchor, return_inverse=True, return_counts=True)
    return float(((n[at] > 1) | several).mean())


def test_short_repeats_are_not_looked_at_again():
    """Texts of phrases that all occur many times, but no 200 bytes do."""
    rng = random.Random(8)
    phrases = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(40)) for _ in range(400)]
    texts = ["".join(rng.choice(phrases) for _ in range(25)) for _ in range(200)]
    assert listed_share(texts) < 0.1
    assert listed_share(texts + texts) == 1


@pytest.mark.parametrize("period", [1, 2, 50, 120, 170])
def test_periodic_text_has_few_contexts(period):
    rng = random.Random(period)
    raw = np.frombuffer(bytes(rng.choice(b"abcdefgh") for _ in range(period)) * (20000 // period), np.uint8)
    of, _, first, last, _ = S.contexts(raw, np.array([0, len(raw)]), S.SPAN_BYTES, S.GRAM_BYTES)
    assert len(of) <= len(raw) / 30
    assert [w for b, e in zip(first, last) for w in range(b, e + 1)] == list(range(len(raw) - S.SPAN_BYTES + 1))


@settings(max_examples=200, derandomize=True, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=40).map(lambda b: bytes(x % 2 + 97 for x in b)), st.integers(1, 2)),
                min_size=1, max_size=8), st.integers(1, 40))
def test_repeated_windows(contexts, span):
    """Each distinct window of several places, or of a context that occurs twice; and one of each."""
    contexts = list({t: n for t, n in contexts if len(t) >= span}.items())
    if not contexts:
        return
    again, one = S.repeated_windows([t for t, _ in contexts], np.array([n for _, n in contexts]), span)
    windows = [[t[i:i + span] for i in range(len(t) - span + 1)] for t, _ in contexts]
    count = {}
    for listed, (_, n) in zip(windows, contexts):
        for w in listed:
            count[w] = count.get(w, 0) + n
    assert [m.tolist() for m in again] == [[count[w] > 1 for w in listed] for listed in windows]
    chosen = [w for m, listed in zip(one, windows) for x, w in zip(m, listed) if x]
    assert sorted(chosen) == sorted(count)
