"""Packing: tokeniser round trip, pieces, capacities."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tunelift.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
EDGE = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (4, "a " * 1023), (5, "a " * 1024),
        (6, "word \n\t é 中文 🙂 ok " * 900), (None, "no id"), (7, "end <|endoftext|> of <|endoftext|>"), (8, " \x00\x07 "),
        (9, "don't WE'LL 12345 ___ \r\n\n x" * 50)]


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=200, derandomize=True, deadline=None)
@given(st.text(max_size=60))
def test_encoder_agrees_with_tokenizers(text):
    assert P.token_ids(text, P.encoder(PATH)) + [2] == ids_of(text)


@settings(max_examples=100, derandomize=True, deadline=None)
@given(st.integers(1, 60), st.integers(1, 20))
def test_piece_bounds(n, most):
    bounds = P.piece_bounds(n, most)
    assert bounds[0][0] == 0 and sum(k for _, k in bounds) == n
    assert all(k == most for _, k in bounds[1:]) and all(0 < k <= most for _, k in bounds)
    assert all(a + k == b for (a, k), (b, _) in zip(bounds, bounds[1:]))


def check_packed(rows, most=1024):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in by.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_pieces_and_sequences(make_docs):
    rows = P.pack(P.token_pieces(make_docs(EDGE, extra=("length", "piece", "shard")))).collect()
    want = []
    for doc_id, text in EDGE:
        ids = np.array(ids_of(text), dtype="<u4")
        want += [(doc_id, i, s, n, zlib.crc32(ids[s:s + n].tobytes())) for i, (s, n) in enumerate(P.piece_bounds(len(ids), 1024))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert check_packed(rows) <= -(-sum(x[3] for x in want) // 1024) + 1


def test_empty_table(make_docs):
    assert P.pack(P.token_pieces(make_docs([]))).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 100, 400))[::-1]
    at = P.best_fit(lengths, (100, 5, 6000 + 100 ** 2 // 2), (1.0, 0.5, 2.0), rule)
    for b in np.unique(at):
        x = lengths[at == b]
        assert x.sum() <= 100 and len(x) <= 5 and (x.astype(float) ** 2).sum() <= 11000


def test_packs_close_to_the_bound():
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 1024, 3000))[::-1]
    at = P.best_fit(lengths, (1024, 1024, 1024 ** 2), (1, 1, 1), "norm")
    assert at.max() + 1 <= 1.02 * lengths.sum() / 1024 + 1


def test_many_shards_and_refusal(spark, make_docs):
    pieces = P.token_pieces(make_docs([(i, "tok " * (i % 50)) for i in range(300)]))
    check_packed(P.pack(pieces, shard_rows=20).collect())
    with pytest.raises(Exception, match="exceeds a capacity"):
        P.pack(P.token_pieces(make_docs([(1, "a b c d")])), capacities=(3, 9, 9)).collect()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_item_goes_to_the_best_bin(rule):
    """Replay of the choices: a bin is opened only if no open one has room in every respect, and
    else the chosen one has the largest weighted dot product, or the smallest residual norm."""
    rng = np.random.default_rng(8)
    for caps, w in (((100, 6, 6000), (1.0, 0.5, 2.0)), ((64, 64, 4096), (1.0, 1.0, 1.0)), ((50, 3, 1200), (2.0, 1.0, 0.1))):
        lengths = np.sort(rng.integers(1, 33, 300))[::-1]
        left = {}
        for n, at in zip(lengths.tolist(), P.best_fit(lengths, caps, w, rule).tolist()):
            d = [n / caps[0], 1 / caps[1], n * n / caps[2]]

            def score(room):
                if rule == "dot":
                    return -sum(x * k * y for x, k, y in zip(room, w, d))
                return sum(k * (x - y) ** 2 for x, k, y in zip(room, w, d))

            fits = {b: score(room) for b, room in left.items() if all(x >= y - 1e-12 for x, y in zip(room, d))}
            if at not in left:
                assert not fits and at == len(left)
                left[at] = [1.0, 1.0, 1.0]
            else:
                assert fits[at] <= min(fits.values()) + 1e-9
            left[at] = [x - y for x, y in zip(left[at], d)]
