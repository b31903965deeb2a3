"""Secret scan: patterns against the plain rules, segmentation against all segmentations."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tunelift.llm import secret_scan as S

RANKS = {w: i + 1 for i, w in enumerate(["password", "horse", "the", "correct", "staple", "abc", "cat"])}


def plain_base(text):
    """The patterns as they are stated: leftmost matches, those that are too short dropped."""
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token"))
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({names}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f for _, _, f in sorted(found)]


PIECES = st.sampled_from(["password", "PassWd", "token", "SECRET", "api_key", "apiKey", "ſecret", "toKen", "=", ":", " ", '"', "'",
                          "abcdefghijkl", "deadbeef", "0123456789abcdef", "AKIA", "AKIAABCDEFGHIJKLMN", "Z9", "é", "\U0001f600", "\n",
                          "abc", ".", "password=token=short", "password=secret: "])


@settings(max_examples=300, derandomize=True, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans(text):
    got = S.secrets(text, RANKS)
    assert [f"{k}:{a}:{b}" for k, a, b, _, _ in got if k != "guess"] == plain_base(text)
    assert all(text[a:b] == v for _, a, b, v, _ in got)
    hit = bool(re.search(S._HINT, text))
    assert hit or not got  # a text without a hint is not looked at


def every_segmentation(value, ranks):
    found = {}
    for i, end, _, bits in S.spans(value, ranks):
        found[i, end] = min(bits, found.get((i, end), 1e9))
    n = len(value)

    def rest(i):
        if i == n:
            return 0.0
        costs = []
        for end in range(i + 1, n + 1):
            span = min(sum(map(S.char_bits, value[i:end])), found.get((i, end), 1e9))
            costs.append(S.SPAN_BITS + span + rest(end))
        return min(costs)

    return rest(0)


@settings(max_examples=120, derandomize=True, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "cat", "C4t", "the", "12", "1999", "qwe", "ab", "X", "é", "!", "aaa"]), max_size=6)
       .map("".join).filter(lambda v: len(v) <= 11))
def test_segmentation_is_the_cheapest(value):
    bits, parts = S.segmented(value, RANKS)
    assert bits == pytest.approx(every_segmentation(value, RANKS))
    assert [a for a, _, _ in parts] == [0, *[b for _, b, _ in parts]][:len(parts)] and (parts[-1][1] if parts else 0) == len(value)


@pytest.mark.parametrize("value, kinds", [
    ("correcthorsestaple", ["word"] * 3), ("P4ssword1999", ["word", "date"]), ("2024-05-17", ["date"]), ("17052024", ["date"]),
    ("abababababab", ["repeat"]), ("qwertyuiop", ["walk"]), ("abcdefghijk", ["walk"]), ("x7Kq!9zP", ["brute"]), ("catcatcat", ["repeat"]),
])
def test_kinds_of_spans(value, kinds):
    assert [k for _, _, k in S.segmented(value, RANKS)[1]] == kinds


@pytest.mark.parametrize("text, guessed", [
    ("password: your-password-here", []), ("pwd = qwertyuiop12345", []), ("passphrase: aaaaaaaaaaaaaaaaaaaa", []),
    ("the compass: x7Kq9zPw3RtY!vB", []), ("pwd=x7Kq9zPw3RtY!vB.", ["x7Kq9zPw3RtY!vB"]), ("Authorization := Zm9vYmFyQmF6UXV4MTk4", ["Zm9vYmFyQmF6UXV4MTk4"]),
    ("access-key => 'kd93#sLw02!qqPz8'", ["kd93#sLw02!qqPz8"]), ("secret: short", []),
])
def test_values_that_are_costly_to_guess(text, guessed):
    ranks = RANKS | {"your": 8, "here": 9}
    assert [v for k, _, _, v, _ in S.secrets(text, ranks) if k == "guess"] == guessed


def test_time_grows_with_length_alone():
    assert S.segmented("a" * 60_000, RANKS)[0] < 40
    bits, parts = S.segmented("q8Z!" + "as" * 20_000 + "İ" * 3, RANKS)
    assert bits < 120 and len(parts) < 6


def test_words_come_from_outside_credential_values(spark, make_docs):
    docs = make_docs([(i, "Plain WORDS élan token: zebrazebrazebra here") for i in range(20)] + [(50, None), (51, "plain again")])
    ranks = S.word_ranks(docs, words=4)
    assert set(ranks) - set(S.COMMON) == {"plain", "words", "élan"} and ranks["plain"] < ranks["words"]  # with "token" or "here"
    assert "zebrazebrazebra" not in S.word_ranks(docs)


def test_edge_cases(spark, make_docs):
    token = "token = \"" + "0a1b2c3d" * 5 + '"'
    long = "plain words " * 100_000 + token
    rows = [(1, token), (1, token), (None, "é😀 " + token), (2, None), (3, ""), (4, long), (5, "no secret here")]
    docs = make_docs(rows, extra=("secrets", "kind", "scanned", "scanned_", "bits"))
    out = S.find_secrets(docs, RANKS)
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), [(s["kind"], s["start"], s["end"]) for s in r["secrets"]]) for r in out.collect())
    n = len(long) - len(token)
    spans = [("assign", 0, 49), ("hex", 9, 49), ("guess", 9, 49)]
    assert got == sorted([("1", spans), ("1", spans), ("None", [(k, a + 3, b + 3) for k, a, b in spans]), ("2", []), ("3", []),
                          ("4", [(k, a + n, b + n) for k, a, b in spans]), ("5", [])])
    none = make_docs([])
    assert S.find_secrets(none, S.word_ranks(none)).collect() == []


def test_query_on_its_table(spark):
    got = S.op13_secret_scan(spark, SF_CHECK).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        base = plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b.startswith(k) for b in base) for k in S.KINDS[:3]]
        every = r["spans"].split(",") if r["spans"] else []
        assert [s for s in every if not s.startswith("guess")] == base and len(every) == len(base) + r["n_guess"]
    assert sum(r["n_guess"] for r in got) >= sum(r["n_assign"] for r in got) > 0
