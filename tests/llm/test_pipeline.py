"""The pipeline: stage by stage on a small corpus, and run() on the smallest tables."""

import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def corpus():
    """rows (doc_id, text, lang, source) and quality labels."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdehilnorst") for _ in range(rng.randint(2, 8))) for _ in range(900)]

    def line():
        return " ".join(rng.choice(vocabulary) for _ in range(40)).capitalize() + "."

    shared = line()
    good = [(i, "\n".join(line() for _ in range(4)), "en", "abc"[i % 3]) for i in range(60)]
    rows = good + [(100 + i, "\n".join(line().upper().replace(" ", "!! ") for _ in range(4)), "en", "a") for i in range(30)]
    rows += [(200 + i, f"{line()}\n{shared}\n{line()}", "en", "b") for i in range(10)]     # one line that ten share
    rows += [(300, good[3][1], "en", "c"), (301, good[3][1], "en", "a")]                       # exact copies
    one = line().replace(".", "") + " " + " ".join(rng.choice(vocabulary) for _ in range(120))
    rows += [(400, one, "en", "a"), (401, one + " and a few more words", "en", "b")]           # near copies of one line
    rows += [(500, None, "en", "a"), (501, "", "en", None), (502, "ok", "en", "c"), (None, line(), "en", "b")]
    labels = [(i, 1, 0) for i, *_ in good[:40]] + [(100 + i, 0, 0) for i in range(20)]
    return rows, labels


@pytest.fixture()
def sf_dir(spark, corpus, tmp_path):
    spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, make_docs, corpus, sf_dir):
    rows, _ = corpus
    docs = make_docs(rows, extra=("quality", "line", "n", "size"))
    seen = {}
    for name, stage in P.STAGES:
        seen[name] = docs = P.materialize(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "packing":
            assert docs.columns == make_docs(rows, extra=("quality", "line", "n", "size")).columns
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in seen.items()}
    # low quality goes, clean documents stay
    assert ids["quality"] == {r[0] for r in rows} - set(range(100, 130))
    # copies lose all their lines and go; the shared line stays once; no other line is lost
    assert ids["lines"] == ids["quality"] - {300, 301, 401} or ids["lines"] == ids["quality"] - {300, 301}
    text = {r["doc_id"]: r["text"] for r in seen["lines"].collect()}
    before = {r[0]: r[1] for r in rows}
    assert all(text[i] == before[i] for i in range(60)) and text[200] == before[200]
    assert all(text[200 + i] == "\n".join(before[200 + i].split("\n")[::2]) for i in range(1, 10))
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in seen["lines"].collect())
    # near copies: one of each group
    assert ids["near_duplicates"] == ids["lines"] - {401}
    # the mix takes words of kept documents only, none more than three times
    words = {}
    for r in seen["mixing"].collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert set(words) <= ids["near_duplicates"] - {500, 501}
    assert all(n <= 3 * len(text[i].split()) for i, n in words.items())
    # packing: gapless sequences of at most 1024 tokens
    by = {}
    for r in seen["packing"].collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in by.values():
        ends = [0] + [o + n for o, n in sorted(x)]
        assert [o for o, _ in sorted(x)] == ends[:-1] and ends[-1] <= 1024


def test_empty_table(spark, make_docs, sf_dir):
    docs = make_docs([])
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, sf_dir), f"empty-{name}")
        assert docs.count() == 0


def test_run(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "packing"]
