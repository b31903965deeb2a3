"""I-Match fingerprints against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tunelift.llm import imatch as M


def edited(rows):
    """(doc_id, text, edited text, next text) by ascending (doc_id, text)."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        out.append((i, t, t[:len(t) - h] + nxt[:h], nxt))
    return out


def words(t):
    return set(re.findall(r"[^\W_]+", t.lower()))


def brute(spark, rows, lex):
    """Prints from the lexicon's ids and masks, likeness from the prints."""
    band = {r["term"]: (r["id"], r["mask"]) for r in lex.collect()}
    order = edited(rows)
    texts = sorted({x for _, t, e, n in order for x in (t, e, n)})
    subsets = [(t, k, [i for i, m in sorted(band[w] for w in words(t) if w in band) if m >> k & 1])
               for t in texts for k in range(M.SUBSETS)]
    hashed = spark.createDataFrame(subsets, "t string, k int, ids array<long>").select(
        "t", "k", F.when(F.size("ids") > 0, F.xxhash64("ids", "k")).alias("h")).collect()
    parts = {}
    for r in hashed:
        parts.setdefault(r["t"], {})[r["k"]] = "-" if r["h"] is None else f"{r['h'] % 2 ** 32:08x}"

    def show(t):
        if not any(w in band for w in words(t)):
            return "text:" + hashlib.sha256(t.encode()).hexdigest()
        return ".".join(parts[t][k] for k in range(M.SUBSETS))

    def near(a, b):
        if a == b:
            return 1.0
        if a.startswith("text:") or b.startswith("text:"):
            return 0.0
        some = [x == y for x, y in zip(a.split("."), b.split(".")) if (x, y) != ("-", "-")]
        return sum(some) / max(1, len(some))

    return [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), show(t), show(e), near(show(t), show(e)), near(show(t), show(n)))
            for i, t, e, n in order]


def random_rows(seed=5, n=80):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    ids = rng.sample(range(-50, 5000), n)
    return [(i, rng.choice([" ", "\n", ", "]).join(rng.choice(vocabulary) for _ in range(rng.choice([1, 8, 60, 200])))) for i in ids]


def check(spark, make_docs, rows, range_rows):
    df = make_docs(rows, extra=("range", "place", "kind", "term", "id", "mask", "of"))
    lex = M.lexicon(df, 0.03, 0.9)
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = sorted(tuple(r[c] for c in cols) for r in M.imatch(df, lex, range_rows).collect())
    assert got == sorted(brute(spark, rows, lex))


def test_many_small_ranges(spark, make_docs):
    check(spark, make_docs, random_rows(), 3)


def test_one_range(spark, make_docs):
    check(spark, make_docs, random_rows(6, 30) + [(9000, None), (9001, ""), (9002, "é"), (9003, "!?")], 512)


def test_far_apart_and_extreme_ids(spark, make_docs):
    rows = random_rows(7, 20) + [(2 ** 62, "a b c"), (-2 ** 63, "x y"), (2 ** 63 - 1, "z z")]
    check(spark, make_docs, rows, 4)


def test_repeated_rows(spark, make_docs):
    rows = [(1, "a b"), (1, "a b"), (1, "c d"), (2, "a c"), (2, "a c")]
    check(spark, make_docs, rows, 1)


def test_single_row_and_empty_table(spark, make_docs):
    check(spark, make_docs, [(5, "one row")], 512)
    assert M.imatch(make_docs([])).collect() == []


def test_rows_without_id(make_docs):
    rows = [(None, "abcd"), (None, None), (1, "a b"), (2, "a c"), (None, "abcd")]
    got = {(r["doc_id"], r["n_chars"]): r for r in M.imatch(make_docs(rows)).collect()}
    assert got[None, 4]["edited_sha256"] == hashlib.sha256(b"ab").hexdigest() and got[None, 4]["near_next"] == 0.0
    assert got[None, 0]["near_next"] == 1.0 and len(M.imatch(make_docs(rows)).collect()) == 5


def test_equal_texts_equal_prints_and_edits_stay_near(spark, make_docs):
    rows = random_rows(8, 120)
    df = make_docs(rows + [(10 ** 6 + i, t) for i, t in rows[:20]])
    got = {r["doc_id"]: r for r in M.imatch(df).collect()}
    for i, t in rows[:20]:
        assert got[i]["fingerprint"] == got[10 ** 6 + i]["fingerprint"]
    long = [r for r in got.values() if r["n_chars"] > 150]
    assert sum(r["near_edited"] for r in long) > 1.5 * sum(r["near_next"] for r in long)


def test_no_python_in_the_plan(spark, make_docs):
    plan = M.imatch(make_docs(random_rows(9, 10)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_a_text_on_a_third_of_the_rows_keeps_its_terms(spark, make_docs):
    rows = [(i, t) for i, (_, t) in enumerate(random_rows(10, 90)) if len(words(t)) > 5]
    rng = random.Random(4)
    common = " ".join(rng.choice(sorted(words(rng.choice(rows)[1]))) for _ in range(80))
    copies = [(1000 + i, common) for i in range(len(rows) // 2)]
    df = make_docs(rows + copies + [(5000, common[:-1] + "!")], extra=("hash", "count"))
    once = make_docs(rows + copies[:1] + [(5000, common[:-1] + "!")])
    assert {r["term"] for r in M.lexicon(df).collect()} == {r["term"] for r in M.lexicon(once).collect()}
    got = {r["doc_id"]: r for r in M.imatch(df).collect()}
    assert all(got[i]["fingerprint"] == got[1000]["fingerprint"] for i, _ in copies)
    assert not got[1000]["fingerprint"].startswith("text:") and got[1000]["near_next"] == 1.0
    x, y = (got[i]["fingerprint"].split(".") for i in (1000, 5000))
    assert sum(a == b for a, b in zip(x, y)) > 0.5 * len(x)  # one character apart


def test_lexicon_is_the_band_of_distinct_texts(make_docs):
    """Document frequencies recounted in plain Python, copies of a text once."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(80)] + ["Élan", "élan", "x1", "中文"]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=rng.randint(0, 25)))
             for _ in range(120)]
    rows = list(enumerate(texts + texts[:30] + [texts[5]] * 60 + [None, ""]))
    counts, distinct = {}, {t or "" for _, t in rows}
    for t in distinct:
        for term in set(re.findall(r"[^\W_]+", t.lower())):
            counts[term] = counts.get(term, 0) + 1
    for lo, hi in ((0.002, 0.2), (0.1, 0.5)):
        want = {t for t, n in counts.items() if max(2, lo * len(distinct)) <= n <= max(2, hi * len(distinct))}
        got = [r["term"] for r in M.lexicon(make_docs(rows), lo, hi).collect()]
        assert sorted(got) == sorted(want) and want
