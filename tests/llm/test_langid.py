"""Language identification: edge cases and held-out accuracy."""

import zlib

from pyspark.sql import functions as F

from conftest import SF_CHECK
from tunelift.llm import langid as L


def test_edge_cases(make_docs):
    train = make_docs([(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog and the house " * 20, "en"), ("le chat et le chien et la maison " * 20, "fr"),
         (None, "en"), ("no label", None), ("123 456", "zz")])], extra=("at", "rank"))
    learned = L.learn_dictionaries(train)
    assert sorted(learned) == ["en", "fr"] and len({len(d) for d in learned.values()}) == 1
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the house and the cat"), (4, "the house and the cat"),
            (None, "la maison et le chat"), (5, "x"), (6, "THE DOG AND THE HOUSE " * 20000)]
    got = {r["doc_id"]: r for r in L.identify(make_docs(rows, extra=("letters", "score")), learned).collect()}
    assert [got[i]["lang_best"] for i in (1, 2, 3, 4, None, 6)] == ["und", "und", "und", "en", "fr", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] == 0
    assert got[5]["lang_best"] in ("en", "fr") and got[5]["lang"] == "und"  # too short to tell: rejected
    assert L.identify(make_docs(rows), learned).count() == len(rows)


def test_nothing_learned_and_one_language(make_docs):
    rows = make_docs([(1, "some text")])
    assert L.learn_dictionaries(make_docs([])) == {}
    assert [r["lang"] for r in L.identify(rows, {}).collect()] == ["und"]
    assert [(r["lang"], r["score"]) for r in L.identify(rows, {"en": b"text " * 9}).collect()] == [("en", 1.0)]
    assert L.identify(make_docs([]), {"en": b"text"}).collect() == []


def test_sample_is_bounded(make_docs):
    train = make_docs([(i, f"word{i} " * 9, "en") for i in range(400)])
    learned = L.learn_dictionaries(train, sample_docs=32, sample_chars=10)
    assert len(learned["en"]) <= 32 * 11


def test_held_out_accuracy(spark):
    found = L.op5_compression_langid(spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(held) >= 0.95 * len(held)
    assert found.agg(F.min("score"), F.max("score")).first()[0] >= 0


def test_one_short_text_shortens_no_other_dictionary(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    held = L.id_remainder("doc_id", 4) == 2
    train = docs.where(~held)
    short = spark.createDataFrame([(-1, "hola amigos", "zz")], "doc_id long, text string, lang string")
    alone, both = L.learn_dictionaries(train), L.learn_dictionaries(train.unionByName(short))
    assert {k: v for k, v in both.items() if k != "zz"} == alone and "hola amigos" in both["zz"].decode()
    rows = L.identify(docs.where(held), both).join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    assert sum(r["lang_best"] == r["true"] for r in rows) >= 0.95 * len(rows)
    # eleven bytes are too few to compress, with any dictionary
    assert L.identify(short.withColumn("text", F.repeat("text", F.lit(3))), both).first()["lang_best"] == "zz"


def test_identify_matches_plain_compression(make_docs):
    """Every text in blocks, one raw-content dictionary a language, the smallest sum wins."""
    import random

    import zstandard
    rng = random.Random(4)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(60)]
             for lang, letters in (("aa", "abcdefgh"), ("bb", "klmnopqr"), ("cc", "stuvwxyzé"))}
    learned = {lang: " ".join(rng.choice(w) for _ in range(400)).encode() for lang, w in words.items()}
    rows = [(i, " ".join(rng.choice(words[rng.choice(["aa", "bb", "cc"]) if rng.random() < 0.2 else "abc"[i % 3] * 2])
                         for _ in range(rng.choice([1, 5, 40, 3000])))) for i in range(30)] + [(99, "12 34"), (98, None)]
    for r in L.identify(make_docs(rows), learned).collect():
        text = dict(rows)[r["doc_id"]]
        if r["doc_id"] >= 98:
            assert (r["lang_best"], r["score"]) == ("und", 0.0)
            continue
        data, sizes = text.lower().encode(), {}
        for lang, d in learned.items():
            z = zstandard.ZstdCompressor(level=L.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                         write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(z.compress(data[i:i + L.BLOCK_BYTES])) for i in range(0, len(data), L.BLOCK_BYTES))
        best, second = sorted(sizes, key=lambda k: (sizes[k], k))[:2]
        assert r["lang_best"] == best and abs(r["margin"] - (1 - sizes[best] / sizes[second])) < 1e-12


def test_a_hot_id_sends_one_text(make_docs):
    rows = [(7, f"the same id again and again {i:03}", "en") for i in range(300)] + [(8, "ein anderer text", "de")]
    assert L.learn_dictionaries(make_docs(rows)) == L.learn_dictionaries(make_docs([rows[0], rows[-1]]))
