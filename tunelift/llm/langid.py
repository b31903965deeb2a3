"""Language identification by compression.

For every language a raw-content Zstandard dictionary is cut from a bounded sample of its
training texts.  A text is lower-cased, compressed in blocks with each dictionary in turn,
and belongs to the language whose dictionary leaves the fewest bytes in all.  Where the
best two are nearly equal, the decision is marked as rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunelift.llm.common import id_remainder, read_table
from tunelift.session import materialize

STRATA = 16                # hash strata from which the sample of a language is drawn
SAMPLE_DOCS = 64           # training documents sampled for each language, in all strata
SAMPLE_CHARS = 2048        # characters of each of them that go into the dictionary
DICTIONARY_BYTES = 32 << 10
BLOCK_BYTES = 4096         # a text is compressed in blocks, so a long one still leans on the dictionary
LEVEL = 9                  # lower levels miss the short matches that tell languages apart
MIN_MARGIN = 0.005         # share of the second-best size under which a decision is rejected
UNDETERMINED = "und"
RESULT = "doc_id long, lang_best string, lang string, score double, margin double"


def learn_dictionaries(train: DataFrame, sample_docs: int = SAMPLE_DOCS,
                       sample_chars: int = SAMPLE_CHARS,
                       dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary bytes of each language of ``train`` (doc_id, text, lang).

    The sample is, of each of STRATA hash strata of a language, the documents with the
    smallest hash, at most ``sample_docs`` a language in all; only their ids are ranked (the
    limit also applies before the shuffle), and only their first ``sample_chars`` characters reach the driver: at most
    languages x sample_docs x sample_chars.  A language's dictionary is the end of its own sample,
    ``dictionary_bytes`` at most; a smaller sample is repeated to the bytes of the largest, so
    a language with little text shortens no other's.  Of rows that share doc_id and lang the
    smallest text teaches; an empty table teaches nothing (no dictionaries).  Rows with a null text or lang, and texts
    without a letter, teach nothing."""
    usable = train.where("text is not null and lang is not null").where(
        F.regexp_like("text", F.lit(r"\p{L}")))
    rank = F.row_number().over(W.partitionBy("lang", F.pmod("at", F.lit(STRATA))).orderBy("at", "doc_id"))
    chosen = materialize(
        usable.select("doc_id", "lang", F.xxhash64("doc_id", "lang").alias("at"))
        .withColumn("rank", rank).where(F.col("rank") <= max(1, sample_docs // STRATA))
        .select("doc_id", "lang", "at").distinct(), "language-sample")
    rows = (usable.select("doc_id", "lang", F.substring("text", 1, sample_chars).alias("text"))
            .join(chosen, ["doc_id", "lang"])
            # an id that very many rows share sends one of its texts, the first
            .groupBy("doc_id", "lang", "at").agg(F.min("text").alias("text")).select("lang", "at", "text").collect())
    out: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["at"], r["text"])):
        out.setdefault(row["lang"], []).append(row["text"].lower().encode())
    # every language keeps its sample; a small one is repeated to the bytes of the largest
    whole = {lang: b" ".join(x) for lang, x in out.items()}
    even = min(dictionary_bytes, max(map(len, whole.values()), default=0))
    return {lang: b" ".join([x] * -(-(even + 1) // (len(x) + 1)))[-even:] for lang, x in whole.items()}


def compressed_sizes(text: str, presses: list, block_bytes: int = BLOCK_BYTES) -> list[int]:
    """Bytes that each compressor needs for the whole text."""
    data = text.lower().encode()
    blocks = [data[i:i + block_bytes] for i in range(0, len(data), block_bytes)]
    return [sum(len(p.compress(b)) for b in blocks) for p in presses]


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL) -> tuple[list[str], list]:
    langs, presses = sorted(dictionaries), []
    for lang in langs:
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        presses.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                write_checksum=False, write_dict_id=False))
    return langs, presses


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Language of every text: doc_id, lang_best, lang, score, margin (RESULT).

    ``lang_best`` is the language with the smallest size (ties: the first by name);
    ``lang`` is the same, but ``und`` where the margin is under ``min_margin``.  margin is
    the lead over the second best as a share of the latter; score is the softmax weight of
    the best, with sizes measured in the square root of their own scale, 0 to 1.  A null
    text, one without a letter, and every text if no language was learned give ``und``,
    score 0 and margin 0.  One learned language wins always, with score 1.  Repeated rows
    and null ids are kept as they are; an empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, presses = compressors(dictionaries)
        for batch in batches:
            out = []
            for text, letters in zip(batch["text"], batch["letters"].to_pylist()):
                if not letters or not langs:
                    out.append((UNDETERMINED, UNDETERMINED, 0.0, 0.0))
                    continue
                sizes = compressed_sizes(text.as_py(), presses, block_bytes)
                best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
                rest = [s for i, s in enumerate(sizes) if i != best]
                margin = 1 - sizes[best] / min(rest) if rest else 1.0
                scale = max(4.0, math.sqrt(sizes[best]))
                score = 1 / sum(math.exp((sizes[best] - s) / scale) for s in sizes)
                out.append((langs[best], langs[best] if margin >= min_margin else UNDETERMINED,
                            score, margin))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.record_batch([batch["doc_id"], pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                   pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                                  names=["doc_id", "lang_best", "lang", "score", "margin"])

    return rows.mapInArrow(run, RESULT)


def op5_compression_langid(spark, sf_dir):
    """Language of all documents, learned from those with crc32(doc_id) % 4 other than 2."""
    docs = read_table(spark, sf_dir, "documents")
    train = docs.where(F.coalesce(id_remainder("doc_id", 4) != 2, F.lit(False)))
    found = identify(docs, learn_dictionaries(train))
    return found.select("doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        F.col("lang_best").alias("lang_pred"), "score",
                        ((F.col("lang") == UNDETERMINED) & (F.col("lang_best") != UNDETERMINED)).alias("rejected"))
