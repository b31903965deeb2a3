"""Best-fit packing of tokenised documents into fixed-length sequences.

Texts are tokenised where they are read; only one small row per piece moves.  A sequence
has three capacities: tokens, documents and attention cost (the sum of squared lengths).
Pieces are dealt by hash into shards of about ``shard_rows`` rows, and each shard is packed
on its own, longest piece first: among the open sequences that can take the piece under
every capacity, the one with the largest weighted dot product of demand and residual
(``rule="dot"``) or the smallest norm of the residual left (``rule="norm"``) is chosen.
A shard loses at most about one part-filled sequence against packing everything at once.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.llm.common import read_table
from tunelift.session import materialize

SEQUENCE_TOKENS = 1024
SHARD_ROWS = 4096
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict[str, tiktoken.Encoding] = {}


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers JSON file, as an encoder of the same ids.

    The file writes bytes as printable characters: those that are printable stand for
    themselves, the others follow from code point 256 on, in order."""
    if path not in _ENCODERS:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        _ENCODERS[path] = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def token_ids(text: str, enc: tiktoken.Encoding) -> list[int]:
    """Ids without added tokens; a special token written in the text keeps its own id."""
    if any(s in text for s in enc.special_tokens_set):
        return enc.encode(text, allowed_special="all")
    return enc.encode_ordinary(text)


def piece_bounds(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than ``most``."""
    first = n % most or most
    return [(0, min(first, n))] + [(s, most) for s in range(first, n, most)]


def token_pieces(docs: DataFrame, path: str | None = None, most: int = SEQUENCE_TOKENS,
                 end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``most`` ids: doc_id, piece, start, length, ids_crc32.

    A document is the ids of its text followed by ``end_id``, so a null or empty text has
    one id.  Repeated rows give repeated pieces; a null doc_id stays null."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.array(token_ids(text.as_py() or "", enc) + [end_id], dtype="<u4")
                out += [(doc_id, i, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                        for i, (s, n) in enumerate(piece_bounds(len(ids), most))]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacities: Sequence[float], weights: Sequence[float],
             rule: str) -> np.ndarray:
    """Sequence number of each item, items taken in the order given."""
    caps = np.asarray(capacities, dtype=float)
    need = np.column_stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2]) / caps
    w = np.asarray(weights, dtype=float)
    left, name = np.empty((len(lengths), 3)), np.empty(len(lengths), dtype=np.int64)
    chosen = np.empty(len(lengths), dtype=np.int64)
    open_bins = bins = 0
    for i, d in enumerate(need):
        room = left[:open_bins]
        fits = np.flatnonzero((room >= d - 1e-12).all(axis=1))
        if len(fits):
            after = room[fits] - d
            score = -(room[fits] * (w * d)).sum(axis=1) if rule == "dot" else (w * after * after).sum(axis=1)
            at = fits[np.argmin(score)]
            left[at] -= d
        else:
            at = open_bins
            left[at], name[at] = 1.0 - d, bins
            open_bins, bins = open_bins + 1, bins + 1
        chosen[i] = name[at]
        if left[at].min() <= 1e-12:  # full in some respect: closed
            open_bins -= 1
            left[at], name[at] = left[open_bins], name[open_bins]
    return chosen


def pack(pieces: DataFrame, capacities: Sequence[float] | None = None,
         weights: Sequence[float] = (1.0, 1.0, 1.0), rule: str = "norm",
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences.

    ``capacities``: tokens, documents and attention cost of a sequence; by default 1024
    tokens, and no more documents or attention than 1024 tokens can have.  A piece that
    exceeds a capacity by itself is refused.  Adds sequence_id (shard number times 2**32
    plus a running number) and offset, gapless from 0.  Ties in length are broken by
    doc_id and piece; an empty table packs into nothing."""
    caps = list(capacities or (SEQUENCE_TOKENS, SEQUENCE_TOKENS, SEQUENCE_TOKENS ** 2))
    pieces = materialize(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_rows))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True],
                                kind="stable")
        lengths = rows["length"].to_numpy()
        if len(lengths) and (lengths[0] > caps[0] or 1 > caps[1] or float(lengths[0]) ** 2 > caps[2]):
            raise ValueError("a piece exceeds a capacity by itself")
        at = best_fit(lengths, caps, weights, rule)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.r_[True, np.diff(at[order]) != 0]
        base = np.maximum.accumulate(np.where(first, ends - lengths[order], 0))
        offset = np.empty(len(rows), dtype=np.int64)
        offset[order] = ends - lengths[order] - base
        return rows.drop(columns="shard").assign(sequence_id=(int(key[0]) << 32) + at, offset=offset)

    return (pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
            .groupBy("shard").applyInPandas(run, PIECES + ", sequence_id long, offset long"))


def op1_best_fit_packing(spark, sf_dir):
    """All documents, packed into sequences of at most 1024 tokens."""
    return pack(token_pieces(read_table(spark, sf_dir, "documents")))
