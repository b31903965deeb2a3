"""N-gram Jaccard join: documents whose sets of word shingles are similar.

Texts with equal sets are one class, found by a 128-bit digest.  Classes meet in tiles: a
tile is a band of set sizes (a class near the upper edge of its band also enters the next,
so sizes that can link always meet) and one of many keys of min-wise hashes.  The number of
keys follows from the threshold: two sets exactly at it share no tile with a probability
under ``MISS``, more similar ones with far less.

Within a tile a pair is first bounded by its hashed bitmaps: each bit is the parity of the
shingles that hash to it, so the bits that differ count no more than the shingles that
differ, and the overlap cannot exceed half of (both sizes - differing bits).  Pairs that
pass are decided exactly, by intersecting their sorted arrays.

Pairs are searched as linking.py says: a tile is never expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.llm.common import free_names, read_table, text_or_empty
from tunelift.llm.hashing import LOWER, mix, shingle_hashes, text_slices, word_hashes, words
from tunelift.llm.linking import LEADER_ROUNDS, link_components, open_pairs, shared_tiles
from tunelift.session import materialize

MISS = 1e-11
BAND_RATIO = 1.5
SIGNATURE = "doc_id long, t long, n long, d1 long, d2 long, bitmap binary, tiles array<long>"
_RNG = np.random.default_rng(17)
_MULTIPLIERS = _RNG.integers(0, 2 ** 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 2 ** 64, 1024, dtype=np.uint64)


def tile_plan(percent: int) -> tuple[int, int]:
    """(hashes in a key, keys) for a similarity of ``percent`` / 100."""
    width = 4 if percent >= 85 else 3
    return width, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** width))


def size_bands(most: int) -> np.ndarray:
    """Lower bounds of the bands of set sizes, up to one beyond ``most``."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * BAND_RATIO)))
    return np.array(bounds)


def bitmap(x: np.ndarray) -> bytes:
    """Parity bitmap of a set, of 2 to 4 bits an element (64 bits at least): wide enough for
    the bound to reject nearly all pairs a little under the threshold."""
    width = 1 << max(6, (max(1, len(x)) - 1).bit_length() + 1)
    bit = ((x ^ (x >> np.uint64(29))) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> bytes:
    """The bitmap as it would be at a smaller width (bytes)."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = (int.from_bytes(bits[:half], "little") ^ int.from_bytes(bits[half:], "little")).to_bytes(half, "little")
    return bits


def may_link(na: int, a: bytes, nb: int, b: bytes, percent: int) -> bool:
    """Whether the bound that the bitmaps give on the overlap reaches the threshold."""
    size = min(len(a), len(b))
    differ = (int.from_bytes(folded(a, size), "little") ^ int.from_bytes(folded(b, size), "little")).bit_count()
    return (100 + percent) * ((na + nb - differ) // 2) >= percent * (na + nb)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact: 100 * intersection >= percent * union of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for at, raw, offsets in text_slices(texts):
        raw = LOWER[raw]
        starts, ends, firsts = words(raw, offsets)
        h, begin = shingle_hashes(word_hashes(raw, starts, ends), firsts, k)
        for i in range(len(offsets) - 1):
            yield at + i, np.unique(h[begin[i]:begin[i + 1]])


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """SIGNATURE of each row: size, digest, bitmap and tiles of its set of shingles."""
    width, keys = tile_plan(percent)
    a, b = _MULTIPLIERS[:width * keys], _ADDENDS[:width * keys]

    def tiles(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        low = np.full(len(a), np.uint64(2 ** 64 - 1))
        for i in range(0, len(x), 2048):
            low = np.minimum(low, (x[i:i + 2048, None] * a + b).min(axis=0))
        key = np.zeros(keys, dtype=np.uint64)
        for j in range(width):
            key = mix(key * np.uint64(31) + low[j::width] + np.uint64(j))
        band = int(np.searchsorted(bounds, len(x), side="right")) - 1
        bands = [band, band + 1] if 100 * len(x) >= percent * bounds[band + 1] else [band]
        return np.concatenate([mix(key + np.arange(keys, dtype=np.uint64) * np.uint64(1009)
                                   + np.uint64(c * 0x9E3779B97F4A7C15 % 2 ** 64)) for c in bands])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = size_bands(1 << 40)
        for batch in batches:
            n, d, bits, out = [], [], [], []
            for _, x in shingle_sets(batch["text"], k):
                n.append(len(x))
                d.append(np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), dtype=np.int64))
                bits.append(bitmap(x))
                out.append(_signed(tiles(x, bounds)) if len(x) else np.empty(0, np.int64))
            d = np.array(d).reshape(-1, 2)
            flat = np.concatenate(out) if out else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(t) for t in out])], pa.int32()),
                                             pa.array(flat))
            yield pa.record_batch([batch["doc_id"], batch["t"], pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                                   pa.array(bits, pa.binary()), lists],
                                  names=["doc_id", "t", "n", "d1", "d2", "bitmap", "tiles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("t"),
                       "text").mapInArrow(run, SIGNATURE)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(v, x): the sorted shingle hashes of the classes ``wanted`` (v, rep, d1, d2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = np.column_stack([batch["d1"].to_numpy(), batch["d2"].to_numpy()])
            rows, x = [], []
            for i, s in shingle_sets(batch["text"], k):
                if (np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64) == digests[i]).all():
                    rows.append(i)
                    x.append(s.tobytes())
            yield pa.record_batch([batch["v"].take(pa.array(rows, pa.int64())), pa.array(x, pa.binary())],
                                  names=["v", "x"])

    # the list grows with the corpus: no broadcast, however short it is at a small size; and
    # the texts need no sort to meet it
    j = docs.select(F.col("doc_id").alias("rep"), "text").join(wanted.hint("shuffle_hash"), "rep")
    # a repeated row of the same id and text would give its set twice
    return j.select("v", "d1", "d2", "text").mapInArrow(run, "v long, x binary").dropDuplicates(["v"])


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: bounded by their bitmaps, then decided exactly."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch[c].to_pylist() for c in ("na", "ba", "nb", "bb")]
            ok = pa.array([may_link(*row, percent) for row in zip(*cols)], pa.bool_())
            yield batch.select(["a", "b"]).filter(ok)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                  for x, y in zip(batch["xa"], batch["xb"])]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    for side in "ab":
        pairs = pairs.join(classes.select(F.col("v").alias(side), F.col("n").alias(f"n{side}"),
                                          F.col("bitmap").alias(f"b{side}")), side)
    near = materialize(pairs.mapInArrow(bound, "a long, b long"), "bounded-pairs")
    for side in "ab":
        near = near.join(sets.select(F.col("v").alias(side), F.col("x").alias(f"x{side}")), side)
    return near.mapInArrow(decide, "a long, b long")


def _block_bound(percent: int):
    """The bitmap bound for pairs within a block: sizes and bitmaps of the rows."""

    def bound(i: np.ndarray, j: np.ndarray, values: list) -> np.ndarray:
        n, bits = np.array(values[0]), values[1]
        keep = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        at = np.flatnonzero(keep)
        size = min(map(len, bits))
        m = np.frombuffer(b"".join(folded(b, size) for b in bits), np.uint64).reshape(len(bits), -1)
        step = max(1, (1 << 20) // m.shape[1])
        for s in range(0, len(at), step):
            p, q = i[at[s:s + step]], j[at[s:s + step]]
            differ = np.bitwise_count(m[p] ^ m[q]).sum(axis=1, dtype=np.int64)
            keep[at[s:s + step]] = (100 + percent) * ((n[p] + n[q] - differ) // 2) >= percent * (n[p] + n[q])
        return keep

    return bound


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80,
                       leader_rounds: int = LEADER_ROUNDS) -> DataFrame:
    """Link documents whose sets of k-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more, and number the components.

    Input columns doc_id and text (others are ignored).  A-Z are lower-cased; words are runs
    of characters other than the six ASCII white spaces; a text with fewer than k words has
    them all as its only shingle.  Returns one row per input row: doc_id, n_shingles,
    component_id (the smallest doc_id that links reach, itself included), text_hash.

    Null, empty and wordless texts have no shingle, link with nothing and are their own
    component.  A row without doc_id links with nothing and has no component_id.  Each row
    of a repeated doc_id is a document of its own; the ids of what it reaches decide.
    Shingles are compared by 64-bit hashes, sets by 128-bit digests."""
    sig = materialize(signatures(docs, k, percent), "signatures")
    classes = (sig.where("n > 0 and doc_id is not null").groupBy("d1", "d2")
               .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"),
                    F.first("tiles").alias("tiles"))
               .withColumn("v", F.monotonically_increasing_id()))
    classes = materialize(classes, "classes")  # stored, so v is settled
    members = shared_tiles(classes.select(F.explode("tiles").alias("tile"), "v"))
    wanted = members.select("v").distinct().join(classes.select("v", "rep", "d1", "d2"), "v")
    sets = materialize(_sets(docs, materialize(wanted, "wanted"), k), "sets")
    labels = link_components(
        members, lambda pairs: _verified(pairs, classes, sets, percent),
        lambda now: open_pairs(now, classes, ["n", "bitmap"], _block_bound(percent)), leader_rounds)

    names = classes.select("d1", "d2", "v", "rep")
    if labels is None:
        names = names.withColumn("component_id", F.col("rep"))
    else:
        named = names.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
        smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
        names = named.join(smallest, "label")
    names = materialize(names.select("d1", "d2", "component_id"), "class-components")
    linkable = F.when(F.col("n") > 0, F.col("doc_id"))
    rows = sig.select("doc_id", "t", "n", F.when(linkable.isNotNull(), F.col("d1")).alias("d1"),
                      F.when(linkable.isNotNull(), F.col("d2")).alias("d2"))
    alone = rows.where("d1 is null").select("doc_id", "t", "n", F.col("doc_id").alias("component_id"))
    found = rows.where("d1 is not null").join(names, ["d1", "d2"]).select("doc_id", "t", "n", "component_id")
    return found.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                     F.col("t").alias("text_hash"))


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, with its columns (whatever their names), with one document of each component: the
    one whose doc_id is the smallest.  Documents that link with nothing stay, rows without doc_id
    too, and so do null, empty and wordless texts; rows that repeat both id and text are one
    document.  Whole texts are compared, very long ones like others; an empty table stays empty."""
    id_, t_, hash_ = free_names(docs.columns, "__id", "__t", "__hash")
    found = materialize(jaccard_components(docs, k, percent), "components")
    stays = (found.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
             .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(t_)).distinct())
    j = docs.withColumn(hash_, F.xxhash64(text_or_empty()))
    j = j.join(stays, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(t_)), "left_semi")
    # of rows that repeat both id and text, the smallest by source and language
    copies = j.where("doc_id is not null").dropDuplicates(["doc_id", hash_])
    return copies.unionByName(j.where("doc_id is null")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_ngram_jaccard_join(spark, sf_dir):
    """All documents, 3-word shingles, Jaccard similarity of 0.9 or more."""
    return jaccard_components(read_table(spark, sf_dir, "documents"), k=3, percent=90)
