"""Vector code compression: product codes whose codebooks come from active-entry Lloyd rounds.

Vectors are cut into equal parts, and every part position has a codebook.  A round assigns
each part to the nearest entry and then moves every used entry to the mean of its parts.  A
row keeps the entry of each part and the exact distance to it.  In the next round a part whose
entry stayed where it was compares only the entries that moved with that stored distance (the
others are as far as before, and none was nearer); a part whose entry moved compares all.
Equal distances go to the lower index either way, so codes are those of full scans.

The codebooks are of fixed size (parts x entries x components of a part) and travel between
driver and tasks.  Rows stay where they are: a round writes them with their new state, and
tasks send sums and counts of entries, which are added up before the driver sees them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelift.llm.common import read_table
from tunelift.llm.vectors import matrix, number_type, scaled, usable
from tunelift.session import materialize

PARTS = 4
ENTRIES = 256           # of a codebook, at most (an index is one byte)
ROUNDS = 4
STEP_ROWS = 4096        # rows compared at a time

STATE = [T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("far", T.ArrayType(T.LongType()))]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of whole numbers, exact in the type of the arguments."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest entry, the first of equal ones."""
    d = distances(x, entries)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def reassigned(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray,
               far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``nearest`` from the assignment before the entries in ``moved`` (a mask) moved, and the
    number of comparisons made."""
    at, far = at.copy(), far.copy()
    active = np.flatnonzero(moved)
    again = moved[at]
    if again.any():
        at[again], far[again] = nearest(x[again], entries)
    kept = np.flatnonzero(~again)
    if len(active) and len(kept):
        i, d = nearest(x[kept], entries[active])
        i = active[i]
        better = (d < far[kept]) | ((d == far[kept]) & (i < at[kept]))
        at[kept[better]], far[kept[better]] = i[better], d[better]
    return at, far, int(again.sum()) * len(entries) + len(kept) * len(active)


def _cut(lists: pa.Array, dims: int, parts: int, dtype: type) -> np.ndarray:
    """(row, part, component)"""
    return matrix(lists, dims, dtype).reshape(-1, parts, dims // parts)


def first_books(rows: DataFrame, id: str, dims: int, parts: int, entries: int, dtype: type) -> np.ndarray:
    """(part, entry, component) from the rows with the smallest ids (null ids last; equal ids
    by vector)."""
    found = rows.select(id, "x").orderBy(F.col(id).asc_nulls_last(), "x").limit(entries).toArrow()
    return _cut(found["x"].combine_chunks(), dims, parts, dtype).transpose(1, 0, 2).copy()


def assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None = None) -> DataFrame:
    """``rows`` with ``code`` and ``far`` of each part; ``moved`` (part, entry) tells which entries
    differ from those that the state in ``rows`` was made with (None: no state yet)."""
    keep = [c for c in rows.columns if c not in ("code", "far")]
    shared = rows.sparkSession.sparkContext.broadcast((books, moved))
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, changed = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_ROWS):
                b = whole.slice(start, STEP_ROWS)
                x = _cut(b["x"], parts * width, parts, entries.dtype.type)
                if changed is None:
                    state = [nearest(x[:, p], entries[p]) for p in range(parts)]
                else:
                    at, far = matrix(b["code"], parts, np.int64), matrix(b["far"], parts, entries.dtype.type)
                    state = [reassigned(x[:, p], entries[p], changed[p], at[:, p], far[:, p])[:2] for p in range(parts)]
                code = np.stack([s[0] for s in state], axis=1).astype(np.int32)
                far = np.stack([s[1] for s in state], axis=1).astype(np.int64)
                yield pa.record_batch([*[b[c] for c in keep], pa.array(list(code), pa.list_(pa.int32())),
                                       pa.array(list(far), pa.list_(pa.int64()))], names=[*keep, "code", "far"])

    return rows.mapInArrow(run, T.StructType([*rows.select(*keep).schema.fields, *STATE]))


def entry_sums(rows: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(part, entry, n, sums) over all rows that are assigned to each entry; a task sends a row
    for each entry that it uses."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), dtype=np.int64)
        n = np.zeros((parts, entries), dtype=np.int64)
        for b in batches:
            x, code = _cut(b["x"], parts * width, parts, np.int64), matrix(b["code"], parts, np.int64)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, first = np.unique(code[order, p], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(x[order, p], first, axis=0)
                    n[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(n)
        for i in range(width):
            yield pa.record_batch([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(np.full(len(p), i), pa.int32()),
                                   pa.array(n[p, e]), pa.array(total[p, e, i])], names=["part", "entry", "i", "n", "total"])

    return (rows.select("x", "code").mapInArrow(run, "part int, entry int, i int, n long, total long")
            .groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))


def means(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The entries after a round: floor(sum / count) of each component; unused ones stay."""
    out = books.copy()
    r = sums.toArrow()   # parts x entries x components rows at most
    at = tuple(r[c].to_numpy() for c in ("part", "entry", "i"))
    out[at] = r["total"].to_numpy() // r["n"].to_numpy()
    return out


def encode(rows: DataFrame, id: str = "id", parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Product codes of ``rows`` (``id``, x array<int>, further columns, which are kept), and the
    codebooks (part, entry, component).

    Added columns: ``code`` array<int> (an index for each part) and ``far`` array<long> (squared
    distances); columns of these names are replaced.  Rows with a null vector are left out.
    Vectors end in zeros up to the longest length, rounded up to a multiple of ``parts`` (empty
    vectors are all zeros).  With fewer rows than ``entries`` a codebook has one entry a row, an
    empty table has none; repeated rows and null ids count like others, null ids as the largest.
    Sums are exact; where a product might not fit a long, an ArithmeticError says so."""
    rows = materialize(rows.where("x is not null"), "vectors")
    top = F.greatest(F.abs(F.array_max("x").cast("long")), F.abs(F.array_min("x").cast("long")))
    s = rows.agg(F.max(F.size("x")).alias("dims"), F.max(top).alias("top")).first()
    dims = -(-max(s["dims"] or 0, 1) // parts) * parts
    dtype = number_type(dims // parts, 2 * (s["top"] or 0))  # a difference is at most twice as large
    books = first_books(rows, id, dims, parts, entries, dtype)
    if not books.shape[1]:
        keep = [f for f in rows.schema.fields if f.name not in ("code", "far")]
        return rows.sparkSession.createDataFrame([], T.StructType([*keep, *STATE])), books
    state = materialize(assigned(rows, books), "codes")
    for _ in range(rounds):
        after = means(books, entry_sums(state, books.shape))
        moved = (after != books).any(axis=2)
        books = after
        state = materialize(assigned(state, books, moved), "codes")
    return state, books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def op12_vector_codes(spark, sf_dir):
    """Codes of all embeddings with a usable vector."""
    e = read_table(spark, sf_dir, "embeddings").where(usable("embedding"))
    codes, books = encode(e.select("vec_id", "label", scaled("embedding", 1024).alias("x")), id="vec_id")
    hexes = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    rows = materialize(codes.select("vec_id", "label", F.concat_ws("", hexes).alias("code"),
                                    F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error")), "coded")
    # stored, so that both sides of the join are plain shuffles and a hot label can be split
    by_label = materialize(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))
