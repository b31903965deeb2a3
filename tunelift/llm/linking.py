"""Similarity links among rows that share a tile, without expanding a tile into all pairs.

A tile is any key that rows which can link share.  In a few rounds every member of a tile
is compared with one leader of it, another in each round, and tiles whose members already
are in one component drop out.  Only what then still lies in different components is
compared in blocks of tile members, so no group is ever held by one task, and no link
between different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.llm.components import connected_components
from tunelift.session import materialize

LEADER_ROUNDS = 2
BLOCK_ROWS = 512


def shared_tiles(tiles: DataFrame) -> DataFrame:
    """Of ``tiles`` (tile long, v long; each pair once) the rows whose tile has several."""
    several = materialize(tiles.groupBy("tile").count().where("count > 1").select("tile"), "shared-tiles")
    # a hash join: the tiles of all rows need no sort to be looked up in the shared ones
    return materialize(tiles.join(several.hint("shuffle_hash"), "tile"), "tile-members")


def meetings(members: DataFrame, facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (tile, bi, bj, block, label, v, tiles, *columns): which members are compared in which step.

    The largest component of a tile is kept apart: its blocks meet those of the other members,
    never each other, so a tile of very many linked rows and a few strangers takes a copy of
    each row for every BLOCK_ROWS strangers."""
    by_label = members.groupBy("tile", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(by_label.groupBy("tile").agg(
        F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1").select(
            "tile", F.col("main.label").alias("main"),
            F.ceil(F.col("main.n") / BLOCK_ROWS).cast("int").alias("main_blocks"),
            F.ceil((F.col("members") - F.col("main.n")) / BLOCK_ROWS).cast("int").alias("blocks")), "open-tiles")
    in_main = F.col("label") == F.col("main")

    def numbers(n: str) -> F.Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    # a block of the largest component has a number below 0; the meetings of a row: (bi, bj)
    block = F.when(in_main, -1 - F.pmod(F.xxhash64("v"), F.col("main_blocks"))).otherwise(
        F.pmod(F.xxhash64("v"), F.col("blocks"))).cast("int")
    with_main = F.transform(numbers("main_blocks"), lambda b: F.struct((-1 - b).alias("bi"), F.col("block").alias("bj")))
    with_rest = F.transform(numbers("blocks"), lambda b: F.struct(
        F.least("block", b).alias("bi"), F.greatest("block", b).alias("bj")))
    return (members.join(counts, "tile").join(facts.select("v", "tiles", *columns), "v").withColumn("block", block)
            .withColumn("meets", F.explode(F.when(in_main, with_rest).otherwise(F.concat(with_main, with_rest))))
            .withColumn("bi", F.col("meets.bi")).withColumn("bj", F.col("meets.bj")))


def _common(tiles: Sequence[Sequence[int]]) -> np.ndarray:
    """How many tiles each two of some rows share."""
    row = np.repeat(np.arange(len(tiles)), [len(t) for t in tiles])
    _, code, n = np.unique(np.concatenate([np.asarray(t, dtype=np.int64) for t in tiles]), return_inverse=True, return_counts=True)
    several = np.cumsum(n > 1) - 1
    met = n[code] > 1
    out = np.zeros((len(tiles), len(tiles)), dtype=np.float32)
    for at in range(0, int(several[-1]) + 1, 1024):  # so many columns at a time
        now = met & (several[code] >= at) & (several[code] < at + 1024)
        has = np.zeros((len(tiles), min(1024, int(several[-1]) + 1 - at)), dtype=np.float32)
        has[row[now], several[code[now]] - at] = 1
        out += has @ has.T
    return out


def open_pairs(members: DataFrame, facts: DataFrame, columns: Sequence[str],
               may_link: Callable[[np.ndarray, np.ndarray, list[list]], np.ndarray],
               needed: Callable[[list[list]], np.ndarray] | None = None) -> DataFrame:
    """Pairs (a, b) of different components that share a tile and pass ``may_link``.  With
    ``needed`` (of the values of the columns: a number for each row) they share as many tiles as
    the one that needs fewer.

    ``members``: (tile, v, label).  ``facts``: (v, tiles, *columns), tiles being all tiles of
    v.  Tiles are cut into blocks of about BLOCK_ROWS members, and pairs of blocks are
    compared, each by one step of bounded size: may_link(i, j, values of the columns) gives
    a mask for the index arrays i and j.  Of the tiles that a pair shares, only the smallest
    gives it, so no pair comes twice."""
    rows = meetings(members, facts, columns)
    fields = ["block", "label", "v", "tiles", *columns]

    def compare(tile: int, within: bool, block: np.ndarray, label: np.ndarray, v: np.ndarray, tiles: pa.Array,
                values: list) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.triu_indices(len(v), 1)
        ok = (label[i] != label[j]) & (within | (block[i] != block[j]))
        i, j = i[ok], j[ok]
        keep = may_link(i, j, values)
        i, j = i[keep], j[keep]
        if not len(i):
            return i, j
        # only rows of pairs that passed: their tiles take longer to look at
        some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        lists, left, right = tiles.take(pa.array(some)).to_pylist(), at[:len(i)], at[len(i):]
        if needed is not None:
            n = needed(values)
            keep = _common(lists)[left, right] >= np.minimum(n[i], n[j])
            i, j, left, right = i[keep], j[keep], left[keep], right[keep]
        sets = {k: set(lists[k]) for k in {*left.tolist(), *right.tolist()}}
        first = np.array([min(sets[x] & sets[y]) == tile for x, y in zip(left.tolist(), right.tolist())], dtype=bool)
        return np.minimum(v[i], v[j])[first], np.maximum(v[i], v[j])[first]

    def groups(rows: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        """The pairs of the steps that begin at ``starts`` (one more: where the last ends)."""
        whole = rows.combine_chunks().to_batches()[0]
        key = [whole[c].to_numpy() for c in ("tile", "bi", "bj")]
        block, label, v = (whole[c].to_numpy() for c in ("block", "label", "v"))
        values = [x.to_numpy() if pa.types.is_primitive(x.type) and not x.null_count else x for x in (whole[c] for c in columns)]
        for b, e in zip(starts, starts[1:]):
            if e - b > 1:
                x, y = compare(int(key[0][b]), bool(key[1][b] == key[2][b]), block[b:e], label[b:e], v[b:e],
                               whole["tiles"].slice(b, e - b),
                               [x[b:e] if isinstance(x, np.ndarray) else x.slice(b, e - b).to_pylist() for x in values])
                if len(x):
                    yield pa.record_batch([pa.array(x), pa.array(y)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            key = [rows[c].to_numpy() for c in ("tile", "bi", "bj")]
            starts = [0, *(1 + np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))).tolist()]
            yield from groups(rows, starts)  # all but the last step, which may go on
            held = rows.slice(starts[-1])
        if held is not None:
            yield from groups(held, [0, held.num_rows])

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("tile", "bi", "bj", *fields).repartition(n, "tile", "bi", "bj")
            .sortWithinPartitions("tile", "bi", "bj").mapInArrow(run, "a long, b long"))


def link_components(members: DataFrame, verify: Callable[[DataFrame], DataFrame],
                    rest: Callable[[DataFrame], DataFrame],
                    leader_rounds: int = LEADER_ROUNDS, links: DataFrame | None = None) -> DataFrame | None:
    """Components (v, label) of the links among ``members`` (tile, v), None without a link.
    ``links`` (a, b; a stored table) are links found before, to which those of the members are added.

    ``verify`` keeps the pairs (a, b), a < b, that link; ``rest`` gives the pairs to verify
    of members (tile, v, label) after the leader rounds, as open_pairs does."""
    tested = None
    labels = None if links is None or links.isEmpty() else materialize(connected_components(links), "labels")
    if members.isEmpty():
        return labels
    for turn in range(leader_rounds + 1):
        now = members.withColumn("label", F.col("v")) if labels is None else (
            members.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v")))
        if turn < leader_rounds:
            # the smallest member first, which makes components shallow; then others
            at = F.lit(0).cast("long") if turn == 0 else F.xxhash64(F.col("v"), F.lit(turn))
            leader = F.min(F.struct(at.alias("at"), "v", "label")).alias("leader")
            tops = materialize(now.groupBy("tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), leader)
                               .where("lo < hi").select("tile", F.col("leader.v").alias("of"),
                                                        F.col("leader.label").alias("of_label")), "leaders")
            pairs = (now.join(tops, "tile").where("label <> of_label")
                     .select(F.least("v", "of").alias("a"), F.greatest("v", "of").alias("b")).distinct())
        else:
            pairs = rest(now)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = materialize(verify(pairs), "links")
        if found.isEmpty():
            continue  # the components are as they were
        if labels is None:
            labels = materialize(connected_components(found), "labels")
            continue
        # components grow by the links between them
        for side in "ab":
            found = (found.join(labels.select(F.col("v").alias(side), F.col("label").alias("of")), side, "left")
                     .withColumn(side, F.coalesce("of", side)).drop("of"))
        grown = materialize(connected_components(found).select(F.col("v").alias("label"), F.col("label").alias("into")), "grown")
        fresh = grown.join(labels.select(F.col("v").alias("label")), "label", "left_anti").select(
            F.col("label").alias("v"), F.col("into").alias("label"))
        labels = materialize(labels.join(grown, "label", "left").select("v", F.coalesce("into", "label").alias("label"))
                             .union(fresh), "labels")
    return labels
