"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

Scores are inner products of integer vectors.  A last component that brings every vector to
the length of the longest one turns them into angles: a row's angle to an anchor grows as its
score falls, so a window of scores is an annulus of angles around the anchor.

A node of the tree has up to FANOUT split points; a row belongs to the nearest one, so the
cells are bounded by hyperplanes.  For every split point and every sibling subtree the node
stores the range of angles between that point and all rows of that subtree.  An anchor whose
angle to the point, shifted by that range, cannot reach the annulus eliminates the subtree.
The shape of the tree comes from a sample of bounded size; every row is placed, ranges are
those of all rows, and what is left of the leaves is compared exactly, so the result is exact.

A leaf is cut into blocks of bounded size by a hash of its rows (a vector that a third of all
rows share fills many blocks), and the anchors that visit it into chunks of bounded size: one
step compares one block with one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelift.llm.common import read_table
from tunelift.llm.vectors import matrix, number_type, scaled, usable
from tunelift.session import materialize

SAMPLE_ROWS = 8192      # rows that shape the tree and give the first bounds
FANOUT = 16             # split points of a node, at most
LEAF_ROWS = 2048        # rows of a leaf's block, about
CHUNK_ANCHORS = 2048    # anchors that meet a block in one step, about
STEP = 128              # anchors of one matrix product
SLACK = 1e-6            # radians by which annuli are widened, for rounding
FAR_LOW, FAR_HIGH = -(2 ** 62), 2 ** 62     # ends of a window that is open on that side
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Node:
    points: np.ndarray      # split points, one a row
    children: list[int]     # of each point: a node, or -1 - leaf
    near: np.ndarray        # [i, j]: smallest angle between point i and a row of subtree j
    far: np.ndarray         # [i, j]: the largest


@dataclass
class Tree:
    """Split points and ranges (a few MB at most), and the labelled sample."""

    dims: int
    radius: float                       # length of the longest vector
    dtype: type
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 1
    ids: np.ndarray | None = None       # of the sample
    labels: np.ndarray | None = None
    sample: np.ndarray | None = None

    def tail(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.radius ** 2 - (x.astype(np.float64) ** 2).sum(axis=1), 0))

    def angles(self, node: Node, x: np.ndarray) -> np.ndarray:
        """Angles between the rows of x and a node's points, both brought to one length."""
        dots = (x @ node.points.T).astype(np.float64) + self.tail(x)[:, None] * self.tail(node.points)
        return np.arccos(np.clip(dots / max(self.radius ** 2, 1e-300), -1, 1))

    def placed(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For every node that rows of x pass: (node, which rows, their child, their angles)."""
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            at, rows = todo.pop()
            angle = self.angles(self.nodes[at], x[rows])
            child = angle.argmin(axis=1)
            yield at, rows, child, angle
            for j, below in enumerate(self.nodes[at].children):
                if below >= 0 and (child == j).any():
                    todo.append((below, rows[child == j]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), dtype=np.int32)
        for at, rows, child, _ in self.placed(x):
            below = np.array(self.nodes[at].children)[child]
            leaf[rows[below < 0]] = -1 - below[below < 0]
        return leaf

    def visits(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, leaf) pairs that may hold a row with a score in one of the anchor's windows;
        low and high: a row of window ends for each anchor (low > high: no window)."""
        if not self.nodes:
            some = np.flatnonzero((low <= high).any(axis=1))
            return some, np.zeros(len(some), dtype=np.int32)
        size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * self.radius
        unit = np.maximum(size, 1e-300)[:, None]
        inner = np.arccos(np.clip(high / unit, -1, 1)) - SLACK
        outer = np.arccos(np.clip(low / unit, -1, 1)) + SLACK
        anchors, leaves = [], []
        todo = [(0, np.arange(len(q)), low <= high)]
        while todo:
            at, rows, open_ = todo.pop()
            node = self.nodes[at]
            angle = np.arccos(np.clip((q[rows] @ node.points.T).astype(np.float64) / unit[rows], -1, 1))
            for j, below in enumerate(node.children):
                if node.near[0, j] > node.far[0, j]:
                    continue  # no row is there
                least = np.maximum(angle - node.far[:, j], node.near[:, j] - angle).max(axis=1)
                most = (angle + node.far[:, j]).min(axis=1)
                # a null anchor has the score 0 with every row: angles say nothing
                met = ((least[:, None] <= outer[rows]) & (most[:, None] >= inner[rows])) | (size[rows] == 0)[:, None]
                met &= open_
                some = met.any(axis=1)
                if below >= 0 and some.any():
                    todo.append((below, rows[some], met[some]))
                elif some.any():
                    anchors.append(rows[some])
                    leaves.append(np.full(some.sum(), -1 - below, dtype=np.int32))
        none = np.zeros(0, dtype=np.int32)
        return np.concatenate(anchors or [none]), np.concatenate(leaves or [none])


def _split_points(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Up to k distinct rows of x that lie far apart: of 3 k candidates, always the one whose
    nearest chosen point is farthest."""
    some = np.unique(x[rng.permutation(len(x))[:3 * k]], axis=0)
    square = (some.astype(np.float64) ** 2).sum(axis=1)
    picked = [int(rng.integers(len(some)))]
    nearest = np.full(len(some), np.inf)
    while len(picked) < min(k, len(some)):
        p = some[picked[-1]]
        nearest = np.minimum(nearest, square + square[picked[-1]] - 2 * (some @ p).astype(np.float64))
        nearest[picked] = -1
        picked.append(int(nearest.argmax()))
    return some[picked]


def grow(tree: Tree, rows: int, leaf_rows: int, fanout: int = FANOUT, seed: int = 11) -> None:
    """Split the sample until a leaf stands for about ``leaf_rows`` of ``rows`` rows."""
    rng = np.random.default_rng(seed)
    each = rows / max(len(tree.sample), 1)

    def split(x: np.ndarray) -> Node | None:
        k = int(min(fanout, np.ceil(len(x) * each / leaf_rows)))
        points = _split_points(x, k, rng) if k > 1 and len(x) >= 2 * k else x[:0]
        if len(points) < 2:
            return None
        return Node(points, [], np.full((len(points),) * 2, np.inf), np.full((len(points),) * 2, -np.inf))

    root = split(tree.sample)
    if root is None:
        return
    tree.nodes, tree.leaves = [root], 0
    todo = [(0, tree.sample)]
    while todo:
        at, x = todo.pop(0)
        child = tree.angles(tree.nodes[at], x).argmin(axis=1)
        for j in range(len(tree.nodes[at].points)):
            inside = x[child == j]
            below = split(inside) if len(inside) < len(x) else None
            if below is None:
                tree.leaves += 1
                tree.nodes[at].children.append(-tree.leaves)
            else:
                tree.nodes[at].children.append(len(tree.nodes))
                todo.append((len(tree.nodes), inside))
                tree.nodes.append(below)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS) -> Tree | None:
    """The tree over ``rows`` (id, label, x), without its ranges; None for an empty table.

    The sample holds the rows whose hash is below a limit set by the number of rows, about
    ``sample_rows`` (all, if there are no more)."""
    top = F.greatest(F.abs(F.array_max("x").cast("long")), F.abs(F.array_min("x").cast("long")))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims"),
                 F.max(top).alias("top"), F.max(square).alias("square")).first()
    if not s["n"]:
        return None
    limit = min(1.0, sample_rows / s["n"])
    found = (rows.where(F.pmod(F.xxhash64("id", "x"), F.lit(2 ** 31)) < F.lit(int(limit * 2 ** 31)))
             .select("id", "label", "x").toArrow())
    tree = Tree(max(s["dims"], 1), float(np.sqrt(s["square"])), number_type(max(s["dims"], 1), s["top"] or 0))
    found = found.take(np.lexsort((found["id"].to_numpy(),)))
    tree.ids, tree.labels = found["id"].to_numpy(), found["label"].to_numpy()
    tree.sample = matrix(found["x"].combine_chunks(), tree.dims, tree.dtype)
    grow(tree, s["n"], leaf_rows)
    return tree


def place(rows: DataFrame, tree: Tree) -> DataFrame:
    """``rows`` with the leaf of each."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches:
            leaf = pa.array(t.leaf_of(matrix(b["x"], t.dims, t.dtype)))
            yield pa.record_batch([b["id"], b["label"], b["x"], leaf], names=["id", "label", "x", "leaf"])

    return rows.select("id", "label", "x").mapInArrow(
        run, T.StructType([*rows.select("id", "label", "x").schema.fields, T.StructField("leaf", T.IntegerType())]))


def set_ranges(rows: DataFrame, tree: Tree) -> None:
    """Fill the ranges of ``tree`` from all rows: a task sends one row for each pair of a split
    point and a subtree that its rows reach, so the driver gets a row for each pair."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, seen = shared.value, {}
        for b in batches:
            for at, _, child, angle in t.placed(matrix(b["x"], t.dims, t.dtype)):
                for j in np.unique(child).tolist():
                    a = angle[child == j]
                    lo, hi = seen.get((at, j), (np.inf, -np.inf))
                    seen[at, j] = np.minimum(lo, a.min(axis=0)), np.maximum(hi, a.max(axis=0))
        for (at, j), (lo, hi) in seen.items():
            n = len(lo)
            yield pa.record_batch([pa.array(np.full(n, at, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                                   pa.array(np.full(n, j, np.int32)), pa.array(lo), pa.array(hi)],
                                  names=["node", "i", "j", "near", "far"])

    found = (rows.select("x").mapInArrow(run, "node int, i int, j int, near double, far double")
             .groupBy("node", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect())
    for r in found:
        tree.nodes[r["node"]].near[r["i"], r["j"]] = r["near"]
        tree.nodes[r["node"]].far[r["i"], r["j"]] = r["far"]


def _itself(ids: np.ndarray, x: np.ndarray, of_ids: np.ndarray, of_x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal rows (equal ids, equal vectors)."""
    i, j = np.nonzero(ids[:, None] == of_ids)
    same = (x[i] == of_x[j]).all(axis=1)
    return i[same], j[same]


def _top(s: np.ndarray, k: int, none) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the k largest of each row, the first of equal ones first; ``s`` is
    used up.  ``none`` marks what may not be taken."""
    every = np.arange(len(s))
    at, value = np.zeros((len(s), k), dtype=np.int64), np.full((len(s), k), none, dtype=s.dtype)
    for r in range(min(k, s.shape[1])):
        at[:, r] = s.argmax(axis=1)
        value[:, r] = s[every, at[:, r]]
        s[every, at[:, r]] = none
    return at, value


def _windowed(s: np.ndarray, other: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, none):
    """_top of the entries within [low, high] of their row, among those marked in ``other``."""
    return _top(np.where(other & (s >= low[:, None]) & (s <= high[:, None]), s, none), k, none)


def _nothing(dtype) -> float | int:
    return -np.inf if dtype is np.float64 else np.iinfo(np.int64).min



def _visits(anchors: DataFrame, tree: Tree, same: bool, k: int) -> DataFrame:
    """Anchors (aid, id, label, x, low, high) with the leaves that they must visit.

    The sample gives the first bound: if it holds k rows of a window, only scores not below the
    k-th can matter, which raises the window's lower end."""
    shared = anchors.sparkSession.sparkContext.broadcast(tree)
    names = ["aid", "id", "label", "x", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        none = _nothing(t.dtype)
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                b = whole.slice(start, STEP)
                q = matrix(b["x"], t.dims, t.dtype)
                ids, labels = b["id"].to_numpy(zero_copy_only=False), b["label"].to_numpy(zero_copy_only=False)
                width = len(b["low"][0])
                low, high = matrix(b["low"], width, np.int64), matrix(b["high"], width, np.int64)
                s = q @ t.sample.T
                takes = (labels[:, None] == t.labels) == same
                i, j = _itself(ids, q, t.ids, t.sample)
                takes[i, j] = False
                for w in range(width):
                    value = _windowed(s, takes, low[:, w], high[:, w], k, none)[1][:, -1]
                    full = value != none
                    low[full, w] = value[full].astype(np.int64)
                anchor, leaf = t.visits(q, low, high)
                out = b.take(pa.array(anchor))
                ends = [pa.array(list(v[anchor]), pa.list_(pa.int64())) for v in (low, high)]
                yield pa.record_batch([*[out[c] for c in names[:4]], *ends, pa.array(leaf, pa.int32())],
                                      names=[*names, "leaf"])

    schema = T.StructType([*anchors.select(*names).schema.fields, T.StructField("leaf", T.IntegerType())])
    return anchors.select(*names).mapInArrow(run, schema)


def _search(placed: DataFrame, anchors: DataFrame, tree: Tree, same: bool, k: int, leaf_rows: int,
            chunk_anchors: int) -> DataFrame:
    """(aid, w, id, score, place): for each anchor and window (w counts from 1) the k rows with
    the largest score, ties by smaller id, among those of the same label or of other labels."""
    visits = materialize(_visits(anchors, tree, same, k), "visits")
    # a row for each leaf at most
    sizes = F.broadcast(materialize(
        placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / leaf_rows).cast("int").alias("blocks"))
        .join(visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / chunk_anchors).cast("int").alias("chunks")),
              "leaf"), "leaf-sizes"))
    rows = (placed.join(sizes, "leaf")
            .withColumn("block", F.pmod(F.xxhash64("id", "x"), F.col("blocks")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("leaf", "block", "chunk", "id", "label", "x"))
    asks = (visits.join(sizes, "leaf")
            .withColumn("chunk", F.pmod(F.xxhash64("aid"), F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", "block", "chunk", "aid", "id", "label", "x", "low", "high"))
    dims, dtype, none = tree.dims, tree.dtype, _nothing(tree.dtype)

    def vectors(x: pd.Series) -> np.ndarray:
        return matrix(pa.array(x.tolist(), pa.list_(pa.int32())), dims, dtype)

    def compare(block: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({c: pd.Series(dtype="int64") for c in ("aid", "w", "id", "score")})]
        if not len(block) or not len(chunk):
            return found[0]
        block = block.sort_values("id", kind="stable")
        x, ids, labels = vectors(block["x"]), block["id"].to_numpy(), block["label"].to_numpy()
        for start in range(0, len(chunk), STEP):
            a = chunk.iloc[start:start + STEP]
            q, aid = vectors(a["x"]), a["aid"].to_numpy()
            low, high = np.stack(a["low"].to_numpy()), np.stack(a["high"].to_numpy())
            s = q @ x.T
            takes = (a["label"].to_numpy()[:, None] == labels) == same
            i, j = _itself(a["id"].to_numpy(), q, ids, x)
            takes[i, j] = False
            for w in range(low.shape[1]):
                at, value = _windowed(s, takes, low[:, w], high[:, w], k, none)
                who, rank = np.nonzero(value != none)
                found.append(pd.DataFrame({"aid": aid[who], "w": w + 1, "id": ids[at[who, rank]],
                                           "score": value[who, rank].astype(np.int64)}))
        return pd.concat(found)

    key = ("leaf", "block", "chunk")
    found = rows.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(compare, "aid long, w int, id long, score long")
    place = F.row_number().over(W.partitionBy("aid", "w").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _percent(score: str, percent: int, up: bool = False) -> Column:
    """percent / 100 of a whole number, rounded down or up to whole numbers without doubles."""
    rest = f"pmod({score}, 100)"
    return F.expr(f"{percent} * (({score} - {rest}) div 100) + ({percent} * {rest} + {99 * up}) div 100")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
         chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """Hard negatives of ``rows`` (id long, label, x array<int>; other columns are ignored).

    Scores are inner products, ordered from the largest, ties by smaller id.  An anchor's
    positives are its first ``positives`` other rows of its label; the negatives of a positive
    the first ``negatives`` rows of other labels whose score is from ``low`` to ``high`` percent
    of the positive's.  Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); a pair without a negative gives no row, an empty table none.

    Rows with a null id, label or vector take no part.  Identical rows (id, label, vector) count
    once; rows that share an id and differ otherwise are rows of their own.  Shorter vectors end
    in zeros; an empty one has the score 0 with all.  Where a score might not fit a long, an
    ArithmeticError says so."""
    rows = materialize(rows.select("id", "label", "x").where("id is not null and label is not null and x is not null")
                       .distinct(), "vectors")
    tree = fit(rows, sample_rows, leaf_rows)
    if tree is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    placed = materialize(place(rows, tree), "placed-vectors")
    if tree.nodes:
        set_ranges(placed, tree)
    every = [F.array(F.lit(end)).alias(name) for name, end in (("low", FAR_LOW), ("high", FAR_HIGH))]
    anchors = materialize(rows.where(is_anchor).withColumn("aid", F.monotonically_increasing_id()).select("*", *every),
                          "anchors")
    best = materialize(_search(placed, anchors, tree, True, positives, leaf_rows, chunk_anchors).select(
        "aid", F.col("place").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        _percent("score", low, up=True).alias("lo"), _percent("score", high).alias("hi")), "positives")

    def ends(column: str, missing: int) -> Column:
        return F.array(*[F.coalesce(F.max(F.when(F.col("w") == w, F.col(column))), F.lit(missing).cast("long"))
                         for w in range(1, positives + 1)])

    windows = best.where("lo <= hi").groupBy("aid").agg(ends("lo", 1).alias("low"), ends("hi", 0).alias("high"))
    asking = materialize(anchors.drop("low", "high").join(windows, "aid"), "asking-anchors")
    found = _search(placed, asking, tree, False, negatives, leaf_rows, chunk_anchors)
    return (best.join(found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score"), ["aid", "w"])
            .join(anchors.select("aid", F.col("id").alias("anchor_id")), "aid")
            .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of the anchors (vec_id divisible by 50) among all embeddings."""
    e = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = e.where(usable("embedding")).select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
                                               scaled("embedding", 256).alias("x"))
    return mine(rows, F.col("id") % 50 == 0)
