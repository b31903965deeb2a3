"""Suffix-array dedup: remove every byte of a repeated passage of ``span`` bytes or more.

Which windows of ``span`` bytes can repeat at all is settled first.  Equal windows have the
smallest hash of their ``gram``-byte strings in equal places, in the first or the second half
of the window.  The bytes around it that all windows of that half cover, more than half of
each, are hashed with it into the anchor, so equal windows have equal anchors, and a phrase
that many texts share makes none.  Neighbouring windows of one anchor, with the bytes they
cover, form a context, so each window belongs to exactly one context.  An anchor that occurs
once in the whole corpus cannot belong to a repeated window; only contexts of the other
anchors, about the repeated part of the corpus, are looked at again.

Equal contexts are counted, not repeated; where an anchor has only one distinct context that
occurs several times, all of its windows repeat.  The others go to shards by anchor.  Contexts of an
anchor that occurs very often are first cut into pieces: equal windows have the anchor in equal
places, so windows are taken together by that place, PIECE_WINDOWS at a time, and what all
windows of a piece cover, nearly the whole of each, becomes their anchor.  Pieces of unlike
surroundings part that way, and equal ones are counted.  Only where very many unlike pieces
still have one such anchor (around the ends of a passage that many texts share) is it salted
over several shards.  Each shard builds a suffix array
by Larsson-Sadakane refinement in numpy (only groups that are still tied are sorted again, by
the ranks at multiples of the length settled so far, until ``span`` bytes are settled), and
longest common prefixes of the windows by Kasai's rule, advancing in all contexts at once.  Windows with a common prefix of ``span`` bytes with a
neighbour in the array, or in a context that occurs several times, repeat.  The distinct
windows of salted pieces are merged across shards by binary search in the sorted union of
what the shards have.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.llm.common import read_table, text_or_empty
from tunelift.llm.hashing import _BYTE, mix, powers, text_slices
from tunelift.session import materialize

SPAN_BYTES = 200
GRAM_BYTES = 24
SHARD_CONTEXTS = 1024      # contexts of one anchor in a shard
PIECE_WINDOWS = 16         # windows that a piece of a frequent anchor's context has at most
ARRAY_BYTES = 512 << 10    # bytes of the contexts that one suffix array covers
SLICE_BYTES = 256 << 10    # bytes hashed at a time, so that the arrays stay in a core's cache


def byte_sums(raw: np.ndarray) -> np.ndarray:
    """Sums from which ``run_hashes`` has the hash of any run of bytes."""
    return np.r_[np.uint64(0), np.cumsum(_BYTE[raw] * powers(len(raw))[0][:len(raw)], dtype=np.uint64)]


def run_hashes(total: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes from each of ``begin``, wherever they stand."""
    return (total[begin + size] - total[begin]) * powers(len(total))[1][begin]


def gram_hashes(raw: np.ndarray, gram: int, total: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes [i, i + gram) for every i."""
    if len(raw) < gram:
        return np.empty(0, dtype=np.uint64)
    total = byte_sums(raw) if total is None else total
    h = (total[gram:] - total[:-gram]) * powers(len(raw))[1][:len(raw) - gram + 1]
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def sliding_minima(g: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each window of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        g = np.minimum(g[:-step], g[step:])
        have += step
    return g


def contexts(raw: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts in a run of bytes: text number, anchor, first and last window start (in the
    text) of every context, and whether its anchor occurs several times in it (its own
    windows may be equal then).  A context has span - gram + 1 windows at most."""
    if len(raw) < span:
        return (np.empty(0, np.int64),) * 5
    most = span - gram + 1
    half = -(-most // 2)
    total = byte_sums(raw)
    hashes = gram_hashes(raw, gram, total)
    smallest = sliding_minima(hashes, most)
    starts = np.arange(len(smallest))
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(smallest)]
    valid = starts + span <= offsets[of + 1]
    starts, of, smallest = starts[valid], of[valid], smallest[valid]
    # windows of one occurrence of the smallest hash: up to the window that begins with it
    own = hashes[starts] == smallest
    first, last = _stretches((np.diff(smallest) != 0) | (np.diff(of) != 0) | own[:-1], len(own))
    at = starts[last]
    far = np.flatnonzero(~own[last])
    at[far] += np.lib.stride_tricks.sliding_window_view(hashes, most)[at[far]].argmin(axis=1)
    smallest, of, first, last = smallest[first], of[first], starts[first], starts[last]
    # by the place of the occurrence, in the first or the second half
    high = (at - first) // half
    i = np.repeat(np.arange(len(at)), high - (at - last) // half + 1)
    side = high[i] - (np.arange(len(i)) - np.searchsorted(i, i))
    core = at[i] - side * half              # the last window of this half begins here
    anchor = mix(run_hashes(total, core, span - half + 1) + mix(smallest[i] + side.astype(np.uint64)))
    of, first, last = of[i], np.maximum(first[i], core - half + 1), np.minimum(last[i], core)
    # neighbours of one anchor (periodic text) are together again, and cut where they are many
    new, end = _stretches((np.diff(anchor) != 0) | (np.diff(of) != 0), len(of))
    of, anchor, first, last, several = of[new], anchor[new], first[new], last[end], end > new
    i = np.repeat(np.arange(len(of)), -(-(last - first + 1) // most))
    first = first[i] + (np.arange(len(i)) - np.searchsorted(i, i)) * most
    last = np.minimum(first + most - 1, last[i])
    base = offsets[of[i]]
    return of[i], anchor[i], first - base, last - base, several[i]


def _stretches(edge: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of n values between which there is no edge."""
    new = np.flatnonzero(np.r_[True, edge][:n])
    return new, np.r_[new[1:], n][:len(new)] - 1


def suffix_ranks(raw: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` bytes at least; ``ends``: where the context
    of each position ends (a suffix ends there).  Equal prefixes share a rank, the place of
    the first of them in the order."""
    n = len(raw)
    place = np.arange(n)
    left = ends - place
    # as many symbols as fit in 64 bits, numbered among the bytes that occur; 0 stands for the end
    code = np.cumsum(np.bincount(raw, minlength=256) > 0).astype(np.uint64)
    bits = max(1, int(code[-1]).bit_length())
    reach = 64 // bits
    symbols = np.r_[code[raw], np.zeros(reach, np.uint64)]
    key = np.zeros(n, dtype=np.uint64)
    for i in range(reach):
        key <<= np.uint64(bits)
        key |= symbols[i:i + n] * (left > i)
    order = np.argsort(key)
    head = np.r_[True, np.diff(key[order]) != 0]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))
    size = np.diff(np.r_[np.flatnonzero(head), n])
    tied = order[np.repeat(size, size) > 1]
    # a key holds the ranks at as many distances as fit: two for any size, mostly three
    width = int(n).bit_length() + 1
    together = max(2, 63 // width)
    while reach < depth:
        tied = tied[left[tied] >= reach]  # the others are equal to their ends
        if not len(tied):
            break
        together = min(together, -(-depth // reach))
        group, rest = rank[tied], left[tied]
        key = group.copy()
        for i in range(1, together):
            key = (key << width) | np.where(rest > i * reach, rank[np.minimum(tied + i * reach, n - 1)] + 1, 0)
        by = np.argsort(key)
        tied, key, group = tied[by], key[by], group[by]
        k = np.arange(len(tied))
        fresh = np.r_[True, np.diff(group) != 0]
        head = np.r_[True, np.diff(key) != 0]
        place_in = k - np.maximum.accumulate(np.where(fresh, k, 0))
        rank[tied] = group + np.maximum.accumulate(np.where(head, k, 0)) - (k - place_in)
        size = np.diff(np.r_[np.flatnonzero(head), len(tied)])
        tied = tied[np.repeat(size, size) > 1]
        reach *= together
    return rank


def common_prefixes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, array: np.ndarray, most: int,
                    least: int = 1, tied: np.ndarray | None = None) -> np.ndarray:
    """Common prefix (up to ``most``) of each suffix in the array with the one before it, by
    Kasai's rule: from one position of a context to the next it shrinks by one at most.

    Suffixes of less than ``least`` bytes are left out (0).  ``tied``: which places of the array
    have the same ``most`` bytes as the one before, or all bytes to the end; their own order
    is open, so the rule begins anew after them."""
    n = len(raw)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    last = np.repeat(ends, ends - begins)
    limit = np.minimum(np.minimum(last - np.arange(n), np.where(before >= 0, last[before] - before, 0)), most)
    eight = np.lib.stride_tricks.sliding_window_view(np.r_[raw, np.zeros(7, np.uint8)], 8).copy().view(np.uint64)[:, 0]
    found = np.zeros(n, dtype=np.int64)
    known = np.zeros(n, dtype=bool)
    if tied is not None:
        known[array[tied]] = True
    have = np.zeros(len(begins), dtype=np.int64)
    for t in range(int((ends - begins).max(initial=0)) - least + 1):
        lane = np.flatnonzero(begins + t + least <= ends)
        equal = known[begins[lane] + t]
        have[lane[equal]] = 0
        found[begins[lane[equal]] + t] = limit[begins[lane[equal]] + t]
        lane = lane[~equal]
        i = begins[lane] + t
        j, top = before[i], limit[i]
        length = np.minimum(np.maximum(have[lane] - 1, 0), top)
        for step, values in ((8, eight), (1, raw)):
            live = np.flatnonzero(length + step <= top)
            while len(live):
                same = values[i[live] + length[live]] == values[j[live] + length[live]]
                live = live[same]
                length[live] += step
                live = live[length[live] + step <= top[live]]
        found[i] = length
        have[lane] = length
    return found[array]


def repeated_windows(texts: list[bytes], counts: np.ndarray, span: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each distinct context two masks over window starts: those that repeat, and one
    window of each set of equal ones."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    rank = suffix_ranks(raw, np.repeat(ends, size), span)
    array = np.argsort(rank * len(raw) + np.arange(len(raw)))  # equal suffixes by position
    tied = np.r_[False, np.diff(rank[array]) == 0][:len(raw)]
    group = np.cumsum(common_prefixes(raw, begins, ends, array, span, span, tied) < span) - 1
    many = np.bincount(group)[group] > 1
    again = np.zeros(len(raw), dtype=bool)
    # a context that occurs several times repeats, and so does whatever equals a window of it
    often = np.zeros(group.max(initial=-1) + 1, dtype=bool)
    often[group[np.repeat(counts > 1, size)[array]]] = True
    again[array] = many | often[group]
    one = np.zeros(len(raw), dtype=bool)
    one[array] = np.r_[True, np.diff(group) != 0][:len(raw)]
    return tuple([m[b:max(b, e - span + 1)] for b, e in zip(begins, ends)] for m in (again, one))


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _rows(texts: pa.Array, span: int, gram: int) -> Iterator[tuple]:
    for at, raw, offsets in text_slices(texts, SLICE_BYTES):
        yield at, *contexts(raw, offsets, span, gram)


def _anchors(docs: DataFrame, span: int, gram: int, places: bool) -> DataFrame:
    """The anchor (a) of every context, twice if it occurs several times in it; or, with
    ``places``, (a, u, w) of every context, w being its first window and their number - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, of, anchor, first, last, several in _rows(batch["text"], span, gram):
                if not places:
                    twice = np.repeat(anchor, 1 + several.astype(int))
                    yield pa.record_batch([pa.array(twice.view(np.int64))], names=["a"])
                    continue
                a = pa.array(np.ascontiguousarray(anchor).view(np.int64))
                u = batch["u"].take(pa.array(at + of))
                yield pa.record_batch([a, u, pa.array((first << 16) | (last - first))], names=["a", "u", "w"])

    if places:
        return docs.select("u", "text").mapInArrow(run, "a long, u long, w long")
    return docs.select("text").mapInArrow(run, "a long")


def _texts_with_contexts(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(u, z, w): compressed text of each document that has contexts of repeated anchors, and
    those contexts (place, occurrences of the anchor)."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [c.compress((t.as_py() or "").encode()) for t in batch["text"]]
            yield pa.record_batch([batch["u"], pa.array(z, pa.binary())], names=["u", "z"])

    shared = materialize(_anchors(docs, span, gram, False).groupBy("a").count().where("count > 1"), "shared-anchors")
    # the contexts of one document, a set in case its row is repeated
    lists = (_anchors(docs, span, gram, True).join(shared, "a").groupBy("u")
             .agg(F.collect_set(F.struct("w", "a", F.col("count").alias("n"))).alias("w")))
    texts = docs.select("u", "text").mapInArrow(press, "u long, z binary")
    return materialize(texts.join(lists, "u"), "texts-with-contexts")


def pieces(raw: bytes, first: int, last: int, anchor: int, span: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """Cut the windows first to last of a text, all of one anchor, into runs: (first window, last
    window, anchor of the piece).

    A window's place is where its smallest hash first occurs, so equal windows have equal places.
    A piece has windows of one stretch of places that are about one occurrence; its anchor is a
    hash of the stretch and of the bytes that any such window covers."""
    width = max(1, min(PIECE_WINDOWS, span // 4))
    hashes = gram_hashes(np.frombuffer(raw, np.uint8, last - first + span, first), gram)
    for p in (np.flatnonzero(hashes == hashes[:span - gram + 1].min()) + first).tolist():
        until = min(last, p)                   # windows that begin after p have another occurrence
        while first <= until:
            stretch = (p - first) // width
            core = p - stretch * width
            seed = (anchor + stretch * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)
            key = xxhash.xxh3_64_intdigest(raw[core:core + span - width + 1], seed)
            yield first, min(until, core), key - 2 ** 64 if key >= 2 ** 63 else key
            first = min(until, core) + 1


def _contexts_of(batch: pa.RecordBatch, span: int, gram: int, cut: bool | None = None) -> Iterator[tuple]:
    """u, place, anchor, digest and bytes of each context listed in a batch; contexts of an anchor of
    more than SHARD_CONTEXTS occurrences come in pieces.  ``cut`` asks for the pieces only, or for
    the others."""
    d = zstandard.ZstdDecompressor()
    row = batch["w"].value_parent_indices().to_numpy()
    w, a, n = (x.to_numpy() for x in (batch["w"].flatten().field(c) for c in ("w", "a", "n")))
    often = n > SHARD_CONTEXTS
    if cut is not None:
        row, w, a, often = (x[(n > SHARD_CONTEXTS) == cut] for x in (row, w, a, often))
    us, at = batch["u"].to_pylist(), -1
    for i, first, last, anchor, many in zip(row.tolist(), (w >> 16).tolist(), ((w >> 16) + (w & 0xFFFF)).tolist(), a.tolist(), often.tolist()):
        if i != at:
            at, u, raw = i, us[i], d.decompress(batch["z"][i].as_py())
        if not many:
            text = raw[first:last + span]
            yield u, first, anchor, xxhash.xxh3_128_digest(text), text
            continue
        for b, e, key in pieces(raw, first, last, anchor, span, gram):
            text = raw[b:e + span]
            yield u, b, key, xxhash.xxh3_128_digest(text), text


def _halves(digests: list[bytes]) -> np.ndarray:
    """The two longs of each digest, as two rows."""
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2).T.copy()


def _distinct_contexts(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """Contexts and pieces with the number of their occurrences, which is summed within a task for
    contexts and over all for pieces; salt spreads an anchor of more than SHARD_CONTEXTS different
    pieces."""
    schema = "a long, c1 long, c2 long, n long, ctx binary"

    def listed(cut: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: dict = {}
                for _, _, a, c, text in _contexts_of(batch, span, gram, cut):
                    seen.setdefault((a, c), [0, text])[0] += 1
                a = pa.array([a for a, _ in seen], pa.int64())
                n, ctx = (pa.array(list(x), t) for x, t in zip(list(zip(*seen.values())) or [[]] * 2, (pa.int64(), pa.binary())))
                yield pa.record_batch([a, *map(pa.array, _halves([c for _, c in seen])), n, ctx], names=["a", "c1", "c2", "n", "ctx"])

        return texts.mapInArrow(run, schema)

    whole = listed(False).select("a", F.lit(0).alias("salt"), F.lit(False).alias("salted"), "c1", "c2", "n", "ctx")
    parts = materialize(listed(True).groupBy("a", "c1", "c2").agg(F.sum("n").alias("n"), F.first("ctx").alias("ctx")),
                        "context-pieces")
    shards = F.ceil(F.count(F.lit(1)) / SHARD_CONTEXTS).cast("int")
    crowded = materialize(parts.groupBy("a").agg(shards.alias("shards")).where("shards > 1"), "crowded-anchors")
    salted = F.col("shards").isNotNull()
    parts = parts.join(crowded, "a", "left").select(
        "a", F.when(salted, F.pmod("c2", "shards")).otherwise(0).cast("int").alias("salt"), salted.alias("salted"),
        "c1", "c2", "n", "ctx")
    return whole.union(parts)


def _repeats(distinct: DataFrame, span: int) -> DataFrame:
    """Rows (c1, c2, x, y): windows x to y of a context repeat; rows with a digest (w1, w2)
    are the distinct windows x = y that a shard has of a salted anchor."""
    schema = "c1 long, c2 long, x int, y int, w1 long, w2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        total, key = 0, None

        def close() -> Iterator[pa.RecordBatch]:
            distinct = Counter(a for a, _, _ in held)
            alone = {k for k, (n, _, salted) in held.items() if distinct[k[0]] == 1 and n > 1 and not salted}
            rows = [(c1, c2, 0, len(held[a, c1, c2][1]) - span, None, None) for a, c1, c2 in alone]
            items = [(k, x) for k, x in held.items() if k not in alone]
            found = repeated_windows([x[1] for _, x in items], np.array([x[0] for _, x in items]), span) if items else ((), ())
            for ((_, c1, c2), (_, text, salted)), mask, one in zip(items, *found):
                rows += [(c1, c2, x, y, None, None) for x, y in _runs(mask)]
                if salted:
                    for x in np.flatnonzero(one).tolist():
                        rows.append((c1, c2, x, x, *struct.unpack("<qq", xxhash.xxh3_128_digest(text[x:x + span]))))
            cols = list(zip(*rows)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["c1", "c2", "x", "y", "w1", "w2"])

        for batch in batches:
            for a, salt, salted, c1, c2, n, ctx in zip(*(batch[c].to_pylist() for c in (
                    "a", "salt", "salted", "c1", "c2", "n", "ctx"))):
                if (a, salt) != key and total >= ARRAY_BYTES:
                    yield from close()
                    held, total = {}, 0
                key = (a, salt)
                old = held.get((a, c1, c2))
                if old is None:
                    total += len(ctx)
                held[(a, c1, c2)] = (n + (old[0] if old else 0), ctx, salted)
        yield from close()

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return distinct.repartition(n, "a", "salt").sortWithinPartitions("a", "salt").mapInArrow(run, schema)


def _merged(windows: DataFrame) -> DataFrame:
    """Of windows (c1, c2, x, y, w1, w2), each distinct within its shard, those that another
    shard has too, by binary search in the sorted union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            w1 = rows["w1"].to_numpy()
            cut = int(np.searchsorted(w1, w1[-1])) if len(w1) else 0  # the last value may go on
            rest = rows.slice(cut)
            yield from decide(rows.slice(0, cut))
        if rest is not None:
            yield from decide(rest)

    def decide(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        w = np.empty(rows.num_rows, dtype=[("a", "<i8"), ("b", "<i8")])
        w["a"], w["b"] = rows["w1"].to_numpy(), rows["w2"].to_numpy()
        union = np.sort(w)
        several = np.searchsorted(union, w, side="right") - np.searchsorted(union, w) > 1
        yield from rows.filter(pa.array(several)).select(["c1", "c2", "x", "y"]).combine_chunks().to_batches()

    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (windows.repartition(n, "w1", "w2").sortWithinPartitions("w1", "w2")
            .mapInArrow(run, "c1 long, c2 long, x int, y int"))


def _spans(covered: pa.ListArray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the maximal runs of bytes that the repeated windows of each
    row's contexts cover, in order; runs that meet are one."""
    listed = covered.flatten()
    runs = listed.field("runs")
    windows = runs.flatten()
    of = runs.value_parent_indices().to_numpy()
    row = covered.value_parent_indices().to_numpy()[of]
    first = listed.field("first").to_numpy()[of]
    begin, end = (first + windows.field(c).to_numpy() for c in ("x", "y"))
    apart = int(end.max(initial=0)) + span + 1  # from a row's bytes to the next row's
    order = np.argsort(row * apart + begin)
    begin = (row * apart + begin)[order]
    end = np.maximum.accumulate((row * apart + end + span)[order])
    new, last = _stretches(begin[1:] > end[:-1], len(begin))
    return begin[new] // apart, begin[new] % apart, end[last] - begin[new]


def repeated_spans(docs: DataFrame, span: int = SPAN_BYTES, gram: int = GRAM_BYTES) -> DataFrame:
    """Maximal runs of bytes covered by repeated strings of ``span`` bytes.

    Input columns doc_id and text (others are ignored).  Texts are UTF-8 bytes; a string that
    starts at two places, of one text or of two, repeats, and overlapping ones count.
    Returns u (hash of doc_id and text), spans (array of struct start, length), n_removed,
    kept (the remaining bytes) for the texts that lose bytes; null, empty and short texts
    never do.  Rows that repeat both id and text repeat all of their strings, and have one
    result row for both.  A null doc_id is as good as any."""
    docs = docs.select(F.xxhash64("doc_id", text_or_empty()).alias("u"), text_or_empty().alias("text"))
    texts = _texts_with_contexts(docs, span, gram)
    found = materialize(_repeats(_distinct_contexts(texts, span, gram), span), "repeats")
    merged = _merged(found.where("w1 is not null"))
    repeats = materialize(found.where("w1 is null").select("c1", "c2", "x", "y").union(merged)
                          .groupBy("c1", "c2").agg(F.collect_set(F.struct("x", "y")).alias("runs")), "context-runs")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, first, digests = list(zip(*((u, b, c) for u, b, _, c, _ in _contexts_of(batch, span, gram)))) or [[]] * 3
            yield pa.record_batch([pa.array(list(c), pa.int64()) for c in (u, first, *_halves(digests))],
                                  names=["u", "first", "c1", "c2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in batches:
            row, begin, size = _spans(batch["covered"], span)
            of = np.searchsorted(row, np.arange(batch.num_rows + 1))
            removed = np.diff(np.r_[0, np.cumsum(size)][of])
            kept, bounds, stops = [], of.tolist(), (begin + size).tolist()
            begins = begin.tolist()
            for z, x, y in zip(batch["z"], bounds, bounds[1:]):
                raw = d.decompress(z.as_py())
                kept.append(b"".join(raw[e:b] for e, b in zip([0, *stops[x:y]], [*begins[x:y], len(raw)])))
            spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(size)], names=["start", "length"])
            yield pa.record_batch([batch["u"], pa.ListArray.from_arrays(pa.array(of, pa.int32()), spans), pa.array(removed),
                                   pa.array(kept, pa.binary())], names=["u", "spans", "n_removed", "kept"])

    covered = (texts.select("u", "z", "w").mapInArrow(places, "u long, first long, c1 long, c2 long").distinct()
               .join(repeats, ["c1", "c2"]).groupBy("u").agg(F.collect_list(F.struct("first", "runs")).alias("covered")))
    return (texts.select("u", "z").dropDuplicates(["u"]).join(covered, "u").mapInArrow(
        cut, "u long, spans array<struct<start: long, length: long>>, n_removed long, kept binary"))


def op8_suffix_array_dedup(spark, sf_dir):
    """All documents without the bytes of repeated 200-byte strings."""
    docs = read_table(spark, sf_dir, "documents")
    cut = materialize(repeated_spans(docs).select("u", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                                  F.sha2("kept", 256).alias("sha")), "cut-texts")
    rows = docs.select("doc_id", F.xxhash64("doc_id", text_or_empty()).alias("u"),
                       F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
                       F.sha2(text_or_empty(), 256).alias("whole"))
    none = F.lit(0).cast("long")
    return rows.join(cut, "u", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))
