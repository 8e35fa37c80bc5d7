"""Hard-negative mining by segment summary filtering.

Every vector is cut into segments of 64, 16 and 4 components, and each segment's mean and deviation are
stored. Over a segment of w components the product of two vectors lies within w * (mean * mean -+ deviation *
deviation), so the sums over the segments bound a score from both sides. Pairs are refined from wide to
narrow segments; a pair goes on only while its bounds leave it a chance, and what is left is scored exactly.

Anchors meet all rows in tiles: ``TILE`` anchors against ``TILE`` rows, dealt by (anchor block, row block). A
row travels once for every ``TILE`` anchors. A first pass finds each anchor's positives, a second one the
negatives in the score windows that the positives set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperflow.llm.common import staged_once

WIDTHS = (64, 16, 4)
TILE = 4096
#: Anchors and rows of a tile that are compared at a time.
_STEP_ANCHORS, _STEP_ROWS = 256, 2048
_BIG = float(1 << 53)
_SUMMARY = "id long, label long, n int, wide boolean, q binary, summary binary"
_FOUND = "anchor_id long, slot int, id long, score long"


def usable(rows: DataFrame, vector: str, label: str, ident: str) -> Column:
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.col(ident).isNotNull() & ~F.coalesce(bad, F.lit(True))


def summarize(q: np.ndarray) -> np.ndarray:
    """Means, then deviations, of each level's segments of the rows of ``q`` (zeros behind the last component)."""
    n, d = q.shape
    wide = np.zeros((n, -(-d // WIDTHS[0]) * WIDTHS[0]))
    wide[:, :d] = q
    parts = []
    for w in WIDTHS:
        cut = wide.reshape(n, -1, w)
        parts += [cut.mean(axis=2), cut.std(axis=2)]
    return np.concatenate(parts, axis=1)


def levels(dimension: int) -> list[tuple[int, slice, slice]]:
    """(width, columns of the means, columns of the deviations) of each level of a summary."""
    out, at = [], 0
    wide = -(-dimension // WIDTHS[0]) * WIDTHS[0]
    for w in WIDTHS:
        n = wide // w
        out.append((w, slice(at, at + n), slice(at + n, at + 2 * n)))
        at += 2 * n
    return out


def with_summaries(rows: DataFrame) -> DataFrame:
    """id, label, the integer components (``wide``: 64 bits each, else 32) and the segment summaries, from id,
    label, vector (doubles)."""
    def run(batches):
        for batch in batches:
            vectors = batch.column(2)
            lengths = np.diff(vectors.offsets.to_numpy())
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                own = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), n)
                q = np.clip(np.floor(256 * own), -2.0**62, 2.0**62)
                wide = bool(np.abs(q).max(initial=0) >= 2**31)
                cells = q.astype(np.int64 if wide else np.int32)
                parts = summarize(q)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array([n] * len(at), pa.int32()),
                     pa.array([wide] * len(at)), pa.array([x.tobytes() for x in cells], pa.binary()),
                     pa.array([x.tobytes() for x in parts], pa.binary())], ["id", "label", "n", "wide", "q", "summary"])

    return rows.mapInArrow(run, _SUMMARY)


class Block:
    """Rows of one side of a tile: ids, labels, components and summaries, with zeros up to ``dimension``."""

    def __init__(self, table: pa.Table, dimension: int):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        cuts = levels(dimension)
        self.q = np.zeros((len(self.ids), dimension), np.int64)
        self.summary = np.zeros((len(self.ids), cuts[-1][2].stop))
        lengths, wide = table.column("n").to_numpy(), table.column("wide").to_numpy()
        q, parts = table.column("q").combine_chunks(), table.column("summary").combine_chunks()
        for n, kind in set(zip(lengths.tolist(), wide.tolist())):
            at = np.flatnonzero((lengths == n) & (wide == kind))
            own = pa.array(at)
            self.q[at, :n] = np.frombuffer(b"".join(q.take(own).to_pylist()), np.int64 if kind else np.int32).reshape(len(at), n)
            found = np.frombuffer(b"".join(parts.take(own).to_pylist()), np.float64).reshape(len(at), -1)
            for (_, m, s), (_, om, os) in zip(cuts, levels(n)):
                self.summary[at, m.start:m.start + om.stop - om.start] = found[:, om]
                self.summary[at, s.start:s.start + os.stop - os.start] = found[:, os]
        self.most = float(np.abs(self.q).max(initial=0))

    def part(self, keep) -> Block:
        out = object.__new__(Block)
        out.ids, out.labels, out.q, out.summary, out.most = (
            self.ids[keep], self.labels[keep], self.q[keep], self.summary[keep], self.most)
        return out


def bounds(a: Block, b: Block, level: tuple[int, slice, slice]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of a tile, a little wider than they are for rounding."""
    w, means, spreads = level
    right = np.concatenate([b.summary[:, means], b.summary[:, spreads]], axis=1).T
    middle, reach = w * a.summary[:, means], w * a.summary[:, spreads]
    lower, upper = np.concatenate([middle, -reach], axis=1) @ right, np.concatenate([middle, reach], axis=1) @ right
    slack = 1 + 1e-9 * a.most * b.most * max(1, a.q.shape[1])
    lower -= slack
    upper += slack
    return lower, upper


def exact(a: Block, b: Block, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs, exactly; beyond 64 bits the nearest 64-bit number."""
    if a.most * b.most * max(1, a.q.shape[1]) < _BIG:
        fa, fb = a.q.astype(np.float64), b.q.astype(np.float64)
        if len(at) > 0.1 * len(fa) * len(fb):  # so many are left that one product of the blocks costs less
            return (fa @ fb.T)[at, to].astype(np.int64)
        out = np.empty(len(at), np.int64)
        for k in range(0, len(at), 1 << 15):
            part = slice(k, k + (1 << 15))
            out[part] = np.einsum("ij,ij->i", fa[at[part]], fb[to[part]])
        return out
    whole = [sum(int(x) * int(y) for x, y in zip(a.q[i], b.q[j])) for i, j in zip(at, to)]
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in whole], np.int64)


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    if values.shape[1] < k:
        return np.full(values.shape[0], -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def _first(at: np.ndarray, to: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each anchor's k first pairs by score, then id."""
    order = np.lexsort((ids[to], ~scores, at))
    new = np.ones(len(order), bool)
    new[1:] = at[order][1:] != at[order][:-1]
    starts = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


def positives_of(a: Block, b: Block, k: int):
    """(anchor, row, score) of the k first other rows of each anchor's label in this tile, label by label."""
    for label in np.intersect1d(a.labels, b.labels):
        mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(b.labels == label)
        x, y = a.part(mine), b.part(theirs)
        live = x.ids[:, None] != y.ids[None, :]
        for level in levels(x.q.shape[1]):
            lower, upper = bounds(x, y, level)
            lower[~live] = -np.inf
            live &= upper >= _kth_largest(lower, k)[:, None]
        at, to = np.nonzero(live)
        scores = exact(x, y, at, to)
        first = _first(at, to, scores, y.ids, k)
        yield mine[at[first]], theirs[to[first]], scores[first]


def negatives_of(a: Block, b: Block, low: np.ndarray, high: np.ndarray, k: int):
    """(slot, anchor, row, score) of the k first rows of another label with low <= score <= high, for each
    anchor and each of its windows (columns of ``low`` and ``high``)."""
    real = low <= high
    least = np.where(real, low, np.inf).min(axis=1)[:, None]
    most = np.where(real, high, -np.inf).max(axis=1)[:, None]
    live = a.labels[:, None] != b.labels[None, :]
    for level in levels(a.q.shape[1]):
        lower, upper = bounds(a, b, level)
        live &= upper >= least
        live &= lower <= most
        if not live.any():
            return
    at, to = np.nonzero(live)
    scores = exact(a, b, at, to)
    inside = (scores >= least[at, 0]) & (scores <= most[at, 0])
    at, to, scores = at[inside], to[inside], scores[inside]
    for slot in range(low.shape[1]):
        own = np.flatnonzero((scores >= low[at, slot]) & (scores <= high[at, slot]))
        own = own[_first(at[own], to[own], scores[own], b.ids, k)]
        yield slot, at[own], to[own], scores[own]


def tiles(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, found) -> DataFrame:
    """``found(anchors, rows, windows)`` over every tile: anchor_id, slot, id, score."""
    a_blocks, r_blocks = -(-n_anchors // TILE), -(-n_rows // TILE)
    if not (a_blocks and r_blocks):
        return anchors.sparkSession.createDataFrame([], _FOUND)

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), F.lit(blocks)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], ["anchor_id", "slot", "id", "score"])
        dimension = max(pc.max(x.column("n")).as_py() for x in (left, right))
        a, b = Block(left, dimension), Block(right, dimension)
        parts = []
        for i in range(0, len(a.ids), _STEP_ANCHORS):
            mine = slice(i, i + _STEP_ANCHORS)
            for j in range(0, len(b.ids), _STEP_ROWS):
                some = b.part(slice(j, j + _STEP_ROWS))
                for slot, at, to, scores in found(a.part(mine), some, left.slice(i, _STEP_ANCHORS)):
                    parts.append((a.ids[mine][at], np.full(len(at), slot, np.int32), some.ids[to], scores))
        cols = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, t) for c, t in enumerate(
            (np.int64, np.int32, np.int64, np.int64))]
        return pa.table(cols, ["anchor_id", "slot", "id", "score"])

    left = dealt(anchors, "block_a", a_blocks, "block_r", r_blocks)
    right = dealt(rows, "block_r", r_blocks, "block_a", a_blocks)
    keys = ["block_a", "block_r"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _FOUND)


def hard_negatives(vectors: DataFrame, is_anchor: Column, vector: str = "embedding", label: str = "label", ident: str = "vec_id",
                   positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as floor(256 * x); a score is the integer inner product with the anchor. Each anchor's
    positives are its first ``positives`` other rows of its label, its negatives for a positive the first
    ``negatives`` rows of another label with least% to most% of the positive's score; higher scores come
    first, ties by id. An anchor without positives, and a positive without negatives, gives no row.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows with
    equal id the one with the least label, then the least vector, takes part. Vectors of unequal lengths are
    compared as if zeros followed the shorter one; empty vectors score 0. Components beyond 2**62 count as
    2**62, scores beyond 64 bits as the nearest 64-bit number. An empty table gives no rows.
    """
    taking = vectors.select(F.col(ident).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                            F.col(vector).cast("array<double>").alias("vector"))
    taking = taking.filter(usable(taking, "vector", "label", "id")).groupBy("id").agg(
        F.min(F.struct("label", "vector")).alias("x")).select("id", "x.*")
    rows = staged_once(with_summaries(taking), "negatives-rows")
    chosen = vectors.filter(is_anchor).select(F.col(ident).cast("long").alias("id")).distinct()
    anchors = staged_once(rows.join(chosen, "id", "left_semi"), "negatives-anchors")
    n_rows, n_anchors = rows.count(), anchors.count()

    def same_label(a, b, _):
        for found in positives_of(a, b, positives):
            yield 0, *found

    def in_windows(a, b, left):
        low, high = (np.array(left.column(c).to_pylist()).reshape(len(a.ids), -1) for c in ("low", "high"))
        yield from negatives_of(a, b, low, high, negatives)

    def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        by = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)

    first = ranked(tiles(anchors, rows, n_anchors, n_rows, same_label), ["anchor_id"], positives)
    pos = staged_once(first.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), "negatives-positives")
    big = F.col("positive_score").cast("decimal(38,0)")
    # Windows of whole numbers: least * p <= 100 * n <= most * p. An anchor with fewer positives gets empty ones.
    low, high = F.ceil(big * least / 100).cast("long"), F.floor(big * most / 100).cast("long")
    windows = pos.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(
        F.collect_list(F.struct("slot", low.alias("low"), high.alias("high")))).alias("w"))

    def padded(field: str, empty: int) -> Column:
        return F.concat(F.col("w")[field], F.array_repeat(F.lit(empty).cast("long"), F.lit(positives) - F.size("w"))).alias(field)

    asking = anchors.join(windows, "id").select("id", "label", "n", "wide", "q", "summary", padded("low", 1), padded("high", 0))
    near = ranked(tiles(asking, rows, n_anchors, n_rows, in_windows), ["anchor_id", "slot"], negatives)
    return near.join(pos, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
