"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's rows fall into blocks by a seeded hash, which permutes them. A source's target
becomes a number of whole passes over its blocks and one partial pass up to a cut in the
permutation. The block quotas are split among the output shards by a binary tree of
multivariate-hypergeometric draws, so each shard gets an exact number of blocks of every source
and the shards are equally full. Each shard then takes disjoint ranges of the permuted
blocks and shuffles its rows locally. Equal seeds give equal mixes.

Only per-source numbers (a row per source and, for the cut, per histogram cell) reach the driver;
the number of sources is that of the weights someone sets, not that of the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperflow.llm.common import staged, words_of

#: Histogram cells per source and round in the search for the cut.
CELLS = 1 << 10
#: Blocks that a shard holds on average.
BLOCKS_PER_SHARD = 64
#: Rows behind the cut among which some are sought first that fill what the cut leaves open.
NEAR_CUT = 1000
#: No source is taken more often than this.
MOST_PASSES = 3
_SPAN = 1 << 40  # positions in a source's permutation
_ANY = (1 << 63) - 1


def targets(sizes: list[int], weights: list[float], most: float = MOST_PASSES) -> list[float]:
    """Words to take per source: shares of all words by weight; what a source cannot give
    (``most`` times its size) is shared again by weight until none is above."""
    total, open_, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    left = total
    while open_ and left > 0:
        weight = sum(weights[k] for k in open_)
        full = {k for k in open_ if left * weights[k] / weight > most * sizes[k]}
        if not full:
            for k in open_:
                out[k] = left * weights[k] / weight
            break
        for k in full:
            out[k] = float(most * sizes[k])
            left -= out[k]
        open_ -= full
    return out


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Block counts [shard, source]: the quotas split in two again and again, each time by one
    multivariate-hypergeometric draw of the left half's share of the blocks."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    draw = int(quotas.sum()) * left // shards
    taken = rng.multivariate_hypergeometric(quotas, draw, method="marginals") if draw else np.zeros_like(quotas)
    return np.vstack([splitting_tree(taken, left, rng), splitting_tree(quotas - taken, shards - left, rng)])


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Adds ``_size`` (words), ``_at`` (position in its source's permutation). Rows with equal doc_id and text share it."""
    at = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(_SPAN))
    return docs.withColumns({"_size": F.size(words_of(F.col("text"))).cast("long"), "_at": at})


def small_table(spark: SparkSession, rows: list[tuple], kinds: dict[str, pa.DataType]) -> DataFrame:
    """``rows`` as a table, handed over as Arrow data: rows of Python objects would go through Python workers of
    their own on the executors, which stay in memory beside the others."""
    fields = pa.schema(list(kinds.items()))
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds, r)) for r in rows], fields))


def top_up(narrow: DataFrame, names: list, cut: list[int], reach: list[int], gap: list[float]) -> tuple[list[list[int]], list[float]]:
    """For every source positions from its cut up to ``reach`` that fill the gap left there, the largest first
    if they fit; and what stays open."""
    spark = narrow.sparkSession
    todo = small_table(spark, [(k, names[k], cut[k], reach[k], float(gap[k])) for k in range(len(names)) if gap[k] >= 1],
                       {"_s": pa.int32(), "source": pa.string(), "_low": pa.int64(), "_high": pa.int64(), "_gap": pa.float64()})
    here = narrow.join(todo, narrow["source"].eqNullSafe(todo["source"])).filter("_at >= _low and _at < _high")
    each = here.groupBy("_s", "_at", "_gap").agg(F.sum("_size").alias("words"))  # repeated rows share a position

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        left, taken = rows["_gap"].iloc[0], []
        for at, words in rows.sort_values(["words", "_at"], ascending=[False, True])[["_at", "words"]].to_numpy():
            if 0 < words <= left:
                taken.append(int(at))
                left -= words
        return pd.DataFrame({"_s": [int(rows["_s"].iloc[0])], "taken": [taken], "left": [float(left)]})

    out: list[list[int]] = [[] for _ in names]
    open_ = [float(g) for g in gap]
    for r in each.groupBy("_s").applyInPandas(fill, "_s int, taken array<long>, left double").collect():
        out[r["_s"]], open_[r["_s"]] = r["taken"], r["left"]
    return out, open_


def find_cuts(narrow: DataFrame, names: list, wanted: dict[int, tuple[int, float, float, int]]) -> dict[int, tuple[int, float]]:
    """For every source k in ``wanted`` (start, need, tolerance, most): the position before which the rows from
    ``start`` on, of at most ``most`` words each, stay below ``need`` words, and their words.

    Histograms of the positions, each CELLS times finer, until a cell holds one position or the words at
    stake are within the tolerance.
    """
    spark = narrow.sparkSession
    low, width = {k: w[0] for k, w in wanted.items()}, _SPAN
    below, open_ = dict.fromkeys(wanted, 0.0), list(wanted)
    kinds = {"_s": pa.int32(), "source": pa.string(), "_low": pa.int64(), "_width": pa.int64(), "_need": pa.float64(), "_most": pa.int64()}
    while width > 1 and open_:
        width = max(1, width // CELLS)
        cells = small_table(spark, [(k, names[k], low[k], width, float(wanted[k][1] - below[k]), wanted[k][3]) for k in open_], kinds)
        here = narrow.join(cells, narrow["source"].eqNullSafe(cells["source"])).filter(
            (F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_low") + F.lit(width * CELLS)) & (F.col("_size") <= F.col("_most")))
        found = here.groupBy("_s", "_need", F.expr("(_at - _low) div _width").alias("cell")).agg(F.sum("_size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("_s").orderBy("cell"))
        # The first cell at which the words taken so far reach the rest.
        first = F.min(F.when(F.col("upto") >= F.col("_need"), F.struct("cell", "words", "upto")))
        over = {r["_s"]: r for r in found.withColumn("upto", upto).groupBy("_s").agg(first.alias("m"), F.max("upto").alias("all")).collect()}
        still = []
        for k in open_:
            r = over.get(k)
            if r is None or r["m"] is None:  # all that is left does not reach it
                low[k] += width * CELLS
                below[k] += r["all"] if r else 0
                continue
            low[k] += r["m"]["cell"] * width
            below[k] += r["m"]["upto"] - r["m"]["words"]
            if width > 1 and r["m"]["words"] > wanted[k][2]:
                still.append(k)
        open_ = still
    return {k: (min(low[k], _SPAN), below[k]) for k in wanted}


def source_plan(narrow: DataFrame, shards: int, seed: int):
    """Rows (source, words, target, passes, cut, blocks, block bounds per shard) for every source.

    The partial pass takes the rows whose position is below ``cut``, and others behind it that fill what the cut
    leaves open: where one long text does not fit, shorter ones behind it do. In the end less than a
    thousandth of the target is open, or no row that is left fits.
    """
    spark = narrow.sparkSession
    stats = narrow.groupBy("source").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    sums, rows = ({r["source"]: r[c] for r in stats} for c in ("words", "rows"))
    names = sorted(sums, key=lambda s: (s is None, s or ""))  # code points, null last
    sizes = [sums[s] for s in names]
    goal = targets(sizes, [1 + k % 3 for k in range(len(names))])
    passes = [int(g // n) if n else 0 for g, n in zip(goal, sizes)]
    rest = [g - p * n for g, p, n in zip(goal, passes, sizes)]
    near = [g / 1000 for g in goal]
    cuts = find_cuts(narrow, names, {k: (0, r, near[k], _ANY) for k, r in enumerate(rest) if r > 0})
    low, below = [cuts.get(k, (0, 0))[0] for k in range(len(names))], [cuts.get(k, (0, 0))[1] for k in range(len(names))]
    reach = [min(_SPAN, low[k] + min(_SPAN, _SPAN * NEAR_CUT // max(1, rows[s]))) for k, s in enumerate(names)]
    extra, gap = top_up(narrow, names, low, reach, [r - b for r, b in zip(rest, below)])
    # Where more than a thousandth is still open the search goes on behind, each time among the rows that fit.
    more: list[list[tuple[int, int, int]]] = [[] for _ in names]
    at, open_ = list(reach), {k for k in range(len(names)) if gap[k] > near[k] and gap[k] >= 1 and reach[k] < _SPAN}
    while open_:
        found = find_cuts(narrow, names, {k: (at[k], gap[k], near[k], int(gap[k])) for k in open_})
        for k, (end, words) in found.items():
            if words > 0:
                more[k].append((at[k], end, int(gap[k])))
            gap[k] -= words
            at[k] = end
            if not words or gap[k] <= near[k] or gap[k] < 1 or end >= _SPAN:
                open_.discard(k)
    share = [p + c / _SPAN for p, c in zip(passes, low)]
    words = sum(s * n for s, n in zip(share, sizes))
    per_block = max(1.0, words / (shards * BLOCKS_PER_SHARD))
    blocks = [max(1, round(n / per_block)) for n in sizes]
    # Blocks of the partial pass: those that begin before the cut. Rows beyond go to the last shard.
    quotas = np.array([p * b + -(-c * b // _SPAN) for p, c, b in zip(passes, low, blocks)], np.int64)
    split = splitting_tree(quotas, shards, np.random.default_rng(seed)) if len(names) else np.zeros((shards, 0), int)
    bounds = np.cumsum(split, axis=0)
    ranges = [[dict(zip(("low", "high", "most"), r)) for r in own] for own in more]
    out = [(names[k], sizes[k], goal[k], passes[k], low[k], extra[k], ranges[k], blocks[k], [int(x) for x in bounds[:, k]]) for k in range(len(names))]
    whole = pa.struct([(c, pa.int64()) for c in ("low", "high", "most")])
    return small_table(spark, out, {
        "_source": pa.string(), "source_size": pa.int64(), "target": pa.float64(), "_passes": pa.int32(), "_cut": pa.int64(),
        "_extra": pa.list_(pa.int64()), "_more": pa.list_(whole), "_blocks": pa.int32(), "_bounds": pa.list_(pa.int32())})


def placed(docs: DataFrame, plan: DataFrame, seed: int, size: Column) -> DataFrame:
    """Adds source_size, target and ``_copies``: array of (pass, shard, order), one per time the row is taken."""
    rows = docs.join(plan, docs["source"].eqNullSafe(plan["_source"]), "left").drop("_source")
    block = F.floor(F.col("_at") * F.col("_blocks") / F.lit(_SPAN)).cast("int")
    rows = rows.withColumn("_block", F.least(block, F.col("_blocks") - 1))
    # ``size`` is asked for only where a source has such ranges
    fits = F.exists("_more", lambda r: (F.col("_at") >= r["low"]) & (F.col("_at") < r["high"]) & (size <= r["most"]))
    rows = rows.withColumn("_fits", fits)
    taken = F.filter(F.sequence(F.lit(0), F.lit(MOST_PASSES)), lambda k: (k < F.col("_passes")) | (
        (k == F.col("_passes")) & ((F.col("_at") < F.col("_cut")) | F.array_contains("_extra", F.col("_at")) | F.col("_fits"))))

    def place(k):
        at = k * F.col("_blocks") + F.col("_block")
        shard = F.least(F.size(F.filter("_bounds", lambda upto: upto <= at)), F.size("_bounds") - 1)
        return F.struct(k.alias("pass"), shard.cast("int").alias("shard"),
                        F.xxhash64(F.lit(seed + 1), k, F.col("_at"), F.col("doc_id")).alias("order"))

    return rows.withColumn("_copies", F.transform(taken, place))


def mix_plan(docs: DataFrame, shards: int = 64, seed: int = 17) -> DataFrame:
    """One row per document, without texts: doc_id, source, size, source_size, target, taken, copies.

    ``taken`` counts the document's words once for each time it is taken (0 to 3 times). Sources
    are weighed 1, 2, 3, repeating, in the order of their code points, null last. A null or empty text has
    no words and is taken like any other; repeated rows are taken alike; a table without words
    takes nothing of what weighs nothing; an empty table gives no rows.
    """
    narrow = staged(keyed(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "_size", "_at"), "mix-sizes")
    out = placed(narrow, source_plan(narrow, shards, seed), seed, F.col("_size"))
    return out.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target",
                      (F.col("_size") * F.size("_copies")).alias("taken"), F.col("_copies").alias("copies"))


def mix(docs: DataFrame, shards: int = 64, seed: int = 17) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken,
    dealt to ``shards`` partitions and shuffled inside them. Nulls, empty texts, repeated rows and empty
    tables as in ``mix_plan``."""
    narrow = staged(keyed(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "_size", "_at"), "mix-sizes")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", F.pmod(
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(_SPAN)).alias("_at"))
    size = F.size(words_of(F.col("_row.text")))
    out = placed(rows, source_plan(narrow, shards, seed), seed, size).select("_row", F.explode("_copies").alias("_copy"))
    dealt = out.repartition(shards, "_copy.shard").sortWithinPartitions("_copy.shard", "_copy.order")
    return dealt.select("_row.*")
