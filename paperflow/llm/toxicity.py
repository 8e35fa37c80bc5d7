"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word beginnings (inflected forms share them), adjacent
pairs and pairs with one word between, hashed into 2**BITS slots. They are hashed where the rows are; training runs over a bounded
sample of labelled rows in one task (per-coordinate learning rates, L1 sparsity) and gives a few
thousand weights, which go to the scoring tasks with the function.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.llm.common import pieces, small_batches

BITS = 20
#: Bound of the training sample: at most this many labelled rows, the same share of all of them.
MAX_TRAIN_ROWS = 10_000
EPOCHS, ALPHA, BETA, L1, L2, POSITIVE_WEIGHT = 2, 0.3, 1.0, 1.0, 0.1, 3.0
#: Lengths of the word beginnings that are features beside the whole words.
STEMS = (3, 4, 5)
KNOWN_WORDS = 150_000
FOLDS = 5
_PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class WordHashes(dict):
    """Word -> row of ``table``: 64-bit hashes of its lower-case letters without punctuation at
    its ends, and of its first STEMS letters (0 where it is not longer)."""

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros((1 << 16, 1 + len(STEMS)), np.uint64)

    def __missing__(self, word: bytes) -> int:
        bare = word.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]{}*#$%&|<>-_/\\")
        self[word] = row = len(self)
        if row >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row, 0] = xxhash.xxh64_intdigest(bare.encode())
        for k, n in enumerate(STEMS):
            if len(bare) > n:
                self.table[row, k + 1] = xxhash.xxh64_intdigest(f"{n}^{bare[:n]}".encode())
        return row


def feature_slots(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Hash slots of a text's words, word beginnings, pairs and skip-pairs, with repeats."""
    if len(hashes) > KNOWN_WORDS:
        hashes.clear()
    words = text.split()
    rows = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))
    seen = hashes.table[rows]
    h, stems = seen[:, 0], seen[:, 1:].ravel()
    kinds = [h, stems[stems != 0], h[:-1] * _PAIR[0] + h[1:] * _PAIR[1], h[:-2] * _SKIP[0] + h[2:] * _SKIP[1]]
    every = np.concatenate(kinds)
    return ((every * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - BITS)).astype(np.int32)


def ftrl(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights after EPOCHS passes in the given order; slot 2**BITS is the intercept (no L1)."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at == size - 1, 0.0, L1), 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for slots, y in zip(rows, labels, strict=True):
            at = np.append(slots, size - 1)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - y) * (POSITIVE_WEIGHT if y else 1.0) / np.where(at == size - 1, 1.0, max(1.0, np.sqrt(len(slots)) / 4))
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(size))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) that are not zero, the intercept last.

    Learns from the rows of ``labels`` whose crc32(doc_id as text) mod 5 is not 0; rows with a
    null label or doc_id, or without a document, teach nothing. Each label row counts.
    Without usable rows of both labels the only weight is a zero intercept: every score is 0.5.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    usable = labels.select("doc_id", "toxic").filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != 0))
    spread = 1 << 20
    total, least, most = usable.agg(F.count(F.lit(1)), F.min("toxic"), F.max("toxic")).first()
    if least == most:  # nothing, or nothing to tell apart
        return np.array([1 << BITS], np.int32), np.zeros(1)
    # One part in 2**20 at least: the limit below holds the bound however large the table is.
    share = spread if total <= max_rows else max(1, int(spread * max_rows * 0.98 / total))
    sample = usable.withColumn("_at", F.xxhash64("doc_id")).filter(F.pmod("_at", F.lit(spread)) < share)
    sample = sample.orderBy("_at", "toxic").limit(max_rows)
    joined = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).join(sample, "doc_id")

    def slots(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [np.unique(feature_slots(t.as_py(), hashes)).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["slots", "toxic", "at"])

    hashed = joined.select("text", F.col("toxic").cast("int").alias("toxic"), F.col("_at").alias("at")).mapInArrow(
        slots, "slots binary, toxic int, at long")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "toxic", "slots"])
        w = ftrl([np.frombuffer(b, np.int32) for b in rows["slots"]], rows["toxic"].to_numpy(float))
        at = np.flatnonzero(w)
        return pd.DataFrame({"slot": at.astype(np.int32), "weight": w[at]})

    with small_batches(docs.sparkSession):
        found = hashed.groupBy(F.lit(0).alias("one")).applyInPandas(fit, "slot int, weight double").toPandas()
    found = found[found["slot"] < 1 << BITS].sort_values("slot"), found[found["slot"] == 1 << BITS]["weight"].sum()
    return (np.append(found[0]["slot"].to_numpy(np.int32), 1 << BITS),
            np.append(found[0]["weight"].to_numpy(float), found[1]))


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str], name: str = "_score") -> DataFrame:
    """The columns ``keep`` of every document, and last its score ``name`` in 0..1 from its whole text.

    Null counts as empty: the intercept's score. Repeated rows score the same. The text goes to
    the workers once, whether it is kept or not.
    """
    at, weight = model
    sent = keep if "text" in keep else [*keep, "text"]
    text_at = sent.index("text")

    def run(batches):
        table = np.zeros((1 << BITS) + 1, np.float32)
        table[at] = weight
        hashes = WordHashes()
        for batch in pieces(batches):
            out = np.empty(batch.num_rows)
            for k, t in enumerate(batch.column(text_at).cast(pa.binary())):
                slots = feature_slots(t.as_py() or b"", hashes)
                slots = np.unique(slots[table[slots] != 0])  # few: the model is sparse
                out[k] = table[-1] + table[slots].sum(dtype=np.float64)
            score = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            rest = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(score)], [*keep, name])

    own = docs.select(*sent)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:len(keep)])
    return own.mapInArrow(run, f"{kinds}, {name} double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; see ``train`` and ``scored``.

    A null doc_id is not held out. An empty ``docs`` gives no rows. Scores use the text alone.
    """
    out = scored(docs, train(docs, labels), ["doc_id"])
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return out.select("doc_id", F.coalesce(crc % FOLDS == 0, F.lit(False)).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; repeated rows go or stay together.

    Null texts count as empty. Without evidence nothing is dropped: labels that are empty, null, or all the
    same leave every document. An empty ``docs`` gives no rows.
    """
    name = "_score"
    while name in docs.columns:
        name = f"_{name}"
    model = train(docs, labels)
    if not np.any(model[1]):
        return docs
    kept = scored(docs, model, docs.columns, name)
    return kept.filter(F.col(name) < 0.5).select(*docs.columns)
