"""Substring dedup: words covered by a window of words that starts earlier in the corpus are removed.

Every text is read as words ``[^\\x20\\x09-\\x0D]+``; a Rabin-Karp hash is rolled over every window of
``size`` words. A first exchange by hash counts the windows; those whose hash is found more than once are
candidates. A second exchange, of the candidates only, takes a 128-bit digest of the window's words, so
that a clash of the rolling hashes removes nothing. Of equal windows the first (smallest doc_id, then
position) stays; the others' words go, overlapping windows merged into maximal intervals.

Windows travel packed by bucket of the hash: one row holds a task's windows of one bucket. A task first
settles what it sees itself and sends each hash once, so a window that stands in a third of all
documents costs one entry per task. The number of buckets follows the text's bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperflow.llm.common import documents_as_rows, staged_once, words_of

SIZE = 20
#: Windows that a task gathers before it packs them, and that a bucket holds on average.
CHUNK, BUCKET = 1 << 19, 1 << 20
BASE = 0x9E3779B97F4A7C15
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_PACKED = "bucket int, hashes binary, docs binary, positions binary"
_PLACES = "doc long, key long, at array<int>"


def rabin_karp(words: list[bytes], size: int) -> np.ndarray:
    """Hash modulo 2**64 of every window of ``size`` words, as a column."""
    n = len(words)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    powers = np.full(n, BASE, np.uint64).cumprod()
    sums = np.concatenate([np.zeros(1, np.uint64), (hashed * powers).cumsum()])
    back = np.full(max(0, n - size + 1), pow(BASE, -1, 1 << 64), np.uint64).cumprod()
    rolled = (sums[size:] - sums[:n + 1 - size]) * back
    rolled ^= rolled >> np.uint64(31)
    return ((rolled * np.uint64(0xBF58476D1CE4E5B9)) ^ (rolled >> np.uint64(29)))[:, None]


def word_digest(window: bytes) -> bytes:
    return hashlib.blake2b(window, digest_size=16).digest()


def word_digests(words: list[bytes], starts: np.ndarray, size: int, digest) -> np.ndarray:
    """Two columns: the 128-bit digest of the words of the windows at ``starts``."""
    joined = b"".join(digest(b" ".join(words[k:k + size])) for k in starts.tolist())
    return np.frombuffer(joined, np.uint64).reshape(-1, 2)


# Packing: byte planes, since small numbers' upper bytes are zero and compress away.

def _planes(numbers: np.ndarray) -> bytes:
    wide = np.ascontiguousarray(numbers, np.uint64)
    return wide.view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def pack(doc: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    """Places sorted by document as (documents with their counts, positions)."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(doc)))
    docs = np.concatenate([doc[starts].view(np.uint64), key[starts].view(np.uint64), counts.astype(np.uint64)])
    steps = np.diff(at.astype(np.int64), prepend=np.int64(0))
    steps[starts] = at[starts]
    return _planes(docs), _planes(steps.view(np.uint64))


def unpack(docs: bytes, positions: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, key, counts = _numbers(docs).reshape(3, -1)
    counts = counts.astype(np.int64)
    sums = _numbers(positions).view(np.int64).cumsum()
    starts = np.cumsum(counts) - counts
    first = np.concatenate([[0], sums])[starts] if len(starts) else np.zeros(0, np.int64)
    return np.repeat(doc.view(np.int64), counts), np.repeat(key.view(np.int64), counts), sums - np.repeat(first, counts)


def found_again(hashes: np.ndarray, doc, key, at, later_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each hash's first place, and of the places of hashes with several places: all of
    them, or those behind the first."""
    order = np.lexsort(hashes.T[::-1])
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1)
    alone = new[:-1] & new[1:]
    single, order = order[alone], order[~alone]
    order = order[np.lexsort((at[order], key[order], doc[order], *hashes[order].T[::-1]))]
    h, d, k, a = hashes[order], doc[order], key[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]).any(axis=1)
    same = np.zeros(len(order), bool)
    same[1:] = ~new[1:] & (d[1:] == d[:-1]) & (k[1:] == k[:-1]) & (a[1:] == a[:-1])
    new, order = new[~same], order[~same]  # repeated rows are one document
    several = ~new
    if not later_only:
        several[:-1] |= ~new[1:]
    return np.concatenate([single, order[new]]), order[several]


def _by_part(part: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray, hashes: np.ndarray | None) -> list[tuple]:
    """Packed rows of the places, one for each part."""
    order = np.lexsort((at, key, doc, part))
    part = part[order]
    ends = np.flatnonzero(np.diff(part, append=-1)) + 1
    rows = []
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        own = order[a:b]
        rows.append((int(part[a]), b"" if hashes is None else hashes[own].tobytes(), *pack(doc[own], key[own], at[own])))
    return rows


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array([r[c] for r in rows], kinds[c]) for c in range(4)], ["bucket", "hashes", "docs", "positions"])


def _packed_rows(pieces: list[tuple], buckets: int, later_only: bool) -> Iterator[pa.RecordBatch]:
    """A task's windows, settled among themselves, by bucket; what is settled travels without hashes."""
    hashes = np.concatenate([p[0] for p in pieces])
    doc, key = (np.concatenate([np.full(len(p[0]), p[c], np.int64) for p in pieces]) for c in (1, 2))
    at = np.concatenate([p[3] for p in pieces]).astype(np.int64)
    first, again = found_again(hashes, doc, key, at, later_only)
    rows = _by_part(key[again] % buckets, doc[again], key[again], at[again], None)
    bucket = (hashes[first, 0] % np.uint64(buckets)).astype(np.int64)
    rows += _by_part(bucket, doc[first], key[first], at[first], hashes[first])
    yield from _table(rows).to_batches()


def _places(doc: np.ndarray, key: np.ndarray, at: np.ndarray) -> pa.Table:
    """doc, key and the sorted positions, one row for each document."""
    order = np.lexsort((at, key, doc))
    doc, key, at = doc[order], key[order], at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    other = new.copy()
    other[1:] |= at[1:] != at[:-1]  # repeated rows are one document
    doc, key, at, new = doc[other], key[other], at[other], new[other]
    starts = np.flatnonzero(new)
    ends = np.append(starts, len(doc))
    return pa.table([pa.array(doc[starts]), pa.array(key[starts]),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))], ["doc", "key", "at"])


def again_by_document(windows: DataFrame, hashed, columns: int, buckets: int, later_only: bool) -> DataFrame:
    """doc, key, at: where the windows stand whose hash is found in several places.

    ``hashed(text, at)`` gives the hashes of a text's windows (``at``: only of these) and their positions.
    """
    chunk = CHUNK

    def pack_windows(batches):
        pieces, held = [], 0
        for batch in batches:
            doc, key, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for k, text in enumerate(batch.column(2)):
                hashes, starts = hashed(text.as_py(), at[k].as_py())
                if len(starts):
                    pieces.append((hashes, doc[k], key[k], starts))
                    held += len(starts)
                if held >= chunk:
                    yield from _packed_rows(pieces, buckets, later_only)
                    pieces, held = [], 0
        if pieces:
            yield from _packed_rows(pieces, buckets, later_only)

    def settle(table: pa.Table) -> pa.Table:
        hashes, places, settled = [], [], []
        for h, docs, positions in zip(*(table.column(c) for c in (1, 2, 3))):
            found = unpack(docs.as_py(), positions.as_py())
            if len(h.as_py()):
                hashes.append(np.frombuffer(h.as_py(), np.uint64).reshape(-1, columns))
                places.append(found)
            else:
                settled.append(found)
        if hashes:
            doc, key, at = (np.concatenate([p[c] for p in places]) for c in range(3))
            _, again = found_again(np.concatenate(hashes), doc, key, at, later_only)
            settled.append((doc[again], key[again], at[again]))
        doc, key, at = (np.concatenate([p[c] for p in settled]) for c in range(3))
        return _table(_by_part(key % buckets, doc, key, at, None))

    def gather(table: pa.Table) -> pa.Table:
        found = [unpack(docs.as_py(), positions.as_py()) for docs, positions in zip(table.column(2), table.column(3))]
        return _places(*(np.concatenate([p[c] for p in found]) for c in range(3)))

    packed = windows.mapInArrow(pack_windows, _PACKED)
    settled = packed.groupBy("bucket").applyInArrow(settle, _PACKED)
    return settled.groupBy("bucket").applyInArrow(gather, _PLACES)


def repeated_windows(docs: DataFrame, size: int = SIZE, rolling=rabin_karp, digest=word_digest) -> DataFrame:
    """doc, key and the sorted positions (in words) of the windows that also start earlier."""
    texts = documents_as_rows(docs).select(
        "doc", "key", F.coalesce(F.col("row.text"), F.lit("")).cast("binary").alias("text"))

    def roll(text: bytes, _):
        words = text.split()
        return (rolling(words, size), np.arange(len(words) - size + 1)) if len(words) >= size else (None, ())

    def take(text: bytes, at):
        starts = np.asarray(at, np.int64)
        return word_digests(text.split(), starts, size, digest), starts

    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    everywhere = texts.withColumn("at", F.lit(None).cast("array<int>"))
    candidates = staged_once(again_by_document(everywhere, roll, 1, 1 + n_bytes // (5 * BUCKET), False), "substring-candidates")
    n_windows = candidates.agg(F.sum(F.size("at").cast("long"))).first()[0] or 0
    chosen = texts.join(candidates, ["doc", "key"]).select("doc", "key", "text", "at")
    return again_by_document(chosen, take, 2, 1 + n_windows // BUCKET, True)


def intervals(at: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal (start, end) runs of words covered by the windows at the sorted positions ``at``."""
    out: list[list[int]] = []
    for k in at:
        if out and k <= out[-1][1]:
            out[-1][1] = k + size
        else:
            out.append([k, k + size])
    return [(a, b) for a, b in out]


def substring_dedup(docs: DataFrame, size: int = SIZE, rolling=rabin_karp, digest=word_digest) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated words cut out of ``text``, and ``_n_words`` (of the
    input text), ``_n_removed`` and ``_removed`` (maximal intervals, start and end in words, end exclusive).

    The white space behind a removed word goes with it, so the words left are those kept, in order. A null
    text stays null, an empty one empty, and a text of fewer than ``size`` words as it is; rows are never
    dropped. Rows with equal doc_id and text (null doc_ids too) count as one document and are treated
    alike; of rows with equal doc_id and different texts one comes first, the same in every run. null
    doc_ids come last. An ``n_chars`` column is brought up to date; input columns named like an output are
    replaced. An empty table gives no rows.
    """
    names = docs.columns
    gone = staged_once(repeated_windows(docs, size, rolling, digest), "substring-removals")
    joined = documents_as_rows(docs).join(gone, ["doc", "key"], "left").select(
        "row", F.coalesce("row.text", F.lit("")).cast("binary").alias("text"), "at")

    def cut(batches):
        for batch in batches:
            texts, counts, removed, runs = [], [], [], []
            for text, at in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                own = intervals(at.as_py(), size) if at.is_valid else []
                if own:
                    starts = [m.start() for m in _WORD.finditer(text)]
                    counts.append(len(starts))
                    starts.append(len(text))
                    ends = [0, *(starts[b] for _, b in own)]
                    text = b"".join(text[x:starts[a]] for x, (a, _) in zip(ends, own)) + text[ends[-1]:]
                else:
                    counts.append(len(text.split()))
                texts.append(text)
                removed.append(sum(b - a for a, b in own))
                runs.append([{"start": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["row", "text", "_n_words", "_n_removed", "_removed"])

    schema = T.StructType([T.StructField("row", joined.schema["row"].dataType)] + [
        T.StructField(c, kind) for c, kind in (
            ("text", T.BinaryType()), ("_n_words", T.LongType()), ("_n_removed", T.LongType()),
            ("_removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))))])
    out = joined.mapInArrow(cut, schema)
    changed = F.col("_n_removed") > 0
    new = {"text": F.when(changed, F.col("text").cast("string")).otherwise(F.col("row.text"))}
    if "n_chars" in names:
        new["n_chars"] = F.when(changed, F.char_length(new["text"])).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    added = ["_n_words", "_n_removed", "_removed"]
    kept = [new.get(c, F.col("row").getField(c)).alias(c) for c in names if c.lower() not in added]
    return out.select(*kept, *added)


def report(deduped: DataFrame) -> DataFrame:
    """doc_id, the words of the input, those removed, and the digest of those kept, joined by one space."""
    return deduped.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
                          F.sha2(F.array_join(words_of(F.col("text")), " "), 256).alias("kept_sha256"))
