"""Line dedup: repeated passages of two lines or more removed.

``passage_dedup`` (the query and the pipeline's stage) cuts texts into content-defined chunks: a
chunk ends where a rolling hash over the last 32 bytes is 0 in its upper bits, and at the end of its
line, so that equal lines have equal chunks whatever stands around them. Chunks whose digest is found
more than once are the seeds; a line all of whose chunks are seeds is extended to the neighbouring
line of that kind, and such windows of two lines are compared byte for byte. A repeated passage is
so found whole, up to the lines where the texts differ. Of equal windows the first (smallest doc_id,
then position) stays, with both its lines; the lines of the others are removed from their texts.

``line_dedup`` compares whole chunks of several lines only: a text's lines are hashed, and a rolling
hash over the last two line hashes decides where a chunk ends. The lines at both ends of a passage
share a chunk with foreign lines there, and stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperflow.llm.common import pieces, small_batches, staged_once

#: A chunk ends behind a line whose rolling hash is 0 modulo DIVISOR, with LEAST to MOST lines.
DIVISOR, LEAST, MOST = 2, 2, 32
#: A removed run of lines has so many words in the query and in the pipeline's stage: short lines that texts
#: share by chance ("Yes.", "No.") stay.
LEAST_WORDS = 10
#: A chunk inside a line has LEAST_BYTES bytes or more, and ends where the upper CUT_BITS bits of the rolling hash are 0.
LEAST_BYTES, CUT_BITS = 128, 9
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)
_POSITION = "decimal(38,0)"


def chunks(text: bytes) -> list[tuple[int, int]]:
    """(first line, end line) of the chunks of a text's lines."""
    out, start, before = [], 0, 0
    lines = text.split(b"\n")
    for k, line in enumerate(lines):
        here = xxhash.xxh64_intdigest(line)
        size = k + 1 - start
        # Both hashes enter, in order: the window of the rolling hash is two lines.
        rolled = (before * 0x9E3779B97F4A7C15 + here) >> 7
        if size >= MOST or size >= LEAST and rolled % DIVISOR == 0:
            out.append((start, k + 1))
            start = k + 1
        before = here
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def multi_line(lines: list[bytes]) -> bool:
    """At least two lines with a word; only such chunks are compared and removed."""
    return sum(1 for x in lines if x.strip()) >= 2


def chunk_table(docs: DataFrame, digest, with_bytes: bool) -> DataFrame:
    """_doc, _key, no, h and, if asked for, the bytes of every multi-line chunk."""
    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for k, value in enumerate(batch.column(2)):
                lines = (text := value.as_py()).split(b"\n")
                for no, (a, b) in enumerate(chunks(text)):
                    if multi_line(lines[a:b]):
                        joined = b"\n".join(lines[a:b])
                        rows.append((k, no, digest(joined), joined if with_bytes else None))
            at = pa.array([r[0] for r in rows], pa.int64())
            cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["_doc", "_key", "no", "h", "bytes"])

    found = keyed(docs).select("_doc", "_key", F.coalesce("text", F.lit("")).cast("binary")).mapInArrow(
        run, "_doc decimal(20,0), _key long, no long, h binary, bytes binary")
    return found if with_bytes else found.drop("bytes")


def keyed(docs: DataFrame) -> DataFrame:
    """Adds _doc (doc_id, null last) and _key (hash of the text)."""
    last = F.lit(str(1 << 63)).cast("decimal(20,0)")
    return docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last),
                             "_key": F.xxhash64(F.coalesce("text", F.lit("")))})


def removals(docs: DataFrame, digest) -> DataFrame:
    """_doc, _key and the chunk numbers to remove, with the doc_ids where their first copies stand."""
    position = (F.col("_doc") * F.lit(1 << 32) + F.col("no")).cast(_POSITION)
    # Grouping by the bytes themselves is the byte comparison; copies collapse before the shuffle.
    by_bytes = chunk_table(docs, digest, True).groupBy("h", "bytes").agg(
        F.min(position).alias("first"), F.count(F.lit(1)).alias("n"))
    # Of a digest that stands for different bytes nothing is removed.
    repeated = by_bytes.groupBy("h").agg(
        F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n")).filter("texts = 1 and n > 1")
    later = chunk_table(docs, digest, False).join(repeated.select("h", "first"), "h").filter(position != F.col("first"))
    origin = F.floor(F.col("first") / F.lit(1 << 32)).cast("decimal(20,0)")
    return later.groupBy("_doc", "_key").agg(
        F.sort_array(F.collect_set("no")).alias("_gone"), F.sort_array(F.collect_set(origin)).alias("_origins"))


def digest128(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def line_dedup(docs: DataFrame, digest=digest128) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated chunks cut out of ``text``, and
    ``_removed_chunks``, ``_removed_lines``, ``_origins`` (doc_ids with the copies that stay).

    A null text stays null and an empty one empty; a text that loses all its lines becomes
    empty; rows are never dropped. Rows with equal doc_id count as one document (null doc_ids
    too): equal ones are treated alike. A chunk repeated inside one document stays once. An ``n_chars`` column is
    brought up to date. An empty table gives no rows.
    """
    names = docs.columns
    gone = removals(docs, digest)
    joined = keyed(docs).join(gone, ["_doc", "_key"], "left")
    text_at = names.index("text")

    def run(batches):
        for batch in batches:
            texts, counts, cut = batch.column(text_at).to_pylist(), [], []
            for k, drop in enumerate(batch.column(len(names)).to_pylist()):
                n = 0
                if drop:
                    drop = set(drop)
                    lines = texts[k].encode().split(b"\n")
                    parts = [(no in drop, lines[a:b]) for no, (a, b) in enumerate(chunks(texts[k].encode()))]
                    texts[k] = b"\n".join(x for out, own in parts if not out for x in own).decode()
                    n = sum(len(own) for out, own in parts if out)
                counts.append(len(drop or ()))
                cut.append(n)
            cols = [pa.array(texts, pa.string()) if k == text_at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(counts, pa.int64()), pa.array(cut, pa.int64()), batch.column(len(names) + 1)],
                [*names, "_removed_chunks", "_removed_lines", "_origins"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = joined.select(*names, "_gone", F.col("_origins").cast("array<long>").alias("_origins")).mapInArrow(
        run, f"{kinds}, _removed_chunks long, _removed_lines long, _origins array<long>")
    if "n_chars" in names:
        changed = F.when(F.col("_removed_chunks") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out


def windows(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end line) of the windows of two neighbouring lines with a word, and blank lines between them."""
    at = [k for k, line in enumerate(lines) if line.strip()]
    return [(a, b + 1) for a, b in zip(at, at[1:])]


def boundaries(text: bytes) -> list[int]:
    """Where the rolling (gear) hash of the 32 bytes before is 0 in its upper bits, in order."""
    if len(text) <= LEAST_BYTES:
        return []
    rolled = _GEAR[np.frombuffer(text, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # sums over 2, 4, ... 32 bytes, each byte shifted by its distance
        longer = rolled.copy()
        longer[step:] += rolled[:-step] << np.uint32(step)
        rolled = longer
    return (np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()


def line_chunks(text: bytes) -> list[list[bytes]]:
    """The content-defined chunks of every line with a word; they add up to the line.

    A boundary lies LEAST_BYTES or more behind the line's beginning, so the hash never sees another line.
    """
    out, cuts, k, start = [], boundaries(text), 0, 0
    for line in text.split(b"\n"):
        end = start + len(line)
        if line.strip():
            own, begun = [], start
            while k < len(cuts) and cuts[k] < end:
                if cuts[k] - begun >= LEAST_BYTES:
                    own.append(text[begun:cuts[k]])
                    begun = cuts[k]
                k += 1
            own.append(text[begun:end])
            out.append(own)
        start = end + 1
    return out


def line_chunk_table(docs: DataFrame, digest) -> DataFrame:
    """_doc, _key, no (line), part (chunk in the line), parts (of the line) and h of every chunk."""
    def run(batches):
        for batch in batches:
            at, nos, part, parts, found = [], [], [], [], []
            for k, value in enumerate(batch.column(2)):
                for no, own in enumerate(line_chunks(value.as_py())):
                    at += [k] * len(own)
                    nos += [no] * len(own)
                    part += range(len(own))
                    parts += [len(own)] * len(own)
                    found += map(digest, own)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(x, pa.int32()) for x in (nos, part, parts)),
                 pa.array(found, pa.binary())], ["_doc", "_key", "no", "part", "parts", "h"])

    return keyed(docs).select("_doc", "_key", F.coalesce("text", F.lit("")).cast("binary")).mapInArrow(
        run, "_doc decimal(20,0), _key long, no int, part int, parts int, h binary")


def seeded_windows(docs: DataFrame, digest) -> DataFrame:
    """_doc, _key, no, h and bytes of the windows of two lines all of whose chunks have a digest found more than once."""
    with small_batches(docs.sparkSession):
        every = staged_once(line_chunk_table(docs, digest), "line-chunks")
    often = every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    seeds = every.join(often, "h").groupBy("_doc", "_key").agg(F.collect_set(F.struct("no", "part", "parts")).alias("seeds"))
    texts = keyed(docs).select("_doc", "_key", F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            at, nos, digests, found = [], [], [], []
            for k, value in enumerate(batch.column(2)):
                lines = value.as_py().split(b"\n")
                own = windows(lines)
                missing: dict[int, int] = {}
                for seed in batch.column(3)[k].as_py():
                    missing[seed["no"]] = missing.get(seed["no"], seed["parts"]) - 1
                for no in sorted(missing):
                    if missing[no] == 0 and missing.get(no + 1) == 0:
                        a, b = own[no]
                        at.append(k)
                        nos.append(no)
                        found.append(b"\n".join(lines[a:b]))
                        digests.append(digest(found[-1]))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(nos, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(found, pa.binary())], ["_doc", "_key", "no", "h", "bytes"])

    return texts.join(seeds, ["_doc", "_key"]).select("_doc", "_key", "text", "seeds").mapInArrow(
        run, "_doc decimal(20,0), _key long, no long, h binary, bytes binary")


def repeats(docs: DataFrame, digest) -> DataFrame:
    """_doc, _key, the windows that repeat an earlier one, those that are repeated later and stay,
    and the doc_ids where the first copies stand."""
    position = (F.col("_doc") * F.lit(1 << 32) + F.col("no")).cast(_POSITION)
    seeded = seeded_windows(docs, digest)
    with small_batches(docs.sparkSession):
        found = staged_once(seeded, "line-windows")
    by_bytes = found.groupBy("h", "bytes").agg(F.min(position).alias("first"), F.count(F.lit(1)).alias("n"))
    # Of a digest that stands for different bytes nothing is removed.
    certain = by_bytes.groupBy("h").agg(
        F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n")).filter("texts = 1 and n > 1")
    placed = found.select("_doc", "_key", "no", "h").join(certain.select("h", "first"), "h")
    later = position != F.col("first")
    origin = F.floor(F.col("first") / F.lit(1 << 32)).cast("decimal(20,0)")
    return placed.groupBy("_doc", "_key").agg(
        F.collect_set(F.when(later, F.col("no"))).alias("_gone"), F.collect_set(F.when(~later, F.col("no"))).alias("_stay"),
        F.sort_array(F.collect_set(F.when(later, origin))).alias("_origins")).filter(F.size("_gone") > 0)


def passage_dedup(docs: DataFrame, digest=digest128, least_words: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated passages cut out of ``text``, and
    ``_removed_chunks`` (runs of lines cut out), ``_removed_lines``, ``_origins`` (doc_ids with the copies that stay).

    A line goes if it lies in a window with an earlier copy and in none that is the first of several;
    blank lines between two lines of a window go with them. A single repeated line stays, and so does a run
    of lines with fewer than ``least_words`` words. A null text stays null and an empty one empty; a text that
    loses all its lines becomes empty; rows are never dropped. Rows with equal doc_id count as one document
    (null doc_ids too): equal ones are treated alike. A passage repeated inside one document stays once. An
    ``n_chars`` column is brought up to date, input columns named like an output are replaced, others keep
    their values whatever their names. An empty table gives no rows.
    """
    added = ("_removed_chunks", "_removed_lines", "_origins")
    gone = repeats(docs.select("doc_id", "text"), digest)
    rows = keyed(docs.select("doc_id", "text", F.struct("*").alias("row")))
    joined = rows.join(gone, ["_doc", "_key"], "left").select(
        "row", "_gone", "_stay", F.col("_origins").cast("array<long>").alias("_origins"))
    text_at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in pieces(batches):
            # A text travels once, in its row, and comes back a second time only if it was cut.
            whole, texts, runs, cut = batch.column(0).field(text_at).cast(pa.binary()), [None] * batch.num_rows, [], []
            gone, stay = batch.column(1), batch.column(2)
            for k in range(batch.num_rows):
                kept: list[list[int]] = []
                if gone[k].is_valid:
                    lines = whole[k].as_py().split(b"\n")
                    own = windows(lines)
                    out = {x for no in gone[k].as_py() for x in range(*own[no])}
                    out.difference_update(x for no in stay[k].as_py() for x in range(*own[no]))
                    parts: list[list[int]] = []
                    for x in sorted(out):
                        if parts and parts[-1][-1] == x - 1:
                            parts[-1].append(x)
                        else:
                            parts.append([x])
                    kept = [p for p in parts if sum(len(lines[x].split()) for x in p) >= least_words]
                    drop = {x for p in kept for x in p}
                    if drop:
                        texts[k] = b"\n".join(x for at, x in enumerate(lines) if at not in drop)
                runs.append(len(kept))
                cut.append(sum(map(len, kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()), pa.array(runs, pa.int64()), pa.array(cut, pa.int64()), batch.column(3)],
                ["row", "text", *added])

    kinds = (T.BinaryType(), T.LongType(), T.LongType(), T.ArrayType(T.LongType()))
    out = joined.mapInArrow(run, T.StructType([T.StructField("row", joined.schema["row"].dataType)] + [
        T.StructField(c, t) for c, t in zip(("text", *added), kinds)]))
    changed = F.col("_removed_lines") > 0
    new = {"text": F.when(changed, F.col("text").cast("string")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length(new["text"])).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    own = [new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns if c.lower() not in added]
    return out.select(*own, "_removed_chunks", "_removed_lines", F.when(changed, F.col("_origins")).alias("_origins"))


def report(deduped: DataFrame) -> DataFrame:
    """doc_id, what was removed, and the digest of the text that is left."""
    text = F.coalesce("text", F.lit(""))
    return deduped.select(
        "doc_id", F.col("_removed_chunks").alias("removed_chunks"), F.col("_removed_lines").alias("removed_lines"),
        F.coalesce("_origins", F.array().cast("array<long>")).alias("origin_doc_ids"),
        F.char_length(text).cast("long").alias("n_chars_left"), F.sha2(text, 256).alias("text_sha256"))
