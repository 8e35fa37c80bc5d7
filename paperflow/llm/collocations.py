"""Phrase collocations: phrases of 2 to 5 words, by how much more often they stand together than apart.

Top-order marginalisation: every word leads one window of the longest order, padded where its piece ends,
and only these windows are counted. The counts of all shorter phrases are sums over the windows that begin
with them, and Spark's ROLLUP over the lead-window columns gives them all, down to the language's number of
words; no shorter phrase is ever exploded by itself.

A phrase found ``least`` times holds only words, pairs and triples found as often, so a window may end before
the first rare one. Two rounds count hashes of words and pairs, then of triples of frequent pairs; hashes
travel packed by bucket. The frequent ones reach the tasks as a bit table of fixed size: a wrong hit there
only leaves a longer window, so the counts of frequent phrases are exact at every size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperflow.llm.common import staged_once

ORDER, LEAST, TOP = 5, 100, 2000
#: Words that a task gathers before it counts, and hashes that a bucket holds on average.
CHUNK, BUCKET = 1 << 20, 1 << 20
#: Bits of the table of frequent words, pairs and triples: 16 MB, whatever the corpus.
TABLE_BITS = 27
#: A byte that no UTF-8 text holds: the word behind the last one of a piece.
_END = b"\xff"
#: A-Z in lower case, the characters between pieces as line feeds, tabs as spaces.
_FOLD = bytes(10 if c in b".,;:!?\n\x0b\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_and_ends(text: bytes) -> list[bytes]:
    """The words of a text's pieces, ``_END`` behind each piece."""
    return (text.translate(_FOLD) + b"\n").replace(b"\n", b" " + _END + b" ").split()


def gram_hashes(words: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the ``order`` words from each index in ``at`` on, by the hashes of the single words."""
    mixed = np.full(len(at), order, np.uint64)
    for k in range(order):
        mixed = (mixed ^ words[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def table_bits(hashes: np.ndarray) -> np.ndarray:
    """Two places in the table for each hash."""
    return np.stack([hashes >> np.uint64(64 - TABLE_BITS), (hashes >> np.uint64(5)) & np.uint64((1 << TABLE_BITS) - 1)])


class Sequence:
    """A language's words in a row, as numbers; number 0 ends a piece. Numbers stay the same from one stretch of
    words to the next."""

    def __init__(self, lang: str):
        self.lang, self._number, self._parts, self.windows = lang, {_END: 0}, [], []
        self._spelled = np.zeros(1, np.uint64)

    def add(self, words: list[bytes]) -> int:
        number = self._number
        self._parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        return len(words)

    def close(self) -> Sequence:
        """Ends the stretch: its numbers, the hashes of its words and where words start."""
        self.ids = np.concatenate([*self._parts, np.zeros(1, np.int32)])
        self._parts = []
        self.vocabulary = list(self._number)
        seed = xxhash.xxh64_intdigest(self.lang)
        new = self.vocabulary[len(self._spelled):]
        self._spelled = np.append(self._spelled, np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in new), np.uint64, len(new)))
        self.hashes = self._spelled[self.ids]
        self.starts = np.flatnonzero(self.ids)
        return self

    def frequent(self, at: np.ndarray, order: int, table: np.ndarray) -> np.ndarray:
        """Those of the starts ``at`` whose ``order`` words are in the table."""
        bits = table_bits(gram_hashes(self.hashes, at, order))
        return at[((table[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)]

    def mixed(self, columns: np.ndarray) -> np.ndarray:
        """A hash of each column of word numbers."""
        out = np.zeros(columns.shape[1], np.uint64)
        for row in columns:
            out = (out ^ self._spelled[row]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def pairs(self) -> np.ndarray:
        return self.starts[self.ids[self.starts + 1] > 0]  # a word is never last: its piece ends behind it

    def triples(self, table: np.ndarray) -> np.ndarray:
        """Starts of three words whose two pairs are frequent."""
        pairs = self.frequent(self.pairs(), 2, table)
        return pairs[np.isin(pairs + 1, pairs, assume_unique=True)]


def lead_windows(own: Sequence, order: int, table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct windows as columns of word numbers, 0 for padding; their counts). With a ``table`` windows end
    before the first rare word, pair or triple; those of rare words are one empty window."""
    size = len(own.ids)
    if table is None:
        starts, on = own.starts, [own.ids[np.minimum(np.arange(size) + 1, size - 1)] > 0] * 2
    else:
        starts, on = own.frequent(own.starts, 1, table), [np.zeros(size, bool), np.zeros(size, bool)]
        on[0][own.frequent(own.pairs(), 2, table)] = True
        on[1][own.frequent(own.triples(table), 3, table)] = True
    lead, going = [own.ids[starts]], np.ones(len(starts), bool)
    for k in range(1, order):
        if table is None:
            going = going & on[0][np.minimum(starts + k - 1, size - 1)]
        else:
            going = going & (on[0][starts] if k == 1 else on[1][np.minimum(starts + k - 2, size - 1)])
        lead.append(np.where(going, own.ids[np.minimum(starts + k, size - 1)], 0))
    columns, counts = distinct(np.stack(lead), np.ones(len(starts), np.int64), len(own.vocabulary))
    rest = len(own.starts) - len(starts)
    if rest:
        columns, counts = np.concatenate([columns, np.zeros((order, 1), columns.dtype)], axis=1), np.append(counts, rest)
    return columns, counts


def distinct(columns: np.ndarray, counts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns, of numbers below ``base``, with their counts summed."""
    code = columns[0].astype(np.int64)
    for row in columns[1:]:
        code = np.unique(code, return_inverse=True)[1] * base + row
    _, where, which = np.unique(code, return_index=True, return_inverse=True)
    return columns[:, where], np.bincount(which, weights=counts, minlength=len(where)).astype(np.int64)


def by_sequence(docs: DataFrame, found, end, schema: str) -> DataFrame:
    """Record batches of ``found(Sequence)`` over every stretch of words that a task gathers by language, and of
    ``end(Sequence)`` behind the last one."""
    chunk = CHUNK

    def run(batches):
        held: dict[str, Sequence] = {}
        n = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in held:
                    held[lang] = Sequence(lang)
                n += held[lang].add(words_and_ends(text.as_py()))
                if n >= chunk:
                    for own in held.values():
                        yield from found(own.close())
                    n = 0
        for own in held.values():
            yield from found(own.close())
            yield from end(own)

    texts = docs.select(F.coalesce("lang", F.lit("und")), F.coalesce("text", F.lit("")).cast("binary"))
    return texts.mapInArrow(run, schema)


def counted_windows(docs: DataFrame, order: int, table=None, buckets: int = 1) -> DataFrame:
    """lang, w1 to w<order> (null behind the window's end) and c: the distinct windows with their counts.

    Each task counts its own and sends them packed, one row for each bucket of the windows' hashes; a bucket's
    windows are then added up.
    """
    names = ["lang", *(f"w{k + 1}" for k in range(order))]

    def gather(own):
        own.windows.append(lead_windows(own, order, table.value if table else None))
        if len(own.windows) > 1:
            columns, counts = (np.concatenate([w[k] for w in own.windows], axis=-1) for k in (0, 1))
            own.windows = [distinct(columns, counts, len(own.vocabulary))]
        return ()

    def pack(own):
        lead, counts = own.windows[0]
        bucket = (own.mixed(lead) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        offsets = pa.array(np.append(starts, len(by)), pa.int32())
        spelled = pa.array([None, *own.vocabulary[1:]], pa.binary()).cast(pa.string())
        columns = [pa.array([own.lang] * len(by), pa.string()), *(spelled.take(pa.array(row[by])) for row in lead), pa.array(counts[by], pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[by][starts], pa.int32()), *(pa.ListArray.from_arrays(offsets, c) for c in columns)],
                                         ["bucket", *names, "c"])

    def add_up(group: pa.Table) -> pa.Table:
        flat = pa.table({c: group.column(c).combine_chunks().flatten() for c in (*names, "c")})
        return flat.group_by(names).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select([*names, "c"])

    packed = by_sequence(docs, gather, pack, "bucket int, " + ", ".join(f"{c} array<string>" for c in names) + ", c array<long>")
    return packed.groupBy("bucket").applyInArrow(add_up, ", ".join(f"{c} string" for c in names) + ", c long")


def frequent_bits(docs: DataFrame, least: int, buckets: int, table=None) -> DataFrame:
    """slot, mask: the table's bits of the words and pairs, or with the ``table`` of these of the triples, whose
    hash is counted ``least`` times or more."""
    def pack(own):
        if table:
            hashes = gram_hashes(own.hashes, own.triples(table.value), 3)
        else:
            hashes = np.concatenate([gram_hashes(own.hashes, own.starts, 1), gram_hashes(own.hashes, own.pairs(), 2)])
        hashes, counts = np.unique(hashes, return_counts=True)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        parts = [(k, order[a:b]) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
        # Counts as byte planes: most are 1, so all but one plane compress away.
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in parts], pa.int32()), pa.array([hashes[x].tobytes() for _, x in parts], pa.binary()),
             pa.array([counts[x].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() for _, x in parts], pa.binary())],
            ["bucket", "hashes", "counts"])

    def settle(group: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in group.column("hashes")])
        counts = np.concatenate([np.ascontiguousarray(np.frombuffer(x.as_py(), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
                                 for x in group.column("counts")])
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order].astype(np.int64)
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        often = hashes[starts][np.add.reduceat(counts, starts) >= least]
        bits = table_bits(often).ravel()
        return pa.table([(bits >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)], ["slot", "mask"])

    packed = by_sequence(docs, pack, lambda own: (), "bucket int, hashes binary, counts binary")
    return packed.groupBy("bucket").applyInArrow(settle, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))


def bit_table(docs: DataFrame, least: int, buckets: int):
    """Broadcast bit table of the frequent words, pairs and triples: 2**TABLE_BITS bits, of any number of them."""
    bits, table = np.zeros(1 << (TABLE_BITS - 6), np.uint64), None
    for _ in range(2):
        found = staged_once(frequent_bits(docs, least, buckets, table), "collocation-bits").toArrow()
        bits[found.column("slot").to_numpy()] |= found.column("mask").to_numpy().view(np.uint64)
        table = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
    return table


def marginals(windows: DataFrame, order: int, least: int) -> DataFrame:
    """lang, words, k and f: languages (k = 0) and the phrases of k words found ``least`` times or more."""
    names = [f"w{k + 1}" for k in range(order)]
    summed = windows.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    # ROLLUP over order + 1 columns: grouping id 2**j - 1 has the last j columns summed away.
    k = F.lit(order) - F.round(F.log2(F.col("g") + 1)).cast("int")
    words = F.slice(F.array(*names), 1, F.col("k"))
    return summed.withColumn("k", k).filter("k >= 0").withColumn("words", words).filter(
        (F.col("k") == 0) | (F.col("f") >= least) & F.element_at("words", -1).isNotNull()).select("lang", "words", "k", "f")


def association(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact while the products have 38 digits or fewer."""
    whole = "decimal(38,0)"
    top = (F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(19,0)")).cast("decimal(23,0)") * n.cast("decimal(19,0)")
    return F.call_function("div", top.cast(whole), (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast(whole)).cast("long")


def phrase_counts(docs: DataFrame, order: int = ORDER, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang and n: its number of words; lang, words, k, f: its phrases of 1 to ``order`` words found ``least`` times)."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + n_bytes // (5 * BUCKET)
    windows = counted_windows(docs, order, bit_table(docs, least, buckets), buckets)
    found = staged_once(marginals(windows, order, least), "collocation-phrases")
    return found.filter("k = 0").select("lang", F.col("f").alias("n")), found.filter("k > 0")


def collocations(docs: DataFrame, order: int = ORDER, least: int = LEAST, top: int = TOP, share: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, k: each language's first ``top`` phrases.

    Texts, A-Z in lower case, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words
    ``[^\\x20\\x09]+``. Candidates are phrases of 2 to ``order`` words found ``least`` times or more within
    pieces (a). Their cut into l * r with the lowest floor(1000 * a * n / (l * r)) counts, ties to the shortest
    first part; n is the language's number of words. A candidate inside a longer one that is found ``share``
    percent as often or more is dropped. Order: score and a descending, phrase ascending (bytes).

    A null language counts as ``und``, a null text as empty; repeated rows count each time. An empty table, and
    a language without candidates, give no rows. Other columns are not looked at.
    """
    words, phrases = phrase_counts(docs, order, least)
    spelled = F.array_join("words", " ")
    found = phrases.select("lang", spelled.alias("phrase"), "f")
    candidates = phrases.filter("k >= 2").withColumn("phrase", spelled).withColumnRenamed("f", "a")
    parts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumns({
        "first": F.array_join(F.slice("words", 1, F.col("cut")), " "),
        "rest": F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ")})
    scored = (parts.join(found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(words, "lang")
              .withColumn("score", association(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
              .groupBy("lang", "phrase", "a", "n", "k").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least")))
    inner = (candidates.filter("k >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
             .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .groupBy("lang", F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("phrase"))
             .agg(F.max("a").alias("longer")))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    by = Window.partitionBy("lang").orderBy(F.desc("least.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "least.l", "least.r", "n", "least.score", F.col("k").cast("long").alias("k"))
