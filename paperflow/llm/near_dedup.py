"""MinHash near-dedup by a chosen-path set similarity join.

A text is the set of its shingles, of 4 words unless told otherwise. ``TREES`` independent trees branch the texts by
chosen minwise tokens: a node's texts go to the child of their next token until a node is small,
and small nodes are compared exhaustively. Nodes that stay large although their tokens agree
are crowds of similar texts; they are compared in small parts that all hold the crowd's most
central texts. A first look at the minwise tokens leaves the texts that have a partner; exact
intersections of the whole sets confirm each link. Inside a small node only a spanning
forest of its links is passed on, so no crowd emits all its pairs. Groups are the connected components.
Of a crowd's texts that these links leave in different groups, all those that may still be linked are
then compared block by block; a large crowd is dealt to parts, and every pair of parts is compared.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.llm.common import small_batches, staged

#: Words per shingle, minwise tokens per text, trees, tokens on a path.
SHINGLE, TOKENS, TREES, DEPTH = 4, 64, 12, 3
#: A node of more texts branches on; texts that one task holds of a crowd; central texts in each small part.
SMALL, CROWD, CENTRAL = 64, 4096, 16
#: Texts in each of the two blocks of a crowd that are compared at a time.
BLOCK = 256
#: Links: 100 * intersection >= SIMILARITY * union.
SIMILARITY = 80
#: Share of equal tokens below which a pair is not looked at: at 0.8 similarity, 64 tokens fall
#: this low once in a hundred million pairs.
GLANCE = 0.5
KNOWN_WORDS = 150_000
_RNG = np.random.default_rng(20240817)
_MULTIPLY = (_RNG.integers(0, 1 << 31, TOKENS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, TOKENS, dtype=np.uint32)
#: For each tree the tokens on its paths; the first differs from tree to tree.
PATHS = [[t, *[int(x) for x in _RNG.permutation([k for k in range(TOKENS) if k != t])[:DEPTH - 1]]] for t in range(TREES)]
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def words_in(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z in lower case (bytes methods know ASCII only)."""
    return text.lower().split()


def shingles(words: list[bytes], hashes: WordHashes, length: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``length`` (up to 5) words; fewer words are one shingle."""
    if len(words) < length:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))] if words else [], np.uint64)
    if len(hashes) > KNOWN_WORDS:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - length + 1
    mixed = sum(h[k:k + n] * _POWERS[k] for k in range(length))
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9))


def minwise(of: np.ndarray) -> np.ndarray:
    """TOKENS minwise tokens of a set that is not empty."""
    x = (of >> np.uint64(32)).astype(np.uint32)
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 4096):  # bounded memory for long texts
        np.minimum(out, (x[k:k + 4096, None] * _MULTIPLY + _ADD).min(axis=0), out=out)
    return out


def prints(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """doc_id, row key, digest of the words, set size and minwise tokens of every row (empty: none)."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            digests, sizes, tokens = [], [], []
            for value in batch.column(2):
                words = words_in(value.as_py())
                own = shingles(words, hashes, length)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                tokens.append(minwise(own).view(np.int32) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int32()))], ["doc_id", "key", "digest", "n_shingles", "tokens"])

    raw = F.coalesce("text", F.lit("")).cast("binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(raw), raw).mapInArrow(
        run, f"doc_id {kind}, key long, digest binary, n_shingles long, tokens array<int>")


def small_nodes(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, digest) of all nodes with 2 to SMALL texts and of the parts of crowds; and the crowds
    (tree, crowd, parts, part, digest). A crowd of more than CROWD texts is dealt, anew in each tree, to parts of about that size."""
    tree = [F.struct(F.lit(t).alias("tree"), *[F.xxhash64(F.lit(t), *[F.col("tokens")[i] for i in path[:d + 1]]).alias(f"k{d}")
                       for d in range(DEPTH)]) for t, path in enumerate(PATHS)]
    rows = classes.select("digest", F.explode(F.array(*tree)).alias("k")).select("digest", "k.*")
    found = []
    for d in range(DEPTH):
        key = f"k{d}"
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        rows = staged(rows.join(sizes, key), f"near-level{d}")
        found.append(rows.filter(F.col("_n") <= SMALL).select(F.col(key).alias("node"), "digest"))
        rows = rows.filter(F.col("_n") > SMALL)
        if d < DEPTH - 1:
            rows = rows.drop("_n")
    crowds = rows.withColumn("parts", F.ceil(F.col("_n") / CROWD)).select(
        "tree", F.col(key).alias("crowd"), "parts", F.pmod(F.xxhash64(key, "digest"), "parts").alias("part"), "digest")
    found.append(by_node(crowds.select(F.xxhash64("crowd", "part").alias("node"), "digest").join(classes.select("digest", "tokens"), "digest"),
                         split_crowds, "node long, digest binary"))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out, crowds


def open_crowds(crowds: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, digest): pairs of blocks of the crowds, with the texts that may be linked with one of
    another group. Every two parts of a crowd meet in a node of their own, and each part meets itself.
    A pair of texts that meets in the crowds of several trees counts in the first."""
    group = crowds.join(labels.withColumnRenamed("v", "digest"), "digest", "left").withColumn(
        "label", F.coalesce("label", "digest"))
    mixed = group.groupBy("crowd").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b").select("crowd")
    of_tree = [F.coalesce(F.max(F.when(F.col("tree") == t, F.col("crowd"))), F.xxhash64("digest", F.lit(t))) for t in range(TREES)]
    every = crowds.groupBy("digest").agg(F.array(*of_tree).alias("crowds"))
    rows = group.join(mixed, "crowd", "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("node", F.xxhash64("crowd", F.least("part", "other"), F.greatest("part", "other"))).withColumn(
        "side", F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2))
    rows = rows.select("node", "side", "tree", "digest", "label").join(every, "digest").join(
        classes.select("digest", "n_shingles", "tokens"), "digest")
    return by_node(rows, unsettled, "node long, digest binary").distinct()


def by_node(rows: DataFrame, work, schema: str) -> DataFrame:
    """Apply ``work`` to Arrow tables that hold whole nodes, sorted by node."""
    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = table["node"].to_numpy()
            cut = np.flatnonzero(keys[1:] != keys[:-1])
            if len(cut):
                yield from work(table.slice(0, cut[-1] + 1).combine_chunks())
                rest = table.slice(cut[-1] + 1)
            else:
                rest = table
        if rest is not None and rest.num_rows:
            yield from work(rest.combine_chunks())

    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, schema)


def groups(table: pa.Table):
    keys = table["node"].to_numpy()
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    return zip(keys[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist())


def token_matrix(table: pa.Table) -> np.ndarray:
    return np.asarray(table["tokens"].combine_chunks().flatten()).reshape(-1, TOKENS)


def node_rows(nodes: list[int], members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(members, pa.binary())], ["node", "digest"])


def node_id(*of: bytes) -> int:
    return xxhash.xxh64_intdigest(b"".join(of)) - (1 << 63)


def split_crowds(table: pa.Table):
    """Parts of at most SMALL texts; each holds the CENTRAL texts whose tokens agree most with all others'."""
    tokens, digests = token_matrix(table), table["digest"].to_pylist()
    nodes, members = [], []
    for node, a, b in groups(table):
        agree = np.zeros(b - a)
        for column in tokens[a:b].T:
            _, at, n = np.unique(column, return_inverse=True, return_counts=True)
            agree += n[at]
        order = np.argsort(-agree, kind="stable") + a
        central, rest = order[:CENTRAL], sorted(order[CENTRAL:], key=lambda k: xxhash.xxh64_intdigest(digests[k], node & 0xFFFF))
        step = SMALL - CENTRAL
        for k in range(0, max(1, len(rest)), step):
            own = [digests[i] for i in [*central, *rest[k:k + step]]]
            nodes += [node_id(node.to_bytes(8, "little", signed=True), k.to_bytes(8, "little"))] * len(own)
            members += own
    yield node_rows(nodes, members)


def unsettled(table: pa.Table):
    """Nodes of two blocks of a crowd each: the texts in a pair of different groups whose tokens and
    set sizes come near. Blocks hold texts of the same group side by side. A node holds one part of a
    crowd (side 0), or two (sides 1 and 2), of which the one's blocks meet the other's."""
    tokens, sizes, digests = token_matrix(table), table["n_shingles"].to_numpy(), table["digest"].to_pylist()
    trees, sides, labels = table["tree"].to_numpy(), table["side"].to_numpy(), table["label"].to_pylist()
    crowds = np.asarray(table["crowds"].combine_chunks().flatten()).reshape(-1, TREES)
    nodes, members = [], []
    for _, a, b in groups(table):
        order = np.array(sorted(range(a, b), key=lambda k: (labels[k], digests[k])))
        _, code = np.unique([labels[k] for k in order], return_inverse=True)
        own, first, second = (np.flatnonzero(sides[order] == s) for s in (0, 1, 2))
        blocks, ones, twos = ([of[k:k + BLOCK] for k in range(0, len(of), BLOCK)] for of in (own, first, second))
        for x, others in [*((x, blocks[i:]) for i, x in enumerate(blocks)), *((x, twos) for x in ones)]:
            for y in others:
                one, two = order[x], order[y]
                near = code[x][:, None] != code[y][None, :]
                if not near.any():
                    continue
                for t in range(trees[a]):
                    near &= crowds[one, t][:, None] != crowds[two, t][None, :]
                n, m = sizes[one][:, None], sizes[two][None, :]
                near &= 100 * np.minimum(n, m) >= SIMILARITY * np.maximum(n, m)
                if not near.any():
                    continue
                agree = np.zeros(near.shape, np.uint8)
                for k in range(TOKENS):
                    agree += tokens[one, k][:, None] == tokens[two, k][None, :]
                near &= agree >= GLANCE * TOKENS
                of = sorted({digests[k] for k in [*one[near.any(1)], *two[near.any(0)]]})
                nodes += [node_id(*of)] * len(of)
                members += of
    yield node_rows(nodes, members)


def glance(table: pa.Table):
    """Texts with a partner whose tokens and set size come near, as new nodes: one for each connected
    part, named by its members, so that the same part found in several trees is one node."""
    tokens, sizes, digests = token_matrix(table), table["n_shingles"].to_numpy(), table["digest"].to_pylist()
    nodes, members = [], []
    for _, a, b in groups(table):
        own, n = tokens[a:b], sizes[a:b]
        near = (own[:, None, :] == own[None, :, :]).sum(2) >= GLANCE * TOKENS
        near &= 100 * np.minimum(n[:, None], n[None, :]) >= SIMILARITY * np.maximum(n[:, None], n[None, :])
        if near.sum() == b - a:
            continue
        part = connected(near)
        for p in np.unique(part):
            of = sorted(digests[a + k] for k in np.flatnonzero(part == p))
            if len(of) > 1:
                nodes += [node_id(*of)] * len(of)
                members += of
    yield node_rows(nodes, members)


def connected(near: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches."""
    label = np.arange(len(near))
    while True:
        best = np.where(near, label[None, :], len(near)).min(1)
        best = best[best]
        if (best == label).all():
            return label
        label = best


def confirm(table: pa.Table, length: int, hashes: WordHashes):
    """Exact links of a node's texts on their whole sets: the edges of a spanning forest."""
    left, right = [], []
    digests, texts = table["digest"].to_pylist(), table["text"]
    for _, a, b in groups(table):
        sets = []
        for k in range(a, b):
            words = words_in(texts[k].as_py())
            # The row key that fetched the text is a hash: make sure of the text itself.
            sets.append(shingles(words, hashes, length) if xxhash.xxh3_128_digest(b" ".join(words)) == digests[k] else None)
        sets, own = [s for s in sets if s is not None], [d for s, d in zip(sets, digests[a:b]) if s is not None]
        m = len(sets)
        if m < 2:
            continue
        n = np.array([len(s) for s in sets])
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        shared = np.flatnonzero(np.bincount(at) > 1)
        place = np.full(len(values), -1)
        place[shared] = np.arange(len(shared))
        column, row = place[at], np.repeat(np.arange(m), n)
        both = np.zeros((m, m), np.float64)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        for k in range(0, len(shared), 8192):  # bounded memory
            x, y = np.searchsorted(column, [k, k + 8192])
            block = np.zeros((m, 8192), np.float32)
            block[row[x:y], column[x:y] - k] = 1
            both += block @ block.T
        near = 100 * both >= SIMILARITY * (n[:, None] + n[None, :] - both)
        reached, todo = {}, list(range(m))
        for s in todo:
            if s in reached:
                continue
            reached[s], stack = s, [s]
            while stack:
                u = stack.pop()
                for v in np.flatnonzero(near[u]).tolist():
                    if v not in reached:
                        reached[v] = s
                        stack.append(v)
                        left.append(own[u])
                        right.append(own[v])
    yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex that each vertex reaches, by alternating large and small stars."""
    def marked(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(e: DataFrame) -> DataFrame:
        """Every u with its least neighbour or itself, beside its neighbours."""
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        return e.join(least, "u").withColumn("m", F.least("u", "m"))

    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    before = marked(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = star(large)
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            small.select("u", F.col("m").alias("v"))).distinct()
        e = staged(e, "near-edges")
        now = marked(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("v"), F.col("v").alias("label"))


def near_groups(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept for every row; shingles have ``length`` words.

    Rows with equal words are one vertex. A text without words is linked with nothing: its own
    component. Null doc_ids come last: a component's id is its smallest other doc_id, or null; a row with a null
    doc_id is kept only in a component without other ids. Repeated rows get equal answers; an
    empty table gives no rows; other columns are not read.
    """
    with small_batches(docs.sparkSession):
        return grouped(docs, length)


def grouped(docs: DataFrame, length: int) -> DataFrame:
    """The work of ``near_groups``. All its Python steps end in staged tables, only joins of those are left to do."""
    every = staged(prints(docs, length), "near-prints")
    classes = every.filter("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("row"),
        F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"))
    classes = staged(classes.select("digest", "row.doc_id", "row.key", "n_shingles", "tokens"), "near-classes")
    nodes, crowds = small_nodes(classes)
    crowds = staged(crowds, "near-crowds")
    nodes = nodes.join(classes.select("digest", "n_shingles", "tokens"), "digest")
    parts = staged(by_node(nodes, glance, "node long, digest binary").distinct(), "near-parts")
    looked_at = parts.select("digest").unionByName(crowds.select("digest")).distinct()
    wanted = classes.select("digest", "doc_id", "key").join(looked_at, "digest", "left_semi")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    fetched = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(raw).alias("key"), raw.alias("text"))
    texts = wanted.join(fetched, (wanted["key"] == fetched["key"]) & wanted["doc_id"].eqNullSafe(fetched["_id"]))
    texts = staged(texts.select("digest", "text").distinct(), "near-texts")
    links = partial(confirm, length=length, hashes=WordHashes())  # every task has words of its own
    labels = components(by_node(parts.join(texts, "digest"), links, "a binary, b binary"))
    rest = open_crowds(crowds, classes, labels)
    more = staged(by_node(rest.join(texts, "digest"), links, "a binary, b binary"), "near-links")
    if not more.isEmpty():
        labels = components(labels.select(F.col("v").alias("a"), F.col("label").alias("b")).unionByName(more))
    known = classes.select("digest", "doc_id").join(labels, classes["digest"] == labels["v"], "left").select(
        "digest", "doc_id", F.coalesce("label", "digest").alias("label"))
    least = known.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = known.join(least, "label").select(F.col("digest").alias("_digest"), F.col("component_id").alias("_component"))
    out = every.join(named, every["digest"] == named["_digest"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all columns; repeated kept rows stay once."""
    kept = near_groups(docs, length).filter("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    rows = docs.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")))
    out = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_text_key"] == kept["_key"]), "left_semi")
    return out.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")
