"""Exact deduplication with Structured Streaming state.

Documents are fingerprinted into small files in the shared folder; a streaming aggregation
whose state lives in RocksDB (on disk, keyed by digest, without watermark, so nothing expires)
keeps for each digest the row that stays: its length, stable identifier and content locator.
Later files can be fed to the same checkpoint. Where a digest is hit by more than one row, the
full normalised bytes are compared; texts that share a digest but differ are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperflow.llm.common import staged, without_whitespace
from paperflow.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: A micro-batch writes its changes to the checkpoint, not a snapshot of each partition's whole state.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Each open store would reserve megabytes of disk ahead for its manifest and logs, which adds up over many partitions.
FALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"


def sha256(normalised: Column) -> Column:
    return F.sha2(normalised.cast("binary"), 256)


def best_row() -> Column:
    """Order of preference inside a group: most code points, then smallest doc_id (null last),
    then smallest locator. The preferred row is the largest struct."""
    return F.struct(F.col("n_chars_text").alias("n"), (-F.col("doc_id")).alias("neg_id"),
                    F.col("locator").alias("locator"))


def fingerprints(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, digest, text_sha256, code points of the original text, content locator.

    The locator names a file and row (``_metadata``) where ``docs`` is read from files, else
    it is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    try:
        located = docs.select("doc_id", "text", F.concat_ws(
            "#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")).alias("locator"))
        located.schema  # noqa: B018 - resolves the hidden column
    except Exception as e:  # noqa: BLE001 - only a missing hidden column is expected
        if "UNRESOLVED_COLUMN" not in str(e):
            raise
        located = docs.select("doc_id", "text", F.lit("").alias("locator"))
    bare = without_whitespace(F.col("text"))
    return located.select("doc_id", digest(bare).alias("digest"), sha256(bare).alias("text_sha256"),
                          F.char_length(text).cast("long").alias("n_chars_text"), "locator")


def feed_state(spark, prints_path: str, schema, state_path: str, out_path: str, max_files: int | None = None) -> None:
    """Run the stream over all fingerprint files that its checkpoint has not seen yet.

    Every micro-batch writes the groups it changed to its own folder, named by batch id, so a
    repeated batch overwrites what it wrote before.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    state = reader.parquet(prints_path).groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(best_row()).alias("best"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    wanted = {PROVIDER: ROCKSDB, CHANGELOG: "true", FALLOCATE: "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        (state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state_path)
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(docs: DataFrame, digest=sha256, max_files: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting [\\x20\\x09-\\x0D]; null counts as empty, so
    null, empty and blank texts form one group. The row with the most code points in the
    original text stays, then the smallest doc_id; of repeated rows with equal doc_id all are
    ``kept`` if their doc_id is the one that stays (they are the same document). A null doc_id
    is preferred last, and kept only where its group has no other. An empty table gives no
    rows; other columns are not read. ``digest`` can be replaced (the tests use a short one).
    """
    spark = docs.sparkSession
    prints_path, out = scratch_path(spark, "dedup-prints"), scratch_path(spark, "dedup-groups")
    prints = fingerprints(docs, digest)
    prints.write.parquet(prints_path)
    prints = spark.read.schema(prints.schema).parquet(prints_path)
    feed_state(spark, prints_path, prints.schema, scratch_path(spark, "dedup-state"), out, max_files)
    schema = prints.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(best_row()).alias("best")).schema
    # A group changed by several micro-batches: its last state has the largest count.
    groups = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out).groupBy("digest").agg(
        F.max(F.struct("group_size", "best")).alias("s")).select("digest", "s.group_size", "s.best")
    # Byte check of the hits: equal copies collapse before the shuffle, so a hot text is one
    # row per task; two rows of one digest would be different bytes under one digest.
    bare = without_whitespace(F.col("text"))
    variants = docs.select(digest(bare).alias("digest"), bare.alias("bytes")).groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"))
    clashes = staged(variants.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"),
                     "dedup-clashes")
    agreed = prints.join(groups, "digest")
    if not clashes.isEmpty():
        # Exact way for texts that share a digest: their groups are formed on the bytes' own hash and length.
        apart = prints.join(clashes, "digest", "left_semi").groupBy("digest", "text_sha256").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(best_row()).alias("best"))
        agreed = agreed.join(clashes, "digest", "left_anti").unionByName(
            prints.join(apart, ["digest", "text_sha256"]).select(agreed.columns))
    keep = -F.col("best.neg_id")
    return agreed.select(
        "doc_id", keep.alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256", F.col("best.locator").alias("keep_locator"))
