"""Token ids in Parquet: lists of ids in ascending document order, made for selective reads.

Ids are dictionary encoded (a vocabulary fits one dictionary page), document ids and
positions are delta encoded, row groups and pages are bounded, and Parquet's column and
page indexes let a reader skip what a range of documents does not touch. Spark's own
writer commits the files, so a lost executor costs only its tasks.

Defined results: NULL text reads as empty; NULL ids come first, equal ids follow a hash of
their texts; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, whatever other
columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexlake.llm import tokens, words
from plexlake.llm.stage import keep
from plexlake.plans.session import scratch_path

END_ID = 1
SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10
) -> None:
    """Encode (doc_id, text) and write one file per range of documents."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(1)):
                ids, counts = tokens.append_id(*tokens.shared_tokenizer(vocabulary).encode(data, offsets), end_id)
                ends = np.cumsum(counts)
                n = last - first
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(before + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)),
                    ],
                    names=["doc_id", "shard", "shard_start", "n_tokens", "ids"],
                )
                before += int(counts.sum())

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    (
        ordered.mapInArrow(encode, SCHEMA)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#shard_start", "false")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in [first, last]; ``start`` counts all ids before it.

    The totals of the shards, one row per file, turn positions within a shard into positions
    within the corpus; that pass reads two narrow columns only.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    bases = keep(totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "shards")
    if first is not None:
        files = files.where(F.col("doc_id") >= first)
    if last is not None:
        files = files.where(F.col("doc_id") <= last)
    return files.join(bases, "shard").select("doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        crc = tokens.crc32(lists.values.to_numpy(), offsets[:-1], offsets[1:])
        yield pa.record_batch([*batch.columns[:3], pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(read: DataFrame) -> DataFrame:
    """One row per document of :func:`read_tokens` with the checksum of its ids."""
    return read.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, vocabulary: str) -> str:
    """Write to a fresh folder of the shared storage; its path."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return path
