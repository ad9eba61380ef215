"""Best-fit packing of tokenised documents, planned on the histogram of lengths.

1. Documents become pieces of at most ``capacity`` ids; each task numbers its pieces of
   every length.
2. The counts per length, at most ``capacity`` numbers, come to the driver. Best-fit decreasing
   runs over counts: a run of equal pieces fills a run of equally filled sequences at once, so
   its cost depends on the capacity and not on the number of documents.
3. A piece's rank within its length is its number in its task plus the counts of earlier
   tasks; the plan says where that rank goes. No task sees more than its share.

Defined results: NULL and empty texts are the closing id alone; repeated rows are packed each;
an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexlake.llm import tokens, words
from plexlake.llm.stage import keep

CAPACITY = 2048
CLOSING_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, shard_rank long, ids array<int>"


def tokenise(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece, numbered within its task and length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(1)):
                ids, counts = tokens.append_id(*tokens.shared_tokenizer(vocabulary).encode(data, offsets), closing_id)
                n_pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(last - first), n_pieces)
                piece = words.gather_runs(np.zeros(len(counts), np.int64), n_pieces)
                start = piece * capacity
                length = np.minimum(counts[doc] - start, capacity)
                ends = np.cumsum(length)
                order = np.argsort(length, kind="stable")
                same = length[order]
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(same)) - np.searchsorted(same, same) + met[same]
                met += np.bincount(length, minlength=capacity + 1)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                        pa.array(tokens.crc32(ids, ends - length, ends)),
                        pa.array(np.full(len(doc), shard, np.int32)), pa.array(rank),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "shard_rank", "ids"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(cut, PIECES)


@dataclass(frozen=True)
class Plan:
    """Segments by (length, first rank): rank r goes to sequence + (r - rank) // each, at place + (r - rank) % each * length."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    place: np.ndarray
    n_sequences: int


def best_fit_plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over counts.

    ``room`` maps free space to runs (first sequence, how many). The longest pieces go first, each
    to the fullest sequence that still takes it, which then takes as many of that length as fit.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    segments: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(space: int, run: tuple[int, int]) -> None:
        if space and run[1]:
            if space not in room:
                room[space] = []
                insort(spaces, space)
            room[space].append(run)

    for length in sorted(histogram, reverse=True):
        left, rank = int(histogram[length]), 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, many = room[space].pop()
                if not room[space]:
                    del room[space], spaces[at]
            else:
                space, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = space // length
            full = min(many, left // each)
            if full:
                segments.append((length, rank, first, each, capacity - space))
                leave(space - each * length, (first, full))
                rank, left = rank + full * each, left - full * each
            if full < many:
                if left:  # the last few pieces of this length share one sequence
                    segments.append((length, rank, first + full, left, capacity - space))
                    leave(space - left * length, (first + full, 1))
                    left, full = 0, full + 1
                leave(space, (first + full, many - full))
    columns = np.array(sorted(segments), np.int64).reshape(-1, 5).T
    return Plan(*columns, n_sequences=opened)


def slots(pieces: DataFrame, plan: Plan, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` without their ids, with sequence_id and offset."""
    counts = pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    key = plan.length << 40 | plan.rank

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(key, length << 40 | rank, side="right") - 1
        within = rank - plan.rank[at]
        return pd.DataFrame(
            {
                "sequence_id": plan.sequence[at] + within // plan.each[at],
                "offset": plan.place[at] + within % plan.each[at] * length,
            }
        )

    ranked = pieces.drop("ids").join(bases, ["length", "shard"])
    placed = ranked.withColumn("_at", place("length", F.col("base") + F.col("shard_rank")))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset", "shard", "shard_rank"
    )


@dataclass(frozen=True)
class Packed:
    pieces: DataFrame  # with ids, on shared storage
    slots: DataFrame
    n_sequences: int

    def sequences(self) -> DataFrame:
        """(sequence_id, ids): at most ``capacity`` ids are gathered for each."""
        key = ["shard", "length", "shard_rank"]
        rows = self.slots.select(*key, "sequence_id", "offset").join(self.pieces.select(*key, "ids"), key)
        parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
        return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID) -> Packed:
    """Pack (doc_id, text) into sequences of at most ``capacity`` ids."""
    pieces = keep(tokenise(docs, vocabulary, capacity, closing_id), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    return Packed(pieces, slots(pieces, plan, capacity), plan.n_sequences)
