"""Which sequence contains a peptide: a containment join without a nested loop.

For queries of at least L letters, every text is cut to the minimisers of its k-mer
windows: of each w = L - k + 1 consecutive k-mers only the one with the smallest hash
is kept. A query contributes the minimiser of its own first window. If the query
occurs in the text, that window occurs there too, so the hashes meet in an equi-join;
the candidates are then verified with ``contains``. Queries are classed by the power
of two of their length, so long ones need few anchors and short ones still match.
Tasks work on slices of a bounded number of letters, however many rows a batch has and
however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from plexlake.plans.session import materialise
from plexlake.plans.sizing import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if, checked_broadcast, spread

_MAX_K = 12
_BASE = np.uint64(1_000_003)
_MIX = np.uint64(0x9E3779B97F4A7C15)
HOT_ROWS = 10_000  # rows of one anchor that meet in one place
SLICE = 1 << 19  # letters worked on at once: a dozen arrays of eight bytes a letter are made of them


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of neighbouring texts with at most ``SLICE`` bytes; a larger text stands alone."""
    first, filled = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and filled + size > SLICE:
            yield first, i
            first, filled = i, 0
        filled += size
    if len(texts):
        yield first, len(texts)


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts of a slice, one after the other, and the borders between them."""
    values = ["" if t is None else t for t in texts.to_pylist()]
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    codes = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return codes, np.concatenate([[0], np.cumsum(lengths)])


def _kmer_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k neighbours along the last axis."""
    n = max(0, codes.shape[-1] - k + 1)
    h = codes[..., :n].copy()
    for i in range(1, k):
        h *= _BASE
        h += codes[..., i : i + n]
    h ^= h >> np.uint64(31)
    h *= _MIX
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    if len(h) < w:
        return h[:0]
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = w - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _batch_anchors(codes: np.ndarray, borders: np.ndarray, lengths: Iterable[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(text, anchor) of all texts of a slice, distinct and in order of texts, for every (class, shortest length)."""
    texts, anchors, hashes = [], [], {}
    owner = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    for cls, length in lengths:
        k, w = _shape(length)
        if k not in hashes:
            hashes[k] = _kmer_hashes(codes, k)
        minima = _window_minima(hashes[k], w)
        start = np.arange(len(minima))
        at = owner[: len(minima)]
        inside = start + length <= borders[at + 1]  # windows that do not run into the next text
        minima, at = minima[inside], at[inside]
        # neighbouring windows mostly share their minimum: one of each run stays
        new = np.ones(len(minima), bool)
        new[1:] = (minima[1:] != minima[:-1]) | (at[1:] != at[:-1])
        texts.append(at[new])
        anchors.append(_marked(minima[new], cls))
    at, anchor = np.concatenate(texts), np.concatenate(anchors)
    order = np.lexsort((anchor, at))
    at, anchor = at[order], anchor[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (anchor[1:] != anchor[:-1])
    return at[new], anchor[new]


def _shape(length: int) -> tuple[int, int]:
    """k and w for queries of at least ``length`` letters."""
    k = min(length, _MAX_K, max(6, length // 2))
    return k, length - k + 1


def _marked(anchors, cls: int):
    """Anchors of different length classes never meet."""
    return anchors ^ np.int64(cls * 0x5851F42D4C957F2D & 0x7FFFFFFFFFFFFFFF)


def _run_anchors(texts: pa.Array, classes: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_batch_anchors`; a text beyond ``SLICE`` is cut into pieces that overlap by one letter less than a window."""
    longest = max(classes.values())
    size = max(SLICE, 2 * longest)
    text = texts[0].as_py() if len(texts) == 1 else None
    if text is None or len(text) <= size:
        return _batch_anchors(*_code_points(texts), classes.items())
    found = np.zeros(0, np.int64)
    for at in range(0, len(text) - longest + 1, size - longest + 1):
        found = np.union1d(found, _batch_anchors(*_code_points(pa.array([text[at : at + size]])), classes.items())[1])
    return np.zeros(len(found), np.int64), found


def _with_anchors(batches: Iterable[pa.RecordBatch], columns: list[str], classes: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """(<columns>, _anchors) of batches with a text ``_t``, a slice at a time."""
    for batch in batches:
        for first, end in _runs(batch.column("_t")):
            rows = batch.slice(first, end - first)
            at, found = _run_anchors(rows.column("_t"), classes)
            borders = np.searchsorted(at, np.arange(len(rows) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(found))
            yield pa.record_batch([*(rows.column(c) for c in columns), lists], names=[*columns, "_anchors"])


def _anchored(sources: DataFrame, columns: list[str], classes: dict[int, int]) -> DataFrame:
    """(<columns>, anchor) of all anchors of every text of ``sources`` (_id, _t)."""
    schema = StructType([*(sources.schema[c] for c in columns), StructField("_anchors", ArrayType(LongType()))])
    found = sources.mapInArrow(lambda batches: _with_anchors(batches, columns, classes), schema)
    return found.select(*columns, F.explode("_anchors").alias("anchor"))


def _query_anchor(classes: dict[int, int]):
    @F.arrow_udf(LongType())
    def anchor(queries: pa.Array, cls: pa.Array) -> pa.Array:
        kinds, out = cls.to_numpy(), np.zeros(len(queries), np.int64)
        for at, end in _runs(queries):
            codes, borders = _code_points(queries.slice(at, end - at))
            for c in np.unique(kinds[at:end]):
                length = classes[c]
                k, w = _shape(length)
                rows = np.flatnonzero(kinds[at:end] == c)
                first = codes[borders[rows][:, None] + np.arange(length)]  # every query of a class is that long at least
                out[at + rows] = _marked(_kmer_hashes(first, k)[:, :w].min(axis=1), c)
        return pa.array(out)

    return anchor


def _salted(texts: DataFrame, queries: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join by anchor with two salts, (anchor, by_text, by_query).

    Anchors are counted on both sides. One with more than ``most`` rows on a side is cut there into parts of that
    size by a hash of the row, and the other side is repeated for each part: every pair still meets once. There
    are at most rows / ``most`` such anchors on a side.
    """
    n_texts = texts.join(queries.select("anchor").distinct(), "anchor", "left_semi").groupBy("anchor").agg(F.count(F.lit(1)).alias("_nt"))
    n_queries = queries.groupBy("anchor").agg(F.count(F.lit(1)).alias("_nq"))
    parts = [F.ceil(F.col(c) / most).cast("int").alias(name) for c, name in (("_nt", "_st"), ("_nq", "_sq"))]
    hot = materialise(n_texts.join(n_queries, "anchor").where((F.col("_nt") > most) | (F.col("_nq") > most)).select("anchor", *parts), "hot_anchors")
    hot = broadcast_if(hot, hot.count())
    one = F.lit(1)
    st, sq = F.coalesce("_st", one), F.coalesce("_sq", one)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = texts.join(hot, "anchor", "left").withColumn("by_text", F.pmod(F.xxhash64("_id"), st).cast("int")).withColumn("by_query", every(sq))
    right = queries.join(hot, "anchor", "left").withColumn("by_query", F.pmod(F.xxhash64("_q"), sq).cast("int")).withColumn("by_text", every(st))
    return left.drop("_st", "_sq"), right.drop("_st", "_sq")


def _hits(
    queries: DataFrame, query: str, texts: DataFrame, text: str, text_id: str, broadcast_limit: int
) -> tuple[DataFrame, bool]:
    """(<query>, <text_id>) of every verified hit, and whether a pair may come several times."""
    wanted = queries.select(F.col(query).alias("_q")).where(F.length("_q") > 0).distinct()
    cls = F.floor(F.log2(F.length("_q"))).cast("long")
    bounds = wanted.groupBy(cls.alias("class")).agg(
        F.min(F.length("_q")).alias("shortest"), F.count("*").alias("n"), F.sum(F.octet_length("_q")).alias("bytes")
    ).collect()
    classes = {r["class"]: r["shortest"] for r in bounds}  # one entry per power of two
    if not classes:
        return texts.where(F.lit(False)).select(F.col(text).alias(query), text_id), False
    small = sum(r["n"] for r in bounds) <= broadcast_limit and sum(r["bytes"] for r in bounds) <= BROADCAST_BYTES
    wanted = wanted.select("_q", _query_anchor(classes)(F.col("_q"), cls).alias("anchor"))
    sources = texts.select(F.col(text_id).alias("_id"), F.col(text).alias("_t"))
    if small:
        hits = _anchored(spread(sources), ["_id", "_t"], classes).join(F.broadcast(wanted), "anchor").where(F.contains("_t", "_q"))
    else:
        placed = materialise(_anchored(spread(sources), ["_id"], classes), "anchors")
        left, right = _salted(placed, materialise(wanted, "queries"), HOT_ROWS)
        candidates = left.join(right, ["anchor", "by_text", "by_query"]).select("_q", "_id").distinct()
        hits = candidates.join(sources, "_id").where(F.contains("_t", "_q"))
    return hits.select(F.col("_q").alias(query), F.col("_id").alias(text_id)), small


def contains_pairs(
    queries: DataFrame, query: str, texts: DataFrame, text: str, text_id: str, broadcast_limit: int = BROADCAST_ROWS
) -> DataFrame:
    """(<query>, <text_id>) for every distinct non-empty query and every text that contains it.

    ``text_id`` must be unique. Up to ``broadcast_limit`` queries of bounded size are broadcast and the
    texts are scanned once without a shuffle. Beyond it, anchors and ids are shuffled, those of hot anchors
    salted by measured counts, and texts are fetched again only for candidates.
    """
    hits, repeated = _hits(queries, query, texts, text, text_id, broadcast_limit)
    return hits.distinct() if repeated else hits


def first_containing(
    queries: DataFrame, query: str, texts: DataFrame, text: str, text_id: str, broadcast_limit: int = BROADCAST_ROWS
) -> DataFrame:
    """(<query>, <text_id>) of the first text that contains it; tasks keep one text per query, never the pairs."""
    hits, _ = _hits(queries, query, texts, text, text_id, broadcast_limit)
    return hits.groupBy(query).agg(F.min(text_id).alias(text_id))


def first_match(pairs: DataFrame, query: str, text_id: str) -> DataFrame:
    """(<query>, <text_id>, n_matches): the match that comes first, combined map-side."""
    return pairs.groupBy(query).agg(F.min(text_id).alias(text_id), F.count(F.lit(1)).alias("n_matches"))


def fill_accessions(peptides: DataFrame, fasta: DataFrame, sequence: str = "peptide_seq", accession: str = "accession") -> DataFrame:
    """Give rows without an accession that of the first protein whose sequence contains them.

    NULL where no protein does.
    """
    missing = F.coalesce(F.col(accession), F.lit("")) == ""
    first = first_containing(peptides.where(missing).select(sequence), sequence, fasta, "sequence", "fasta_ord")
    found = first.join(fasta.select("fasta_ord", F.col("accession").alias("_found")), "fasta_ord").select(sequence, "_found")
    found = checked_broadcast(materialise(found, "matches"))
    return (
        peptides.join(found, sequence, "left")
        .withColumn(accession, F.when(missing, F.col("_found")).otherwise(F.col(accession)))
        .drop("_found")
        .select(*peptides.columns)
    )


def with_records(df: DataFrame, fasta: DataFrame, key: str = "good_accession", mode: str = "exact") -> DataFrame:
    """``df`` with gene name and description of its key's record; rows without one stay, with NULL."""
    return df.join(lookup_accessions(df, fasta, key, mode), key, "left")


def lookup_accessions(keys: DataFrame, fasta: DataFrame, key: str = "good_accession", mode: str = "exact") -> DataFrame:
    """Distinct keys with gene name and description of the first matching record.

    ``exact`` joins on equality; ``contains`` also takes accessions that merely
    contain the key. NULL where nothing matches.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if mode == "exact":
        records = fasta.groupBy(F.col("accession").alias(key)).agg(
            F.min_by("gene_name", "fasta_ord").alias("gene_name"),
            F.min_by("description", "fasta_ord").alias("description"),
        )
        return wanted.join(records, key, "left")
    if mode != "contains":
        raise ValueError(f"unknown mode {mode!r}")
    first = first_containing(wanted, key, fasta, "accession", "fasta_ord")
    records = first.join(fasta.select("fasta_ord", "gene_name", "description"), "fasta_ord")
    return wanted.join(records.select(key, "gene_name", "description"), key, "left")
