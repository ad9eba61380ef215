"""Near-duplicate texts by b-bit MinHash (Li and Koenig 2010), links confirmed on full shingle sets.

1. One pass turns every text into the size and a 128-bit hash of its shingle set, the band keys of
   its minima, and a signature of their low bits packed into longs.
2. Texts with equal sets are one class from here on, represented by its smallest id, so
   copies meet in counts and never in pairs.
3. Classes that share a band key are candidates. Every bucket is first compared as a star
   around the member that shares most buckets with others. Packed signatures give a similarity, corrected for chance
   agreement of low bits; what may reach the threshold is confirmed on the full sets.
4. Buckets whose members are in one component by now are done. In the others, what is outside
   the hub's component meets all members once per component, in blocks of bounded size that
   carry the texts: signatures rule out, full sets decide, and only links leave the task. So no
   link between components is lost, and a large group of near copies makes no pairs.

With 32 bands of 4 minima a pair at the threshold is missed with probability
(1 - 0.75**4)**32 = 5e-6, and a signature rules it out wrongly with probability 3e-5; both fall
quickly above the threshold, and a document is lost only if all its links are.

Defined results: NULL text reads as empty; texts without words link with nothing; repeated rows are
copies of each other and get the same answer; should different texts share a ``doc_id``, that id
stands for all of them in links (:func:`distinct_documents` tells them apart); rows without a ``doc_id`` are returned and link with nothing. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexlake.llm import words
from plexlake.llm.graph import connected_components
from plexlake.llm.stage import keep, unused
from plexlake.plans.sizing import checked_broadcast

WORD_BYTES = words.byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
_RNG = np.random.Generator(np.random.PCG64(75))
_PLACES = _RNG.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature array<long>"


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 32
    rows: int = 4
    bits: int = 2
    percent: int = 75  # link when 100 * intersection >= percent * union
    slack: float = 4.0  # standard errors below the threshold that a signature may estimate
    texts_per_task: int = 128  # of one hub, confirmed together
    block: int = 512  # texts of either side that are compared in one place

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def most_differences(self) -> int:
        """Low-bit groups that may differ in a pair to be confirmed.

        Two minima are equal with probability J, and low bits agree by chance in 2**-bits of the rest.
        """
        chance = 2.0**-self.bits
        agree = chance + (1 - chance) * self.percent / 100
        error = math.sqrt(agree * (1 - agree) / self.hashes)
        return math.ceil(self.hashes * (1 - agree + self.slack * error))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and how many each text has."""
    starts, ends = words.word_spans(data, offsets, WORD_BYTES)
    hashes = words.span_hashes(data, starts, ends, lower=True)
    first = words.per_text(starts, offsets)
    n_words = np.diff(first)
    long = n_words >= size
    counts = np.where(long, n_words - size + 1, (n_words > 0).astype(np.int64))
    out = np.empty(int(counts.sum()), np.uint64)
    upto = np.concatenate([[0], np.cumsum(counts)])
    if len(hashes) >= size:
        rolling = np.zeros(len(hashes) - size + 1, np.uint64)
        for k in range(size):
            rolling += hashes[k : k + len(rolling)] * _PLACES[k]
        out[words.gather_runs(upto[:-1][long], counts[long])] = rolling[words.gather_runs(first[:-1][long], counts[long])]
    for i in np.flatnonzero(~long & (n_words > 0)).tolist():  # a few words: the whole sequence, told apart by its length
        a, b = first[i], first[i + 1]
        out[upto[i]] = (hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) ^ _PLACES[size + b - a]
    out = words.mix(out)
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[upto[:-1][counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])[upto]
    return out[fresh], np.diff(kept)


def _sketches(settings: Settings):
    rng = np.random.Generator(np.random.PCG64(2010))
    odd = rng.integers(0, 1 << 63, settings.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, settings.hashes, dtype=np.uint64)
    per_long = 64 // settings.bits

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(1)):
                shingles, counts = shingle_sets(data, offsets, settings.shingle)
                full = counts > 0
                at = (np.cumsum(counts) - counts)[full]
                n, m = len(counts), int(full.sum())
                sums = np.zeros((2, n), np.uint64)
                minima = np.empty((m, settings.hashes), np.uint64)
                if m:
                    sums[0, full] = np.add.reduceat(words.mix(shingles ^ flip[0]), at)
                    sums[1, full] = np.add.reduceat(words.mix(shingles * odd[0]), at)
                    for k in range(settings.hashes):
                        minima[:, k] = np.minimum.reduceat((shingles ^ flip[k]) * odd[k], at)
                minima >>= np.uint64(32)
                keys = np.zeros((m, settings.bands), np.uint64)
                for r in range(settings.rows):
                    keys = words.mix(keys + minima[:, r :: settings.rows] * odd[r])
                keys = words.mix(keys ^ odd[: settings.bands])  # the same minima in another band are another key
                low = minima & np.uint64((1 << settings.bits) - 1)
                shifts = (np.arange(settings.hashes) % per_long * settings.bits).astype(np.uint64)
                packed = np.add.reduceat(low << shifts, np.arange(0, settings.hashes, per_long), axis=1)

                def lists(values: np.ndarray) -> pa.Array:
                    ends = np.concatenate([[0], np.cumsum(full * values.shape[1])]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1).view(np.int64)))

                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first), pa.array(counts),
                        pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        lists(np.ascontiguousarray(keys)), lists(np.ascontiguousarray(packed)),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
                )

    return sketch


def differences(x: Column, y: Column, settings: Settings) -> Column:
    """How many of the packed low-bit groups differ: fold each group onto its lowest bit and count."""
    mask = sum(1 << i for i in range(0, 64, settings.bits))
    mask -= (mask >> 63) << 64  # as a signed long
    total = F.lit(0)
    for i in range(-(-settings.hashes * settings.bits // 64)):
        apart = x[i].bitwiseXOR(y[i])
        folded = apart
        for shift in range(1, settings.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(apart, shift))
        total = total + F.bit_count(folded.bitwiseAND(F.lit(mask).cast("long")))
    return total


def similarity(x: Column, y: Column, settings: Settings) -> Column:
    """Jaccard estimate of two signatures, corrected for low bits that agree by chance."""
    chance = 2.0**-settings.bits
    return (1 - differences(x, y, settings) / settings.hashes - chance) / (1 - chance)


def _confirm(settings: Settings):
    def confirm(key: tuple, group: pa.Table) -> pa.Table:
        hub = key[0].as_py()
        ids = group.column("id").to_numpy()
        sets: list[np.ndarray] = []
        for _, _, data, offsets in words.text_slices(group.column("text").combine_chunks()):
            shingles, counts = shingle_sets(data, offsets, settings.shingle)
            sets += np.split(shingles, np.cumsum(counts)[:-1])
        hubs = [s for i, s in zip(ids, sets) if i == hub]
        linked = set()
        for i, s in zip(ids.tolist(), sets):
            for h in hubs if i != hub else []:
                if not len(s) or not len(h):
                    continue
                at = np.minimum(np.searchsorted(h, s), len(h) - 1)
                both = int((h[at] == s).sum())
                if 100 * both >= settings.percent * (len(s) + len(h) - both):
                    linked.add(i)
        return pa.table({"a": pa.array([hub] * len(linked), pa.int64()), "b": pa.array(sorted(linked), pa.int64())})

    return confirm


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def confirm_links(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The (a, b) of ``pairs`` (hub, id) whose full sets are similar enough.

    A hub's pairs are dealt out in portions of bounded size, each with the hub's text.
    """
    portions = keep(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / settings.texts_per_task).alias("n")), "hubs")
    dealt = pairs.join(portions, "hub").select("hub", F.pmod(F.xxhash64("id"), "n").alias("portion"), "id")
    own = portions.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("portion"), F.col("hub").alias("id"))
    wanted = keep(dealt.unionByName(own), "requests")
    found = _texts(docs).join(checked_broadcast(wanted), "id").groupBy("hub", "portion").applyInArrow(_confirm(settings), "a long, b long")
    return keep(found, "links")


def _compare_blocks(settings: Settings):
    """Within sorted runs of (main, i, j): links between outsiders and members."""
    limit = settings.most_differences()
    mask = np.uint64(sum(1 << i for i in range(0, 64, settings.bits)))

    def compare(block: pa.Table) -> pa.RecordBatch:
        ids, comp = block.column("id").to_numpy(), block.column("component").to_numpy()
        role, stray = block.column("outside").to_numpy(), block.column("stray").to_numpy(zero_copy_only=False)
        packed = block.column("signature").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
        sets: list[np.ndarray] = []
        for _, _, data, offsets in words.text_slices(block.column("text").combine_chunks()):
            shingles, counts = shingle_sets(data, offsets, settings.shingle)
            sets += np.split(shingles, np.cumsum(counts)[:-1])
        x, y = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        for k in x.tolist():
            apart = packed[y] ^ packed[k]
            folded = apart.copy()
            for shift in range(1, settings.bits):
                folded |= apart >> np.uint64(shift)
            differ = np.bitwise_count(folded & mask).sum(axis=1, dtype=np.int64)
            # two outsiders meet in both roles: once is enough
            maybe = y[(differ <= limit) & (comp[y] != comp[k]) & (~stray[y] | (ids[y] > ids[k]))]
            maybe = maybe[100 * np.minimum(sizes[maybe], sizes[k]) >= settings.percent * np.maximum(sizes[maybe], sizes[k])]
            if not len(maybe) or not sizes[k]:
                continue
            other = np.concatenate([sets[m] for m in maybe.tolist()])
            at = np.minimum(np.searchsorted(sets[k], other), sizes[k] - 1)
            both = np.add.reduceat((sets[k][at] == other).astype(np.int64), np.cumsum(sizes[maybe]) - sizes[maybe])
            linked = maybe[100 * both >= settings.percent * (sizes[maybe] + sizes[k] - both)]
            found.append(np.stack([np.full(len(linked), ids[k]), ids[linked]], axis=1))
        rows = np.concatenate(found)
        return pa.record_batch([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = np.stack([held.column(c).to_numpy() for c in ("main", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], cuts.tolist()):
                yield compare(held.slice(a, b - a))
            held = held.slice(int(cuts[-1])) if len(cuts) else held  # its run may go on in the next batch
        if held is not None and len(held):
            yield compare(held)

    return blocks


def outside_links(shared: DataFrame, components: DataFrame, signatures: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): links of those that share a bucket with a hub outside their own component.

    ``shared`` is (hub, id) of the buckets. All buckets of one hub component are one comparison of its
    strays with its members, so nothing is compared once per band.
    """
    of_hub = components.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    named = shared.where("id <> hub").distinct().join(components.select(F.col("node").alias("id"), "component"), "id", "left").join(of_hub, "hub", "left")
    main, component = F.coalesce("hub_component", "hub"), F.coalesce("component", "id")
    named = keep(named.select(main.alias("main"), "id", component.alias("component")).distinct().withColumn("stray", F.col("component") != F.col("main")), "named")
    sizes = named.groupBy("main").agg(F.count(F.lit(1)).alias("members"), F.count_if("stray").alias("strays")).where("strays > 0")
    parts = lambda n: F.ceil(F.col(n) / settings.block)
    sizes = keep(sizes.select("main", parts("strays").alias("ni"), parts("members").alias("nj")), "sizes")
    rows = keep(named.join(sizes, "main").join(signatures.dropDuplicates(["id", "signature"]), "id"), "members")
    wanted = checked_broadcast(keep(rows.select("id").distinct(), "requests"))
    texts = keep(_texts(docs).join(wanted, "id", "left_semi"), "texts")
    at = lambda n: F.pmod(F.xxhash64("id"), n)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["main", "i", "j", "id", "component", "stray", "signature"]
    asking = rows.where("stray").withColumn("i", at("ni")).withColumn("j", upto("nj")).select(*columns, F.lit(1).alias("outside"))
    asked = rows.withColumn("j", at("nj")).withColumn("i", upto("ni")).select(*columns, F.lit(0).alias("outside"))
    dealt = asking.unionByName(asked).join(texts, "id").repartition("main", "i", "j").sortWithinPartitions("main", "i", "j")
    return keep(dealt.mapInArrow(_compare_blocks(settings), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = keep(texts.mapInArrow(_sketches(settings), SKETCH), "sketches")
    same = ["set_a", "set_b", "n_shingles"]
    filled = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = keep(filled.groupBy(*same).agg(F.min("doc_id").alias("id")), "classes")
    chosen = classes.select(*same, F.col("id").alias("doc_id"))
    heads = keep(
        filled.join(chosen, [*same, "doc_id"], "left_semi").select(F.col("doc_id").alias("id"), "bands", "signature"), "heads"
    )

    bands = heads.select("id", F.explode("bands").alias("band"))
    buckets = keep(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = keep(bands.join(buckets, "band"), "shared")
    # the original of a family of copies meets most of them in most bands, so it makes the best hub
    company = met.groupBy("id").agg(F.sum("n").alias("company"))
    ranked = keep(met.join(company, "id").select("band", "n", "id", "company"), "shared")
    central = ranked.groupBy("band").agg(F.max(F.struct("company", (-F.col("id")).alias("least"))).alias("_hub"))
    central = keep(central.select("band", (-F.col("_hub.least")).alias("hub")), "buckets")
    shared = keep(ranked.join(central, "band").select("band", "n", "id", "hub").where("id <> hub OR n > 2"), "shared")

    signatures = heads.select("id", "signature")
    hubs = signatures.select(F.col("id").alias("hub"), F.col("signature").alias("hub_signature"))
    alike = differences(F.col("signature"), F.col("hub_signature"), settings) <= settings.most_differences()
    stars = shared.where("id <> hub").select("hub", "id").distinct()
    candidates = stars.join(signatures, "id").join(hubs, "hub").where(alike).select("hub", "id").distinct()
    links = confirm_links(keep(candidates, "candidates"), docs, settings)
    first = keep(connected_components(links), "components")

    # what the stars left open: buckets of three or more with members outside the hub's component
    more = outside_links(shared.where("n > 2").select("hub", "id"), first, signatures, docs, settings)
    joined = first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    components = keep(connected_components(joined), "components")
    by_class = classes.join(components, classes["id"] == components["node"], "left").select(
        *same, F.coalesce("component", "id").alias("_component")
    )
    by_class = keep(by_class, "classes")
    rows = sketches.select("doc_id", *same).join(by_class, same, "left")
    shared_ids = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return rows.select("doc_id", "n_shingles", shared_ids.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _own_nodes(docs: DataFrame, node: str) -> DataFrame:
    """``docs`` with a number for every pair of ``doc_id`` and text: ``doc_id`` itself, but for further texts of one id.

    Those get a hash without sign that no other row has, so that small ids still stand for their groups.
    """
    own, text = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    ids = docs.select(own.alias("_id"), text.alias("_hash")).where("_id IS NOT NULL")
    mixed = ids.groupBy("_id").agg(F.min("_hash").alias("_first"), F.max("_hash").alias("_last")).where("_first <> _last")
    mixed = keep(mixed.select("_id", "_first"), "mixed")
    if mixed.isEmpty():
        return docs.withColumn(node, own)
    further = keep(ids.join(checked_broadcast(mixed), "_id").where("_hash <> _first").select("_id", "_hash").distinct(), "further")
    for salt in range(8):
        named = keep(further.withColumn("_node", F.xxhash64(F.lit(salt), "_id", "_hash").bitwiseAND(F.lit(2**63 - 1))), "nodes")
        taken = named.join(ids.select(F.col("_id").alias("_node")), "_node", "left_semi")
        if taken.isEmpty() and named.groupBy("_node").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("no free numbers for texts that share a doc_id")
    number, hashed = unused(docs, "_number"), unused(docs, "_hashed")
    named = named.select(F.col("_id").alias(node), F.col("_hash").alias(hashed), F.col("_node").alias(number))
    rows = docs.withColumn(node, own).withColumn(hashed, text)
    return rows.join(checked_broadcast(named), [node, hashed], "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.coalesce(number, node).alias(node)
    )


def distinct_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that represent their groups, with all their columns.

    Different texts under one ``doc_id`` are documents of their own: each is compared, and each stays or goes,
    by itself. Of several rows with one ``doc_id`` and one text the first by a hash of all columns stays;
    rows without a ``doc_id`` all stay.
    """
    node = unused(docs, "_node")
    rows = _own_nodes(docs, node)
    found = keep(near_duplicates(rows.select(F.col(node).alias("doc_id"), "text"), settings), "groups")
    ids = found.where("doc_id IS NOT NULL")
    gone = keep(ids.where("NOT kept").select(F.col("doc_id").alias(node)).distinct(), "gone")
    repeated = keep(
        ids.where("kept").groupBy(F.col("doc_id").alias(node)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(node), "repeated"
    )
    stay = rows.join(checked_broadcast(gone), node, "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if repeated.isEmpty():
        return stay.select(*columns)
    single = stay.join(checked_broadcast(repeated), node, "left_anti").select(*columns)
    several = stay.join(checked_broadcast(repeated), node, "left_semi")
    rank = unused(docs, "_rank")
    order = Window.partitionBy(node).orderBy(F.xxhash64(*columns))
    first = several.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return single.unionByName(first.select(*columns))
