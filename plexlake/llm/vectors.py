"""Near-duplicate vectors by dual traversal of cover trees, exact above a cosine threshold.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). Vectors of one label are
dealt into blocks of bounded size. Every pair of blocks goes to one task, which builds a tree for
each: nested levels of centres with halving radii, every node knowing the true radius that covers
its members. Both trees are descended together, and a pair of nodes goes no further when its
centres are farther apart than both radii and the threshold; what is left is compared in double
precision. A task returns, per vector, a count of links and a local component, never pairs.

Equal vectors are one class, so copies cost nothing. The work between blocks of one label grows with
the square of its size unless the vectors cluster; in many dimensions no exact bound avoids that.

Defined results: NULL, zero, empty or non-finite vectors and rows without label or id link with
nothing; vectors of different length are not compared; repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.llm import words
from plexlake.llm.graph import connected_components, roots
from plexlake.llm.stage import keep

THRESHOLD = 0.98
BLOCK_NUMBERS = 1 << 17  # numbers in a block of vectors
_RADII = (1.0, 0.5, 0.25)  # below the root, which covers the sphere with radius 2
_PAIRS = 1 << 17


class Tree:
    """Levels of (centre, parent, radius); points are reordered so that a last-level node is a range."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        node = np.zeros(n, np.int64)
        centres = np.zeros(1, np.int64)
        self.levels = [(centres, np.zeros(1, np.int64), self._radii(node, centres))]
        for radius in _RADII:
            centres, parents, node = self._split(node, centres, radius)
            self.levels.append((centres, parents, self._radii(node, centres)))
        self.order = np.argsort(node, kind="stable")
        self.counts = np.bincount(node, minlength=len(centres))
        self.first = np.cumsum(self.counts) - self.counts

    def _radii(self, node: np.ndarray, centres: np.ndarray) -> np.ndarray:
        gaps = np.linalg.norm(self.points - self.points[centres[node]], axis=1)
        out = np.zeros(len(centres))
        np.maximum.at(out, node, gaps)
        return out

    def _split(self, node: np.ndarray, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cover the members of every node with balls; its own centre is the first of them."""
        new_centres, parents, new_node = [], [], np.empty_like(node)
        order = np.argsort(node, kind="stable")
        borders = np.searchsorted(node[order], np.arange(len(centres) + 1))
        for k, centre in enumerate(centres.tolist()):
            members = order[borders[k] : borders[k + 1]]
            points, open_ = self.points[members], np.ones(len(members), bool)
            at = int(np.flatnonzero(members == centre)[0])
            while True:
                near = open_ & (points @ points[at] >= 1 - radius * radius / 2)
                near[at] = True  # whatever rounding says
                new_node[members[near]] = len(new_centres)
                new_centres.append(int(members[at]))
                parents.append(k)
                open_ &= ~near
                if not open_.any():
                    break
                at = int(open_.argmax())
        return np.array(new_centres), np.array(parents), new_node


def near_pairs(a: Tree, b: Tree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (i, j), points of both trees that may be within ``reach``: every such pair is among them."""
    allowed = np.ones((1, 1), bool)
    for (ca, pa_, ra), (cb, pb, rb) in zip(a.levels, b.levels):
        allowed = allowed[pa_][:, pb]
        bound = ra[:, None] + rb[None, :] + reach
        i, j = np.nonzero(allowed)
        if len(i) * 8 > allowed.size:
            gaps = 2 - 2 * (a.points[ca] @ b.points[cb].T)
            allowed &= gaps <= bound * bound + 1e-9
        else:
            for at in range(0, len(i), _PAIRS):
                x, y = i[at : at + _PAIRS], j[at : at + _PAIRS]
                gaps = 2 - 2 * np.einsum("ij,ij->i", a.points[ca[x]], b.points[cb[y]])
                allowed[x, y] = gaps <= bound[x, y] ** 2 + 1e-9
    x, y = np.nonzero(allowed)
    sizes = a.counts[x] * b.counts[y]
    at = 0
    while at < len(x):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), _PAIRS, side="right")) + at)
        p, q = x[at:upto], y[at:upto]
        if upto == at + 1:  # one pair of nodes, whatever its size, row by row
            left, right = a.order[a.first[p[0]] :][: a.counts[p[0]]], b.order[b.first[q[0]] :][: b.counts[q[0]]]
            rows = max(1, _PAIRS // len(right))
            for k in range(0, len(left), rows):
                part = left[k : k + rows]
                yield np.repeat(part, len(right)), np.tile(right, len(part))
        else:
            block = np.repeat(np.arange(len(p)), sizes[at:upto])
            within = words.gather_runs(np.zeros(len(p), np.int64), sizes[at:upto])
            width = b.counts[q][block]
            yield a.order[a.first[p][block] + within // width], b.order[b.first[q][block] + within % width]
        at = upto


def _compare(threshold: float):
    reach = math.sqrt(2 - 2 * threshold) + 1e-7

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        one, other = key[2].as_py(), key[3].as_py()
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        raw = np.stack([np.asarray(v, np.float64) for v in group.column("v").to_pylist()])
        order = np.argsort(ids, kind="stable")
        ids, copies, raw, block = ids[order], copies[order], raw[order], group.column("block").to_numpy()[order]
        norms = np.linalg.norm(raw, axis=1)
        unit = raw / norms[:, None]
        sides = [np.flatnonzero(block == k) for k in (one, other)]
        left = Tree(unit[sides[0]])
        right = left if one == other else (Tree(unit[sides[1]]) if len(sides[1]) else None)
        links, edges = np.zeros(len(ids), np.int64), []
        for i, j in near_pairs(left, right, reach) if right is not None else ():
            i, j = sides[0][i], sides[1][j]
            if one == other:
                i, j = i[i < j], j[i < j]
            cosine = np.einsum("ij,ij->i", raw[i], raw[j]) / (norms[i] * norms[j])
            i, j = i[cosine >= threshold], j[cosine >= threshold]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            # a spanning set of edges is enough from here on
            root = roots(len(ids), np.concatenate([*(e[0] for e in edges), i]), np.concatenate([*(e[1] for e in edges), j]))
            moved = np.flatnonzero(root != np.arange(len(ids)))
            edges = [(moved, root[moved])]
        root = roots(len(ids), *edges[0]) if edges else np.arange(len(ids))
        hit = links > 0
        return pa.table({"id": ids[hit], "root": ids[root[hit]], "links": links[hit]})

    return compare


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, n, digest): length and digest of usable vectors, NULL for the others."""
    for batch in batches:
        sizes, digests = [], []
        for v in batch.column(2):
            x = np.array([math.nan if e is None else e for e in v.as_py()], np.float64) if v.is_valid else np.zeros(0)
            # the squares must add up to something: no underflow, no overflow
            good = len(x) > 0 and np.isfinite(x).all() and 0 < float(x @ x) < math.inf
            sizes.append(len(x) if good else None)
            digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if good else None)
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())], names=["vec_id", "label", "n", "digest"]
        )


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    read = keep(rows.mapInArrow(_read, "vec_id long, label string, n int, digest binary"), "vectors")
    usable = read.where("digest IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    same = ["label", "n", "digest"]
    classes = keep(usable.groupBy(*same).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    sizes = classes.groupBy("label", "n").agg(F.count(F.lit(1)).alias("members"))
    blocks = keep(
        sizes.select("label", "n", F.ceil(F.col("members") / F.greatest(F.lit(64), F.lit(BLOCK_NUMBERS) / F.col("n"))).cast("int").alias("blocks")), "blocks"
    )
    placed = keep(
        classes.join(blocks, ["label", "n"]).select("id", "label", "n", "copies", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), "blocks"),
        "placed",
    )
    heads = placed.join(rows.select(F.col("vec_id").alias("id"), F.col("v"), F.size("v").alias("n"), "label"), ["id", "label", "n"])
    heads = heads.dropDuplicates(["id", "label", "n"])  # rows of one class and id are equal
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    dealt = heads.select("id", "label", "n", "copies", "block", "v", partner).select(
        "id", "label", "n", "copies", "block", "v", F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("other")
    )
    found = keep(dealt.groupBy("label", "n", "one", "other").applyInArrow(_compare(threshold), "id long, root long, links long"), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    answers = classes.join(counts, "id", "left").join(parts, F.col("id") == F.col("node"), "left").select(
        *same, (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    answers = keep(answers, "answers")
    linkable = read.withColumn("label", F.when(F.col("vec_id").isNotNull(), F.col("label")))
    return linkable.join(answers, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
