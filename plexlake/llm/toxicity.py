"""Toxicity by a logistic model whose scores must not depend on which group a sentence names.

Features are the words of a text and their first letters, hashed. A bounded sample of labelled rows
selects the features and fits the weights. In every labelled text that names an identity, each name is
swapped in turn for the others of its kind, and the squared change of the log odds, averaged over a text's
swaps, joins the loss of that text, so a group that happens to stand in toxic texts does not become
evidence itself, and the more texts name it, the more it counts. Equal changes are added up in Spark.

Defined results: NULL and empty texts get the score of the intercept; repeated rows are answered
each; rows without id are scored and count as not held out; without labels of both
classes the score is the smoothed share of toxic rows. Only ``doc_id`` and ``text`` make the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexlake.llm import words
from plexlake.llm.stage import keep

FOLDS = 5
WORD_BYTES = words.byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))
PREFIXES = (4, 5, 6)
# Kinds of identity terms; a name is swapped for the others of its kind.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("mexican", "chinese", "german", "french", "spanish", "american"),
    # German
    ("muslime", "juden", "christen", "buddhisten", "atheisten"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("türken", "polen", "deutsche", "franzosen", "amerikaner"),
    # French
    ("musulmans", "juifs", "chrétiens", "bouddhistes", "athées"),
    ("femmes", "hommes", "filles", "garçons"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("immigrés", "réfugiés", "étrangers", "autochtones"),
    ("arabes", "noirs", "blancs", "asiatiques"),
    # Spanish
    ("musulmanes", "judíos", "cristianos", "budistas", "ateos"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
    ("negros", "blancos", "asiáticos", "latinos"),
)


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000  # labelled rows that the model is fitted on, at most
    features: int = 4096
    least_rows: int = 5  # of the sample that must hold a feature
    ridge: float = 1e-4
    fairness: float = 1.0  # weight of the score changes under swaps
    steps: int = 400
    identities: Sequence[Sequence[str]] = IDENTITIES


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the words and word beginnings of a slice, several times if they repeat."""
    starts, ends = words.word_spans(data, offsets, WORD_BYTES)
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes, owners = [words.span_hashes(data, starts, ends, lower=True)], [text]
    for size in PREFIXES:
        long = ends - starts > size
        hashes.append(words.mix(words.span_hashes(data, starts[long], starts[long] + size, lower=True) + np.uint64(size)))
        owners.append(text[long])
    return np.concatenate(owners), np.concatenate(hashes)


def term_features(term: str) -> np.ndarray:
    data = np.frombuffer(term.encode(), np.uint8)
    return np.unique(_features(data, np.array([0, len(data)]))[1])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): how many rows of each class hold a feature, added up per task."""
    parts = []
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, data, offsets in words.text_slices(batch.column(0)):
            owner, found = _features(data, offsets)
            pairs = np.unique(np.stack([found, owner.astype(np.uint64)]), axis=1)
            label = toxic[first:last][pairs[1].astype(np.int64)]
            feature, at = np.unique(pairs[0], return_inverse=True)
            parts.append((feature, np.bincount(at, label == 1, len(feature)), np.bincount(at, label != 1, len(feature))))
    if parts:
        feature, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([p[k] for p in parts]), len(feature)).astype(np.int64) for k in (1, 2)]
        yield pa.record_batch([pa.array(feature.view(np.int64)), pa.array(sums[0]), pa.array(sums[1])], names=["feature", "toxic", "clean"])


def _select(selected: np.ndarray, owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, index) pairs, once each, of the features that were selected (sorted hashes)."""
    sieve = np.zeros(1 << 20, bool)
    sieve[(selected & np.uint64(0xFFFFF)).astype(np.int64)] = True
    maybe = sieve[(found & np.uint64(0xFFFFF)).astype(np.int64)]
    owner, found = owner[maybe], found[maybe]
    at = np.minimum(np.searchsorted(selected, found), len(selected) - 1)
    hit = selected[at] == found
    pairs = np.unique(owner[hit].astype(np.int64) << 32 | at[hit])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _sparse(selected: np.ndarray):
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(0)):
                owner, index = _select(selected, *_features(data, offsets))
                ends = np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32)
                yield pa.record_batch(
                    [batch.column(1).slice(first, last - first), pa.ListArray.from_arrays(pa.array(ends), pa.array(index.astype(np.int32)))],
                    names=["toxic", "features"],
                )

    return sparse


def _changes(selected: np.ndarray, settings: Settings):
    """(change, n): features that a swap takes from (below 0) or gives to a text, numbered from 1; n sums 1 / swaps of a text."""
    names = [(k, t) for k, kind in enumerate(settings.identities) for t in kind]
    word = np.array([words.span_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t.encode())]), lower=True)[0] for _, t in names])
    order = np.argsort(word)
    given = [np.searchsorted(selected, term_features(t)) for _, t in names]  # all of them are selected

    def change(index: np.ndarray, named: np.ndarray, old: int, new: int) -> tuple[int, ...]:
        """``index`` are the selected features of all words of a text, ``named`` those of the name; both with repeats."""
        before, counts = np.unique(index, return_counts=True)
        taken, times = np.unique(named, return_counts=True)
        gone = taken[counts[np.searchsorted(before, taken)] == times]  # no other word has them
        lost, won = np.setdiff1d(gone, given[new]), np.setdiff1d(given[new], before)
        return (*(-1 - lost).tolist(), *(won + 1).tolist())

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, ...], float] = {}
        for batch in batches:
            for _, _, data, offsets in words.text_slices(batch.column(0)):
                starts, ends = words.word_spans(data, offsets, WORD_BYTES)
                text = np.searchsorted(offsets, starts, side="right") - 1
                hashes = words.span_hashes(data, starts, ends, lower=True)
                at = np.minimum(np.searchsorted(word[order], hashes), len(order) - 1)
                met = np.unique(np.stack([text, order[at]])[:, word[order][at] == hashes], axis=1)
                for row in np.unique(met[0]).tolist():
                    part = data[offsets[row] : offsets[row + 1]]
                    _, found = _features(part, np.array([0, len(part)]))
                    place = np.minimum(np.searchsorted(selected, found), len(selected) - 1)
                    index = place[selected[place] == found]
                    pairs = [(a, b) for a in met[1][met[0] == row].tolist() for b in range(len(names)) if names[a][0] == names[b][0] and a != b]
                    for a, b in pairs:
                        times = int(((text == row) & (hashes == word[a])).sum())
                        key = change(index, np.repeat(given[a], times), a, b)
                        total[key] = total.get(key, 0.0) + 1 / len(pairs)
        if total:
            yield pa.record_batch([pa.array([list(k) for k in total], pa.list_(pa.int32())), pa.array(list(total.values()))], names=["change", "n"])

    return changes


@dataclass(frozen=True)
class Model:
    selected: np.ndarray
    weights: np.ndarray
    intercept: float


def sample_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(text, toxic) of at most ``settings.sample`` labelled rows, chosen by a hash of their ids."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = keep(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keep(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "sample")  # bounded by the setting


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    rows = sample_rows(docs, labels, settings)
    sizes = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    toxic, clean = sizes
    prior = float(np.log((toxic + 0.5) / (clean + 0.5)))
    if not toxic or not clean:
        return Model(np.zeros(1, np.uint64), np.zeros(1), prior)
    counted = rows.mapInArrow(_count, "feature long, toxic long, clean long").groupBy("feature")
    counted = counted.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") + F.col("c") >= settings.least_rows)
    share = (F.col("t") + F.col("c")) / (toxic + clean)
    z = F.abs(F.col("t") / toxic - F.col("c") / clean) / F.sqrt(share * (1.000001 - share))
    top = counted.orderBy(F.desc(z), "feature").limit(settings.features).select("feature").collect()  # bounded by the setting
    identity = [h for kind in settings.identities for term in kind for h in term_features(term).tolist()]
    selected = np.unique(np.concatenate([np.array([r[0] for r in top], np.int64).view(np.uint64), np.array(identity, np.uint64)]))
    sparse = rows.select("text", "toxic").mapInArrow(_sparse(selected), "toxic int, features array<int>").toPandas()
    counts = sparse["features"].map(len).to_numpy()
    column = np.concatenate(sparse["features"].to_list()).astype(np.int64)
    y = (sparse["toxic"].to_numpy() == 1).astype(float)
    if not settings.fairness or not identity:
        return Model(selected, *_descend(column, counts, y, [], prior, settings, len(selected)))
    changed = rows.select("text").mapInArrow(_changes(selected, settings), "change array<int>, n double").groupBy("change")
    found = changed.agg(F.sum("n").alias("n")).where("size(change) > 0").orderBy("change").collect()  # bounded by the sample
    swaps = [(np.abs(c) - 1, np.sign(c).astype(float), r["n"]) for r in found for c in [np.array(r["change"], np.int64)]]
    return Model(selected, *_descend(column, counts, y, swaps, prior, settings, len(selected)))


def _descend(column, counts, y, swaps, prior: float, settings: Settings, width: int) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on mean log loss + ridge + mean over all rows of the squared change of log odds under swaps."""
    row = np.repeat(np.arange(len(y)), counts)
    at = np.concatenate([s[0] for s in swaps]) if swaps else np.zeros(0, np.int64)
    sign = np.concatenate([s[1] for s in swaps]) if swaps else np.zeros(0)
    which = np.repeat(np.arange(len(swaps)), [len(s[0]) for s in swaps]) if swaps else np.zeros(0, np.int64)
    share = np.array([s[2] for s in swaps]) / len(y)  # of the rows that a change stands for
    weights, intercept = np.zeros(width), prior
    seen_w, seen_b = weights.copy(), intercept
    # curvature of each coordinate, rows weighted by their length: dominates the Hessian, so steps of one are safe
    curve = 0.25 * np.bincount(column, (counts + 1.0)[row], width) / len(y) + settings.ridge
    if len(swaps):
        curve += 2 * settings.fairness * np.bincount(at, (np.bincount(which) * share)[which], width)
    curve_b = 0.25 * (counts + 1.0).mean()
    for step in range(settings.steps):
        score = seen_b + np.bincount(row, seen_w[column], len(y))
        rest = 1 / (1 + np.exp(-np.clip(score, -700, 700))) - y
        gradient = np.bincount(column, rest[row], width) / len(y) + settings.ridge * seen_w
        if len(swaps):
            change = share * np.bincount(which, sign * seen_w[at], len(swaps))
            gradient += 2 * settings.fairness * np.bincount(at, sign * change[which], width)
        new_w, new_b = seen_w - gradient / curve, seen_b - rest.mean() / curve_b
        push = step / (step + 3)
        seen_w, seen_b = new_w + push * (new_w - weights), new_b + push * (new_b - intercept)
        weights, intercept = new_w, new_b
    return weights, float(intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    selected, weights, intercept = model.selected, model.weights, model.intercept

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(1)):
                owner, index = _select(selected, *_features(data, offsets))
                total = intercept + np.bincount(owner, weights[index], last - first)
                yield pa.record_batch(
                    [batch.column(0).slice(first, last - first), pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700))))], names=["doc_id", "score"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scores, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scored = score(docs, fit(docs, labels, settings))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
