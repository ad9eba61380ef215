"""Secrets in texts: fixed rules, and two character Markov models for what the rules miss.

One model describes random strings, one ordinary identifiers. Their training strings are labelled by
the corpus itself: what the rules match, and the words of its prose. Transition counts over all
documents are added up in the tasks and then in Spark, a table of at most 2 x 96 x 96 numbers. Ordinary
strings are the words of the prose, as they stand and in capitals (those as long as candidates only where their
case is a word's, lest keys teach it), short identifiers and numbers; and a
character may repeat itself, as in a ruled line. A candidate, a run of 16 or more of the characters that keys
are made of with a letter or digit among them, is reported when its log-likelihood ratio exceeds the prior odds
against it; nothing else decides.

Defined results: NULL and empty texts hold nothing; repeated rows are answered each; without any
rule match the random model is uniform, without prose the other one is. Positions count code
points from 0, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed by the contract.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_MARK = re.compile(r"(?ai:passw|secret|token|api_?key)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

ADDED = "random"
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[+/_=-]*[A-Za-z0-9])[A-Za-z0-9+/_=-]{16,}")
_ORDINARY = re.compile(r"[^\W\d_]{4,}(?:_[^\W\d_]+)*|(?<![\w+/=-])(?:[\w+/=-]{4,15}|\d{16,})(?![\w+/=-])")  # words, else short identifiers and numbers
SYMBOLS = 96  # printable ASCII; 0 is the edge and everything else
CAPITALS, REPEATS = 0.05, 0.1  # weight of words in capitals, share of a character that repeats itself
JOINTS = 0.1  # weight of a joint within an identifier against the edge of a word
SEEN = 10  # transitions by the frequency of the next symbol alone that every symbol starts with
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank, end) by the rules, leftmost and non-overlapping per kind."""
    found = []
    if _ASSIGN_MARK.search(text):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def symbols(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings with an edge around each, and where each string's transitions begin."""
    raw = np.frombuffer(("\x00" + "\x00".join(strings) + "\x00").encode("ascii", "replace"), np.uint8).astype(np.int64) - 32
    codes = np.where((raw > 0) & (raw < SYMBOLS), raw, 0)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    return codes, np.cumsum(lengths) - lengths


def _secret_part(text: str, span: tuple[int, int, int]) -> str:
    if span[1] == 0:
        return _ASSIGN.match(text, span[0])[1]
    return text[span[0] : span[2]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(2 * SYMBOLS * SYMBOLS, np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py() or ""
            secrets = [_secret_part(text, s) for s in base_spans(text)]
            prose = [w for w in (m[0] for m in _ORDINARY.finditer(text)) if len(w) < 16 or w.islower() or w.isupper() or w.istitle() or w.isdigit()]
            for k, strings in enumerate((secrets, prose)):
                if strings:
                    codes, _ = symbols(strings)
                    pairs = codes[:-1] * SYMBOLS + codes[1:]
                    totals += np.bincount(pairs + k * SYMBOLS * SYMBOLS, minlength=len(totals))
    seen = np.flatnonzero(totals)
    if len(seen):
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(totals[seen])], names=["cell", "n"])


def train(docs: DataFrame, uniform: float = 0.5) -> np.ndarray:
    """Log-likelihood ratio of every transition. ``uniform`` is the share of a flat model in both."""
    cells = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "cell int, n long")
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most 2 x 96 x 96
    counts = np.zeros(2 * SYMBOLS * SYMBOLS)
    for r in rows:
        counts[r["cell"]] = r["n"]
    counts = counts.reshape(2, SYMBOLS, SYMBOLS)
    upper = np.array([ord(chr(c + 32).upper()) - 32 for c in range(SYMBOLS)])
    np.add.at(counts[1], (upper[:, None], upper[None, :]), CAPITALS * counts[1])
    for joint in (ord(c) - 32 for c in "_-/"):  # an identifier is words with these between
        counts[1][:, joint] += JOINTS * counts[1][:, 0]
        counts[1][joint] += JOINTS * counts[1][0]
    # what the rules match are often digests: the flat part stands for random strings of other alphabets
    alphabet = np.array([c == 0 or chr(c + 32).isalnum() or chr(c + 32) in "+/_=-" for c in range(SYMBOLS)])
    flats = (alphabet / alphabet.sum(), np.full(SYMBOLS, 1 / SYMBOLS))
    models = []
    for table, flat, share in zip(counts, flats, (uniform, 0.02)):
        single = (table.sum(axis=0) + flat) / (table.sum() + 1)  # stands in where a symbol was hardly seen
        models.append((1 - share) * (table + SEEN * single) / (table.sum(axis=1, keepdims=True) + SEEN) + share * flat)
    models = [0.999 * m + 0.001 / SYMBOLS for m in models]
    models[1] = (1 - REPEATS) * models[1] + REPEATS * np.eye(SYMBOLS)
    return np.log(models[0]) - np.log(models[1])


def ratios(strings: list[str], table: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each string, its edges included."""
    codes, first = symbols(strings)
    return np.add.reduceat(table[codes[:-1], codes[1:]], first)


def _free(text: str, spans: list[tuple[int, int, int]]) -> list[re.Match]:
    """Candidates that meet no span of the rules."""
    starts, reach = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
    found = []
    for m in _CANDIDATE.finditer(text):
        before = bisect_left(starts, m.end())
        if not before or reach[before - 1] <= m.start():
            found.append(m)
    return found


def _scan(table: np.ndarray, odds: float):
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, asked = [], []
            for row, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                spans = base_spans(text)
                out.append([{"start": s, "rank": r, "end": e, "kind": KINDS[r], "score": 1.0} for s, r, e in spans])
                asked += [(row, m.start(), m.end(), m[0]) for m in _free(text, spans)]
            if asked:
                ratio = ratios([a[3] for a in asked], table)
                score = 1 / (1 + np.exp(np.clip(odds - ratio, -700, 700)))
                for k in np.flatnonzero(ratio > odds).tolist():
                    row, start, end, _ = asked[k]
                    out[row].append({"start": start, "rank": len(KINDS), "end": end, "kind": ADDED, "score": float(score[k])})
            out = [sorted(spans, key=lambda s: (s["start"], s["rank"])) for spans in out]
            yield pa.record_batch([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return scan


def find_secrets(docs: DataFrame, table: np.ndarray | None = None, odds: float = 12.0) -> DataFrame:
    """(doc_id, spans) of every row; ``table`` is what :func:`train` made, by default of ``docs``."""
    table = train(docs) if table is None else table
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(table, odds), f"doc_id long, spans {SPAN}")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


