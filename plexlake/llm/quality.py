"""Text quality by the perplexity of an interpolated modified Kneser-Ney model (Chen and Goodman 1999).

The model predicts a text's characters, each code point a symbol of its own, from the three before
them; a word that repeats the one before it is a symbol too, as no short context could tell.
Trusted text trains it: documents whose labels all say quality 1. Counts of all trusted text are
added up in tables sharded by n-gram; joins by context and by shorter n-gram give the discounted
probabilities, order by order. No table is gathered or sent to all tasks, so nothing bounds the
number of n-grams but the text.

Documents are scored by joins too. They are dealt into blocks of a few megabytes; each block asks once
for every n-gram it holds, however often and in however many documents, so a common n-gram meets
the table once a block. The distinct questions are answered order by order, and the
answers go back to their block.

A document is rejected when its log perplexity is beyond the 0.99 quantile of the trusted documents of its
language by more than 1.645 standard errors, the sampling uncertainty of a mean over as many
symbols; nothing else is allowed for. Languages with little trusted text use the quantile of all.

Defined results: NULL and empty texts are scored as the end symbol alone; NULL is a language of its
own; repeated rows are answered each; without trusted text all symbols are equally likely and
nothing is rejected. Columns other than ``doc_id``, ``text`` and ``lang`` pass through
``accepted`` and do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from plexlake.llm import words
from plexlake.llm.stage import keep, keep_by, remove, unused
from plexlake.plans.sizing import checked_broadcast

ORDER = 4
SLICE_BYTES = 1 << 20  # several arrays of eight bytes a symbol are made of a slice
FEW = 2  # symbols whose spread is assumed
BLOCK_BYTES = 8 << 20  # of text that ask for their n-grams together
_SPACE = words.byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
_PUNCTUATION = b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"


def _symbol_table() -> np.ndarray:
    """Byte to class: 0 is the edge of a text, letters a-z, one class each for capitals and digits,
    white space, single signs, and lead and other bytes of longer characters."""
    table = np.full(256, 63, np.uint8)
    table[0x00:0x20] = 29
    table[0xC0:] = 62
    table[0x7F] = 29
    table[list(range(ord("a"), ord("z") + 1))] = np.arange(1, 27)
    table[list(range(ord("A"), ord("Z") + 1))] = 27
    table[list(range(ord("0"), ord("9") + 1))] = 28
    table[ord(" ")] = 29
    table[ord("\n")] = 30
    table[ord(".")], table[ord(",")] = 31, 32
    for i, byte in enumerate(_PUNCTUATION):
        table[byte] = min(33 + i, 60)
    return table


def _code_points(data: np.ndarray) -> np.ndarray:
    """The code point that begins at each byte; bytes within a character have no meaning here."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    first, (b, c, d) = wide[:n], (wide[k : n + k] & 0x3F for k in (1, 2, 3))
    two, three, four = (first & 0x1F) << 6 | b, (first & 0x0F) << 12 | b << 6 | c, (first & 0x07) << 18 | b << 12 | c << 6 | d
    return np.select([first < 0x80, first < 0xE0, first < 0xF0], [first, two, three], four)


@dataclass(frozen=True)
class Alphabet:
    """How texts become symbols; symbol 0 is the edge of a text."""

    bits: int
    size: int
    repeat: int  # the symbol of a word that repeats the one before it
    characters: bool  # code points, or classes of bytes

    def symbols(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of every byte, and whether a symbol begins there."""
        if not self.characters:
            return _symbol_table()[data].astype(np.int32), np.ones(len(data), bool)
        return _code_points(data) + 1, (data & 0xC0) != 0x80


# Classes of bytes lose the letters of most scripts; what judges documents is trained on characters.
CLASSES = Alphabet(6, 64, 61, False)
CHARACTERS = Alphabet(21, 0x110002, 0x110001, True)


@dataclass(frozen=True)
class Settings:
    high: float = 0.99  # the threshold: this quantile of trusted log perplexities, per language
    least_trusted: int = 50  # documents a language needs for a quantile of its own
    deviations: float = 1.645  # standard errors of its own mean by which a text must miss the threshold


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) whose labels are there and all say quality 1."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def _body(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts with edges around each, where their n-grams begin, and how many a text has."""
    starts, ends = words.word_spans(data, offsets, _SPACE)
    hashes = words.span_hashes(data, starts, ends, lower=True)
    again = np.zeros(len(starts), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    first = words.per_text(starts, offsets)[:-1]
    again[first[first < len(starts)]] = False
    symbols, begins = alphabet.symbols(data)
    gaps = ends[:-1][again[1:]]  # the space before a repeated word goes with it
    symbols[gaps] = alphabet.repeat
    edges = np.zeros(len(data) + 1, np.int8)
    np.add.at(edges, gaps + 1, 1)
    np.add.at(edges, ends[again], -1)
    stay = (np.cumsum(edges[:-1], dtype=np.int8) == 0) & begins
    offsets = np.concatenate([[0], np.cumsum(stay)])[offsets]
    symbols = symbols[stay]
    lengths = np.diff(offsets)
    n = len(lengths)
    pad = ORDER - 1
    body = np.zeros(len(symbols) + n * pad + pad, np.int32)  # the edges of the next text close this one
    body[np.arange(len(symbols)) + np.repeat(pad * np.arange(1, n + 1), lengths)] = symbols
    counts = lengths + 1  # the symbols and the end
    first = np.concatenate([[0], np.cumsum(lengths + pad)])[:-1]
    return body, words.gather_runs(first, counts), counts


def _pack(parts: list[np.ndarray], bits: int) -> np.ndarray:
    packed = parts[0].astype(np.int64)
    for part in parts[1:]:
        packed = packed << bits | part
    return packed


def _distinct(body: np.ndarray, at: np.ndarray, alphabet: Alphabet, **also: bool) -> tuple:
    """(context, symbol) of the distinct n-grams that begin at ``at``, and what else np.unique is asked for."""
    windows = lambda symbols: [symbols[k : k + len(body) - ORDER + 1] for k in range(ORDER)]
    letters, small = np.unique(body, return_inverse=True) if alphabet.characters else (np.arange(alphabet.size), body)
    width = int(len(letters) - 1).bit_length()
    if ORDER * width <= 63:
        found, *more = np.unique(_pack(windows(small), width)[at], **also) if also else (np.unique(_pack(windows(small), width)[at]),)
        parts = [letters[found >> width * (ORDER - 1 - k) & ((1 << width) - 1)] for k in range(ORDER)]
        return _pack(parts[:-1], alphabet.bits), parts[-1].astype(np.int32), *more
    *before, last = windows(body)
    contexts, which = np.unique(_pack(before, alphabet.bits)[at], return_inverse=True)
    found, *more = np.unique(which << alphabet.bits | last[at], **also) if also else (np.unique(which << alphabet.bits | last[at]),)
    return contexts[found >> alphabet.bits], (found & ((1 << alphabet.bits) - 1)).astype(np.int32), *more


def ngram_counts(texts: DataFrame, alphabet: Alphabet = CHARACTERS) -> DataFrame:
    """(context, symbol, n) over all of ``texts`` (text): every task adds up its own before anything moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in words.text_slices(batch.column(0), SLICE_BYTES):
                body, at, _ = _body(data, offsets, alphabet)
                context, symbol, n = _distinct(body, at, alphabet, return_counts=True)
                yield pa.record_batch([pa.array(context), pa.array(symbol), pa.array(n)], names=["context", "symbol", "n"])

    counted = texts.mapInArrow(count, "context long, symbol int, n long")
    return counted.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the counts of counts; half an occurrence where these are degenerate."""
    row = counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = row
    if not (n1 and n2 and n3):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), k) for d, k in zip(found, (0.9, 1.9, 2.9)))


def _nearest(order: int, alphabet: Alphabet) -> Column:
    """The context of an n-gram of ``order``, cut out of a longer one."""
    return F.col("context").bitwiseAND(F.lit((1 << alphabet.bits * (order - 1)) - 1).cast("long"))


@dataclass(frozen=True)
class Model:
    """Per order: (context, symbol, p), and (context, weight) of the next lower order; tables on shared storage."""

    probabilities: list[DataFrame]
    contexts: list[DataFrame]
    alphabet: Alphabet

    def remove(self) -> None:
        """Delete the tables once no score reads them any more."""
        for table in [*self.probabilities, *self.contexts]:
            remove(table)


def train(texts: DataFrame, alphabet: Alphabet = CLASSES) -> Model:
    """Kneser-Ney over ``texts`` (text). Lower orders count different left neighbours, not occurrences."""
    levels = [keep(ngram_counts(texts, alphabet), "ngrams")]
    for order in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy(_nearest(order, alphabet).alias("context"), "symbol")
        levels.insert(0, keep(shorter.agg(F.count(F.lit(1)).alias("n")), "ngrams"))
    probabilities: list[DataFrame] = []
    contexts: list[DataFrame] = []
    for order, counts in enumerate(levels, 1):
        d1, d2, d3 = _discounts(counts)
        taken = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        by_context = counts.groupBy("context").agg(
            F.sum("n").alias("total"),
            ((d1 * F.count_if(F.col("n") == 1) + d2 * F.count_if(F.col("n") == 2) + d3 * F.count_if(F.col("n") > 2)) / F.sum("n")).alias("weight"),
        )
        by_context = keep(by_context, "contexts")
        rows, below = _with_lower(counts.join(by_context, "context"), order, probabilities, alphabet)
        found = rows.select("context", "symbol", ((F.col("n") - taken) / F.col("total") + F.col("weight") * below).alias("p"))
        probabilities.append(keep(found, "probabilities"))
        contexts.append(by_context)
        remove(counts)
    return Model(probabilities, contexts, alphabet)


def _with_lower(rows: DataFrame, order: int, found: list[DataFrame], alphabet: Alphabet) -> tuple[DataFrame, Column]:
    """``rows`` of n-grams next to the probabilities one order below, the last of ``found``."""
    if order == 1:
        return rows, F.lit(1.0 / alphabet.size)
    lower = found[-1].select(F.col("context").alias("lower_context"), F.col("symbol").alias("lower_symbol"), F.col("p").alias("lower_p"))
    same = (_nearest(order - 1, alphabet) == F.col("lower_context")) & (F.col("symbol") == F.col("lower_symbol"))
    return rows.join(lower, same), F.col("lower_p")


def answer(asked: DataFrame, model: Model) -> DataFrame:
    """(context, symbol, p) of the distinct n-grams in ``asked``; what was not seen gets its context's weight times the lower order."""
    levels = [asked]
    for order in range(ORDER - 1, 0, -1):
        levels.insert(0, levels[0].select(_nearest(order, model.alphabet).alias("context"), "symbol").distinct())
    found: list[DataFrame] = []
    for order, level in enumerate(levels, 1):
        rows = level.join(model.probabilities[order - 1], ["context", "symbol"], "left").join(model.contexts[order - 1].select("context", "weight"), "context", "left")
        rows, below = _with_lower(rows, order, found, model.alphabet)
        p = F.coalesce("p", F.coalesce("weight", F.lit(1.0)) * below)
        found.append(keep(rows.select("context", "symbol", p.alias("p")), "answers"))
        if order > 1:
            remove(found[order - 2])
    return found[-1]


def _blocks(docs: DataFrame, text: str, block: str) -> DataFrame:
    """``docs`` with the number of the block that each row belongs to."""
    at, names = docs.columns.index(text), [*docs.columns, block]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for first, last, data, _ in words.text_slices(batch.column(at), SLICE_BYTES):
                if filled and filled + len(data) > BLOCK_BYTES:
                    number, filled = number + 1, 0
                filled += len(data)
                rows = batch.slice(first, last - first)
                yield pa.record_batch([*rows.columns, pa.array(np.full(last - first, number, np.int64))], names=names)

    return docs.mapInArrow(deal, StructType([*docs.schema.fields, StructField(block, LongType())]))


def _asked(dealt: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(block, context, symbol): the n-grams of each block of ``dealt`` (text, block).

    Rows of a block stand together, so a task gives each n-gram of it once and nothing is shuffled; a block
    that two tasks read has some twice, which changes no answer.
    """

    def once(parts: list[tuple[np.ndarray, np.ndarray]], number: int) -> pa.RecordBatch:
        context, symbol = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((symbol, context))
        context, symbol = context[order], symbol[order]
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (symbol[1:] != symbol[:-1])
        columns = [np.full(int(new.sum()), number, np.int64), context[new], symbol[new]]
        return pa.record_batch([pa.array(c) for c in columns], names=["block", "context", "symbol"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            numbers = batch.column(1).to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for at, to in zip(borders[:-1], borders[1:]):
                if to == at:
                    continue
                if parts and numbers[at] != current:
                    yield once(parts, current)
                    parts = []
                current = int(numbers[at])
                for _, _, data, offsets in words.text_slices(batch.column(0).slice(at, to - at), SLICE_BYTES):
                    body, where, _ = _body(data, offsets, alphabet)
                    parts.append(_distinct(body, where, alphabet))
        if parts:
            yield once(parts, current)

    return dealt.mapInArrow(ask, "block long, context long, symbol int")


def score(docs: DataFrame, model: Model, log_perplexity: str = "log_perplexity", n_symbols: str = "n_symbols", text: str = "text", standard_error: str = "standard_error", with_text: bool = True) -> DataFrame:
    """``docs`` with the three columns added to every row, written to shared storage; ``with_text=False`` leaves the text out.

    Texts are written once, in buckets by block, and stay there: only the answers are shuffled.

    The standard error is that of the mean over the text's own symbols. The spread among n symbols is taken
    as one of n + ``FEW``, the others as far off the mean as a symbol drawn at random from the alphabet would be:
    a few symbols cannot tell their spread.
    """
    alphabet, block = model.alphabet, unused(docs, "_block")
    far = float(np.log(alphabet.size)) ** 2
    dealt = keep_by(_blocks(docs, text, block), "blocks", block)
    asked = keep(_asked(dealt.select(F.col(f"`{text}`").cast("string"), block), alphabet), "asked")
    questions = keep(asked.select("context", "symbol").distinct(), "questions")
    found = answer(questions, model)
    remove(questions)
    answers = keep(asked.join(found, ["context", "symbol"]).select("block", "context", "symbol", F.log("p").alias("log_p")), "answers")
    for table in (asked, found):
        remove(table)
    at, fields = docs.columns.index(text), [f for f in docs.schema.fields if with_text or f.name != text]
    kept = [k for k, c in enumerate(docs.columns) if with_text or c != text]
    names = [*(f.name for f in fields), n_symbols, log_perplexity, standard_error]

    def scores(rows: pa.Table, known: pa.Table) -> pa.Table:
        context, symbol, log_p = (known.column(k).to_numpy() for k in ("context", "symbol", "log_p"))
        order = np.lexsort((symbol, context))
        context, symbol, log_p = context[order], symbol[order], log_p[order]
        starts = np.flatnonzero(np.diff(context, prepend=-1))
        contexts = context[starts]
        key = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(context))) << alphabet.bits | symbol
        lengths, means, errors = [], [], []
        for _, _, data, offsets in words.text_slices(rows.column(at).combine_chunks(), SLICE_BYTES):
            body, where, counts = _body(data, offsets, alphabet)
            own_context, own_symbol, inverse = _distinct(body, where, alphabet, return_inverse=True)
            values = log_p[np.searchsorted(key, np.searchsorted(contexts, own_context) << alphabet.bits | own_symbol)]
            begins = np.cumsum(counts) - counts
            mean = np.add.reduceat(values[inverse], begins) / counts
            squares = np.add.reduceat((values[inverse] - np.repeat(mean, counts)) ** 2, begins)
            lengths.append(counts)
            means.append(-mean)
            errors.append(np.sqrt((squares + FEW * far) / (counts + FEW) / counts))
        columns = [rows.column(k) for k in kept]
        return pa.table([*columns, *(pa.array(np.concatenate(v)) for v in (lengths, means, errors))], names=names)

    schema = StructType([*fields, StructField(n_symbols, LongType()), StructField(log_perplexity, DoubleType()), StructField(standard_error, DoubleType())])
    scored = keep(dealt.groupBy(block).cogroup(answers.groupBy("block")).applyInArrow(scores, schema), "scored")
    for table in (dealt, answers):
        remove(table)
    return scored


def thresholds(scores: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, float | None]:
    """(lang, threshold) of languages with enough of the trusted ``scores``, and the one for all others.

    Quantiles are read off counts in bins of a thousandth, so no language is gathered in one place.
    """
    bins = scores.groupBy("lang", F.ceil(F.col("log_perplexity") * 1000).alias("bin"))
    counted = keep(bins.agg(F.count(F.lit(1)).alias("n")), "bins")

    def limits(counts: DataFrame, *by: str) -> DataFrame:
        upto = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.select(*by, "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy(*by)).alias("total"))
        high = F.min(F.when(F.col("upto") >= F.col("total") * settings.high, F.col("bin")))
        return ranked.groupBy(*by).agg((high / 1000).alias("threshold"), F.max("total").alias("total"))

    own = keep(limits(counted, "lang").where(F.col("total") >= settings.least_trusted).select("lang", "threshold"), "thresholds")
    every = limits(counted.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("_all", F.lit(1)), "_all").first()
    return own, None if every is None else every["threshold"]


def _trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id) that the labels call good."""
    ids = checked_broadcast(keep(trusted_ids(labels), "trusted").withColumnRenamed("doc_id", "_trusted_id"))
    return docs.join(ids, docs["doc_id"].cast("long") == F.col("_trusted_id"), "left_semi")


def decide(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), with_text: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with five columns more; their names in ``docs``'s terms.

    The model is trained on the trusted part. All rows are scored once, and the thresholds are read off the
    scores of the trusted ones.
    """
    names = {n: unused(docs, n) for n in ("log_perplexity", "n_symbols", "standard_error", "threshold", "kept")}
    model = train(_trusted(docs, labels).select(F.col("text").cast("string").alias("text")), CHARACTERS)
    scored = score(docs, model, names["log_perplexity"], names["n_symbols"], "text", names["standard_error"], with_text)
    model.remove()
    good = _trusted(scored, labels).select(F.col("lang").cast("string").alias("lang"), F.col(names["log_perplexity"]).alias("log_perplexity"))
    return with_decision(scored, names, *thresholds(good, settings), settings), names


def with_decision(scored: DataFrame, names: dict[str, str], own: DataFrame, overall: float | None, settings: Settings = Settings()) -> DataFrame:
    """Scored rows with their language's threshold, the overall one elsewhere, and whether they stay."""
    of_lang = unused(scored, "_lang")
    own = own.select(F.col("lang").alias(of_lang), F.col("threshold").alias(names["threshold"]))
    rows = scored.join(checked_broadcast(own), F.col("lang").cast("string").eqNullSafe(F.col(of_lang)), "left").drop(of_lang)
    rows = rows.withColumn(names["threshold"], F.coalesce(names["threshold"], F.lit(overall).cast("double")))
    allowed = F.col(names["threshold"]) + settings.deviations * F.col(names["standard_error"])
    kept = F.col(names["threshold"]).isNull() | (F.col(names["log_perplexity"]) <= allowed)
    return rows.withColumn(names["kept"], kept)


def assess(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, lang, n_symbols, log_perplexity, threshold, kept) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    decided, _ = decide(rows, labels, settings, with_text=False)
    return decided.select("doc_id", "lang", "n_symbols", "log_perplexity", "threshold", "kept")


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    decided, names = decide(docs, labels, settings)
    return decided.where(names["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
