"""Benchmark passages in documents by a prefix-filtered join, on DataFrame functions alone.

A benchmark item is cut into windows of ``size`` words. A window can only occur in a document
that holds all of its words, so under a global order by rarity the first word of its set, the
prefix for full containment, must be there.

1. Rarity: the number of documents with each benchmark word, over all documents.
2. Every window is filed under its rarest word, its prefix word. The words of a document meet these
   in a broadcast join, with their places; beyond the bounds of a broadcast, documents with such a word are
   found first and only the words around its places are shuffled.
3. Each place of a prefix word fixes where a window would have to start.
   Position and length bounds drop places that would leave the document, and the window is
   compared word by word with the document there.
4. Words inside any occurrence are counted once.

Words are made with A-Z lowered, in the search for candidates as in the comparison.

Defined results: NULL and empty texts have no words; an item without words has no window, one of
fewer words than ``size`` is one window; items without an id are left out, items that share one
count once; repeated rows get the same answer each; empty tables give no hits. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexlake.llm.stage import keep, unused
from plexlake.plans.sizing import checked_broadcast

SIZE = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def word_list(lowered: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(window_id, words, items): distinct windows with the ids of their items, sorted as strings."""
    items = benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item"), word_list(ascii_lower(F.col("text").cast("string"))).alias("w")
    )
    items = keep(items.where(F.size("w") > 0), "items")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    cut = items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), F.lit(size)).alias("words"))
    # the text of a window names it: words hold no spaces
    found = cut.groupBy(F.array_join("words", " ").alias("window")).agg(F.collect_set("item").alias("items"))
    return keep(found.select("window", F.split("window", " ").alias("words"), "items"), "windows")


def _whole_text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _document_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))


def _documents(docs: DataFrame) -> DataFrame:
    """Key columns and text; rows with equal keys have equal answers."""
    text = _whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _document_key().alias("_doc"), F.xxhash64(text).alias("_text"), text.alias("text"))


def prefix_words(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(prefix, place, words, items): every window under its rarest word, with that word's place in it."""
    vocabulary = keep(found.select(F.explode("words").alias("word")).distinct().select("word", F.col("word").alias("_w")), "vocabulary")
    in_docs = docs.select(F.explode(F.array_distinct(word_list(ascii_lower(F.col("text"))))).alias("_w"))
    counted = in_docs.join(checked_broadcast(vocabulary.select("_w").distinct()), "_w").groupBy("_w").agg(F.count(F.lit(1)).alias("n"))
    rarity = keep(vocabulary.join(counted, "_w", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")), "rarity")
    placed = found.select("window", F.posexplode("words").alias("place", "word")).join(rarity, "word")
    rarest = placed.groupBy("window").agg(F.min(F.struct("n", "word", "place")).alias("r"))
    filed = rarest.join(found, "window").select(F.col("r.word").alias("prefix"), "r.place", "words", "items")
    return keep(filed, "prefixes")


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(_doc, _text, start, length, items) of every place where a window occurs in a document."""
    keyed = _documents(docs)
    filed = prefix_words(keyed, windows(benchmark, size))
    small = checked_broadcast(filed)
    split = keyed.select("_doc", "_text", word_list(ascii_lower(F.col("text"))).alias("w"))
    start, length = F.col("at") - F.col("place"), F.size("words")
    inside = (start >= 0) & (start + length <= F.col("n"))
    found = [F.col("_doc"), F.col("_text"), start.alias("start"), length.alias("length"), F.col("items")]
    if small is not filed:
        # one pass: the words of a text are looked up where they stand, and compared in place
        at = split.select("_doc", "_text", "w", F.size("w").alias("n"), F.posexplode("w").alias("at", "prefix"))
        same = F.slice("w", F.greatest(start, F.lit(0)) + 1, length) == F.col("words")
        return at.join(small, "prefix").where(inside & same).select(*found)
    # windows beyond the bounds of a broadcast are dealt by prefix word, and so are the few words around each of its places
    prefixes = filed.select("prefix").distinct()
    met = keyed.select("_doc", "_text", F.explode(F.array_distinct(word_list(ascii_lower(F.col("text"))))).alias("prefix")).join(prefixes, "prefix")
    candidates = keep(met.groupBy("_doc", "_text").agg(F.collect_set("prefix").alias("prefixes")), "candidates")
    texts = keep(split.join(candidates, ["_doc", "_text"]), "candidate-words")
    first = lambda i: F.greatest(i - (size - 1), F.lit(0))
    around = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains("prefixes", F.col("w")[i])),
        lambda i: F.struct(
            F.col("w")[i].alias("prefix"), i.alias("at"), first(i).alias("first"), F.slice("w", first(i) + 1, F.lit(2 * size - 1)).alias("near")
        ),
    )
    places = texts.select("_doc", "_text", F.size("w").alias("n"), F.explode(around).alias("p")).select("_doc", "_text", "n", "p.*")
    same = F.slice("near", F.greatest(start - F.col("first"), F.lit(0)) + 1, length) == F.col("words")
    return places.join(filed, "prefix").where(inside & same).select(*found)


def _answers(docs: DataFrame, benchmark: DataFrame, size: int, one_in: int) -> DataFrame:
    found = keep(occurrences(docs, benchmark, size), "occurrences")
    key = ["_doc", "_text"]
    covered = found.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    hit = covered.groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    items = found.select(*key, F.explode("items").alias("item")).distinct()
    items = items.groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    answers = keep(hit.join(items, key), "hits")
    words = _documents(docs).select("doc_id", *key, F.size(word_list(ascii_lower(F.col("text")))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    rows = words.join(answers, key, "left").select(
        "doc_id", *key, "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids")
    )
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, one_in: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) of every row of ``docs``.

    Contaminated: at least one word in ``one_in`` lies in a window that occurs.
    """
    return _answers(docs, benchmark, size, one_in).drop("_doc", "_text")


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, one_in: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = keep(_answers(docs, benchmark, size, one_in).where("contaminated").select("_doc", "_text").distinct(), "contaminated")
    d, t = unused(docs, "_d"), unused(docs, "_t")
    keyed = docs.withColumns({d: _document_key(), t: F.xxhash64(_whole_text())})
    matched = (keyed[d] == bad["_doc"]) & (keyed[t] == bad["_text"])
    return keyed.join(checked_broadcast(bad), matched, "left_anti").drop(d, t)
