import random

import pytest

from plexlake.llm import neardup
from plexlake.llm.graph import connected_components

from .helpers import frame, groups, near_groups


def _words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def _check(spark, texts):
    docs = frame(spark, texts).withColumnRenamed("source", "hub").repartition(4)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    sizes, root = near_groups(dict(enumerate(texts)))
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_copies_edits_and_odd_texts(spark):
    rng = random.Random(1)
    texts = ["", None, "one two", "One two", "three", "a b c d e", "A B C D E", " \t\n ", "É b c d e", "é b c d e", "x y z"]
    for _ in range(12):
        base = _words(rng, rng.randrange(20, 120))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            edit = list(base)
            for _ in range(rng.randrange(4)):
                edit[rng.randrange(len(edit))] = "changed"
            texts.append("\n".join(edit))
    texts += [texts[12]] * 30
    rng.shuffle(texts)
    _check(spark, texts)


def test_a_family_that_only_its_original_joins(spark):
    """Copies of one text with three changed words each: alike to it, not to each other."""
    rng = random.Random(2)
    base = _words(rng, 170)
    texts = []
    for i in range(60):
        copy = list(base)
        for k in range(3):
            copy[(7 * i + 50 * k) % 170] = f"new{i}x{k}"
        texts.append(" ".join(copy))
    texts.insert(41, " ".join(base))
    _check(spark, texts)


def test_chains_and_shared_passages(spark):
    rng = random.Random(3)
    passage = _words(rng, 60)
    texts = [" ".join(_words(rng, 30) + passage + _words(rng, 30)) for _ in range(40)]
    chain = _words(rng, 100)
    for i in range(12):  # each is near the one before it only
        chain = chain[8:] + [f"c{i}x{k}" for k in range(8)]
        texts.append(" ".join(chain))
    _check(spark, texts)


def test_empty_table_null_ids_and_one_of_each_group(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (5, None), (5, None), (7, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert got == [
        (False, 2, 2, True), (False, 3, 2, False), (False, 3, 2, False), (False, 5, 5, True), (False, 5, 5, True), (False, 7, 7, True),
        (True, 0, None, True),
    ]
    kept = neardup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.where("text IS NOT NULL").collect()) == [(0, "a b c d e f"), (2, "a b c d e f"), (7, "q r s t u v")]
    assert kept.where("doc_id = 5").count() == 1
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(_words(rng, 60)) for _ in range(4))
    rows = [(3, a, "x"), (3, b, "x"), (2, a, "x"), (4, c, "x"), (4, d, "x"), (4, d, "x"), (9, c + " more", "x"), (5, None, "x"), (5, b, "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _node string").repartition(3)
    kept = neardup.distinct_documents(docs)
    assert kept.columns == docs.columns
    got = [r.text or "" for r in kept.collect()]
    assert all(got.count(t) == 1 for t in (a, b, d)) and got.count(c) + got.count(c + " more") == 1
    assert got.count("") == 2 and len(got) == 6  # a NULL and an empty text are linked with nothing


@pytest.mark.parametrize(("seed", "task_links"), [(0, 1_000_000), (1, 1_000_000), (2, 10)])
def test_components(spark, seed, task_links):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), task_links).collect()}
    want = groups({i for p in pairs for i in p}, pairs)
    assert got == {i: c for i, c in want.items() if any(i in p and p[0] != p[1] for p in pairs)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
