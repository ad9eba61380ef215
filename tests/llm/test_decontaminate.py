import random

import pytest

from plexlake.llm import decontaminate

from .helpers import contamination, frame


def _check(spark, texts, items):
    docs = frame(spark, texts).withColumnRenamed("source", "n_hit")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string").selectExpr("*", "1 AS words")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, benchmark).collect()}
    for i, text in enumerate(texts):
        n, hit, ids = contamination(text, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].item_ids) == (n, hit, len(ids), ids), text
        assert got[i].contaminated == (hit > 0 and 20 * hit >= n)
    kept = {r.doc_id for r in decontaminate.clean(docs, benchmark).collect()}
    assert kept == {i for i in got if not got[i].contaminated}


@pytest.mark.parametrize("small", [True, False])
def test_against_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(decontaminate, "checked_broadcast", lambda table: table)
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("Ab", "éx", "ÉX", "q9", "the") for b in ("", "a", "é", "1")]
    item = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    bodies = [item(n) for n in (1, 3, 12, 13, 14, 20, 30)]
    items = {i: rng.choice([" ", ", ", "-"]).join(b) for i, b in enumerate(bodies)} | {20: None, 21: "...", 22: "  ", 23: " ".join(bodies[4])}
    texts = [None, "", "!!", "x" * 3000]
    for _ in range(30):
        parts = [item(rng.randrange(30)) for _ in range(2)]
        body = rng.choice(bodies)
        at = rng.randrange(len(body))
        middle = rng.choice([body, body[at:], body[: at + 1], [w.swapcase() for w in body], body + body])
        texts.append(rng.choice([" ", "; ", "\n"]).join(parts[0] + middle + parts[1]))
    texts.append(" ".join(["the"] * 40_000 + bodies[5] + ["q9"] * 40_000))  # a long text of few words
    _check(spark, texts + texts[4:7], items)


def test_letters_that_only_full_lowering_equates(spark):
    items = {1: " ".join(f"É{i}" for i in range(13)), 2: "Kelvin İx"}
    _check(spark, [" ".join(f"é{i}" for i in range(13)), " ".join(f"É{i}" for i in range(13)), "kelvin ix", "KELVIN İX"], items)


def test_empty_tables_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "c"), (4, "a b"), (4, "zz")], "item_id long, text string")
    rows = decontaminate.contamination(docs, items).collect()
    assert sorted((r.n_hit, r.item_ids) for r in rows) == [(0, []), (2, ["4"]), (2, ["4"]), (2, ["4"])]
    assert [r.text for r in decontaminate.clean(docs, items).collect()] == ["c"]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_capital_sigma_at_a_separator(spark):
    words = "ΧΥΣ"
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    rows = decontaminate.contamination(frame(spark, ["ΧΥΣ.Α", "ΧΥΣ Α", "χυσ"]), items).orderBy("doc_id").collect()
    assert [r.n_hit for r in rows] == [1, 1, 0]
