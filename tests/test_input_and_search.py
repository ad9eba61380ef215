"""Order of rows over several files, and containment search with anchors that all texts share."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plexlake.operators import annotate, search
from plexlake.sources import columns, tables


def _write(folder, sizes):
    n = 0
    folder.mkdir()
    for name, size in sizes.items():
        rows = [f"{k % 7},{k},{'x' * (k % 50)}" for k in range(n, n + size)]
        (folder / f"{name}.csv").write_text("\n".join(["Key,Place,Filler", *rows]) + "\n")
        n += size
    return n


@pytest.mark.parametrize("split", [4_000_000, 2_000])
def test_rows_of_several_files_keep_their_order(spark, tmp_path, split):
    """Small files share a task and go by size there; large ones are cut into blocks. Numbers go by path and place."""
    n = _write(tmp_path / "in", {"a": 20, "b": 3_000, "c": 1, "d": 700})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = tables.in_input_order(columns.clean_columns(tables.read_csv(spark, str(tmp_path / "in"))), "_ord")
        got = df.select("_ord", F.col("place").cast("int")).orderBy("_ord").collect()
        assert [tuple(r) for r in got] == [(k, k) for k in range(n)]
        joined = annotate.concat_annotation(df, "key", ["place"], "_ord").where("key = '3'").first()
        assert joined["place"] == ";".join(str(k) for k in range(n) if k % 7 == 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "empty.csv").write_text("Key,Place\n")
    assert tables.in_input_order(tables.read_csv(spark, str(tmp_path / "empty.csv"))).count() == 0


def _plain_anchors(text, length):
    k, w = search._shape(length)
    codes = np.array([ord(c) for c in text], np.uint64)
    h = search._kmer_hashes(codes, k)
    return {int(h[i : i + w].min()) for i in range(len(text) - length + 1)}


def test_batch_anchors_stop_at_the_end_of_a_text():
    rng = random.Random(1)
    texts = ["", "short", *["".join(rng.choice("ABCD") for _ in range(rng.randint(1, 80))) for _ in range(50)], None, "é" * 40, "𝛼bc" * 9]
    codes, borders = search._code_points(pa.array(texts, pa.string()))
    for length in (3, 7, 20, 64):
        at, found = search._batch_anchors(codes, borders, [(0, length)])
        for i, text in enumerate(texts):
            assert set(found[at == i].tolist()) == _plain_anchors(text or "", length), (i, length)


def test_a_batch_of_many_texts_is_worked_on_in_slices():
    """Arrays of eight bytes a letter are made of a slice, not of the batch: 12 million letters."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=3_000)) for _ in range(4_000)]
    batch = pa.record_batch([pa.array(range(4_000)), pa.array(texts)], names=["_id", "_t"])
    tracemalloc.start()
    found = [len(x.column("_anchors").values) for x in search._with_anchors([batch], ["_id"], {6: 81, 7: 128})]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) > 4_000 * 50 and peak < 150e6


def test_slices_and_pieces_of_a_long_text_lose_no_anchor(monkeypatch):
    monkeypatch.setattr(search, "SLICE", 100)
    rng = random.Random(6)
    texts = ["", None, *["".join(rng.choice("ABCé") for _ in range(n)) for n in (5, 30, 99, 100, 101, 150, 1_000, 177, 40)], None, "𝛼bc" * 90]
    for classes in ({0: 3}, {0: 3, 4: 20}, {5: 32, 6: 64}, {6: 90}):
        batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["_id", "_t"])
        got = [r for x in search._with_anchors([batch], ["_id"], classes) for r in x.to_pylist()]
        assert [r["_id"] for r in got] == list(range(len(texts)))
        for r, text in zip(got, texts):
            want = {int(search._marked(np.int64(a), c)) for c, n in classes.items() for a in _plain_anchors(text or "", n)}
            assert sorted(r["_anchors"]) == sorted(want)


def _case(spark, n_texts, n_queries):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))
    common = word(12)
    texts = [(i, word(40) + common + word(30)) for i in range(n_texts)]
    queries = [common, "".join(common[:9])] + [t[k : k + 12] for (_, t), k in zip(texts, range(0, n_queries))]
    want = {(q, i) for q in set(queries) for i, t in texts if q in t}
    q = spark.createDataFrame([(x,) for x in queries], "peptide string")
    t = spark.createDataFrame(texts, "id long, sequence string").repartition(4)
    return q, t, want


@pytest.mark.parametrize("most", [50, 10_000])
def test_an_anchor_that_all_texts_share(spark, monkeypatch, most):
    monkeypatch.setattr(search, "HOT_ROWS", most)
    queries, texts, want = _case(spark, 600, 40)
    pairs = search.contains_pairs(queries, "peptide", texts, "sequence", "id", broadcast_limit=0)
    assert {tuple(r) for r in pairs.collect()} == want


def test_hot_anchors_are_dealt_evenly(spark):
    """One anchor in every text, and one that many queries share: no task has above twice the median."""
    texts = spark.range(20_000).select(F.col("id").alias("_id"), F.explode(F.array(F.lit(7), F.col("id") + 100)).alias("anchor"))
    queries = spark.range(3_000).select(F.col("id").cast("string").alias("_q"), F.when(F.col("id") < 2_000, F.lit(7)).otherwise(F.col("id")).alias("anchor"))
    left, right = search._salted(texts, queries, 250)
    keys = ["anchor", "by_text", "by_query"]
    # every pair of the hot anchor meets exactly once
    per = lambda side: side.where("anchor = 7").groupBy("by_text", "by_query").count().withColumnRenamed("count", side.columns[1])
    met = per(left.select("anchor", "_id", "by_text", "by_query")).join(per(right.select("anchor", "_q", "by_text", "by_query")), ["by_text", "by_query"])
    assert met.agg(F.sum(F.col("_id") * F.col("_q"))).first()[0] == 20_000 * 2_000
    for side in (left, right):
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 2 * 250
        sizes = side.repartition(8, *keys).groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert sizes.max() < 2 * sizes.median()
