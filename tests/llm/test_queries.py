"""The registered corpus queries against their SQL, and the pipeline against plain versions of its stages."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from plexlake.llm import pii, quality, queries
from plexlake.llm.stage import keep
from tests.oracle_check import compare, connect

from .helpers import contamination, near_groups, token_ids
from .test_pii import plain_spans

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    good, note = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert good, note


@pytest.mark.parametrize("name", ["op3_secret_scans", "op4_toxicity", "op5_pii", "op7_license_scans", "op10_quality_classifier"])
def test_one_row_per_document(spark, name):
    ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()
    assert sorted(queries.QUERIES[name](spark, SF_DIR).select("doc_id").collect()) == sorted(ids)


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, None
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        decided = quality.assess(docs, labels).where("kept") if name == "quality_classifier" else None
        docs = keep(stage(spark, docs, SF_DIR), name)
        if name == "best_fit_packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality_classifier":
            assert set(after) == {r.doc_id for r in decided.collect()}
            assert {r.doc_id for r in labels.where("quality = 1").collect()} & set(before) <= set(after)
        if name == "minhash_near_dedup":
            _, root = near_groups({i: r.text for i, r in before.items()})
            assert set(after) == {i for i, r in root.items() if i == r}
        if name == "benchmark_decontamination":
            found = {i: contamination(r.text, items) for i, r in before.items()}
            assert set(after) == {i for i, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)}
        if name == "pii":
            assert set(after) == set(before)
            for i, r in after.items():
                assert (r.text == before[i].text) or plain_spans(before[i].text)
                assert not plain_spans(r.text) and r.n_chars == len(r.text)
    want = dict(zip(before, token_ids([r.text for r in before.values()], 0)))
    for r in docs.collect():
        part = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length
    assert docs.agg({"length": "sum"}).first()[0] == sum(map(len, want.values()))
    assert {s.name for s in pii.BASE} == {"email", "ip", "card", "phone"}
