import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plexlake.llm import packing, token_files, tokens, words
from plexlake.plans.session import scratch_path

from .helpers import VOCABULARY, frame, token_ids

ODD = [
    "It's they'll o'clock 'sure '' don't.stop", "ábc é é", "Ünïcode ΣΑΣ ς ſtraße İstanbul Kelvin", "1234 12a b34 x_y __", "<|endoftext|> a<|startoftext|>b",
    "tab\tnew\nline\r\n nbsp em", "", None, "word%%% the&&& WORD!! |", "\U0001f600\U0001f600 日本語 テスト", "x" * 5000, "a b " * 3000, "\x00\x01 \x7f", "ab-cd e.f,g;h",
]


def _encode(texts, tokenizer):
    out = []
    for _, _, data, offsets in words.text_slices(pa.array(texts, pa.string()), 2000):
        ids, counts = tokenizer.encode(data, offsets)
        out += np.split(ids, np.cumsum(counts)[:-1])
    return [o.tolist() for o in out]


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.WordTokenizer(VOCABULARY, cache_bits=12)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    assert _encode(ODD * 2, tokenizer) == [i[:-1] for i in token_ids(ODD * 2, 0)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=5))
def test_ids_of_any_text(tokenizer, texts):
    assert _encode(texts, tokenizer) == [i[:-1] for i in token_ids(texts, 0)]


def test_a_full_cache_changes_nothing(tokenizer):
    many = [f"word{i} wörd{i} Ab{i}, x{i * 7919}" for i in range(4000)]
    assert _encode(many, tokenizer) == [i[:-1] for i in token_ids(many, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    histogram = {int(k): int(rng.integers(1, 40)) for k in rng.integers(1, capacity + 1, 12)}
    plan = packing.best_fit_plan(histogram, capacity)
    filled = {}
    for length, n in histogram.items():
        mine = plan.length == length
        for rank in range(n):
            at = np.flatnonzero(mine)[np.searchsorted(plan.rank[mine], rank, side="right") - 1]
            within = rank - plan.rank[at]
            place = plan.place[at] + within % plan.each[at] * length
            filled.setdefault(int(plan.sequence[at] + within // plan.each[at]), []).append((int(place), length))
    for parts in filled.values():
        parts.sort()
        assert [p for p, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
        assert sum(n for _, n in parts) <= capacity
    assert len(filled) == plan.n_sequences
    total = sum(k * n for k, n in histogram.items())
    assert plan.n_sequences <= 1 + 11 / 9 * max(-(-total // capacity), sum(n for k, n in histogram.items() if 2 * k > capacity))


def test_packing_round_trip(spark):
    texts = [*ODD, *ODD[:4]]
    docs = frame(spark, texts).withColumnRenamed("source", "sequence_id").repartition(3)
    packed = packing.pack(docs, VOCABULARY, capacity=256)
    rows = packed.slots.toPandas().sort_values(["doc_id", "piece"])
    for doc, ids in enumerate(token_ids(texts, 0)):
        mine = rows[rows.doc_id == doc]
        assert mine.length.sum() == len(ids) and (mine.start == 256 * mine.piece).all()
        for start, n, crc in zip(mine.start, mine.length, mine.ids_crc32):
            assert zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()) == crc
    sequences = {r.sequence_id: r.ids for r in packed.sequences().collect()}
    assert len(sequences) == packed.n_sequences and max(map(len, sequences.values())) <= 256
    for r in rows.itertuples():
        part = sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert packing.pack(docs.limit(0), VOCABULARY).slots.count() == 0


def test_token_files_in_order_and_by_range(spark):
    texts = [*ODD, *ODD[:4]]
    docs = frame(spark, texts).withColumnRenamed("source", "shard").repartition(3)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, VOCABULARY)
    want, start = token_ids(texts, 1), 0
    got = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    sums = {r.doc_id: r.ids_crc32 for r in token_files.token_digests(token_files.read_tokens(spark, path)).collect()}
    for doc, ids in enumerate(want):
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids) == (start, len(ids), ids)
        assert sums[doc] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    part = token_files.read_tokens(spark, path, 5, 9).collect()
    assert sorted(r.doc_id for r in part) == [5, 6, 7, 8, 9] and all(r.start == got[r.doc_id].start for r in part)


def test_token_files_of_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c"), (1, None)], "doc_id long, text string")
    path = token_files.encode_corpus(docs, VOCABULARY)
    rows = sorted((r.start, r.n_tokens) for r in token_files.read_tokens(spark, path).collect())
    assert len(rows) == 4 and [s for s, _ in rows] == [0, *np.cumsum([n for _, n in rows])[:-1].tolist()]
    assert token_files.read_tokens(spark, token_files.encode_corpus(docs.limit(0), VOCABULARY)).count() == 0
