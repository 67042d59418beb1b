"""Registered queries against their SQL twins or plain versions, and the pipeline."""

from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from compare import TABLES_DIR, connect, differences
from isobar.llm import bpe, queries
from isobar.llm.common import table
from test_search_and_join import brute_join


@pytest.mark.parametrize("name", queries.ORACLE)
def test_matches_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, TABLES_DIR), connect(), queries.ORACLE[name]) == []


def test_join_of_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, TABLES_DIR, "documents").collect()]
    assert {tuple(r) for r in queries.op5_ngram_join(spark, TABLES_DIR).collect()} == brute_join(rows)


def test_stages_take_effect(spark, documents, odd):
    docs = table(spark, TABLES_DIR, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TABLES_DIR)
        assert out.columns == columns, name
        before, after = docs.collect(), out.collect()
        if name == "near duplicates":
            kept = {c for _, c, _, _ in brute_join([(r.doc_id, r.text) for r in before])}
            assert {r.doc_id for r in after} == kept and len(after) == len(kept)
        elif name == "mix":
            assert max(Counter(r.doc_id for r in after).values()) <= 2
            assert abs(sum(len(r.text.split()) for r in after) / sum(len(r.text.split()) for r in before) - 1.5) < 0.2
        else:
            assert set(after) < set(before) and len(after) > 0.8 * len(before) or set(after) == set(before)
        docs = spark.createDataFrame(after, docs.schema)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES_DIR).collect()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(tokens) == docs.count() and all(r.round_trip for r in tokens)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id]) for r in tokens)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, odd, stage):
    assert stage(spark, odd, TABLES_DIR).count() <= 20
    assert stage(spark, odd.limit(0), TABLES_DIR).count() == 0
