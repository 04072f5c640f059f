from __future__ import annotations

import zlib

import numpy as np

import corpus_pipeline
from quitanda.llm.common import stored


def test_stages_in_order(spark, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "tokens"]
    from quitanda.llm.catalog import tokenizer_path
    from tokenizers import Tokenizer
    docs, sf = documents, "/root/testdata/sf0.001"
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        assert docs.schema == documents.schema
        counts.append(docs.count())
    n = documents.count()
    assert counts[0] == n and counts[1] < n and counts[2] <= counts[1] and counts[3] > 0
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert set(rows) <= {(r.doc_id, r.text) for r in documents.collect()}
    t = Tokenizer.from_file(tokenizer_path())
    expected, start = [], 0
    for d, text in rows:
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == expected


def test_awkward_documents_pass_through(spark, clashing, empty_docs):
    for docs in (clashing, empty_docs):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, "/root/testdata/sf0.001"), f"awkward-{name}")
            if name != "tokens":
                assert now.columns == docs.columns
        assert now.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
