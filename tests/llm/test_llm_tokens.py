from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quitanda.llm import tokenbin
from quitanda.llm.catalog import tokenizer_path


@given(st.integers(1, 32), st.lists(st.integers(0, 2 ** 32 - 1), max_size=300), st.data())
@settings(max_examples=60, deadline=None)
def test_bits_round_trip(bits, values, data):
    ids = np.array([v % (1 << bits) for v in values], np.uint32)
    packed = tokenbin.pack(ids, bits)
    assert len(packed) == (len(ids) * bits + 7) // 8
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert tokenbin.unpack(packed, bits, a, b).tolist() == ids[a:b].tolist()


def test_least_bits():
    assert [tokenbin.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


@given(st.lists(st.text(st.sampled_from("aé<|endoftx|> \n\t.,'sl1Ω \x1c\x85ªŒ"), max_size=60), max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_library(texts):
    encoder = test_encoder_equals_library.__dict__.setdefault("encoder", tokenbin.Encoder(tokenizer_path(), known=50))
    texts = texts + ["x<|endoftext|> y", "don't  we'll"]
    expected = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == expected


def expected_rows(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [500, 1 << 16])
def test_documents_read_back(documents, block_ids):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = tokenbin.tokenized(documents.repartition(5), tokenizer_path(), block_ids=block_ids).collect()
    assert sorted(map(tuple, got)) == expected_rows(rows)


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    got = sorted(map(tuple, tokenbin.tokenized(awkward, tokenizer_path()).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r.doc_id for r in awkward.collect()), key=lambda d: (d is not None, d or 0))
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]
    one = {d: c for d, _, _, c in expected_rows([(r.doc_id, r.text) for r in awkward.collect() if r.doc_id in (3, 6, 8)])}
    assert all(c == one[d] for d, _, _, c in got if d in one)
    again = sorted(map(tuple, tokenbin.tokenized(clashing, tokenizer_path()).collect()), key=lambda r: r[1])
    assert again == got
    assert tokenbin.tokenized(empty_docs, tokenizer_path()).collect() == []


def test_random_access(spark, documents):
    from quitanda.session import scratch_path
    out = scratch_path(spark, "test-tokens")
    tokenbin.write_tokens(documents, out, tokenizer_path())
    row = spark.read.parquet(out).orderBy("shard", "block").first()
    texts = {r.doc_id: r.text for r in documents.collect()}
    i = len(row.doc_ids) // 2
    encoder = tokenbin.Encoder(tokenizer_path())
    ids = tokenbin.unpack(bytes(row.payload), row.bits, row.offsets[i], row.offsets[i + 1])
    assert ids.tolist() == encoder._whole([texts[row.doc_ids[i]]])[0].tolist() + [0]


def test_repeated_row_spreads_over_shards(spark):
    from quitanda.session import scratch_path
    rows = spark.range(0, 4000, 1, 8).selectExpr("if(id % 2 = 0, 6, id) as doc_id", "if(id % 2 = 0, 'same text', 'own') as text")
    out, merge = scratch_path(spark, "test-tokens"), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    try:
        spark.conf.set(merge, "false")  # the table is small
        tokenbin.write_tokens(rows, out, tokenizer_path(), block_ids=500)
    finally:
        spark.conf.set(merge, before)
    blocks = spark.read.parquet(out)
    assert len({b.shard for b in blocks.collect() if 6 in b.doc_ids}) > 1
    got = sorted(map(tuple, tokenbin.read_documents(blocks).collect()), key=lambda r: r[1])
    pairs = sorted((r.doc_id, r.text) for r in rows.collect())
    assert sorted(got) == sorted(expected_rows(pairs))
    limit = tokenbin.BROADCAST_SHARDS
    try:
        tokenbin.BROADCAST_SHARDS = 0  # the plain join gives the same
        assert sorted(map(tuple, tokenbin.read_documents(blocks).collect())) == sorted(got)
    finally:
        tokenbin.BROADCAST_SHARDS = limit
