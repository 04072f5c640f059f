from __future__ import annotations

import re
from collections import defaultdict

import pytest

from quitanda.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water level by repeated sharing of what is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(most * sizes[s] for s in stopped)
        target = {s: most * sizes[s] for s in stopped}
        target.update({s: left * weight[s] / sum(weight[x] for x in free) for s in free})
        over = {s for s in free if target[s] >= most * sizes[s]}
        if not over:
            return target
        stopped |= over


def by_source(rows):
    out = defaultdict(lambda: [0, 0, None, 0])
    for r in rows:
        own = out[r.source]
        own[0] += r.size
        own[1] += r.taken
        own[2] = r.target
        own[3] = max(own[3], r.size)
    return out


def test_targets_and_totals(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == docs.count()
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert all(r.size == sizes[r.doc_id] and r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    groups = by_source(rows)
    expected = plain_targets({s: g[0] for s, g in groups.items()})
    for source, (size, taken, target, longest) in groups.items():
        assert target == pytest.approx(expected[source])
        assert abs(taken - target) <= longest
    again = mixing.mix(docs.repartition(7), labels).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}


def test_selection_follows_keys(spark):
    """Inside a source the taken documents are those of the least keys, by a plain sort."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "s" if i % 3 else "t") for i in range(600)],
                                 "doc_id long, text string, source string")
    for cells in (1, 16, 4096):
        rows = mixing.mix(docs, cells=cells).collect()
        for source in "st":
            own = [r for r in rows if r.source == source]
            epochs = min(r.copies for r in own)
            extra = {r.doc_id for r in own if r.copies > epochs}
            keyed = {r.doc_id: r.key for r in mixing.sizes_of(docs, "doc_id", "text", "source").withColumn(
                "weight_of", mixing.F.lit(mixing.UNLABELLED)).withColumn("key", mixing.sampling_key()).collect()}
            order = sorted((r for r in own), key=lambda r: keyed[r.doc_id])
            rest, run, chosen = own[0].target - epochs * own[0].source_size, 0, set()
            for r in order:
                run += r.size
                if run - r.size / 2 <= rest:
                    chosen.add(r.doc_id)
            assert extra == chosen or not extra


def test_quality_weights_raise_the_odds(spark):
    docs = spark.createDataFrame([(i, "a b c d", "s") for i in range(4000)] + [(i, "a b c d", "t") for i in range(5000, 7000)],
                                 "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7000)], "doc_id long, quality int")
    rows = [r for r in mixing.mix(docs, labels, weights=(1.0, 9.0)).collect() if r.source == "s" and r.copies == 2]
    good = sum(r.doc_id % 2 for r in rows)
    assert good > 1.5 * (len(rows) - good)


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and all(r.taken is not None and r.taken <= 2 * r.size for r in rows)
    assert all(r.taken == 0 for r in rows if r.size == 0)
    sizes = {s: g[0] for s, g in by_source(rows).items()}
    expected = plain_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in rows} == expected
    assert mixing.mix(empty_docs).collect() == []
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = mixing.mixed_documents(clashing, labels)
    assert out.columns == clashing.columns
    got = mixing.mix(clashing, labels)
    assert out.count() == got.groupBy().sum("copies").first()[0]
    assert mixing.mixed_documents(empty_docs).count() == 0


def test_a_repeated_row_is_taken_as_often_as_fits(spark):
    """A row that is 40 percent of a source draws the least key: the source still meets its target within one document."""
    alone = [(i, "w " * 10, "t") for i in range(1200)] + [(i, "w " * 25, "s") for i in range(5000, 5800)]
    keyed = mixing.sizes_of(spark.createDataFrame(alone, "doc_id long, text string, source string"), "doc_id", "text", "source")
    keyed = keyed.withColumn("weight_of", mixing.F.lit(mixing.UNLABELLED)).withColumn("key", mixing.sampling_key())
    for place in ("key", "key desc"):  # the least key, then the greatest
        first = keyed.where("source = 't'").orderBy(mixing.F.expr(place.split()[0]).desc() if "desc" in place else "key").first().doc_id
        docs = spark.createDataFrame(alone + [(first, "w " * 10, "t")] * 800, "doc_id long, text string, source string")
        for cells in (1, 4096):
            got = mixing.mix(docs, weights=(3.0, 1.25), cells=cells)
            rows = got.collect()
            assert len(rows) == docs.count()
            for source in "st":
                own = [r for r in rows if r.source == source]
                assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
            out = mixing.mixed_documents(docs, weights=(3.0, 1.25), cells=cells)
            assert out.count() == sum(r.copies for r in rows)
            assert out.where(f"doc_id = {first}").count() == sum(r.copies for r in rows if r.doc_id == first)
