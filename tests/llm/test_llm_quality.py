from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quitanda.llm import quality


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(text):
    w, text = words(text), text or ""
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_match_brute_force(documents):
    texts = [r.text for r in documents.select("text").collect()]
    texts += [None, "", " \n\n ", "a\na\n a\na", "a b c d e f g h " * 3, "x\n" * 5000, "é\né\r\né", "a b c d e f g a b c d e f g a", "#*$ %&|<>"]
    got = quality.statistics(pa.array(texts, pa.string()))
    rows = list(zip(*(got[k].tolist() for k in quality.STATS[:5])))
    assert rows == [brute(t) for t in texts]
    sliced = quality.statistics(pa.array(texts, pa.string()).slice(len(texts) - 4, 3))
    assert sliced["n_words"].tolist() == [len(words(t)) for t in texts[-4:-1]]


def test_verdicts_follow_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.assess(docs, labels).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(not r.kept for r in bad) >= 0.5 * len(bad)
    assert not any(r.kept for r in rows if r.base_failed)


def test_forest_isolates_what_is_unusual():
    rng = np.random.default_rng(0)
    usual = rng.normal(0, 1, (3000, 4))
    odd = np.full((5, 4), 9.0)
    forest = quality.Forest(usual)
    assert forest.score(odd).min() > np.quantile(forest.score(usual), 0.999)
    same = quality.Forest(np.zeros((10, 4)))
    assert np.isfinite(same.score(usual)).all()
    assert np.isfinite(quality.Forest(np.zeros((1, 4))).score(usual)).all()


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 0), (None, 1), (8, None)], "doc_id long, quality int")
    for df in (awkward, clashing):
        rows = quality.assess(df, labels).collect()
        assert len(rows) == awkward.count()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in awkward.collect())
        assert all(r.kept is not None for r in rows) and not any(r.kept for r in rows if r.base_failed)
    none = quality.assess(awkward, labels.where("false")).collect()
    assert [r.kept for r in none] == [not r.base_failed for r in none]
    assert quality.assess(empty_docs, labels).collect() == []
