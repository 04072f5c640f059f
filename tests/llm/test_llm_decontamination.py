from __future__ import annotations

import random
import re
from itertools import combinations

from quitanda.llm import decontam

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def brute(docs, items):
    """(doc_id, item_id) with an aligned window of 13 words (a shorter item: all) that agrees in 80 percent."""
    out = set()
    for d, t in docs:
        a = words(t)
        for i, s in items:
            b = words(s)
            n = min(len(b), decontam.WINDOW)
            if len(b) < decontam.INSIDE:
                if b and a == b:
                    out.add((d, i))
                continue
            for shift in range(-len(b), len(a)):
                same = [0 <= k + shift < len(a) and a[k + shift] == b[k] for k in range(len(b))]
                if any(100 * sum(same[k:k + n]) >= 80 * n for k in range(len(b) - n + 1)):
                    out.add((d, i))
                    break
    return out


def found(docs, items, **options):
    return {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, items, **options).collect()}


def test_masks_hit_every_window_within_tolerance():
    """Every choice of substituted words that an item of any size may have leaves a mask whole."""
    import numpy as np
    for n in range(1, decontam.WINDOW + 1):
        masks = [m for m, use in zip(decontam.ALL_MASKS, decontam.needed_masks(np.array([n]))[0]) if use]
        for bad in combinations(range(n), n - -(-decontam.AGREE * n // 100)):
            assert any(all(o + i not in bad for i in mask) for mask in masks for o in range(n - max(mask))), (n, bad)
    assert all(set(m) != set(range(len(m))) for m in decontam.MASKS + decontam.SHORT_MASKS)


def test_every_substitution_in_short_items(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 14)]
    docs = []
    for n, text in items:
        for bad in combinations(range(n), n // 5):
            own = [f"no{k}" if k in bad else w for k, w in enumerate(text.split())]
            docs.append((len(docs), "before it " + " ".join(own) + " after"))
            docs.append((len(docs), " ".join(own)))
        docs.append((len(docs), "x " + " ".join(["no"] * (n // 5 + 1) + text.split()[n // 5 + 1:]) + " y"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(spark.createDataFrame(docs, "doc_id long, text string"), bench) == brute(docs, items)


def test_planted_passages_match_brute_force(spark, documents):
    rng = random.Random(11)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    clean = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if r.doc_id % 4 == 0]
    docs = list(clean)
    for n in range(120):
        part = words(rng.choice(items)[1])
        a = rng.randrange(max(1, len(part) - 13))
        part = part[a:a + rng.randint(9, 30)]
        for _ in range(rng.randint(0, 5)):
            part[rng.randrange(len(part))] = f"sub{rng.randrange(100)}"
        docs.append((10_000 + n, "Before it Stands this " * rng.randint(0, 2) + " ".join(part).upper() + "\n then more"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    upper = [(d, t) for d, t in docs]
    assert found(spark.createDataFrame(upper, "doc_id long, text string"), bench) == {
        (d, i) for d, i in brute([(d, (t or "")) for d, t in upper], items)}


def test_short_items_and_edges(spark):
    items = [(1, "one two three four"), (2, "alpha beta gamma delta epsilon"), (3, None), (4, ""),
             (5, "p q r s t u v w x y z a b c"), (None, "null id item has five words")]
    docs = [(1, "one two three four"), (2, "so alpha beta gamma delta epsilon it is"), (3, "alpha beta gamma delta"),
            (4, "p q r s t u v w x y z a b"), (5, None), (6, ""), (None, "p q r s t u v w x y z a b c"),
            (7, "x null id item has five words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, bench) == {(1, 1), (2, 2), (3, 2), (4, 5), (None, 5), (7, None)}
    kept = decontam.remove_contaminated(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6]
    # a tiny filter passes everything on, and the result is the same
    assert found(df, bench, bloom_bits=5) == found(df, bench)


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    bench = spark.createDataFrame([(1, "the lazy dog near the old river bank today is more than thirteen words long")],
                                  "item_id long, text string")
    # 10 of 13 words agree: too few
    assert found(awkward, bench) == set()
    bench = spark.createDataFrame([(1, "jumps over the lazy dog near the old river bank today"), (1, "word " * 40)],
                                  "item_id long, text string")
    rows = decontam.overlaps(awkward, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 1), (None, 1), (6, 1)}
    assert {r.doc_id: (r.doc_start, r.doc_end) for r in rows}[1] == (4, 15)
    left = decontam.remove_contaminated(clashing, bench)
    assert left.columns == clashing.columns
    # the row that shares doc 2's id but not its text stays
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, [2, 3, 4, 5, None, 7, 8, -9]))
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(awkward, none) == set() and decontam.remove_contaminated(awkward, none).count() == awkward.count()
    assert found(empty_docs, bench) == set()
