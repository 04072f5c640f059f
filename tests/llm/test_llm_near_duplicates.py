from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from quitanda.llm import kernel as K
from quitanda.llm import neardup
from quitanda.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, threshold):
    """Sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
            parent[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        group = [x for x in ids[top(i)] if x is not None]
        out.append((d, len(sets[i]), min(group) if group else None))
    return sorted(out, key=str)


def found(df, **options):
    rows = neardup.near_duplicates(df, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=str)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("k,threshold", [(3, 85), (5, 80)])
def test_documents_match_brute_force(documents, k, threshold):
    assert found(documents, shingle=k, threshold=threshold) == brute(pairs_of(documents), k, threshold)


def test_chains_and_stars_of_near_copies_match_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(120)]
    now = list(base)
    for i in range(60):  # a chain: each link is similar to the last, the ends aren't
        now = list(now)
        now[rng.randrange(len(now))] = rng.choice(vocabulary)
        rows.append((1000 + i, " ".join(now)))
    for i in range(60):  # copies with a few changes each: some pairs are linked, some aren't
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((2000 + i, " ".join(text)))
    for i in range(40):  # short texts, where one word decides
        rows.append((3000 + i, " ".join(rng.choice(vocabulary[:3]) for _ in range(rng.randint(1, 9)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, shingle=3, threshold=85) == brute(rows, 3, 85)


def test_template_documents_do_not_meet(spark):
    """Documents of one template with similarity 0.83 share what is not indexed: few pairs, not all of them."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(9)
    template, n = rng.integers(0, 1 << 62, 200), 600
    rows = [(i, i, np.concatenate((template, rng.integers(0, 1 << 62, 20))).tolist()) for i in range(n)]
    sets = spark.createDataFrame(rows, "node long, comp long, items array<long>")
    rarity = spark.sparkContext.broadcast(neardup._rarity(sets))
    rare = sets.mapInArrow(neardup._prefixes(rarity, 85),
                           "node long, comp long, n long, pos long, word long, indexed boolean")
    main = rare.select("word").distinct().withColumn("main", F.lit(0).cast("long"))
    probe, index = neardup._meetings(rare, main)
    own = rare.where("indexed").count()
    assert probe.join(index, ["word", "side"]).count() < 3 * own  # all pairs on the template would be 18 n n
    # no two of a word's largest component meet
    probe, index = neardup._meetings(rare.withColumn("comp", F.lit(0).cast("long")), main)
    assert probe.join(index, ["word", "side"]).count() == 0
    assert neardup._across(sets.select("node", "items"), sets.select("node", "comp"), 85).count() == 0


@pytest.mark.parametrize("threshold", [60, 80, 85, 95])
def test_exact_join_finds_every_similar_pair(spark, threshold):
    rng = random.Random(threshold)
    base = list(range(1000, 1060))
    sets = [set(rng.sample(base, rng.randint(30, 60))) | {rng.randrange(10**6) for _ in range(rng.randint(0, 6))}
            for _ in range(120)]
    rows = [(i, sorted(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "node long, items array<long>")
    none = spark.createDataFrame([], "node long, comp long")
    got = {(r.u, r.v) for r in neardup._across(df, none, threshold).collect()}
    similar = {(j, i) for i, j in combinations(range(len(sets)), 2)
               if 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])}
    assert similar and similar <= got


def test_awkward_rows(awkward, clashing, empty_docs):
    expected = brute(pairs_of(awkward), 3, 85)
    assert found(awkward, shingle=3, threshold=85) == expected
    assert found(clashing, shingle=3, threshold=85) == expected
    assert found(empty_docs) == []


def test_keep_first_keeps_one_row_of_each_group(awkward, empty_docs, documents):
    kept = neardup.keep_first(awkward)
    assert kept.columns == awkward.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    # the fox texts are one group: its smallest id stays once; rows without words all stay
    assert sum("fox" in (t or "") for _, t in got) == 1
    assert (1, "The quick brown fox jumps over the lazy dog near the old river bank today") in got
    assert {(3, None), (4, ""), (None, None)} <= set(got)
    assert neardup.keep_first(empty_docs).count() == 0
    sizes = brute(pairs_of(documents), 5, 80)
    assert sorted(r.doc_id for r in neardup.keep_first(documents).collect()) == sorted({c for _, _, c in sizes})


def test_keep_first_shuffles_whole_rows_once(spark, documents):
    kept = neardup.keep_first(documents)
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
    whole = [cols for cols in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan) if re.search(r"\b(row|first)#", cols)]
    assert len(whole) == 1
    assert len(re.findall(r"\) MapInArrow\n", plan)) == 1  # sets of the rows are made once for both kinds of row


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.concatenate((a[:360], np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64))))
    sig = neardup.one_permutation(np.concatenate((a, b)), np.array([0, 400, 800]), 4096)
    true = 360 / 440
    assert abs((sig[0] == sig[1]).mean() - true) < 0.06
    one = neardup.one_permutation(a[:1], np.array([0, 1]), 512)  # a single shingle fills every bin
    assert (one != neardup._EMPTY).all()


def test_word_hashes_follow_words():
    import pyarrow as pa
    texts = ["A b\tc", None, "", "a B c", "  a\x0b\x0cb ", "é é", "x" * 3_000_000 + " a"]
    h, first = K.hash_words(pa.array(texts), lower=True)
    got = [h[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got[0] == got[3] and got[1] == [] and got[2] == [] and got[4] == got[0][:2]
    assert got[5][0] == got[5][1] and got[6][1] == got[0][0]
    sliced = pa.array(texts).slice(3, 2)
    assert K.hash_words(sliced, lower=True)[0].tolist() == got[3] + got[4]


def test_components_of_chain_star_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
