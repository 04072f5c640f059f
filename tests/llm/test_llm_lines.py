from __future__ import annotations

import random
import re

import pytest

from quitanda.llm import line_dedup


def word_set(line):
    return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)


def brute(rows, threshold=80):
    """{(doc_id, text): (n_lines, removed line numbers)} by comparing every line with all earlier ones."""
    docs = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None))
    earlier, out = [], {}
    for d, t in docs:
        n, gone = 0, []
        for no, line in enumerate((t or "").split("\n") if t is not None else []):
            s = word_set(line)
            if not s:
                continue
            n += 1
            if any(len(s & e) and 100 * len(s & e) >= threshold * len(s | e) for e in earlier):
                gone.append(no)
            earlier.append(s)
        out[d, t] = (n, gone)
    return out


def found(df, **options):
    texts = {}
    from quitanda.llm.common import text_key
    keyed = df.select("doc_id", "text", text_key(df["text"]).alias("k")).collect()
    for r in keyed:
        texts[r.doc_id, r.k] = r.text
    rows = line_dedup.dedup_lines(df, **options).collect()
    assert len(rows) == len(keyed)
    return {(r.doc_id, texts[r.doc_id, r.text_key]): (r.n_lines, r.removed) for r in rows}


def test_documents_match_brute_force(documents):
    some = documents.where("doc_id < 90")
    assert found(some) == brute([(r.doc_id, r.text) for r in some.collect()])


@pytest.mark.parametrize("seed,threshold", [(1, 80), (2, 80), (3, 60)])
def test_near_copies_match_brute_force(spark, seed, threshold):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 25))] for _ in range(12)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.randint(0, 4)):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line).capitalize())
        rows.append((d, "\n".join(lines)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold) == brute(rows, threshold)


def test_template_lines_do_not_meet(spark):
    """Lines of eight common and two own words are not similar: the join works through few pairs, not all."""
    from pyspark.sql import functions as F
    common = " ".join(f"common{i}" for i in range(8))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit(common), F.format_string(
        " own%d other%d", "id", "id")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    shaped, _ = line_dedup.shaped_lines(docs, 80)
    classes = shaped.withColumn("ref", F.struct("doc_id")).withColumn("open", F.lit(True))
    met = [p.join(i, "word").count() for p, i in line_dedup._meetings(classes, 80)]
    assert met[0] < 8 * 2000 and met[1:] == [0, 0]
    # removed lines never meet each other, whatever they share
    gone = classes.withColumn("open", F.lit(False))
    assert sum(p.join(i, "word").count() for p, i in line_dedup._meetings(gone, 80)) == 0
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id < 150").collect()]
    assert found(docs.where("doc_id < 150").select("doc_id", "text")) == brute(rows)


@pytest.mark.parametrize("threshold", [50, 80, 95])
def test_sets_of_different_sizes_match_brute_force(spark, threshold):
    rng = random.Random(threshold)
    base = [f"b{i}" for i in range(24)]
    rows = []
    for d in range(160):
        line = rng.sample(base, rng.randint(8, 24)) + [f"x{rng.randrange(6)}" for _ in range(rng.randint(0, 3))]
        rows.append((d, " ".join(line)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold) == brute(rows, threshold)


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id != 2]
    expected = brute(rows)
    some = awkward.where("doc_id is null or doc_id <> 2")
    assert found(some) == expected
    assert found(clashing.where("doc_id is null or doc_id <> 2")) == expected
    assert line_dedup.dedup_lines(empty_docs).collect() == []
    texts = line_dedup.without_lines(clashing, line_dedup.dedup_lines(clashing))
    assert texts.columns == clashing.columns
    got = {(r.doc_id, r.text) for r in texts.collect()}
    assert (8, "Ein kurzer Satz über Äpfel\n") in got and (3, None) in got and (4, "") in got
    assert sum("fox" in (t or "") for _, t in got) == 1


@pytest.mark.parametrize("size,vocabulary", [(36, 120), (120, 500)])
def test_lines_that_only_share_rare_words_are_dropped_where_they_meet(spark, size, vocabulary):
    """Their bitmaps tell that too many words differ, so no pair of them is shuffled or looked up."""
    from pyspark.sql import functions as F
    rng = random.Random(size)
    rows = [(d, " ".join([f"rare{d % 6}", f"seldom{d % 6}"] + rng.sample([f"v{i}" for i in range(vocabulary)], size - 2)))
            for d in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shaped, _ = line_dedup.shaped_lines(docs.withColumn("text_key", F.xxhash64("text")), 80)
    classes = shaped.withColumn("ref", F.struct("doc_id")).withColumn("open", F.lit(True))
    pairs = sum(line_dedup._sharing(p, i, 80).count() for p, i in line_dedup._meetings(classes, 80))
    assert pairs < 120  # each meets the 19 others of its two rare words
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("threshold", [60, 80])
def test_lines_around_the_wide_size_match_brute_force(spark, threshold):
    rng = random.Random(threshold)
    base = [f"b{i}" for i in range(110)]
    rows = []
    for d in range(100):
        line = rng.sample(base, rng.randint(line_dedup.WIDE - 15, 110)) + [f"x{rng.randrange(6)}" for _ in range(3)]
        rows.append((d, rng.choice(["\t", "\x0b", "  "]).join(line)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold) == brute(rows, threshold)


def test_near_copies_with_own_words_make_few_pairs(spark, monkeypatch):
    """Each copy is similar to all others; its rarest word is its own and names no line."""
    rng = random.Random(8)
    base = [f"base{i}" for i in range(40)]
    rows = [(0, " ".join(base))]
    for d in range(1, 160):
        line = list(base)
        for i, at in enumerate(rng.sample(range(40), 1)):
            line[at] = f"own{d}x{i}"
        rows.append((d, " ".join(line)))
    counts = {}

    def counted(df, name, keep=line_dedup.stored):
        out = keep(df, name)
        counts[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "stored", counted)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert counts["lines-first"] + counts["lines-rest"] < 2 * len(rows)


def test_removed_and_later_lines_make_no_pair(spark):
    """A line left over meets the removed lines before it only: what comes later can't remove it."""
    from pyspark.sql import functions as F
    rows = [(d, " ".join([f"w{i}" for i in range(20)] + [f"own{d}"])) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    shaped, _ = line_dedup.shaped_lines(docs, 80)
    classes = shaped.withColumn("ref", F.struct("doc_id")).withColumn("open", F.col("doc_id") == 20)
    meetings = zip(line_dedup._meetings(classes, 80), line_dedup.LATER_OPEN)
    met = [line_dedup._sharing(p, i, 80, later).select("x", "c").distinct() for (p, i), later in meetings]
    pairs = met[0].unionByName(met[1]).unionByName(met[2]).select(F.least("x", "c"), F.greatest("x", "c")).distinct()
    assert pairs.count() == 20
