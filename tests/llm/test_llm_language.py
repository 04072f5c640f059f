from __future__ import annotations

import zlib

from quitanda.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.rejected for r in rows)  # clean documents stay


def test_gibberish_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    import random
    rng = random.Random(1)
    noise = "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(400))
    more = spark.createDataFrame([(10 ** 9 + 2, noise, None), (10 ** 9 + 3, "12 34 %%", None), (10 ** 9 + 4, None, None)],
                                 docs.schema)
    rows = {r.doc_id: r for r in langid.identify(docs.unionByName(more)).where("doc_id > 1000000").collect()}
    assert all(r.rejected for r in rows.values())
    assert rows[10 ** 9 + 3].lang_pred == rows[10 ** 9 + 4].lang_pred == "und"
    assert rows[10 ** 9 + 2].lang_pred in ("de", "en", "es", "fr")


def test_model_is_interpolated_kneser_ney(spark):
    """The stored model gives the probabilities of a plain dictionary implementation."""
    from collections import Counter, defaultdict
    import numpy as np
    texts = ["abab abc", "abba", "cab ab"]
    docs = spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string")
    order = 3
    model = langid.train(docs, order=order, bits=24)
    # counts of the highest order, continuation counts below
    top = Counter()
    for t in texts:
        code = "".join(map(chr, langid.letters(t)))
        padded = code[0] * (order - 1) + code
        top.update(padded[i:i + order] for i in range(1, len(code)))
    levels = {order: top}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def p(gram):
        n = len(gram)
        lower = 1 / langid.CHARACTERS if n == 1 else p(gram[1:])
        total = sum(c for g, c in levels[n].items() if g[:-1] == gram[:-1])
        kinds = sum(g[:-1] == gram[:-1] for g in levels[n])
        if not total:
            return lower
        return (max(levels[n][gram] - langid.DISCOUNT, 0) + langid.DISCOUNT * kinds * lower) / total

    for text in ("abab", "bca", "zz"):
        code = langid.letters(text)
        first = np.array([0, len(code)])
        at, begin = langid._predicted(first)
        got = model.log_probabilities(langid.gram_chain(code, begin, at, order, 24))[:, 0]
        for _ in range(2):  # from the sorted arrays, then from the worker's table
            assert np.allclose(model.of_characters(code, first)[:, 0], got, atol=1e-5)
        padded = chr(code[0]) * (order - 1) + "".join(map(chr, code))
        expected = [np.log(p(padded[i:i + order])) for i in range(1, len(code))]
        assert np.allclose(got, expected, atol=1e-6)


def test_awkward_rows(awkward, clashing, empty_docs):
    rows = langid.identify(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.scored_chars == 0)
    assert len(langid.identify(clashing).collect()) == len(rows)
    assert langid.identify(empty_docs).collect() == []
    kept = langid.keep_identified(clashing)
    assert kept.columns == clashing.columns
    assert {r.text for r in kept.collect()}.isdisjoint({None, "", " \t\n\x0b\x0c\r "})
    assert langid.keep_identified(empty_docs).count() == 0
    unlabelled = awkward.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_long_text_is_scored_whole(spark):
    rows = [(1, "alpha beta gamma " * 60000, "xx"), (3, "omega psi chi " * 50, "yy"), (4, "alpha beta", "xx")]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1].scored_chars >= 60000 * 17 - 10 and got[1].lang_pred == "xx" and got[3].lang_pred == "yy"


def test_more_grams_than_slots(spark):
    """Far more than 2**20 different grams keep exact counts and their own contexts."""
    from collections import Counter
    import numpy as np
    order, size = 4, 1 << 21
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(0x4e00, 0x9000, size // 64))) for _ in range(64)]
    docs = spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string").repartition(4)
    model = langid.train(docs, order=order)
    levels = {order: Counter()}
    for t in texts:
        padded = " " * order + t + " "
        levels[order].update(padded[i:i + order] for i in range(1, len(padded) - order + 1))
    assert len(levels[order]) > 1.9 * 2 ** 20
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    totals, kinds = {}, {}
    for n in levels:
        totals[n], kinds[n] = Counter(), Counter(g[:-1] for g in levels[n])
        for g, c in levels[n].items():
            totals[n][g[:-1]] += c

    def p(gram):
        n, context = len(gram), gram[:-1]
        lower = 1 / langid.CHARACTERS if n == 1 else p(gram[1:])
        if not totals[n][context]:
            return lower
        return (max(levels[n][gram] - langid.DISCOUNT, 0) + langid.DISCOUNT * kinds[n][context] * lower) / totals[n][context]

    code = langid.letters(texts[0][:100] + "zz")
    got = model.of_characters(code, np.array([0, len(code)]))[:, 0]
    padded = " " * order + "".join(map(chr, code[1:]))
    expected = [np.log(p(padded[i:i + order])) for i in range(1, len(code))]
    assert len(got) == len(expected) and np.allclose(got, expected, atol=1e-5)


def test_columns_named_like_the_results_keep_their_values(spark, awkward):
    from pyspark.sql import functions as F
    docs = awkward.withColumns({c: F.lit("mine") for c in (*langid.ADDED, "row", "langid_group", "grp", "gram")})
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() > 0
    assert {tuple(r) for r in kept.select(*langid.ADDED, "row", "langid_group", "grp", "gram").collect()} == {("mine",) * 8}


def test_equal_texts_spread_over_groups(spark):
    """50 000 equal rows: no task holds most of them."""
    from pyspark.sql import functions as F
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    docs = spark.range(50_000, numPartitions=4).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit("one text that all rows share").alias("text"), F.lit("en").alias("lang"))
    model = langid.train(docs.limit(50).select("text", "lang"))
    scored = langid.score(docs, model)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few bytes make one task
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    per = scored.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.max("score"), F.min("cross_entropy"))
    try:
        rows = per.collect()
    finally:
        spark.conf.set(setting, before)
    assert sum(r.n for r in rows) == 50_000 and max(r.n for r in rows) < 0.5 * 50_000
