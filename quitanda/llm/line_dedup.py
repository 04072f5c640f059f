"""Operator 1: line dedup by an exact set-similarity join, in DataFrame functions only.

Method: a line is the set of its words (lower case).  Words are ordered by
rarity, the rarest first.  Two lines with Jaccard ``threshold`` share a word of
their prefixes, so only prefix words make postings.  The length filter, the
positional filter (what lies before and after a shared word bounds the overlap)
and a bitmap of each set (bits of the parity of its words: two sets differ in at
least as many words as bits) drop pairs where they meet, the rest are verified on
the whole sets.  A line is removed if an earlier line, by
(doc_id, text, line number), is similar; the first one stays.

Equal sets are one class before the join.  Each line is first paired with one earlier line alone: of the
earliest lines of its ``FIRST_WORDS`` rarest words the one that most of them name (two at least); lines that
this removes need no other pair.  Only the lines left over are joined with every earlier line:
the larger set of two probes with its whole prefix, the smaller is indexed by its rarest ``n - 2 t n / (1 + t) + 1``
words, two removed lines never meet, nor a line left over and a later removed one.  So a group of near copies makes about as many pairs as it has lines, and
lines of one template that are less similar than ``t`` meet on none of the words they share.

Rarity counts all words of all lines, added up in ``2**RANK_BITS`` buckets, so
the order is a fixed-size array at any scale; any fixed order gives the same
result, rarity only makes postings short.

Defined cases: null text has no line; lines without a word are kept and never
match; rows that repeat doc_id and text are one document and get the same
result; null doc_ids come first; an empty table gives no rows; very long texts are
read whole; only ``id_col`` and ``text_col`` are read, so other columns can
have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import same, stored, text_key

THRESHOLD = 80
RANK_BITS = 16


#: Rarest words of a line that name its partner of the first round.  Words of its own name none, so a near copy
#: with one of them still meets the first line of its group.
FIRST_WORDS = 3

#: Sets of more words have 128 bits, else 64.
WIDE = 80


def split_words(text: Column) -> Column:
    """Lower-case words of a text and empty strings; splitting on one plain space needs no pattern."""
    spaced = F.when(text.rlike(r"[\x09-\x0D]"), F.translate(text, "\t\n\x0b\x0c\r", " " * 5)).otherwise(text)
    return F.split(F.lower(spaced), " ", -1)


def word_set(line: Column) -> Column:
    """Distinct word hashes of a line."""
    return F.array_distinct(F.transform(F.array_remove(split_words(line), ""), lambda w: F.xxhash64(w)))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line) of every line; ``docs``: doc_id, text_key, text."""
    return docs.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def rarity(docs: DataFrame) -> Column:
    """Array literal for each hash bucket: the rank (0 to 126) of how often its words occur.

    Plans print it, so its numbers are short.
    """
    size = 1 << RANK_BITS
    words = docs.select(F.explode(split_words(F.col("text"))).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(size - 1)).alias("b")).agg(F.count("*").alias("c"))
    ranks = counts.select(F.col("b").cast("int").alias("b"), F.least(F.lit(126), F.floor(F.log2("c") * 4).cast("int")).alias("r"))
    table = ["0"] * size
    for row in ranks.toLocalIterator():  # at most ``size`` rows
        table[row.b] = str(row.r)
    return F.split(F.lit(",".join(table)), ",").cast("array<long>")


def by_rarity(words: Column, ranks: Column) -> Column:
    """Words as longs that sort by rank, then by hash (its lower 56 bits)."""
    def placed(h: Column) -> Column:
        rank = F.get(ranks, h.bitwiseAND(F.lit((1 << RANK_BITS) - 1)).cast("int"))
        return F.shiftleft(rank, 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))
    return F.sort_array(F.transform(words, placed))


def _parity(words: str, which: str = "") -> str:
    """64 bits of a set, in SQL: each the parity of how many words (``which`` of them) fall on it."""
    bit = "shiftleft(1L, cast(w & 63 as int))"
    return f"aggregate({words}, 0L, (a, w) -> a ^ {f'if({which}, {bit}, 0L)' if which else bit})"


def shaped_lines(docs: DataFrame, threshold: int) -> tuple[DataFrame, Column]:
    """Stored lines with a word (doc_id, text_key, line_no, node, size, prefix, bits, more), and the rank table.

    ``node`` is the hash of the whole set, ``prefix`` its first words by rarity (32 bits of each),
    ``bits`` the parities of its words, ``more`` those of every second hash in sets of over ``WIDE`` words, else 0.
    """
    lines = lines_of(docs).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    ranks = rarity(docs)
    ordered = lines.select("doc_id", "text_key", "line_no", by_rarity(word_set(F.col("line")), ranks).alias("words"))
    return stored(ordered.select(
        "doc_id", "text_key", "line_no", F.xxhash64("words").alias("node"), F.size("words").alias("size"),
        F.expr(f"transform(slice(words, 1, cast(size(words) - ceil({threshold} * size(words) / 100d) + 1 as int)),"
               " w -> cast((w & 4294967295) - 2147483648 as int))").alias("prefix"),
        F.expr(_parity("words")).alias("bits"),
        F.expr(f"if(size(words) > {WIDE}, {_parity('words', '(w & 64) <> 0')}, 0L)").alias("more"),
    ), "lines-shaped"), ranks


def _need(threshold: int, x: str = "x.size", c: str = "c.size") -> str:
    """Least overlap of two sets of these sizes, in SQL."""
    return f"ceil({threshold} * ({x} + {c}) / {100 + threshold}d)"


def _bits_allow(threshold: int) -> str:
    """Whether the bitmaps of x and c leave the least overlap, in SQL: each differing bit is a word of only one set.

    The 64 bits are the two halves of the 128 folded, so a wide set still meets a small one.
    """
    wide = f"x.size > {WIDE} and c.size > {WIDE}"
    differ = (f"if({wide}, bit_count(x.bits ^ x.more ^ c.bits ^ c.more) + bit_count(x.more ^ c.more),"
              " bit_count(x.bits ^ c.bits))")
    return f"x.size + c.size - {differ} >= 2 * {_need(threshold)}"


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, ranks: Column, threshold: int) -> DataFrame:
    """Nodes of the later classes of the pairs (x, c) that are similar; sets are made anew from their first lines."""
    nodes = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("c").alias("node"))).distinct()
    # stored, so that its size is known and few documents are looked up without a shuffle of all texts
    refs = stored(classes.join(nodes, "node", "left_semi").select("node", "ref.*").groupBy(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(
        F.collect_list(F.struct("line_no", "node")).alias("wanted")), "lines-wanted")  # at most the lines of one document
    found = docs.join(refs, same(F.col("doc_id"), F.col("d")) & (F.col("text_key") == F.col("k")))
    found = found.select(F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w")).select(
        F.col("w.node").alias("node"), F.element_at("lines", F.col("w.line_no") + 1).alias("line"))
    sets = stored(found.select("node", by_rarity(word_set(F.col("line")), ranks).alias("words"))
                  .dropDuplicates(["node"]), "lines-sets")
    both = pairs.join(sets.select(F.col("node").alias("x"), F.col("words").alias("a")), "x").join(
        sets.select(F.col("node").alias("c"), F.col("words").alias("b")), "c")
    shared = F.size(F.array_intersect("a", "b"))
    both = both.select("x", "c", shared.alias("n"), (F.size("a") + F.size("b") - shared).alias("either")).where(
        f"100 * n >= {threshold} * either")
    order = classes.select("node", "ref")
    both = both.join(order.select(F.col("node").alias("x"), F.col("ref").alias("xr")), "x").join(
        order.select(F.col("node").alias("c"), F.col("ref").alias("cr")), "c")
    return both.select(F.when(F.col("xr") > F.col("cr"), F.col("x")).otherwise(F.col("c")).alias("node")).distinct()


def _postings(classes: DataFrame, prefix: str) -> DataFrame:
    first = F.coalesce(F.col("ref.doc_id"), F.lit(-(1 << 63)))  # null comes first
    return classes.select("node", first.alias("doc"), "size", "bits", "more", F.posexplode(F.expr(prefix)).alias("pos", "word"))


def _meetings(marked: DataFrame, threshold: int) -> list[tuple[DataFrame, DataFrame]]:
    """Pairs of probing and indexed postings to join on ``word``; ``marked``: classes with ``open``, whether still kept.

    Every two classes of which one is open meet if they are similar, two removed ones never do.
    """
    short = f"cast(size - ceil({2 * threshold} * size / {100 + threshold}d) + 1 as int)"

    def side(is_open: bool, prefix: str) -> DataFrame:
        return _postings(marked.where(F.col("open") == is_open), prefix)
    probe, gone_probe = side(True, "prefix"), side(False, "prefix")
    index, gone_index = (side(o, f"slice(prefix, 1, {short})") for o in (True, False))
    # equal sides are shuffled once
    return [(probe, index), (probe, gone_index), (gone_probe, index)]


#: For each of ``_meetings``: whether the later class is open, in SQL; if it is not, the pair decides nothing.
LATER_OPEN = ("true", "c.doc <= x.doc", "x.doc <= c.doc")


def _sharing(probe: DataFrame, index: DataFrame, threshold: int, later_open: str = "true") -> DataFrame:
    """(x, c) of a probing and an indexed class that share a word, x as large or larger, past the filters."""
    need = _need(threshold)
    return probe.alias("x").join(index.alias("c"), "word").where(
        f"x.node <> c.node and {later_open} and x.size >= c.size and 100 * c.size >= {threshold} * x.size"
        f" and least(x.pos, c.pos) + least(x.size - x.pos, c.size - c.pos) >= {need} and {_bits_allow(threshold)}").select(
        F.col("x.node").alias("x"), F.col("c.node").alias("c"), F.col("x.size").alias("xs"), F.col("c.size").alias("cs"),
        F.least(F.expr("x.size - x.pos"), F.expr("c.size - c.pos")).alias("rest"))


def _first_pairs(classes: DataFrame, threshold: int) -> DataFrame:
    """(x, c): at most one pair for each class, with the earlier one that most of its rarest words name."""
    # only what orders and sizes tell goes with every word; the bitmaps are looked up for the pairs
    rare = _postings(classes, f"slice(prefix, 1, {FIRST_WORDS})").select("word", "node", "doc", "size")
    earliest = rare.groupBy("word").agg(F.min(F.struct("doc", "node", "size")).alias("c"), F.count("*").alias("n")).where(
        "n > 1").select("word", "c.*")
    met = rare.alias("x").join(earliest.alias("c"), "word").where(
        f"x.node <> c.node and 100 * least(x.size, c.size) >= {threshold} * greatest(x.size, c.size)").groupBy(
        F.col("x.node").alias("x"), F.col("c.node").alias("c")).agg(F.count("*").alias("m"), F.max("x.size").alias("size"))
    short = f"size - ceil({threshold} * size / 100d) + 1"
    met = met.where(f"m >= least(2, {short})").groupBy("x").agg(F.max(F.struct("m", "c")).alias("b")).select(
        F.col("x").alias("xn"), F.col("b.c").alias("cn"))
    shape = classes.select("node", "size", "bits", "more")
    both = met.join(shape.alias("x"), F.col("xn") == F.col("x.node")).join(shape.alias("c"), F.col("cn") == F.col("c.node"))
    return both.where(_bits_allow(threshold)).select(
        F.greatest("xn", "cn").alias("x"), F.least("xn", "cn").alias("c")).distinct()


def later_matches(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, line_no, removed) of every line with a word; ``docs``: doc_id (long), text_key, text."""
    shaped, ranks = shaped_lines(docs, threshold)
    # behind here ``node`` is a number given when the classes are written: postings of it take less than of a hash
    classes = stored(shaped.groupBy(F.col("node").alias("hash")).agg(
        F.min(F.struct("doc_id", "text_key", "line_no")).alias("ref"), F.first("size").alias("size"),
        *[F.first(c).alias(c) for c in ("prefix", "bits", "more")])
        .withColumn("node", F.monotonically_increasing_id()), "lines-classes")

    pairs = stored(_first_pairs(classes, threshold), "lines-first")
    gone = stored(_verified(pairs, classes, docs, ranks, threshold), "lines-gone")

    # second round: the lines left, against every line that they share an indexed word with
    marked = classes.join(gone.withColumn("g", F.lit(1)), "node", "left").withColumn("open", F.col("g").isNull()).drop("g")
    met = [_sharing(probe, index, threshold, later_open)
           for (probe, index), later_open in zip(_meetings(marked, threshold), LATER_OPEN)]
    shared = met[0].unionByName(met[1]).unionByName(met[2]).groupBy(
        F.greatest("x", "c").alias("x"), F.least("x", "c").alias("c")).agg(
        F.max("rest").alias("from_first"), F.max("xs").alias("xs"), F.max("cs").alias("cs"))
    # the first shared word is both indexed and probed, so no more can be shared than the rests after it
    rest = shared.where(f"from_first >= {_need(threshold, 'xs', 'cs')}").select("x", "c")
    rest = stored(rest.join(pairs, ["x", "c"], "left_anti"), "lines-rest")
    gone = gone.unionByName(_verified(rest, classes, docs, ranks, threshold)).distinct()

    firsts = classes.join(gone.withColumn("g", F.lit(1)), "node", "left").select("hash", "ref", "g")
    return shaped.select("doc_id", "text_key", "line_no", F.col("node").alias("hash")).join(firsts, "hash").select(
        "doc_id", "text_key", "line_no",
        (F.col("g").isNotNull() | (F.struct("doc_id", "text_key", "line_no") != F.col("ref"))).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: int = THRESHOLD) -> DataFrame:
    """One row per doc_id and text: doc_id, text_key, n_lines (with a word), n_removed, removed (line numbers from 0)."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    lines = later_matches(base, threshold).groupBy("doc_id", "text_key").agg(
        F.size(F.collect_set("line_no")).alias("n_lines"), F.collect_set(F.when(F.col("removed"), F.col("line_no"))).alias("removed"))
    every = base.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    found = every.join(lines, same(F.col("doc_id"), F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    removed = F.coalesce(F.sort_array("removed"), F.array().cast("array<int>"))
    return found.select(F.col("d").alias("doc_id"), F.col("k").alias("text_key"),
                        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                        F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def without_lines(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``dedup_lines`` removes taken out of their texts."""
    cut = found.where("n_removed > 0").select("doc_id", "text_key", "removed").dropDuplicates(["doc_id", "text_key"])
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col(f"row.{text_col}")
    both = rows.join(cut, same(F.col(f"row.{id_col}").cast("long"), F.col("doc_id")) & (text_key(text) == F.col("text_key")),
                     "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("removed", i)), "\n")
    changed = F.when(F.col("removed").isNull(), text).otherwise(kept)
    return both.select(*(changed.alias(c) if c == text_col else F.col(f"row.{c}") for c in docs.columns))
