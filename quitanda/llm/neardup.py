"""Operator 6: near duplicates by one-permutation MinHash.

Method: every document's set of word shingles is hashed once (one permutation)
into ``bands * rows`` bins; empty bins are filled by optimal densification (each
empty bin follows its own universal probe sequence to a filled bin); each band
of bins is a bucket key.  Inside a bucket only star edges to its most popular
node are candidates, and each node takes the one it meets most often, so pairs
grow with the documents, not with the square of a group.  Links are
confirmed on the full sets.

Exact copies of a set fall into one node before any pairing.  A star can miss
links between leaves.  So the nodes of buckets that still hold several
components are joined exactly: shingles ordered by rarity, the larger set of two
similar ones is probed by its rarest ``n - t n + 1`` (prefix), the smaller is
indexed by its rarest ``n - 2 t n / (1 + t) + 1`` only, and the length and
positional filters hold; only nodes outside a shingle's largest component are
paired.  Documents of one template that are less similar than ``t`` have more
shingles of their own than the index takes, so what they share is not indexed
and they meet nowhere, however many they are.
With 56 bands of 7 rows a
pair at similarity 0.85 shares no bucket with probability 5e-10, one at 0.8 with
2e-6.

Defined cases: null or word-less text has an empty set, is linked with nothing
and is kept; rows that repeat a doc_id are separate rows; rows with a null
doc_id take part in linking, their component_id is the smallest doc_id of the
component (null if there is none).  Only ``id_col`` and ``text_col`` are read,
so other columns can have any name.  Very long texts are read whole; an empty
table gives no rows.  Nodes are 64-bit hashes of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quitanda.llm import kernel as K
from quitanda.llm.common import WORD, arrays, stored
from quitanda.llm.components import components

SHINGLE = 5
THRESHOLD = 80
BANDS, ROWS = 56, 7
RARITY_BITS = 18
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def document_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, first of each text + total)."""
    words, first = K.hash_words(texts, lower=True)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= shingle:
            sets.append(np.unique(K.shingle_hashes(words[a:b], shingle)))
        else:  # fewer words: the whole sequence is one shingle
            sets.append(K.shingle_hashes(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def set_nodes(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each whole set; 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(K.mix64(flat ^ K.U64(0x5851F42D4C957F2D)))))
    size = np.diff(first)
    node = K.mix64((sums[first[1:]] - sums[first[:-1]]) ^ (size.astype(np.uint64) << K.U64(32)))
    return np.where(size > 0, node | K.U64(1), K.U64(0))


def one_permutation(flat: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """Densified signatures, one row of ``bins`` values for each non-empty set."""
    size = np.diff(first)
    full = np.flatnonzero(size)
    row = np.repeat(np.arange(len(full)), size[full])
    slot = ((flat >> K.U64(32)) * K.U64(bins)) >> K.U64(32)
    value = np.full(len(full) * bins, _EMPTY, np.uint64)
    np.minimum.at(value, row * bins + slot.astype(np.int64), K.mix64(flat))
    value = value.reshape(len(full), bins)
    filled = value != _EMPTY
    r, j = np.nonzero(~filled)
    attempt = 0
    while len(r):
        attempt += 1
        if attempt <= 64 * bins:  # the same probes for every document: 2-universal in (bin, attempt)
            probe = K.mix64(j.astype(np.uint64) * K.U64(0x9E3779B97F4A7C15) + K.U64(attempt)) % K.U64(bins)
            probe = probe.astype(np.int64)
        else:
            probe = (j + attempt) % bins
        hit = filled[r, probe]
        value[r[hit], j[hit]] = value[r[hit], probe[hit]] + K.U64(attempt)
        r, j = r[~hit], j[~hit]
    return value


def _sketch(shingle: int, bands: int, rows: int, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, text_col):
                flat, first = document_sets(part.column(text_col), shingle)
                size = np.diff(first)
                sig = one_permutation(flat, first, bands * rows)
                keys = np.empty((len(sig), bands), np.uint64)
                for b in range(bands):
                    key = np.full(len(sig), b + 1, np.uint64)
                    for i in range(rows):
                        key = K.mix64(key * K.U64(31) + sig[:, b * rows + i])
                    keys[:, b] = key
                counts = np.where(size > 0, bands, 0)
                yield pa.RecordBatch.from_arrays([
                    part.column(id_col).cast(pa.int64()),
                    pa.array(K.signed(set_nodes(flat, first))),
                    pa.array(size),
                    K.lists_of(K.signed(keys.reshape(-1)), np.concatenate(([0], np.cumsum(counts))), pa.int64()),
                ], names=["doc_id", "node", "n_shingles", "keys"])
    return run


def _sets(shingle: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, text_col):
                flat, first = document_sets(part.column(text_col), shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(set_nodes(flat, first))),
                     K.lists_of(K.signed(flat), first, pa.int64())], names=["node", "items"])
    return run


def _sets_of(nodes: DataFrame, docs: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """(node, items) of the nodes: the sets made anew from the texts of one doc_id each.

    The sets of all documents together would be larger than their texts.
    """
    want = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id")).select("id").distinct()
    # null-safe: a node that only rows without doc_id hold is found among those
    texts = docs.join(want, docs["doc_id"].eqNullSafe(want["id"]), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(shingle, "text"), "node long, items array<long>")
    return stored(sets.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "neardup-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (u, v) of nodes whose whole sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("items").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.select("u", "v", shared.alias("shared"), (F.size("a") + F.size("b") - shared).alias("either")).where(
        f"100L * shared >= {threshold}L * either").select("u", "v")


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle of each of ``2**RARITY_BITS`` hash buckets: a table of fixed size."""
    table = np.zeros(1 << RARITY_BITS, np.uint32)
    counts = arrays(sets.select(F.explode("items").alias("x")).groupBy(
        F.pmod("x", F.lit(1 << RARITY_BITS)).cast("int").alias("b")).agg(F.count("*").alias("c")))
    table[counts["b"]] = np.minimum(counts["c"], 1 << 31)
    return table


def _prefixes(rarity, threshold: int):
    """(node, comp, n, pos, word, indexed) of the rarest shingles, of which two similar sets share one.

    ``indexed`` marks the first of them, by which a set is found from sets that are as large or larger.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = part.column("items")
                first, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
                words, size = [], np.diff(first)
                for a, b in zip(first, first[1:]):
                    own = flat[a:b]
                    n = len(own) - -(-threshold * len(own) // 100) + 1
                    words.append(own[np.lexsort((own, rarity.value[own % (1 << RARITY_BITS)]))[:n]])
                count = np.array([len(w) for w in words], np.int64)
                owner = np.repeat(np.arange(len(words)), count)
                pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                index = size - -(-2 * threshold * size // (100 + threshold)) + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(pa.array(owner)), part.column("comp").take(pa.array(owner)),
                     pa.array(size[owner], pa.int64()), pa.array(pos, pa.int64()), pa.array(np.concatenate(words)),
                     pa.array(pos < index[owner])],
                    names=["node", "comp", "n", "pos", "word", "indexed"])
    return run


def _meetings(rare: DataFrame, main: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Probing and indexed postings that meet on (word, side), at least one of each two outside ``main``.

    Postings outside the word's largest component probe side 0, which has all indexed ones; those inside probe
    side 1, which has the indexed ones outside.  So no two of the largest component meet.
    """
    marked = rare.join(main, "word").withColumn("outside", F.col("comp") != F.col("main")).drop("main")
    probe = marked.select("word", F.when(F.col("outside"), 0).otherwise(1).alias("side"), F.col("node").alias("x"),
                          F.col("comp").alias("xc"), F.col("n").alias("xn"), F.col("pos").alias("xpos"))
    sides = F.when(F.col("outside"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    index = marked.where("indexed").select("word", F.explode(sides).alias("side"), "node", "comp", "n", "pos")
    return probe, index


def _across(sets: DataFrame, comp: DataFrame, threshold: int) -> DataFrame:
    """Pairs (u, v) of nodes in different components that pass the prefix, length and positional filters."""
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(sets))
    placed = sets.join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "items")
    rare = placed.mapInArrow(_prefixes(rarity, threshold),
                             "node long, comp long, n long, pos long, word long, indexed boolean")
    counts = rare.groupBy("word", "comp").agg(F.count("*").alias("c")).groupBy("word").agg(
        F.max(F.struct("c", "comp")).alias("b"), F.count("*").alias("k")).where("k > 1")
    probe, index = _meetings(rare, counts.select("word", F.col("b.comp").alias("main")))
    need = f"ceil({threshold} * (xn + n) / {100 + threshold}d)"
    return probe.join(index, ["word", "side"]).where("xc <> comp and xn >= n").where(
        f"100L * n >= {threshold}L * xn").where(
        f"least(xn - xpos, n - pos) >= {need}").select(
        F.greatest("x", "node").alias("u"), F.least("x", "node").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, node, n_shingles, comp, component_id, kept.

    ``node`` is the document's set, ``comp`` names its component of linked sets.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = stored(base.mapInArrow(_sketch(shingle, bands, rows, "doc_id", "text"),
                                      "doc_id long, node long, n_shingles long, keys array<long>"), "neardup-sketch")
    member = sketches.select("doc_id", "node", "n_shingles")
    classes = sketches.where("n_shingles > 0").groupBy("node").agg(F.first("keys").alias("keys"))
    in_band = classes.select("node", F.explode("keys").alias("bucket"))
    shared = in_band.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    members = stored(in_band.join(shared, "bucket").select("bucket", "node", "c"), "neardup-buckets")
    popular = members.groupBy("node").agg(F.sum("c").alias("p"))
    sets = _sets_of(popular.select("node"), base, member, shingle)

    # first pass: a bucket's centre is the node that shares buckets with the most others, which is
    # near the middle of its group; every node is paired with the centre it meets most often
    ranked = members.join(popular, "node").select("bucket", "node", "p")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("p", "node")).alias("top")).select(
        "bucket", F.col("top.p").alias("cp"), F.col("top.node").alias("centre"))
    met = ranked.join(centres, "bucket").where("node <> centre").groupBy("node", "centre").agg(
        F.count("*").alias("c"), F.max("cp").alias("cp"))
    best = met.groupBy("node").agg(F.max(F.struct("c", "cp", "centre")).alias("b"))
    stars = best.select(F.greatest("node", "b.centre").alias("u"), F.least("node", "b.centre").alias("v")).distinct()
    links = stored(_confirmed(stars, sets, threshold), "neardup-links")
    comp = components(links, "neardup-cc")

    # second pass: nodes of buckets that still hold several components
    placed = members.join(comp, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    left = placed.join(mixed, "bucket", "left_semi").select("node").distinct()
    left = stored(sets.join(left, "node", "left_semi"), "neardup-left")
    more = stored(_confirmed(_across(left, comp, threshold), left, threshold), "neardup-more")
    if not more.isEmpty():
        comp = components(comp.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(more), "neardup-cc")

    placed = member.join(comp, "node", "left").withColumn(
        "comp", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "node")))
    named = placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least_id"))
    return placed.join(named, "comp", "left").select(
        "doc_id", "node", "n_shingles", "comp",
        F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component of near duplicates and every row without words.

    The row kept has the component's smallest doc_id; of several such rows one stays.
    """
    found = near_duplicates(docs, **options).where("kept")
    linked = found.where("n_shingles > 0").groupBy("comp").agg(
        F.min(F.struct("doc_id", "node")).alias("r")).select("r.doc_id", F.col("r.node").alias("kept_node"))
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    has_word = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    keyed = with_node(docs.where(has_word), text_col, options.get("shingle", SHINGLE))
    # rows with one doc_id and one set are copies: one of them stays.  The join is on the same three plain columns,
    # so whole rows are shuffled once for both
    row_id = F.col(f"row.{id_col}").cast("long")
    keyed = keyed.select("row", "node", *_plain(row_id)).dropDuplicates(["id", "no_id", "node"])
    linked = linked.select(F.col("kept_node").alias("node"), *_plain(F.col("doc_id")))
    kept = keyed.join(linked, ["id", "no_id", "node"], "left_semi")
    return kept.select("row.*").unionByName(docs.where(~has_word))


def _plain(doc_id: Column) -> list[Column]:
    """A doc_id as two columns that plain equality compares null-safely."""
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id")]


def with_node(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(row, node): the rows of ``docs`` and the hash of each one's set."""
    schema = StructType([StructField("row", docs.schema), StructField("node", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, text_col):
                flat, first = document_sets(part.column(text_col), shingle)
                yield pa.RecordBatch.from_arrays([part.to_struct_array(), pa.array(K.signed(set_nodes(flat, first)))],
                                                 names=["row", "node"])
    return docs.mapInArrow(run, schema)


#: The contract in SQL: all pairs that share a shingle, then everything reachable.
ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
      THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
  FROM shingles a JOIN shingles b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (n + m - c)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
), comps AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN comps USING (doc_id)
"""
