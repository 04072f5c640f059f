"""Operator 2: benchmark decontamination by spaced-seed hashing.

Method: fixed masks read some of the tokens at a place and skip others, so a
substituted token does not break every hash that covers it.  Two masks of five
tokens hit every window of 13 tokens with up to two substitutions; items of 5 to
12 tokens have two masks of three tokens, which hit them with a fifth of their
tokens substituted; items under five tokens are hashed whole (a test checks all
cases).  A mask that no item of the benchmark needs is not computed.
Training and test hashes are joined; around every hit the aligned tokens of
both sides are compared, and a window of 13 tokens (all of a shorter item) that
agrees in at least 80 percent is a verified overlap.

Training hashes outnumber test hashes by far, so a Bloom filter of the test
hashes (``2**bloom_bits`` bits, a fixed size, built with a group-by) drops
nearly all of them before the shuffle; it loses none.  Rows that pass carry the
tokens around their position as 32-bit hashes, so verification needs no text
and no second pass.

Defined cases: tokens are words, A-Z in lower case; null and empty texts have
none; items of 5 to 12 tokens are found when no more than a fifth of their
tokens differ, items of 3 or 4 when all agree; an item of one or two tokens says
nothing inside a text and is found only where it is a document's whole text;
repeated benchmark rows and
repeated documents give one row for each (doc_id, text, item_id); very long
texts are read whole, in parts of a batch; an empty table on either side gives
no rows; only the named columns are read, so others can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm import kernel as K
from quitanda.llm.common import arrays, text_key

MASKS = ((0, 1, 2, 3, 5), (0, 1, 3, 4, 5))
SHORT_MASKS = ((0, 1, 3), (0, 2, 3))
WHOLE_MASKS = ((0,), (0, 1), (0, 1, 2), (0, 1, 2, 3))
ALL_MASKS = MASKS + SHORT_MASKS + WHOLE_MASKS
WINDOW = 13
AGREE = 80
#: Items below this size are found only as a whole text.
INSIDE = 3
BLOOM_BITS = 24
_SPAN = max(max(m) for m in ALL_MASKS) + 1
#: Tokens carried on each side of a hit's first token.
BEFORE, AFTER = WINDOW - 4, WINDOW + _SPAN


def needed_masks(sizes: np.ndarray) -> np.ndarray:
    """For each item size, which masks its hashes need."""
    needs = np.zeros((len(sizes), len(ALL_MASKS)), bool)
    long, short = len(MASKS), len(MASKS) + len(SHORT_MASKS)
    needs[:, :long] = (sizes >= WINDOW)[:, None]
    needs[:, long:short] = ((sizes >= 5) & (sizes < WINDOW))[:, None]
    for n, _ in enumerate(WHOLE_MASKS):
        needs[:, short + n] = sizes == n + 1
    return needs


def seed_hashes(words: np.ndarray, first: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position of its first word, mask) at every place inside one text; ``use``: the masks of each text."""
    size = np.diff(first)
    last = np.repeat(first[1:], size)
    at = np.arange(len(words))
    hashes, places, numbers = [], [], []
    for number in np.flatnonzero(use.any(axis=0)):
        mask = ALL_MASKS[number]
        fits = at[(at + mask[-1] < last) & np.repeat(use[:, number], size)]
        h = np.full(len(fits), number + 1, np.uint64)
        for i in mask:
            h = h * K.U64(0xD6E8FEB86659FD93) + words[fits + i]
            h ^= h >> K.U64(29)
        hashes.append(K.mix64(h))
        places.append(fits)
        numbers.append(np.full(len(fits), number, np.int64))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places), np.concatenate(numbers)


def _around(words: np.ndarray, first: np.ndarray, owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    """32-bit tokens around each place; 0 outside the text."""
    index = places[:, None] + np.arange(-BEFORE, AFTER)
    inside = (index >= first[owner][:, None]) & (index < first[owner + 1][:, None])
    token = (words >> K.U64(33)).astype(np.int32) | np.int32(1)
    if not len(words):
        return np.zeros(index.shape, np.int32)
    return np.where(inside, token[np.clip(index, 0, len(words) - 1)], np.int32(0))


def _bits(hashes: np.ndarray, bloom_bits: int) -> np.ndarray:
    return np.stack([hashes >> K.U64(64 - bloom_bits), (hashes & K.U64((1 << bloom_bits) - 1))], axis=1)


def _rows(text_col: str, keep: list[str], bloom, bloom_bits: int, used: tuple[int, ...] = ()):
    """Seed hashes that pass the filter, with position, length of the text and the tokens around.

    Without a filter the texts are items and have the masks of their size, else the ``used`` ones.
    """
    width = BEFORE + AFTER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if bloom is None else np.unpackbits(bloom.value, bitorder="little").view(bool)
        for batch in batches:
            for part in K.chunks(batch, text_col):
                words, first = K.hash_words(part.column(text_col), lower=True)
                size = np.diff(first)
                if bloom is None:
                    use = needed_masks(size)
                else:
                    use = np.zeros((len(size), len(ALL_MASKS)), bool)
                    use[:, list(used)] = True
                hashes, places, numbers = seed_hashes(words, first, use)
                if held is not None:
                    bit = _bits(hashes, bloom_bits).astype(np.int64)
                    ok = np.flatnonzero(held[bit[:, 0]])
                    ok = ok[held[bit[ok, 1]]]
                    hashes, places, numbers = hashes[ok], places[ok], numbers[ok]
                owner = np.searchsorted(first, places, "right") - 1
                around = _around(words, first, owner, places)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c).take(pa.array(owner)) for c in keep),
                    pa.array(K.signed(hashes)), pa.array(places - first[owner]), pa.array(size[owner]), pa.array(numbers),
                    pa.FixedSizeListArray.from_arrays(pa.array(around.reshape(-1)), width).cast(pa.list_(pa.int32())),
                ], names=[*keep, "h", "at", "size", "mask", "around"])
    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best window around each hit, if it agrees enough."""
    width = BEFORE + AFTER
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(c).flatten().to_numpy().reshape(-1, width) for c in ("around", "item_around"))
        item = b != 0
        same = (a == b) & item
        size = batch.column("item_size").to_numpy()
        need_len = np.minimum(size, WINDOW)
        sums = np.zeros((len(a), width + 1), np.int16)
        np.cumsum(same, axis=1, out=sums[:, 1:])
        full = np.zeros((len(a), width + 1), np.int16)
        np.cumsum(item, axis=1, out=full[:, 1:])
        best, where = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for n in np.unique(need_len):
            own = np.flatnonzero(need_len == n)
            score = sums[own, n:] - sums[own, :-n]
            score = np.where(full[own, n:] - full[own, :-n] == n, score, 0)
            where[own] = score.argmax(1)
            best[own] = score.max(1)
        ok = 100 * best >= AGREE * need_len
        keep = pa.array(ok)
        start = batch.column("at").to_numpy() - BEFORE + where
        item_start = batch.column("item_at").to_numpy() - BEFORE + where
        out = pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("text_key"), batch.column("item_id"),
            pa.array(start), pa.array(start + need_len), pa.array(item_start), pa.array(item_start + need_len),
            pa.array(best)], names=["doc_id", "text_key", "item_id", "doc_start", "doc_end", "item_start", "item_end", "agree"])
        yield out.filter(keep)


def _bloom(hashes: DataFrame, bloom_bits: int) -> np.ndarray:
    """Bit table of the hashes; at most ``2**bloom_bits / 32`` words reach the driver."""
    mask = (1 << bloom_bits) - 1
    bit = hashes.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - bloom_bits),
                                          F.col("h").bitwiseAND(F.lit(mask)))).alias("bit"))
    words = arrays(bit.groupBy(F.expr("bit div 32").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit % 32))")).alias("v")))
    table = np.zeros((1 << bloom_bits) // 32, np.uint32)
    table[words["w"]] = words["v"].astype(np.uint32)
    return table.view(np.uint8)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text", bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """Verified overlaps: one row for each doc_id, text_key and item_id.

    Columns: doc_id, text_key (tells rows with one doc_id apart), item_id,
    doc_start, doc_end, item_start, item_end (word positions, end exclusive,
    from the first to the last verified window), agree (most agreeing words of
    a window) and n_windows.
    """
    sc = docs.sparkSession.sparkContext
    tests = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    kind = tests.schema["item_id"].dataType.simpleString()
    shape = "h long, at long, size long, mask long, around array<int>"
    seeds = tests.mapInArrow(_rows("text", ["item_id"], None, bloom_bits), f"item_id {kind}, {shape}").select(
        "item_id", "h", "mask", F.col("at").alias("item_at"), F.col("size").alias("item_size"),
        F.col("around").alias("item_around"))
    used = tuple(int(m) for m in arrays(seeds.select("mask").distinct())["mask"])  # at most all masks
    bloom = sc.broadcast(_bloom(seeds.select("h"), bloom_bits))
    base = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    id_kind = base.schema["doc_id"].dataType.simpleString()
    hits = base.mapInArrow(_rows("text", ["doc_id", "text_key"], bloom, bloom_bits, used),
                           f"doc_id {id_kind}, text_key long, {shape}")
    found = hits.join(seeds.drop("mask"), "h").where(f"item_size >= {INSIDE} or size = item_size")
    windows = found.select(
        "doc_id", "text_key", "item_id", "at", "around", "item_at", "item_size", "item_around").mapInArrow(
        _verify, f"doc_id {id_kind}, text_key long, item_id {kind}, doc_start long, doc_end long, item_start long, "
                 "item_end long, agree long")
    return windows.groupBy("doc_id", "text_key", "item_id").agg(
        F.min("doc_start").alias("doc_start"), F.max("doc_end").alias("doc_end"),
        F.min("item_start").alias("item_start"), F.max("item_end").alias("item_end"),
        F.max("agree").alias("agree"), F.count("*").alias("n_windows"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        **options) -> DataFrame:
    """``docs`` without the rows that overlap an item of the benchmark."""
    bad = overlaps(docs, benchmark, id_col, text_col, **options).select("doc_id", "text_key").distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(bad, F.col(f"row.{id_col}").eqNullSafe(F.col("doc_id"))
                     & (text_key(F.col(f"row.{text_col}")) == F.col("text_key")), "left_anti").select("row.*")
