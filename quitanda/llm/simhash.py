"""Operator 11: near duplicates by SimHash fingerprints and pigeonring filtering.

A document's 64-bit fingerprint has a bit set where over half of its word
shingles (repeats included) have it set in their XXH64.  Documents link when
their fingerprints differ in at most ``distance`` bits.

Method: the 64 bits lie on a ring of ``segments`` segments.  If two fingerprints
differ in at most ``distance`` bits, some segment starts a chain whose first l
segments differ in at most ``l * distance / segments`` bits, for every l at once.
The first segments of that chain have a budget below one bit, so they agree
exactly: they are the bucket key (25 or 26 bits for five segments and two
differences).  Inside a bucket the longer prefixes of the chain are held against
their budgets before the full Hamming check.

Pairs are compared only in buckets of at most ``DIRECT`` fingerprints.  A larger
bucket is handled exactly without pairs: each member goes to every value within
``ceil(distance / 2)`` flips of the bits outside the key, and members that meet
at a value within ``distance // 2`` flips of one of them are linked to that one
(the flips of both add up to ``distance`` at most, and two linked members always
meet half way).  So work grows with the fingerprints, however many share a key.
Exact copies of a fingerprint are one node before any of this.

Defined cases: null, empty or word-less text has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle; texts are
taken whole at any length, a block of shingles at a time; rows that repeat a
doc_id are separate rows; rows with a null doc_id take part in linking, their
component_id is the smallest doc_id of the component (null if there is none); an
empty table gives an empty result.  Only ``id_col`` and ``text_col`` are read,
so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import stored
from quitanda.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEGMENTS = 5
BITS = 64
HASH_SEED = 42
#: Fingerprints of a bucket that are compared in pairs; larger buckets are split by flipped bits.
DIRECT = 64
#: Shingles whose bits are counted at a time; the counts fit 16 bits.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one UTF-8 text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators of a word
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (ends - size)[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK], ends[at:at + BLOCK])
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [fingerprint(text, shingle) if text else 0 for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])
    return run


def segment_masks(segments: int) -> list[int]:
    """The bits of each segment; sizes differ by one at most."""
    bounds = [BITS * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]


def chain_masks(segments: int) -> list[list[int]]:
    """For each first segment the bits of its chains of 1, 2, ... all segments around the ring."""
    own = segment_masks(segments)
    chains = []
    for start in range(segments):
        bits, grown = 0, []
        for step in range(segments):
            bits |= own[(start + step) % segments]
            grown.append(bits)
        chains.append(grown)
    return chains


def exact_segments(segments: int, distance: int) -> int:
    """How many first segments of a chain have a budget below one bit."""
    return segments if distance == 0 else -(-segments // distance) - 1


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _mask(bits: int) -> Column:
    return F.lit(_long(bits)).cast("long")


def within_budgets(differing: Column, chain: Column, segments: int, distance: int) -> Column:
    """Whether the chain that a bucket stands for keeps every budget but the whole ring's."""
    fits = F.lit(False)
    for start, grown in enumerate(chain_masks(segments)):
        own = chain == start
        for length in range(exact_segments(segments, distance) + 1, segments):
            own = own & (F.bit_count(differing.bitwiseAND(_mask(grown[length - 1]))) <= length * distance // segments)
        fits = fits | own
    return fits


def flips(segments: int, distance: int) -> list[tuple[int, int, bool]]:
    """(chain, bits to flip, near): all ways of flipping bits outside a chain's key."""
    keys, out = exact_segments(segments, distance), []
    for start, grown in enumerate(chain_masks(segments)):
        free = [b for b in range(BITS) if not grown[keys - 1] >> b & 1]
        for n in range(-(-distance // 2) + 1):
            out += [(start, _long(sum(1 << b for b in some)), n <= distance // 2) for some in combinations(free, n)]
    return out


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, direct: int = DIRECT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` whose components are those of all links.

    Every edge is a link; a bucket of more than ``direct`` members gives a connected part of its links.
    """
    keys = exact_segments(segments, distance)
    if keys < 1:
        raise ValueError("more segments than differing bits are needed")
    chains = F.array(*[F.struct(F.lit(i).alias("chain"), F.col("fp").bitwiseAND(_mask(grown[keys - 1])).alias("key"))
                       for i, grown in enumerate(chain_masks(segments))])
    dealt = fps.select("fp", F.explode(chains).alias("b")).select("fp", "b.chain", "b.key")
    sizes = dealt.groupBy("chain", "key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stored(dealt.join(sizes, ["chain", "key"]), "simhash-buckets")

    small = buckets.where(F.col("size") <= direct)
    differing = F.col("u").bitwiseXOR(F.col("v"))
    pairs = small.select("chain", "key", F.col("fp").alias("u")).join(
        small.select("chain", "key", F.col("fp").alias("v")), ["chain", "key"]).where("u > v")
    near = pairs.where(within_budgets(differing, F.col("chain"), segments, distance)).where(
        F.bit_count(differing) <= distance).select("u", "v")

    large = buckets.where(F.col("size") > direct)
    # a table of fixed size: the ways of flipping few of 64 bits
    ways = fps.sparkSession.createDataFrame(flips(segments, distance), "chain int, flip long, near boolean")
    met = large.join(F.broadcast(ways), "chain").select(
        "chain", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"), "fp", F.when(F.col("near"), F.col("fp")).alias("near"))
    # a value is met by at most as many distinct fingerprints as there are ways, so the list is bounded
    stars = met.groupBy("chain", "at").agg(F.min("near").alias("v"), F.collect_list("fp").alias("all")).where(
        "v is not null and size(all) > 1").select(F.explode("all").alias("u"), "v").where("u <> v")
    return near.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, segments: int = SEGMENTS, direct: int = DIRECT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (the fingerprint's 64 bits as long), component_id, kept.

    ``kept`` marks the rows that carry their component's smallest doc_id.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    member = stored(base.mapInArrow(_fingerprints(shingle), "doc_id long, fp long"), "simhash-fingerprints")
    classes = stored(member.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    comp = components(links(classes.select("fp"), distance, segments, direct), "simhash-cc")
    placed = classes.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("comp", "fp").alias("comp"))
    named = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = placed.join(named, "comp").select("fp", "component_id")
    return member.join(ids, "fp").select("doc_id", "fp", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def hexadecimal(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
