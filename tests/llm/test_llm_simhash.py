"""SimHash near duplicates against brute force."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from quitanda.llm import simhash
from quitanda.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text: str | None, shingle: int = 3) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    k = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], distance: int) -> dict[int, int]:
    """Smallest reachable fingerprint of each, by comparing all pairs."""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            parent[f] = parent[parent[f]]
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {f: root(f) for f in fps}


def expected(rows: list[tuple[int | None, str | None]], distance: int = 2) -> list[tuple]:
    fps = [plain_fingerprint(text) for _, text in rows]
    comp = plain_components(fps, distance)
    least: dict[int, int | None] = {}
    for (doc_id, _), fp in zip(rows, fps):
        ids = [x for x in (least.get(comp[fp]), doc_id) if x is not None]
        least[comp[fp]] = min(ids) if ids else None
    return sorted(((doc_id, f"{fp:016x}", least[comp[fp]]) for (doc_id, _), fp in zip(rows, fps)), key=str)


def found(df) -> list[tuple]:
    out = df.select("doc_id", simhash.hexadecimal(df["fp"]).alias("h"), "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


def test_whole_table_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = found(simhash.near_duplicates(documents))
    assert got == expected(rows)
    assert len({c for _, _, c in got}) < len(got)  # some are linked


def test_awkward_rows_and_clashing_columns(awkward, clashing, empty_docs):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(simhash.near_duplicates(awkward)) == expected(rows)
    assert found(simhash.near_duplicates(clashing)) == expected(rows)
    assert simhash.near_duplicates(empty_docs).collect() == []


def test_long_text_is_counted_in_blocks():
    rng = random.Random(3)
    text = " ".join(rng.choice("ab cd ef gh ij kl Mn".split()) + str(rng.randrange(50)) for _ in range(simhash.BLOCK + 5000))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def clustered(n: int, seed: int, spread: int) -> list[int]:
    """Fingerprints around a few centres, so that buckets are large and many pairs are near."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randrange(spread)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


def signed(f: int) -> int:
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("distance,segments,direct", [(0, 5, 64), (1, 3, 2), (2, 5, 64), (2, 5, 2), (2, 7, 4), (3, 7, 64), (3, 7, 2)])
def test_links_in_small_and_large_buckets(spark, distance, segments, direct):
    fps = clustered(400, 7 + distance, 9)
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(table, distance, segments, direct)
    rows = [(r.u, r.v) for r in edges.collect()]
    assert all(((u ^ v) & (1 << 64) - 1).bit_count() <= distance for u, v in rows)
    comp = plain_components(fps, distance)
    got = {r.node: r.comp for r in components(edges).collect()}
    own = [signed(f) for f in fps]
    groups: dict[int, set] = {}
    for f in fps:
        groups.setdefault(comp[f], set()).add(signed(f))
    for group in groups.values():
        assert {got.get(f, f) for f in group} == {min(group)}
    assert set(got) <= set(own)


def test_every_near_pair_has_a_viable_chain():
    """The filter itself: two differing bits anywhere leave a chain within its budgets."""
    grown = simhash.chain_masks(simhash.SEGMENTS)
    for i in range(64):
        for j in range(i, 64):
            x = 1 << i | 1 << j
            assert any(all((x & chain[n]).bit_count() * simhash.SEGMENTS <= (n + 1) * simhash.DISTANCE
                           for n in range(simhash.SEGMENTS)) for chain in grown)


def test_one_hot_bucket_makes_no_pairs(spark):
    """3 000 fingerprints that share their first 32 bits: rows grow with them, not with their square."""
    rng = random.Random(5)
    top = rng.getrandbits(32) << 32
    fps = [top | rng.getrandbits(32) for _ in range(3000)]
    table = spark.createDataFrame([(signed(f),) for f in sorted(set(fps))], "fp long")
    edges = simhash.links(table)
    assert edges.count() < 3000
    assert {tuple(sorted((r.u, r.v))) for r in edges.collect()} <= {
        tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
