"""Operator 12: hard negatives by segment summaries.

For each anchor vector the best rows of the same label are its positives, and for
each positive the best rows of other labels whose score lies in a window below
the positive's.  A score is the inner product of integer components
``floor(scale * x)``.

Method: every vector stores the mean and the deviation of each of its segments,
for 1, 2, 4, 8 and 16 segments.  Over one segment of length L a product of two
vectors lies within ``L * (mean * mean +- deviation * deviation)``; summed over
the segments this bounds the score from both sides.  Bounds are taken with one
segment first; pairs that can still reach the anchor's window are refined with
twice as many segments, and what is left after the finest level is scored
exactly.  An anchor's lower bound is raised by what it has found so far; it
starts from a pilot, the exact search in one block of rows.

Anchors and rows are dealt into blocks of bounded size, and each block of anchors
meets each block of rows in one task (``BLOCK_ANCHORS`` times ``BLOCK_ROWS``
scores at most), whatever label or vector is frequent.  A block returns the best
few for each window; a ranked window over those gives the result.  Nothing is
broadcast.

Defined cases: rows with a null label or vector, or with a null or non-finite
component take no part; vectors meet only vectors of the same length; empty
vectors take no part; rows that repeat a vec_id are separate rows, an anchor
leaves out only its own row; rows with a null vec_id are no anchors and lose
ties; an anchor without positives and a positive without negatives give no rows;
an empty table gives an empty result; ValueError is raised if a score might not
fit a long.  Only the named columns are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Window of a negative's score in percent of the positive's.
LEAST, MOST = 30, 90
#: Numbers of segments, from coarse to fine.
LEVELS = (1, 2, 4, 8, 16)
#: Anchors and rows that meet in one task.
BLOCK_ANCHORS = 1024
BLOCK_ROWS = 4096
#: Rows scored at a time within a block; the lower bounds rise in between.
STEP = 512
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_ROW = "row_id long, vec_id long, label long, dim int, comps array<long>, summary array<double>"


def levels_of(dim: int) -> list[np.ndarray]:
    """Segment bounds of each level; a level's segments lie within those of the level before."""
    return [np.array([dim * i // n for i in range(n + 1)]) for n in LEVELS if n <= dim]


def summaries(comps: np.ndarray) -> np.ndarray:
    """Means and deviations of every level's segments, one row for each vector."""
    x, out = comps.astype(np.float64), []
    for bounds in levels_of(comps.shape[1]):
        size = np.diff(bounds)
        mean = np.add.reduceat(x, bounds[:-1], axis=1) / size
        apart = x - np.repeat(mean, size, axis=1)
        out += [mean, np.sqrt(np.add.reduceat(apart * apart, bounds[:-1], axis=1) / size)]
    return np.concatenate(out, axis=1)


def by_level(summary: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) of each level, weighted so that a plain product gives a bound's part."""
    out, at = [], 0
    for bounds in levels_of(dim):
        weight, n = np.sqrt(np.diff(bounds)), len(bounds) - 1
        out.append((summary[:, at:at + n] * weight, summary[:, at + n:at + 2 * n] * weight))
        at += 2 * n
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest >= 1 << 63:
        raise ValueError("a score might not fit a long")
    if largest < 1 << 53:  # every partial sum is an exact double
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _prepared(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array(pc.list_value_length(batch.column("vec")).fill_null(0))
            size[np.asarray(batch.column("label").is_null())] = 0
            for dim in np.unique(size[size > 0]).tolist():
                part = batch.take(pa.array(np.flatnonzero(size == dim)))
                flat = pc.list_flatten(part.column("vec")).fill_null(np.nan)
                x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
                good = np.isfinite(x).all(axis=1)
                scaled = np.floor(scale * x[good])
                if np.abs(scaled).max(initial=0) >= 1 << 31:
                    raise ValueError("a score might not fit a long")
                comps, rows = scaled.astype(np.int64), part.filter(pa.array(good))
                summary = summaries(comps)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), pa.array(np.full(len(comps), dim), pa.int32()),
                     _lists(comps), _lists(summary)], names=["vec_id", "label", "dim", "comps", "summary"])
    return run


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.reshape(-1)))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(rows, -1)


class _Best:
    """The first ``k`` rows of each window: higher scores first, then smaller ids, null ids last."""

    def __init__(self, windows: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.rows = np.zeros((5, 0), np.int64)  # window, score, null id, id, row number

    def add(self, window: np.ndarray, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        every = np.concatenate((self.rows, np.array([window, score, no_id, ids, row], np.int64)), axis=1)
        every = every[:, np.lexsort((every[4], every[3], every[2], -every[1], every[0]))]
        first = np.searchsorted(every[0], every[0])
        place = np.arange(every.shape[1]) - first
        self.rows = every[:, place < self.k]
        last = every[:, place == self.k - 1]
        self.floor[last[0]] = np.maximum(self.floor[last[0]], last[1])


def search_block(anchors: pa.Table, rows: pa.Table, k: int, same_label: bool) -> pa.Table:
    """The first ``k`` rows of each window of each anchor (columns ``low`` and ``high``: its windows' bounds).

    A window's ``floor`` is a score that ``k`` rows are known to reach.
    """
    out: list[pa.Table] = []
    dims = set(anchors["dim"].unique().to_pylist()) & set(rows["dim"].unique().to_pylist())
    for dim in sorted(dims):
        out.append(_search(anchors.filter(pc.equal(anchors["dim"], dim)),
                           rows.filter(pc.equal(rows["dim"], dim)), dim, k, same_label))
    return pa.concat_tables(out) if out else _hits(np.zeros((4, 0), np.int64), np.zeros(0, bool), np.zeros(0, np.int64))


def _hits(found: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> pa.Table:
    return pa.table({"anchor": found[0], "window": pa.array(found[1], pa.int32()), "score": found[2],
                     "found_row": found[3], "found_id": pa.array(ids, pa.int64(), mask=no_id)})


def _search(anchors: pa.Table, rows: pa.Table, dim: int, k: int, same_label: bool) -> pa.Table:
    n, m = anchors.num_rows, rows.num_rows
    a, b = _matrix(anchors["comps"], n), _matrix(rows["comps"], m)
    a_levels, b_levels = by_level(_matrix(anchors["summary"], n), dim), by_level(_matrix(rows["summary"], m), dim)
    # rounding of the bounds is far below this share of the largest possible score
    a_norm, b_norm = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (a, b))
    a_label, b_label = (np.asarray(t["label"]) for t in (anchors, rows))
    a_row, b_row = (np.asarray(t["row_id"]) for t in (anchors, rows))
    no_id = np.asarray(rows["vec_id"].is_null())
    ids = np.asarray(rows["vec_id"].fill_null(0))

    count = np.asarray(pc.list_value_length(anchors["low"])).astype(np.int64)
    owner, first = np.repeat(np.arange(n), count), np.cumsum(count) - count
    low, high, floor = (np.asarray(pc.list_flatten(anchors[name])) for name in ("low", "high", "floor"))
    best = _Best(len(owner), k, np.maximum(low, floor))
    for at in range(0, m, STEP):
        to = min(m, at + STEP)
        need = np.minimum.reduceat(best.floor, first)[:, None]
        most = np.maximum.reduceat(high, first)[:, None]
        wanted = (a_label[:, None] == b_label[at:to]) == same_label
        wanted &= a_row[:, None] != b_row[at:to]
        slack = 1e-9 * a_norm[:, None] * b_norm[at:to] + 1e-6
        for (am, ad), (bm, bd) in zip(a_levels, b_levels):
            some, those = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
            if not len(some):
                break
            cut = np.ix_(some, those)
            middle, spread = am[some] @ bm[at:to][those].T, ad[some] @ bd[at:to][those].T + slack[cut]
            wanted[cut] &= (middle + spread >= need[some]) & (middle - spread <= most[some])
        some, those = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not len(some):
            continue
        score = exact_scores(a[some], b[at:to][those])
        i, j = np.nonzero(wanted[np.ix_(some, those)])
        i, j, score = some[i], at + those[j], score[i, j]
        for w in range(int(count.max())):
            has = count[i] > w
            which = first[i] + w
            which[~has] = 0
            fits = has & (score >= best.floor[which]) & (score <= high[which])
            if fits.any():
                best.add(which[fits], score[fits], no_id[j[fits]], ids[j[fits]], j[fits])
    window, score, none, ids_found, row = best.rows
    return _hits(np.array([a_row[owner[window]], window - first[owner[window]], score, b_row[row]]), none.astype(bool), ids_found)


def _blocks(column: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(max(1, count))).cast("int")


def search(anchors: DataFrame, rows: DataFrame, parts: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, window, place, score, found_row, found_id): the first ``k`` rows of every window.

    ``anchors`` has ``block`` and its windows; ``rows`` has ``part``; ``parts`` is the number of parts.
    """
    blocks = anchors.agg(F.max("block")).first()[0]
    if blocks is None:
        blocks = 0
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(0, parts - 1)))))
    right = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(int(blocks)))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        return search_block(a, b, k, same_label)

    hits = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        meet, "anchor long, window int, score long, found_row long, found_id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _with_pilot(anchors: DataFrame, rows: DataFrame, parts: int, k: int, same_label: bool) -> DataFrame:
    """``search`` with floors raised by an exact search in the first part."""
    pilot = search(anchors, rows.where("part = 0"), 1, k, same_label)
    reached = pilot.where(F.col("place") == k).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    raised = anchors.join(reached, anchors["row_id"] == reached["anchor"], "left").withColumn("floor", F.expr(
        f"transform(floor, (x, i) -> greatest(x, coalesce(try_element_at(reached, i), {_LOW + 1}L)))")).drop("anchor", "reached")
    return search(raised, rows, parts, k, same_label)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST, block_anchors: int = BLOCK_ANCHORS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    prepared = base.mapInArrow(_prepared(scale), _ROW.replace("row_id long, ", ""))
    rows = stored(prepared.withColumn("row_id", F.monotonically_increasing_id()), "hardneg-rows")
    chosen = rows.where(is_anchor)
    block = _blocks(F.struct("row_id", F.lit("anchor")), -(-chosen.count() // block_anchors))
    chosen = stored(chosen.withColumn("block", block), "hardneg-anchors")
    parts = -(-rows.count() // block_rows)
    rows = rows.withColumn("part", _blocks(F.col("row_id"), parts))

    bound = lambda x: F.array(F.lit(x).cast("long"))
    seekers = chosen.withColumns({"low": bound(_LOW + 1), "high": bound(_HIGH), "floor": bound(_LOW + 1)})
    found = stored(_with_pilot(seekers, rows, parts, positives, True), "hardneg-positives")

    nth = F.sort_array(F.collect_list(F.struct("place", "score", F.col("found_id").alias("id"))))
    pairs = found.groupBy("anchor").agg(nth.alias("own"))
    # least * p <= 100 * n <= most * p over integers n; products of scores and percents as decimals, so they do not overflow
    exact = "cast(x.score as decimal(38,0))"
    windows = {
        "low": f"transform(own, x -> cast(ceil({least} * {exact} / 100) as long))",
        "high": f"transform(own, x -> cast(floor({most} * {exact} / 100) as long))"}
    seekers = stored(chosen.join(pairs, chosen["row_id"] == pairs["anchor"]).drop("anchor").withColumns(
        {name: F.expr(sql) for name, sql in windows.items()}).withColumn("floor", F.col("low")), "hardneg-windows")
    hits = _with_pilot(seekers.drop("own"), rows, parts, negatives, False)
    named = seekers.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id"), "own")
    return hits.join(named, "anchor").withColumn("positive", F.expr("own[window]")).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"))


#: The contract in SQL: every anchor's score with every row.
ORACLE = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT ar, anchor_id, br AS pr, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, br) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY ar, pr ORDER BY score DESC, id NULLS LAST, br) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s USING (ar)
WHERE NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
