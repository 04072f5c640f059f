"""Operator 5: quality rules with an isolation forest over their statistics.

Method: every whole text gives rule statistics (word and symbol counts, repeated
lines, words in repeated eight-word windows, letter case, punctuation).
An isolation forest of ``TREES`` random trees, each grown on ``SAMPLE`` good rows,
scores a document by its mean path length over the random splits; short paths
mean an unusual document.  The threshold on the score is calibrated on all
labelled rows: the most bad documents found while at most ``GOOD_LOSS`` of the
good ones go.

Bounds: the trees are grown from at most ``TREES * SAMPLE`` labelled rows, drawn
by a hash of their doc_id; statistics and scores cover every row, the threshold
every labelled one.  The forest (at most ``2 * SAMPLE`` nodes a tree) is the only broadcast.

Defined cases: null, empty and word-less texts have statistics 0, fail the base
rule and are not kept; without any label, the base rules alone decide; labels
that are null or repeat a doc_id count by their mean, rounded; repeated rows
score alike; very long texts are counted whole, in parts of a batch; an empty
table gives no rows; only the id and text columns are read, so others can have any
name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm import kernel as K
from quitanda.llm.common import arrays, stored

TREES, SAMPLE = 100, 1024
GOOD_LOSS = 0.002
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct_words")
_SEED = 7


def _byte_set(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_SYMBOLS = _byte_set("#*$%&|<>")
_MARKS = _byte_set("!?;:\"'()[]{}/\\_=+@~^`")
_UPPER = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The rule statistics of each text."""
    data, offsets = K.text_buffers(texts)
    n = len(offsets) - 1
    starts, ends, first = K.word_bounds(data, offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    in_word = ~K._IS_SEP[data]
    out = {"n_words": n_words, "word_chars": total(in_word & ((data & 0xC0) != 0x80)), "n_symbols": total(_SYMBOLS[data])}
    # lines: from each text start or line feed to the next; those without a word don't count
    feeds = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate((offsets[:-1], feeds + 1)))
    line_starts = line_starts[line_starts < len(data)]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    next_feed = np.concatenate((feeds, [len(data)]))[np.searchsorted(feeds, line_starts)]
    line_ends = np.minimum(next_feed, offsets[line_owner + 1]) if n else line_starts
    real = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_owner = line_starts[real], line_ends[real], line_owner[real]
    lines = _within(K._hash_spans(data, line_starts, line_ends, K._BYTE), line_owner)
    out["n_dup_lines"] = np.bincount(line_owner, minlength=n) - _distinct(lines, line_owner, n)
    words = K._hash_spans(data, starts, ends, K._BYTE)
    out["n_distinct_words"] = _distinct(_within(words, owner), owner, n)
    # windows found twice or more inside one text
    at = np.flatnonzero(np.arange(len(words)) + WINDOW <= np.repeat(first[1:], n_words))
    mark = np.zeros(len(words) + 1, np.int64)
    if len(at):
        windows = _within(K.shingle_hashes(words, WINDOW)[at], owner[at])
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        again = at[counts[inverse] > 1]
        np.add.at(mark, again, 1)
        np.add.at(mark, again + WINDOW, -1)
    covered = np.cumsum(mark[:-1]) > 0
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)
    for name, table in (("n_upper", _UPPER), ("n_marks", _MARKS)):
        out[name] = total(table[data])
    return {k: out[k].astype(np.int64) for k in STATS}


def _within(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside one text."""
    return K.mix64(hashes ^ K.mix64(owner.astype(np.uint64) + K.U64(1)))


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    _, at = np.unique(hashes, return_index=True)
    return np.bincount(owner[at], minlength=n)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch, "text", 1 << 20):
            got = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(got[k]) for k in STATS)],
                                             names=["doc_id", *STATS])


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the statistics and base_failed of every row of ``docs``."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    found = base.mapInArrow(_stats, f"doc_id {kind}, " + ", ".join(f"{k} long" for k in STATS))
    return found.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on, a row for each document: roots of ratios, which spread small ones."""
    s = {k: np.asarray(v, np.float64) for k, v in stats.items()}
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.sqrt(np.stack([
        s["n_symbols"] / chars, s["n_repeat_words"] / words, s["n_upper"] / chars, s["n_marks"] / chars,
        # different words, made comparable between lengths
        np.log(np.maximum(s["n_distinct_words"], 1)) / np.log(words + 1)], axis=1))


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, np.float64)
    m = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees as flat arrays.

    A tree is grown on usual rows, but cuts fall anywhere in the box of all
    rows, so that a row in a part of the box that holds no usual one is cut off
    by few splits.
    """

    def __init__(self, rows: np.ndarray, box: np.ndarray | None = None, trees: int = TREES, sample: int = SAMPLE,
                 seed: int = _SEED):
        rng = np.random.default_rng(seed)
        box = rows if box is None else np.concatenate((rows, box))
        low, high = box.min(0), box.max(0)
        self.sample = min(sample, len(rows))
        height = max(1, int(np.ceil(np.log2(max(self.sample, 2)))))
        self.trees = []
        for t in range(trees):
            own = rows[np.arange(t * sample, t * sample + self.sample) % len(rows)]
            self.trees.append(self._grow(own, low, high, rng, height))

    @staticmethod
    def _grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng, height: int) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, length = [], [], [], [], []

        def node(own: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            me = len(feature)
            for column, value in ((feature, -1), (cut, 0.0), (left, me), (right, me), (length, 0.0)):
                column.append(value)
            wide = np.flatnonzero(high > low)
            if depth >= height or len(own) <= 1 or not len(wide):
                length[me] = depth + float(_expected_path(len(own)))
                return me
            f = feature[me] = int(rng.choice(wide))
            cut[me] = float(rng.uniform(low[f], high[f]))
            below = own[:, f] < cut[me]
            top, bottom = high.copy(), low.copy()
            top[f] = bottom[f] = cut[me]
            left[me], right[me] = node(own[below], low, top, depth + 1), node(own[~below], bottom, high, depth + 1)
            return me

        node(rows, low, high, 0)
        return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for anomalies, below 0.5 for the usual."""
        total = np.zeros(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                here = at[inner]
                at[inner] = np.where(rows[inner, f[inner]] < cut[here], left[here], right[here])
            total += length[at]
        return 2.0 ** -(total / len(self.trees) / max(float(_expected_path(self.sample)), 1e-9))


def _scores(forest, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {k: batch.column(k).to_numpy() for k in STATS}
            score = forest.value.score(features(got)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*schema_names, "anomaly"])
    return run


def with_anomaly(stats: DataFrame, forest: Forest) -> DataFrame:
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([*stats.schema.fields, StructField("anomaly", DoubleType())])
    shared = stats.sparkSession.sparkContext.broadcast(forest)
    return stats.mapInArrow(_scores(shared, stats.columns), schema)


def fit(labelled: DataFrame, trees: int = TREES, sample: int = SAMPLE) -> Forest | None:
    """Forest of bounded samples of ``labelled`` (statistics, label): grown on good rows, in the box of all."""
    usual = _drawn(labelled.where("label = 1"), trees * sample)
    every = _drawn(labelled, trees * sample)
    if not len(every):
        return None
    return Forest(usual if len(usual) else every, every, trees, sample)


def _drawn(labelled: DataFrame, most: int) -> np.ndarray:
    """Features of at most ``most`` rows, drawn by a hash of doc_id."""
    n = labelled.count()
    draw = F.xxhash64(F.lit(_SEED), "doc_id")
    rows = labelled.withColumn("_draw", draw)
    if n > 2 * most:  # fewer rows to order; twice as many as are needed
        rows = rows.where(F.pmod(F.col("_draw"), F.lit(1 << 30)) < int(2 * most / n * (1 << 30)))
    return features(arrays(rows.orderBy("_draw", *STATS).select(*STATS).limit(most)))


def threshold(scored: DataFrame, good_loss: float = GOOD_LOSS) -> float:
    """Score above which a document is anomalous: at most ``good_loss`` of the good labelled rows exceed it.

    Among the thresholds allowed by that, the one with the most bad rows above and, of those, the highest.
    """
    steps = 2000
    bins = arrays(scored.groupBy(F.floor(F.col("anomaly") * steps).cast("int").alias("bin")).agg(
        F.sum((F.col("label") == 1).cast("long")).alias("good"),
        F.sum((F.col("label") == 0).cast("long")).alias("bad")))  # at most ``steps`` + 1 rows
    good, bad = np.zeros(steps + 2), np.zeros(steps + 2)
    good[bins["bin"]], bad[bins["bin"]] = bins["good"], bins["bad"]
    above_good = np.cumsum(good[::-1])[::-1]
    above_bad = np.cumsum(bad[::-1])[::-1]
    allowed = np.flatnonzero(above_good <= good_loss * good.sum())
    allowed = allowed[allowed > 0]
    if not len(allowed):
        return 2.0
    best = allowed[above_bad[allowed] == above_bad[allowed].max()].max()
    return best / steps


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, anomaly (null without labels), kept."""
    stats = stored(rule_statistics(docs, id_col, text_col), "quality-stats")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.round(F.avg("quality")).cast("int").alias("label"))
    labelled = stored(stats.join(known, "doc_id"), "quality-labelled")
    forest = fit(labelled.where("not base_failed"))
    if forest is None:
        return stats.withColumn("anomaly", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    # rows that fail the base rules are decided; the threshold is set on the others
    limit = threshold(with_anomaly(labelled.where("not base_failed"), forest))
    return with_anomaly(stats, forest).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(limit)))
