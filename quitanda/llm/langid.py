"""Operator 9: language identification by character Kneser-Ney models.

Training counts the character n-grams of the highest order over all labelled
training rows: tasks sum what they see, a group-by adds the partial counts.
Lower orders use continuation counts (the number of different left
neighbours), as interpolated Kneser-Ney asks.  Grams are kept as the strings
they are, so different grams never share a count, and the model is a set of
written tables that grow with the corpus: nothing of it but the languages'
names reaches the driver, and nothing is broadcast by us.

Scoring deals the documents by a hash of the row and its place in the table into
groups of about ``GROUP_CHARS`` characters, so copies spread over the groups.  A
task goes through its groups one after another and holds the different grams of
one.  These are joined with the model's tables, a gram once for every
``GROUPS_OF_A_ROW`` groups, and come back to their group with one log probability
a language; there they are added up by document.

A text is scored by the mean negative log probability of its characters under
each language; the lowest wins.  ``score`` is the softmax of the mean log
probabilities (sharpened by the text's length, at most 50 characters) at the
winner.  A text is rejected when its cross-entropy exceeds the limit calibrated
on the training rows, or when it is null or has no letter.

Defined cases: null lang rows never train; null, empty and letterless texts give
``und``, score 0, rejected; with no training rows at all every text does.
Texts are scored whole, in slices of bounded size; repeated rows score alike; an
empty table gives an empty result.  ``identify`` and ``keep_identified`` leave
columns of any name alone; ``score`` replaces those it is told to add.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from quitanda.llm import kernel as K
from quitanda.llm.common import stored

ORDER = 4
UNKNOWN = "und"
DISCOUNT = 0.75
#: Size of the character inventory behind the unigrams.
CHARACTERS = 1 << 16
#: The limit of a language: this many times the median cross-entropy of its training texts ...
REJECT_FACTOR = 1.75
#: ... and so many quartile distances above it; a text is rejected when it
#: exceeds the limit by this many nats in all, so that short texts aren't lost by chance.
REJECT_SPREAD, REJECT_NATS = 16.0, 30.0
#: The softmax of ``score`` counts at most so many characters.
SCORE_CHARS = 50
#: Characters scored at a time.
SLICE = 1 << 19
#: Characters a task holds before it counts them; counting takes some 60 bytes for each.
HOLD = 1 << 20
#: Characters of a group of documents that are scored together.
GROUP_CHARS = 1 << 22
#: Groups that are listed in one row beside a gram they need.
GROUPS_OF_A_ROW = 1024


def _letter_table() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, a space for anything else."""
    table = np.full(0x10000, 32, np.uint32)
    for c in range(0x10000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_tables: dict[str, np.ndarray] = {}


def letters(text: str) -> np.ndarray:
    """Code points: letters in lower case, each run of other characters one space, a space at both ends.

    Letters beyond the basic plane count as they are.  Empty if the text has no letter.
    """
    if "letters" not in _tables:
        _tables["letters"] = _letter_table()
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(code < 0x10000, _tables["letters"][code & 0xFFFF], code)
    astral = np.flatnonzero(code >= 0x10000)
    for i in astral:
        if not chr(code[i]).isalpha():
            out[i] = 32
    out = np.concatenate(([32], out, [32])).astype(np.uint32)
    space = out == 32
    if space.all():
        return np.zeros(0, np.uint32)
    return out[~(space & np.concatenate(([False], space[:-1])))]


def _gram_hash(code: np.ndarray, begin: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each of the places ``at`` (before its text: the leading space again)."""
    h = np.full(len(at), n, np.uint64)
    base = K.U64(1)
    for back in range(n):
        h += (code[np.maximum(at - back, begin)].astype(np.uint64) + K.U64(1)) * base
        base = K.U64((int(base) * 0xD6E8FEB86659FD93) % (1 << 64))
    return K.mix64(h)


def _predicted(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, begin of their texts) of all characters but the leading space of each text."""
    size = np.diff(first)
    begin = np.repeat(first[:-1], size - 1)
    return begin + 1 + np.arange(len(begin)) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1), begin


def gram_chain(code: np.ndarray, begin: np.ndarray, at: np.ndarray, order: int, bits: int | None = None) -> np.ndarray:
    """The grams that end at the places ``at``, as strings; suffixes and contexts are parts of them.

    ``bits`` is accepted for older callers and has no effect.
    """
    columns = [code[np.maximum(at - back, begin)] for back in range(order - 1, -1, -1)]
    return np.ascontiguousarray(np.stack(columns, axis=1), np.uint32).view(f"<U{order}")[:, 0]


def _string_hash(grams: np.ndarray, order: int) -> np.ndarray:
    """``_gram_hash`` of grams given as strings."""
    code = np.ascontiguousarray(grams.astype(f"<U{order}")).view(np.uint32)
    begin = np.arange(0, len(code), order)
    return _gram_hash(code, begin, begin + order - 1, order)


def _sliced(code: np.ndarray) -> list[np.ndarray]:
    """A long text in overlapping slices whose predicted characters add up to the text's (but for its first few)."""
    if len(code) <= SLICE:
        return [code]
    return [code[max(0, a - 1):a + SLICE] for a in range(0, len(code), SLICE)]


def _counted(codes: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, grams, counts) of the different grams of some texts."""
    code = np.concatenate(codes)
    at, begin = _predicted(np.concatenate(([0], np.cumsum(list(map(len, codes))))))
    keys, pick, counts = np.unique(_gram_hash(code, begin, at, order), return_index=True, return_counts=True)
    return keys, gram_chain(code, begin[pick], at[pick], order), counts


def _pieces(text: str | None) -> list[np.ndarray]:
    return [x for x in _sliced(letters(text)) if len(x) > 1] if text else []


def _count(order: int):
    """Partial counts: lang, gram, c."""
    def rows(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, codes in held.items():
            _, grams, counts = _counted(codes, order)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for part in K.chunks(batch, "text", SLICE):
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    for x in _pieces(text):
                        held.setdefault(lang, []).append(x)
                        size += len(x)
                        if size >= HOLD:
                            yield from rows(held)
                            held, size = {}, 0
        yield from rows(held)
    return run


@dataclass
class Model:
    """For each order n a written table of (lang, gram, c): counts at the highest order, continuation counts below."""
    langs: list[str]
    order: int
    levels: dict[int, DataFrame]

    def _by_language(self, n: int, key: Column, **values: Column) -> DataFrame:
        """One row for each ``key`` with a column of each value for each language, named by the language's place."""
        return self.levels[n].groupBy(key.alias(f"key{n}")).agg(*(
            F.coalesce(F.sum(F.when(F.col("lang") == lang, value)), F.lit(0)).cast("double").alias(f"{name}{n}_{i}")
            for name, value in values.items() for i, lang in enumerate(self.langs)))

    def with_logs(self, rows: DataFrame) -> DataFrame:
        """``rows`` (gram, ...), one for each gram, with the log probability l0, l1, ... of its last character in each language."""
        keep = rows.columns
        for n in range(1, self.order + 1):
            suffix = F.substring("gram", self.order - n + 1, n)
            grams = self._by_language(n, F.col("gram"), c=F.col("c"))
            rows = rows.withColumn(f"key{n}", suffix).join(grams, f"key{n}", "left").drop(f"key{n}")
            contexts = self._by_language(n, F.substring("gram", 1, n - 1), t=F.col("c"), u=F.lit(1))
            if n == 1:  # one row: the empty context
                rows = rows.crossJoin(F.broadcast(contexts)).drop(f"key{n}")
            else:
                rows = rows.withColumn(f"key{n}", F.substring("gram", self.order - n + 1, n - 1)).join(
                    contexts, f"key{n}", "left").drop(f"key{n}")
            lower = [F.col(f"p{i}") if n > 1 else F.lit(1.0 / CHARACTERS) for i in range(len(self.langs))]
            rows = rows.select(*keep, *(
                F.when(F.col(f"t{n}_{i}") > 0, (
                    F.greatest(F.coalesce(F.col(f"c{n}_{i}"), F.lit(0.0)) - DISCOUNT, F.lit(0.0))
                    + DISCOUNT * F.col(f"u{n}_{i}") * p) / F.col(f"t{n}_{i}")).otherwise(p).alias(f"p{i}")
                for i, p in enumerate(lower)))
        return rows.select(*keep, *(F.log(F.greatest(F.col(f"p{i}"), F.lit(1e-12))).alias(f"l{i}")
                                    for i in range(len(self.langs))))

    def log_probabilities(self, chain: np.ndarray) -> np.ndarray:
        """Log probability under each language of the last character of each of a few grams."""
        grams, inverse = np.unique(chain, return_inverse=True)
        rows = self.levels[self.order].sparkSession.createDataFrame([(str(g),) for g in grams], "gram string")
        logs = {r[0]: r[1:] for r in self.with_logs(rows).collect()}
        return np.array([logs[str(g)] for g in grams])[inverse]

    def of_characters(self, code: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log probability under each language of every predicted character of a few texts."""
        at, begin = _predicted(first)
        return self.log_probabilities(gram_chain(code, begin, at, self.order))


def train(docs: DataFrame, order: int = ORDER, bits: int | None = None) -> Model | None:
    """Model of all rows of ``docs`` (text, lang); None if nothing can be learned.

    ``bits`` is accepted for older callers and has no effect: grams are not hashed into slots.
    """
    rows = docs.where("text is not null and lang is not null").select(
        F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        _count(order), "lang string, gram string, c long")
    levels = {order: stored(rows.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "langid-grams")}
    langs = sorted(r.lang for r in levels[order].select("lang").distinct().toLocalIterator())
    if not langs:
        return None
    for n in range(order - 1, 0, -1):  # continuation counts: different left neighbours
        levels[n] = stored(levels[n + 1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(
            F.count("*").alias("c")), "langid-grams")
    return Model(langs, order, levels)


def _needed(order: int, text_col: str, group_col: str):
    """The different grams of each group of documents: grp, gram.  Rows come group by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[np.ndarray] = []
        known = np.zeros(0, np.uint64), np.zeros(0, f"<U{order}")
        size = 0

        def settled() -> tuple[np.ndarray, np.ndarray]:
            if not held:
                return known
            keys, grams, _ = _counted(held, order)
            keys, grams = np.concatenate((known[0], keys)), np.concatenate((known[1], grams))
            keys, pick = np.unique(keys, return_index=True)
            return keys, grams[pick]

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(known[1]), now, np.int64)), pa.array(known[1], pa.string())], names=["grp", "gram"])

        for batch in batches:
            for part in K.chunks(batch, text_col, SLICE):
                for text, group in zip(part.column(text_col).to_pylist(), part.column(group_col).to_pylist()):
                    if group != now:
                        known = settled()
                        if len(known[1]):
                            yield rows()
                        now, held, size = group, [], 0
                        known = np.zeros(0, np.uint64), np.zeros(0, f"<U{order}")
                    for x in _pieces(text):
                        held.append(x)
                        size += len(x)
                        if size >= HOLD:
                            known, held, size = settled(), [], 0
        known = settled()
        if len(known[1]):
            yield rows()
    return run


def _score(langs: list[str], order: int, text_col: str, group_col: str, added: list[str]):
    def run(docs: pa.Table, given: pa.Table) -> pa.Table:
        keys = _string_hash(given["gram"].to_numpy(), order) if given.num_rows else np.zeros(0, np.uint64)
        by_key = np.argsort(keys)
        keys = keys[by_key]
        logs = np.stack([given[f"l{i}"].to_numpy() for i in range(len(langs))], axis=1)[by_key]
        rest = docs.drop_columns([group_col])
        parts = [_scored(part, keys, logs) for batch in rest.to_batches() for part in K.chunks(batch, text_col, SLICE)]
        return pa.Table.from_batches(parts or [_scored(rest.schema.empty_table().combine_chunks().to_batches()[0], keys, logs)])

    def _scored(part: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
        texts = part.column(text_col).to_pylist()
        sums, chars = np.zeros((len(texts), len(langs))), np.zeros(len(texts), np.int64)
        codes, owner = [], []
        for i, text in enumerate(texts):
            for x in _pieces(text):
                codes.append(x)
                owner.append(i)
        while codes:  # slices of about SLICE characters at a time
            take = max(1, int(np.searchsorted(np.cumsum(list(map(len, codes))), SLICE)))
            now, own = codes[:take], np.array(owner[:take])
            codes, owner = codes[take:], owner[take:]
            size = np.array(list(map(len, now)))
            at, begin = _predicted(np.concatenate(([0], np.cumsum(size))))
            key = _gram_hash(np.concatenate(now), begin, at, order)
            at = np.searchsorted(keys, key)
            if at.max() >= len(keys) or (keys[at] != key).any():
                raise RuntimeError("a gram of a document has no probability: its group was dealt differently twice")
            starts = np.cumsum(size - 1) - (size - 1)
            np.add.at(sums, own, np.add.reduceat(logs[at], starts, axis=0, dtype=np.float64))
            np.add.at(chars, own, size - 1)
        mean = sums / np.maximum(chars, 1)[:, None]
        best = mean.argmax(1)
        gap = (mean - mean[np.arange(len(mean)), best][:, None]) * np.minimum(chars, SCORE_CHARS)[:, None]
        score = np.where(chars > 0, 1.0 / np.exp(gap).sum(1), 0.0)
        ce = -mean[np.arange(len(mean)), best]
        pred = [langs[b] if n else UNKNOWN for b, n in zip(best, chars)]
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(np.where(chars > 0, ce, 0.0)),
             pa.array(chars)], names=[*part.schema.names, *added])
    return run


#: Columns that ``score`` adds.
ADDED = ["lang_pred", "score", "cross_entropy", "scored_chars"]


def score(docs: DataFrame, model: Model | None, text_col: str = "text", added: list[str] = ADDED) -> DataFrame:
    """``docs`` with the prediction, score, cross-entropy and scored characters in the columns ``added``.

    A document's own columns of these names are replaced.
    """
    docs = docs.drop(*added)
    if model is None:
        none = (F.lit(UNKNOWN), F.lit(0.0), F.lit(0.0), F.lit(0).cast("long"))
        return docs.withColumns(dict(zip(added, none)))
    spark = docs.sparkSession
    kinds = (StringType(), DoubleType(), DoubleType(), LongType())
    schema = StructType([*docs.schema.fields, *map(StructField, added, kinds)])
    group = _free("langid_group", docs.columns)
    text = F.col(f"`{text_col}`")
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    groups = max(chars // GROUP_CHARS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    # both uses below share one exchange of the documents; equal rows differ by their place
    dealt = docs.withColumn(group, F.pmod(F.xxhash64(*plain, F.monotonically_increasing_id()), F.lit(groups))).repartition(group)
    needed = dealt.sortWithinPartitions(group).mapInArrow(_needed(model.order, text_col, group), "grp long, gram string")
    listed = needed.groupBy("gram", F.floor(F.col("grp") / GROUPS_OF_A_ROW).alias("some")).agg(
        F.collect_list("grp").alias("grps")).drop("some")
    given = model.with_logs(listed).select(
        F.explode("grps").alias("grp"), "gram", *(F.col(f"l{i}").cast("float") for i in range(len(model.langs))))
    return dealt.groupBy(group).cogroup(given.groupBy("grp")).applyInArrow(
        _score(model.langs, model.order, text_col, group, added), schema)


def _free(name: str, taken: list[str]) -> str:
    """``name``, with underscores until no column has it."""
    while name.lower() in (c.lower() for c in taken):
        name += "_"
    return name


def limits(scored: DataFrame) -> dict[str, float]:
    """Cross-entropy limit of each language, from scored training rows."""
    rows = scored.where("scored_chars > 0").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", [0.5, 0.75], 10_000).alias("q"))
    return {r.lang_pred: max(r.q[0] * REJECT_FACTOR, r.q[0] + REJECT_SPREAD * (r.q[1] - r.q[0]))
            for r in rows.toLocalIterator()}


def rejected(limit: dict[str, float]) -> Column:
    """True for rows without a letter and for those far beyond their language's limit."""
    over = F.lit(False)
    for lang, most in limit.items():
        over = over | ((F.col("lang_pred") == lang)
                       & ((F.col("cross_entropy") - F.lit(most)) * F.col("scored_chars") > REJECT_NATS))
    return (F.col("scored_chars") == 0) | over


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text, modulo 4, is 2 (null ids train)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, cross_entropy, scored_chars, rejected."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(base.where(~held_out()).select("text", "lang"))
    found = stored(score(base.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), *ADDED), "langid-scores")
    return found.withColumn("rejected", rejected(limits(found.where("not held_out"))))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that ``identify`` rejects."""
    known = ~held_out(id_col)
    model = train(docs.where(known).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    added = [_free(name, docs.columns) for name in ADDED]
    found = stored(score(docs, model, text_col, added), "langid-kept")
    training = found.where(known).select(*(F.col(a).alias(b) for a, b in zip(added, ADDED)))
    named = found.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         *(F.col(a).alias(b) for a, b in zip(added, ADDED)))
    return named.where(~rejected(limits(training))).select("row.*")
