"""Operator 7: mixing sources to target weights by Efraimidis-Spirakis sampling.

Method: a source's target is its share by weight of ``share`` times all words,
stopped at ``most`` times its own words; the excess is shared anew by weight
until no source is above its stop.  Complete epochs come first: every document
of a source is taken floor(target / words) times.  For the rest, each document
draws the key ``-ln(u) / quality weight`` (u: from the MD5 of doc_id and text), and
documents are taken in key order until their words reach the rest.

The prefix sum needs no sort of a source: keys fall into ``CELLS`` cells by a
monotone map, cells are summed (pre-aggregated in each task) and prefix-summed
per source; only the documents of the one cell where a source's rest ends are
sorted.  A source with a third of all rows has a third of one cell's rows there.
Rows that repeat doc_id and text draw the same key and stand in that order as one
entry with a count; the source's end cuts at most one such entry, whose rows are
numbered in slices, so a row repeated for a third of the table fills no task.

Defined cases: null and word-less texts have size 0 and are never drawn (their
taken is 0); texts are counted whole at any length; a null source is a source of
its own, last in order; null or missing quality weighs ``UNLABELLED``; of rows that
repeat doc_id and text as many are taken as fit; ties of the key are ordered by
doc_id and text hash; an empty table gives an empty result; only the named columns
are read, so other columns can have any name.  The document on the edge is taken
if at least half of it fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.common import same, stored, text_key, word_count
from quitanda.operators.numbering import number_within

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
CELLS = 4096
#: Quality weights of documents labelled good, bad and not at all.
GOOD, BAD, UNLABELLED = 1.0, 0.25, 0.75


def sizes_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       text_key(F.col(text_col)).alias("text_key"), word_count(F.col(text_col)).alias("size"),
                       F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                                      F.coalesce(F.col(text_col), F.lit(""))).cast("binary")).alias("draw"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, weight, target.  Works on one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everyone = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                ((F.row_number().over(everyone) - 1) % len(weights) + 1)))
    cap = F.lit(most) * F.col("source_size")
    # sources reach their stop in the order of stop / weight: for each, the water
    # level left by those before it
    per = per.withColumns({"cap": cap, "ratio": cap / F.col("weight")})
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({"all_size": F.sum("source_size").over(whole), "all_weight": F.sum("weight").over(whole),
                           "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
                           "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    per = per.withColumn("level", (F.lit(share) * F.col("all_size") - F.col("cap_before"))
                         / (F.col("all_weight") - F.col("weight_before")))
    per = per.withColumn("stopped", F.col("level") >= F.col("ratio"))
    free = per.withColumn("water", F.min(F.when(~F.col("stopped"), F.struct("ratio", "level"))).over(whole)["level"])
    return free.select("source", "source_size", "weight", F.when(
        F.col("stopped"), F.col("cap")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def quality_weight(label: Column) -> Column:
    return F.when(label.isNull(), F.lit(UNLABELLED)).otherwise(F.lit(BAD) + F.lit(GOOD - BAD) * label)


def sampling_key() -> Column:
    """-ln(u) / weight; u in (0, 1) from the first 13 hex digits of ``draw``."""
    u = (F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.col("weight_of")


def mix(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        most: float = MOST, cells: int = CELLS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, source, size, source_size, target, copies, taken.

    ``labels`` (doc_id, quality 0 to 1) weighs documents; several labels of a document count by their mean.
    """
    base = sizes_of(docs, id_col, text_col, source_col)
    if labels is not None:
        known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("label"))
        base = base.join(known, "doc_id", "left")
    else:
        base = base.withColumn("label", F.lit(None).cast("double"))
    base = stored(base.withColumn("weight_of", quality_weight(F.col("label"))).select(
        "doc_id", "text_key", "source", "size", sampling_key().alias("key"), F.monotonically_increasing_id().alias("row"),
    ).withColumn("cell", F.floor(F.lit(cells) * (1 - F.exp(-F.col("key")))).cast("int")), "mixing-keys")

    plan = targets(base, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # words of a source in the cells before each cell
    filled = base.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("cell")
    filled = filled.withColumn("before", F.sum("words").over(up_to) - F.col("words"))
    edges = filled.join(plan.select(F.col("source").alias("s"), "rest"), same(F.col("source"), F.col("s"))).where(
        "before < rest and before + words >= rest").groupBy("source").agg(
        F.min(F.struct("cell", "before")).alias("e"))
    plan = plan.join(edges.select(F.col("source").alias("s"), "e"), same(F.col("source"), F.col("s")), "left").select(
        "source", "source_size", "target", "epochs", "rest", F.col("e.cell").alias("edge"),
        F.col("e.before").alias("edge_before"))
    plan = stored(plan, "mixing-plan").withColumnRenamed("source", "s")

    rows = base.join(plan, same(F.col("source"), F.col("s")), "left").drop("s")
    # without an edge, rounding has left the rest at the source's end or at 0
    chosen = F.when(F.col("edge").isNull(), F.col("rest") > 0).otherwise(F.col("cell") < F.col("edge"))
    outer = rows.where("edge is null or cell <> edge").withColumn("chosen", chosen)
    inner = rows.where("cell = edge")
    # equal rows are one entry of the order: entry i of n is taken if before + i * size - size / 2 <= rest
    entry = ["source", "key", "doc_id", "text_key", "size"]
    line = Window.partitionBy("source").orderBy("key", "doc_id", "text_key")
    entries = inner.groupBy(*entry).agg(F.count("*").alias("n"), F.min("rest").alias("rest"), F.min("edge_before").alias("edge_before"))
    entries = entries.withColumn("before", F.col("edge_before") + F.sum(F.col("n") * F.col("size")).over(line) - F.col("n") * F.col("size"))

    def end_of(i: Column) -> Column:
        return F.col("before") + i * F.col("size") - F.col("size") / 2

    guess = F.when(F.col("size") > 0, F.floor((F.col("rest") - F.col("before")) / F.col("size") + F.lit(0.5))).otherwise(F.lit(0))
    fits = guess + (end_of(guess + 1) <= F.col("rest")).cast("long") - (end_of(guess) > F.col("rest")).cast("long")
    entries = entries.select(*(F.col(c).alias(f"e_{c}") for c in entry), "n", F.greatest(F.lit(0), F.least(F.col("n"), fits)).alias("m"))
    inner = inner.join(entries, F.expr(" and ".join(f"{c} <=> e_{c}" for c in entry))).drop(*(f"e_{c}" for c in entry))
    whole = inner.where("m = 0 or m = n").withColumn("chosen", F.col("m") > 0).drop("m", "n")
    cut = inner.where("m > 0 and m < n")  # one entry of a source at most
    cut = number_within(cut, "source", ["row"], "place").withColumn("chosen", F.col("place") <= F.col("m")).drop("m", "n", "place")
    inner = whole.unionByName(cut)
    picked = outer.unionByName(inner)
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("chosen").cast("long")).otherwise(0)
    return picked.withColumn("copies", copies.cast("long")).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    taken = mix(docs, labels, id_col, text_col, source_col, **options).groupBy("doc_id", "text_key", "source").agg(
        F.min("copies").alias("copies"), F.max("copies").alias("most"), F.sum("copies").alias("total"), F.count("*").alias("n")).where(
        "total > 0").withColumn("more", F.col("total") - F.col("copies") * F.col("n"))
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(taken, same(F.col(f"row.{id_col}"), F.col("doc_id"))
                       & (text_key(F.col(f"row.{text_col}")) == F.col("text_key"))
                       & same(F.col(f"row.{source_col}"), F.col("source")))
    # of equal rows that are taken unequally often, the first ``more`` are taken once more
    even = joined.where("copies = most").select("row", "copies")
    uneven = joined.where("copies < most").withColumn("at", F.monotonically_increasing_id())
    uneven = number_within(uneven.withColumn("entry", F.xxhash64("doc_id", "text_key", "source")), "entry", ["at"], "place").select(
        "row", (F.col("copies") + (F.col("place") <= F.col("more")).cast("long")).alias("copies")).where("copies > 0")
    return even.unionByName(uneven).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


#: The contract's columns in SQL, with one sort of each source.
ORACLE = """
WITH marks AS (SELECT doc_id, avg(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)
         AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
      / CASE WHEN q IS NULL THEN 0.75 ELSE 0.25 + 0.75 * q END AS key
  FROM documents LEFT JOIN marks USING (doc_id)
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM docs GROUP BY source
), level AS (
  SELECT *, 2.0 * source_size / weight AS ratio,
    (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM per WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, CASE WHEN level >= ratio THEN 2.0 * source_size
    ELSE weight * (SELECT arg_min(level, ratio) FROM level WHERE level < ratio) END AS target FROM level
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS n FROM targets
), line AS (
  SELECT docs.doc_id, docs.size, e.source_size, e.target, e.n, e.target - e.n * e.source_size AS rest,
    sum(docs.size) OVER (PARTITION BY docs.source ORDER BY key, docs.doc_id, docs.text ROWS UNBOUNDED PRECEDING) AS until
  FROM docs JOIN epochs e ON docs.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (n + CASE WHEN size > 0 AND until - size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM line
"""
