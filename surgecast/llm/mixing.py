"""Operator 6 - mixing sources to target weights (DataFrame functions only).

Targets. Sources share the whole volume by weight; a target stops at
``most`` times its source's size and the excess is shared again by weight
until none is above. Closed form: with sources in order of cap / weight, the
first ones are at their cap and the others get ``level * weight``.

Sampling (Efraimidis-Spirakis). Each document has the key -ln(u) / w: u is
uniform from a hash of its id, w its quality weight. A source's target is
taken as complete epochs over all its documents, then as the documents with
the smallest keys until their running size reaches the rest. Equal input
gives equal output on every run.

Running sums of a hot source are not one task's work: keys fall into
``CELLS`` cells per source; cell totals are summed up first (at most CELLS
rows a source), and only the cell in which the budget ends is sorted row by
row, rows that repeat doc_id and text as one with a count. Where the budget ends
among such rows, as many of them are taken as fit: they are numbered within
their partitions, with the counts of the partitions before, not in one task.

Defined results: null text has size 0; null source is a source of its own,
last in the order; documents of size 0 are taken 0 times; repeated rows count
as separate documents (with the same key, in the order of their text hash), any
of which may be the ones taken; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgecast.llm import common as C

WEIGHTS = (1, 2, 3)
MOST = 3
CELLS = 1 << 13


def words_of(text: Column) -> Column:
    """The words of a text as an array (null: empty)."""
    # the separators before the first and after the last word make empty ends
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def quality(words: Column) -> Column:
    """Quality weight of a document: a quarter, plus three quarters of its
    share of distinct words. Repetitive text is taken later."""
    n = F.size(words)
    return F.when(n > 0, 0.25 + 0.75 * F.size(F.array_distinct(words)) / n).otherwise(F.lit(0.25))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per
    source: the only rows that one task handles together here."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * float(most))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / weight_left)
    # in this order the first source below its cap fixes the level of the rest
    level = F.first(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.col("level")), ignorenulls=True).over(
        Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return ranked.withColumn("share", level).select("source", "source_size", F.least("cap", F.coalesce(F.col("share") * F.col("w"), F.col("cap"))).alias("target"))


def _keyed(docs: DataFrame, cells: int) -> DataFrame:
    """``docs`` with ``_th``, ``_size``, ``_key``, ``_cell`` and ``_name``."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string")), 11) + 0.5) * 2.0**-53
    rows = docs.withColumns({"_th": F.xxhash64(F.col("text").cast("string")), "_u": u, "_words": words_of(F.col("text"))})
    rows = rows.withColumns({"_size": F.size("_words").cast("long"), "_key": -F.log("_u") / quality(F.col("_words"))}).drop("_u", "_words")
    # keys lie in (0, inf), mostly below 4: an even spread over the cells
    cell = F.least(F.lit(cells - 1), F.floor((1 - F.exp(-F.col("_key"))) * cells)).cast("int")
    return rows.withColumns({"_cell": cell, "_name": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))})


_ORDER = ("_key", "_id", "_th")


def plan_sources(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source_size, target, epochs, and what the
    fractional epoch takes: all cells below ``last``, within it the documents
    up to ``bound`` (key, id, th), of the rows that repeat the next one
    (``part``) the first ``part_take``, and one more (``filler``, which
    ``filler_rows`` rows repeat): of those left the one whose size comes
    nearest to what is then missing."""
    sums = slim.groupBy("_name").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"))
    plan = targets(sums.select("source", "source_size"), weights, most)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = C.cut(plan.withColumn("_name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    # one row per source on the other side: no shuffle of documents by source
    few = F.broadcast if plan.count() <= MOST_BROADCAST else (lambda df: df)
    per_cell = slim.groupBy("_name", "_cell").agg(F.sum("_size").alias("cell_size"))
    up_to = Window.partitionBy("_name").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.withColumn("before", F.coalesce(F.sum("cell_size").over(up_to), F.lit(0)))
    # the cell in which the rest is used up: at most one per source
    last = per_cell.join(few(plan.select("_name", "rest")), "_name").where("before < rest and before + cell_size >= rest")
    last = last.select("_name", "rest", F.col("_cell").alias("last"), "before")
    inside = slim.join(few(last), "_name").where("_cell = last")
    inside = inside.groupBy("_name", "rest", "before", *_ORDER).agg(F.first("_size").alias("_size"), F.count(F.lit(1)).alias("rows"))
    running = Window.partitionBy("_name").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("done", F.col("before") + F.sum(F.col("_size") * F.col("rows")).over(running))
    whole, at = F.col("done") <= F.col("rest"), F.struct(*_ORDER)
    # of the first rows that do not fit as a whole, as many as fit
    fit = F.floor(F.try_divide(F.col("rest") - F.col("done"), F.col("_size")) + F.col("rows") + 1e-12)
    part = F.struct(at.alias("at"), fit.alias("take"), "_size")
    bound = inside.groupBy("_name").agg(F.max(F.when(whole, at)).alias("bound"), F.max(F.when(whole, F.col("done"))).alias("done"), F.min(F.when(~whole, part)).alias("part"))
    last = last.join(bound, "_name", "left").withColumn("part_take", F.coalesce("part.take", F.lit(0)))
    gap = F.col("rest") - F.coalesce("done", "before") - F.coalesce(F.col("part_take") * F.col("part._size"), F.lit(0))
    last = C.cut(last.select("_name", "last", "bound", F.when(F.col("part_take") > 0, F.col("part.at")).alias("part"), "part_take", gap.alias("gap")))
    left = slim.where("_size > 0").join(few(last), "_name").where((F.col("_cell") > F.col("last")) | ((F.col("_cell") == F.col("last")) & (F.col("bound").isNull() | (at > F.col("bound")))))
    off = F.abs(F.col("gap") - F.col("_size"))
    nearest = left.groupBy("_name", *_ORDER).agg(F.min(off).alias("off"), F.count(F.lit(1)).alias("rows"), F.first("gap").alias("gap"))
    nearest = nearest.groupBy("_name").agg(F.min(F.struct("off", at.alias("at"), "rows")).alias("f"), F.first("gap").alias("gap"))
    filler = nearest.where("f.off < gap").select("_name", F.col("f.at").alias("filler"), F.col("f.rows").alias("filler_rows"))
    plan = plan.drop("source").join(last.drop("gap"), "_name", "left").join(filler, "_name", "left")
    more = F.coalesce(F.col("filler") == F.col("part"), F.lit(False))  # one more of the same rows
    plan = plan.withColumn("part_take", F.col("part_take") + more.cast("long")).withColumn("filler", F.when(~more, F.col("filler")))
    return C.cut(plan)


MOST_BROADCAST = 20_000  # sources; a row has under 200 bytes


def _decided(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """Keyed rows with the plan of their source and ``copies``."""
    small = plan.count() <= MOST_BROADCAST
    rows = rows.join(F.broadcast(plan) if small else plan, "_name")
    at, no = F.struct(*_ORDER), F.lit(False)
    below = F.coalesce(F.col("_cell") < F.col("last"), no) | F.coalesce((F.col("_cell") == F.col("last")) & (at <= F.col("bound")), no)
    here = F.when(F.col("last").isNull(), F.col("rest") > 0).otherwise(below | F.coalesce((at == F.col("filler")) & (F.col("filler_rows") == 1), no))
    # of rows that repeat one another only some are taken
    some = F.when(F.coalesce(at == F.col("part"), no), F.col("part_take")).when(F.coalesce((at == F.col("filler")) & (F.col("filler_rows") > 1), no), F.lit(1))

    def with_copies(df: DataFrame, extra: Column) -> DataFrame:
        times = F.when(F.col("_size") > 0, F.least(F.lit(most), F.col("epochs") + extra.cast("long"))).otherwise(0)
        return df.withColumn("copies", times.cast("int"))

    if plan.where("part_take > 0 or filler_rows > 1").isEmpty():
        return with_copies(rows, here)
    rows = rows.withColumn("_some", some)
    tied = C.cut(rows.where("_some is not null")).withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    same = ["_name", *_ORDER]
    tied = C.cut(tied)
    parts = tied.groupBy(*same, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))).drop("_rows")
    place = F.row_number().over(Window.partitionBy(*same, "_part").orderBy("_m")) + F.col("_ahead")
    tied = with_copies(tied.join(parts, [*same, "_part"]).withColumn("_place", place), F.col("_place") <= F.col("_some"))
    plain = with_copies(rows.where("_some is null"), here)
    return plain.unionByName(tied.select(*plain.columns))


def _slim(keyed: DataFrame) -> DataFrame:
    return C.cut(keyed.select(F.col("doc_id").alias("_id"), "source", "_th", "_size", "_key", "_cell", "_name"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, cells: int = CELLS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, size, source,
    source_size, target, ``copies`` (times taken), taken (words)."""
    slim = _slim(_keyed(docs.select("doc_id", "text", "source"), cells))
    rows = _decided(slim, plan_sources(slim, weights, most), most)
    return rows.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source", "source_size", "target", "copies", (F.col("_size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, cells: int = CELLS) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it. Texts
    stay where the scan puts them: a row is decided by its own key and the
    plan of its source."""
    names = [f"`{c}`" for c in docs.columns]
    base = docs.select(F.struct(*names).alias("_row"), "doc_id", "text", "source")
    keyed = _keyed(base, cells).withColumn("_id", F.col("doc_id"))
    slim = _slim(_keyed(docs.select("doc_id", "text", "source"), cells))
    rows = _decided(keyed, plan_sources(slim, weights, most), most).where("copies > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(C.read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
