"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key divided by its quality weight (a hash
of its id gives the uniform number, so reruns agree); inside a source the
smallest keys come first. A source whose target is above its size is taken
in complete epochs first, the rest of the target is filled by the prefix of
the key order whose words sum up to it.

The prefix is found without putting a source in one task: keys are cut into
ranges, the ranges' sums give each range its offset, and running sums are
made per (source, range). What is kept per source is one cut point of the
key order, so applying the mix to whole rows needs no shuffle of texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import pin

WORD = "[^\\x20\\x09-\\x0D]+"
SOURCE_WEIGHTS = (5, 2, 1)  # by rank of the source's name, repeating
RANGE_ROWS = 2000  # rows of one (source, key range), on average; small sources have one range


def words(text) -> F.Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(id, weight): 2 for documents labelled good, 0.5 for bad ones; others weigh 1. The best label counts."""
    best = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("quality"))
    return best.select("id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight"))


def _sized(docs: DataFrame) -> DataFrame:
    """docs with _size and, for rows without an id, the text's hash _hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("_size", words(F.col("text"))).withColumn("_hash", F.when(F.col("doc_id").isNull(), F.md5(text)))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows without an id plus _nth, which counts up from 0 among rows of equal source and text.

    Which of such rows gets which number is left to their places (pinned, so
    that a repeated task agrees); rows are counted per partition first, so no
    group of equal ones meets in one task.
    """
    rows = pin(rows.withColumn("_part", F.spark_partition_id()))
    same = [F.col("source").eqNullSafe(F.col("_s")), F.col("_hash") == F.col("_h"), F.col("_part") == F.col("_p")]
    before = Window.partitionBy("_s", "_h").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("source").alias("_s"), F.col("_hash").alias("_h"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    starts = counts.select("_s", "_h", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("source", "_hash", "_part").orderBy(F.lit(0))) - 1
    return rows.withColumn("_own", own).join(starts, same).withColumn("_nth", F.col("_start") + F.col("_own")).drop(
        "_s", "_h", "_p", "_part", "_own", "_start")


def _keyed(sized: DataFrame, weights: DataFrame | None, seed: str) -> DataFrame:
    """Sized rows with their _weight and the key _key of the sampling order.

    The uniform number is a hash of the id; without an id, of the text and a repeat number.
    """
    known = sized.where("doc_id IS NOT NULL").drop("_hash")
    if weights is not None:
        known = known.join(weights.select(F.col("id").alias("_id"), F.col("weight").alias("_weight")),
                           F.col("doc_id") == F.col("_id"), "left").drop("_id")
    else:
        known = known.withColumn("_weight", F.lit(1.0))
    known = known.withColumn("_weight", F.coalesce("_weight", F.lit(1.0))).withColumn("_name", F.col("doc_id").cast("string"))
    nameless = _numbered(sized.where("doc_id IS NULL")).withColumn("_weight", F.lit(1.0)).withColumn(
        "_name", F.concat("_hash", F.lit(":"), F.col("_nth").cast("string"))).drop("_hash", "_nth")
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col("_name"))), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + 1) / float(16**12 + 1)
    return known.unionByName(nameless).withColumn("_key", -F.log(uniform) / F.col("_weight")).drop("_name")


def _place(key: F.Column, by: F.Column, n: F.Column) -> F.Column:
    """The share of a source's keys that is expected below ``key``; ``by`` lists (weight, rows) of the source."""
    below = F.aggregate(by, F.lit(0.0), lambda sum_, x: sum_ + x["n"] * (1 - F.exp(-x["w"] * key)))
    return below / n


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    ``share`` times all words are shared by weight; a target stops at ``most``
    times its source's size, and the excess goes to the others by weight. In
    order of most * size / weight the sources that stop come first, so one
    running sum over the sources (one row each) finds the level of the rest.
    It runs in one task, which is meant for up to some millions of sources.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, SOURCE_WEIGHTS)), (rank % len(SOURCE_WEIGHTS) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.cast("double").alias("w")).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    s = s.withColumn("level", (F.sum("source_size").over(every) * share - before)
                     / F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("w"))
    s = s.withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    return s.select("source", "source_size",
                    F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("w")).alias("target"))


def plan(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, most: float = 2.0,
         seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(keyed narrow rows, plan per source).

    Plan columns: source, source_size, target, epochs, cut: every document of
    the source is taken ``epochs`` times, and once more if its
    (key, doc_id, size) is not above ``cut`` (null: none).
    """
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    rows = pin(_keyed(_sized(narrow).drop("text"), weights, seed))
    # weights by power of two: at most some 2,000 rows a source
    grade = F.floor(F.log2("_weight")).cast("double")
    sizes = rows.groupBy("source", grade.alias("_grade")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("n"))
    sizes = pin(sizes.groupBy("source").agg(
        F.sum("source_size").alias("source_size"), F.sum("n").alias("n"),
        F.sort_array(F.collect_list(F.struct(F.pow(F.lit(2.0), F.col("_grade")).alias("w"), "n"))).alias("by")))
    goal = targets(sizes.select("source", "source_size"), share, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goal = pin(goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    ranges = sizes.select(F.col("source").alias("_of"), (F.floor(F.col("n") / RANGE_ROWS) + 1).alias("_ranges"),
                          F.col("by").alias("_by"), F.col("n").alias("_rows"))
    cut_in = rows.join(ranges, F.col("source").eqNullSafe(F.col("_of"))).withColumn(
        "range", F.floor(_place(F.col("_key"), F.col("_by"), F.col("_rows")) * F.col("_ranges"))).drop("_of", "_ranges", "_by", "_rows")
    sums = cut_in.groupBy("source", "range").agg(F.sum("_size").alias("sum"))
    offset = F.sum("sum").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(offset, F.lit(0)).alias("offset"))
    # a range is needed only if the rest of the target ends in it or after it
    sums = sums.join(goal.select(F.col("source").alias("g"), "rest"), F.col("s").eqNullSafe(F.col("g"))).where("offset < rest")
    near = Window.partitionBy("source", "range").orderBy("_key", "doc_id", "_size")
    run = F.sum("_size").over(near.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = cut_in.withColumn("run", run).join(
        sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).where(
        F.col("offset") + F.col("run") - F.col("_size") / 2 <= F.col("rest"))
    cuts = picked.groupBy(F.col("source").alias("c")).agg(F.max(F.struct("_key", "doc_id", "_size")).alias("cut"))
    made = goal.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left")
    return rows, pin(made.select("source", "source_size", "target", F.col("epochs").cast("int"), "cut"))


def apply_plan(rows: DataFrame, made: DataFrame) -> DataFrame:
    """rows (with source, _key, doc_id, _size) plus source_size, target and copies, how often the mix takes them."""
    made = made.withColumnRenamed("source", "_source")
    more = F.struct("_key", "doc_id", "_size") <= F.col("cut")
    return rows.join(made, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "copies", F.col("epochs") + F.coalesce(more.cast("int"), F.lit(0))).drop("_source", "cut", "epochs")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, most: float = 2.0,
                seed: str = "mix") -> DataFrame:
    """How often the mix takes each document.

    In: doc_id, source, text (other columns are ignored); weights (id,
    weight > 0) scales a document's chance, 1 where it has no row. Out, one
    row per input row: doc_id, source, size, source_size, target, copies and
    taken = copies * size.

    A null source is a source of its own (last in order); null and empty texts
    have size 0. Rows that repeat an id and a size share one fate; rows without
    an id are each decided on their own, and of those equal in source and text
    only how many are taken is fixed. A source of size 0 has target 0. An
    empty table gives no rows.
    """
    rows, made = plan(docs, weights, share, most, seed)
    return apply_plan(rows, made).select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target",
                                         "copies", (F.col("copies") * F.col("_size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, most: float = 2.0,
                    seed: str = "mix") -> DataFrame:
    """The mix itself: every input row, all its columns, repeated as often as the mix takes it.

    Null ids, sources and texts, repeated rows and ties are decided as in
    ``mix_sources``; a null or empty text is taken with its source's epochs
    like any other. Columns of any other name pass through. An empty table
    gives no rows.
    """
    _, made = plan(docs, weights, share, most, seed)
    plain = ("doc_id", "source", "text")
    safe = docs.select(*[F.col(f"`{c}`").alias(c if c in plain else f"_{i}") for i, c in enumerate(docs.columns)])
    got = apply_plan(_keyed(_sized(safe), weights, seed), made).where("copies > 0")
    return got.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *[F.col(c if c in plain else f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
