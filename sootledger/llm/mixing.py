"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sootledger.llm.shared import cut, documents, packed, row_hash, running_start, unit_hash, unpacked, words

SHARE = 1.5
MOST = 2.0
WEIGHTS = (3.0, 1.0, 2.0)


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Sources, by code point with NULL last, get the weights in turn and share `share` times all
    sizes; a target stops at `most` times its source's size and what is above is shared anew by
    weight until no target is above. In closed form: by rising limit per weight, sources reach their
    limits one after the other, and the last level that all others can still pay for sets the rest.
    """
    rank = W.orderBy(F.col("source").isNull(), F.col("source"))
    weighted = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("k", F.row_number().over(rank) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * F.lit(most))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rising = W.orderBy("ratio", "k")
    levels = (
        weighted.withColumn("all", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("paid", F.coalesce(F.sum("limit").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(rising.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.col("paid")) / F.col("left"))
        .withColumn("open", F.col("ratio") > F.col("level"))
        .withColumn("water", F.min(F.when(F.col("open"), F.col("level"))).over(rising.rowsBetween(W.unboundedPreceding, 0)))
    )
    # The first source that does not reach its limit sets the level for all after it.
    target = F.when(F.col("water").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("weight") * F.first("water", ignorenulls=True).over(every.orderBy("ratio", "k")))
    )
    return levels.select("source", "source_size", target.alias("target"))


def systematic_copies(sizes: DataFrame, goals: DataFrame, seed: int = 11) -> DataFrame:
    """Add source_size, target and copies to rows (source, size, tie, ...).

    All documents of a source expect the same number of copies, target over size. Summed along the
    source in order of size and hash, plus one offset per source, the sum crosses integers; a
    document is taken once for each. Order by size spreads long and short documents evenly.
    """
    placed = running_start(
        sizes.withColumn("_one", F.lit(1).cast("long")), ["source", "size", "tie"], "_one", "_rank"
    )
    counts = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    # NULL comes first in the range order.
    firsts = goals.join(counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_source"), "source_size", "target",
        (F.sum("_n").over(W.orderBy(F.col("source").asc_nulls_first())) - F.col("_n")).alias("_first"),
    )
    each = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    offset = unit_hash(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull())
    before = F.col("_rank") - F.col("_first")
    crossed = F.floor(offset + (before + 1) * each) - F.floor(offset + before * each)
    joined = placed.join(firsts, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("copies", F.least(crossed, F.ceil(each)).cast("long")).drop("_one", "_rank", "_first", "_source")


def sized(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"),
        F.xxhash64("doc_id", F.col("text")).alias("tie"), *more,
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it: none, one or two rows; all columns stay, whatever their names.

    Repeated rows of one id and text count as one document that is that many times as long a run.
    NULL texts have size 0 and are taken like others; NULL sources are a source of their own.
    """
    columns = docs.columns
    marked = docs.select("doc_id", "source", "text", row_hash(docs).alias("_hash"), packed(columns).alias("_row"))
    sizes = cut(sized(marked, "_hash"))
    taken = systematic_copies(sizes, targets(sizes))
    taken = taken.groupBy("doc_id", "_hash").agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_times"))
    taken = taken.where("_all > 0").select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "_all", "_times")
    out = marked.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))
    if not taken.where("_times > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "_hash"])
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_all"))).select(*unpacked(columns))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(sized(documents(spark, sf_dir)))
    return systematic_copies(sizes, targets(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
