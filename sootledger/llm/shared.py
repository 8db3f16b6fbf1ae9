"""Helpers of this subpackage: shared folders, lineage cuts, running totals, components, bounded samples."""

from __future__ import annotations

import re
import tempfile
import uuid
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: words are the longest runs without these characters.
SPACES = r"[\x20\x09-\x0D]"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the session names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; a cluster
    session without it raises.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="sootledger-llm-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages and retries start from shared files."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back."""
    spark, schema = df.sparkSession, df.schema
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; NULL has none. One separator splits faster than a pattern."""
    spaced = F.coalesce(text, F.lit(""))
    for other in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(*columns: Column) -> Column:
    """Hash of the columns as a number from 0 to below 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def column_named(column: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(columns: list[str]) -> Column:
    """The caller's columns as one struct, so that no name of theirs meets one of the operator's."""
    return F.struct(F.lit(True).alias("_is_row"), *(column_named(c).alias(c) for c in columns))


def unpacked(columns: list[str], row: str = "_row") -> list[Column]:
    """The columns of such a struct, as they were."""
    return [F.col(row).getField(c).alias(c) for c in columns]


def numbered(columns: list[str]) -> list[Column]:
    """The caller's columns under names by place, so that joins and groups of the operator can name their own."""
    return [column_named(c).alias(f"c{i}") for i, c in enumerate(columns)]


def renamed(columns: list[str]) -> list[Column]:
    """Such columns under their own names again."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Hash of whole rows; maps, which have no hash of their own, count by their JSON."""
    parts = []
    for c in df.columns if columns is None else columns:
        has_map = "map<" in df.schema[c].dataType.simpleString()
        parts.append(F.to_json(F.struct(column_named(c).alias("c"))) if has_map else column_named(c))
    return F.xxhash64(*parts)


def bounded_sample(
    rows: DataFrame, group: str, key: str, most: int, text: str | None = None, most_bytes: int | None = None
) -> list:
    """At most `most` rows of each value of a column of few values, chosen by hash of the key and the row.

    With `text`, the rows of a value also have at most `most_bytes` bytes of it, the shortest of the
    chosen ones first; the shortest always stays, so that no value is without rows. A share of the keys that
    follows from their estimated number is taken by hash, and what it brings (more, where keys repeat) is
    cut to the bound on the cluster: no more comes to the driver.
    """
    keys = {r[0]: r[1] for r in rows.groupBy(group).agg(F.approx_count_distinct(key, 0.02)).collect()}
    share = F.lit(0.0)
    for value, n in keys.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(1.0 if n <= most else min(1.0, 1.1 * most / n))).otherwise(share)
    drawn = rows.where(unit_hash(F.lit("sample"), F.col(key)) < share)
    chosen = W.partitionBy(group).orderBy(F.xxhash64(F.lit("sample"), F.col(key)), F.col(key), *drawn.columns)
    picked = drawn.withColumn("_at", F.row_number().over(chosen)).where(F.col("_at") <= most)
    if text is not None:
        rising = W.partitionBy(group).orderBy(F.octet_length(text), "_at")
        sums = F.sum(F.octet_length(text)).over(rising.rowsBetween(W.unboundedPreceding, 0))
        picked = picked.withColumns({"_bytes": sums, "_first": F.row_number().over(rising) == 1})
        picked = picked.where((F.col("_bytes") <= most_bytes) | F.col("_first")).drop("_bytes", "_first")
    found = picked.drop("_at").collect()
    found.sort(key=lambda r: (str(r[group]), str(r[key])))
    return found


def running_start(df: DataFrame, order: list, value: str, name: str = "start") -> DataFrame:
    """Add the sum of `value` over all rows before a row in the total order of the given columns.

    The rows are range-sorted and written once; the driver sees one total per partition.
    Give a narrow frame. The column `value` is a long without NULLs.
    """
    placed = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    totals = sorted((r[0], r[1]) for r in placed.groupBy("_part").agg(F.sum(value)).collect())
    base = dict(zip([p for p, _ in totals], accumulate([0] + [n for _, n in totals])))
    kept = df.columns

    def add(batches):
        at = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if at is None:
                at = base[batch.column("_part")[0].as_py()]
            own = batch.column(value)
            ends = pc.add(pc.cumulative_sum(own), at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pc.subtract(ends, own)], names=[*kept, name]
            )
            at = ends[-1].as_py()

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    return placed.mapInArrow(add, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node; roots have no row.

    Alternating star contractions: each node joins the smallest neighbour it knows, first from
    its larger neighbours, then from its smaller ones, until nothing changes. Every round is
    grouped minima (combined before their shuffle) and joins that split hot nodes.
    """
    edges = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    mark = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(hi, lo) as decimal(38, 0)))")).first()
        if seen == mark or seen[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark = seen
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        edges = cut(
            small.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(small.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
