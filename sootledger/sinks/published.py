"""Published tables: parts that are bucketed by key, written once and referenced by later versions.

snapshot/<table>/v=N/part=…     the parts that version N wrote, bucketed by the table's key
snapshot/<table>/v=N/_parts     where all parts of version N lie, its own and earlier ones

Facts have a part for each day of arrival, dimensions one for each bucket. All tables of a version have the
same number of buckets, so facts and dimensions join on their key without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger import schemas

LISTING = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fullest", T.LongType()),
    ]
)
# A table whose fullest bucket is that many times the mean, and large, is read without its
# buckets: joins then shuffle, and adaptive execution splits the hot key.
UNEVEN, LARGE = 2, 1_000_000


@dataclass(frozen=True)
class Part:
    """A part of a published table; ``fullest`` is the number of rows in its fullest bucket."""

    part: str
    location: str
    buckets: int
    rows: int
    fullest: int


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket in which Spark's writer puts a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def with_keys(df: DataFrame, table: str) -> DataFrame:
    """Add the lower-case copies that case-insensitive filters use."""
    columns = [c for c in schemas.KEYED_COLUMNS.get(table, []) if c in df.columns]
    return df.withColumns({f"{c}_KEY": F.lower(c) for c in columns})


def stored_schema(table: str) -> T.StructType:
    """Columns of a published table: its own, lower-case copies, and lineage unless it is the people's."""
    schema = T.StructType(list(schemas.WAREHOUSE[table].fields))
    for c in schemas.KEYED_COLUMNS.get(table, []):
        schema = schema.add(f"{c}_KEY", "string")
    if table != "DIM_PERSONNEL":
        schema = schema.add("ingest_date", "date").add("load_order", "long")
    return schema


def _as_stored(df: DataFrame, table: str) -> DataFrame:
    keyed = with_keys(df, table)
    return keyed.select(
        *[
            (F.col(f.name) if f.name in keyed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in stored_schema(table).fields
        ]
    )


def write_parts(df: DataFrame, table: str, path: str, buckets: int) -> list[Part]:
    """Write the rows of a version, and tell what parts they make.

    Rows come together by bucket, so a task writes one file for each part and bucket it has; adaptive execution
    deals a bucket with too many rows, such as one with a hot key, to several tasks and files.
    """
    spark, key = df.sparkSession, schemas.PRIMARY_KEY[table]
    part = F.col("ingest_date").cast("string") if table in schemas.DATE_COLUMN else bucket_of(key, buckets).cast("string")
    rows = _as_stored(df, table).withColumn("part", F.coalesce(part, F.lit("none")))
    name = f"sootledger_new_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        rows.withColumn("_bucket", bucket_of(key, buckets)).hint("rebalance", "_bucket").drop("_bucket")
        .write.mode("overwrite").format("parquet").option("path", path)
        .partitionBy("part").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay
    written = spark.read.schema(stored_schema(table).add("part", "string")).parquet(path)
    counts = written.groupBy("part", bucket_of(key, buckets).alias("bucket")).count()
    found = counts.groupBy("part").agg(F.sum("count").alias("rows"), F.max("count").alias("fullest"))
    return [
        Part(r["part"], f"{path}/part={r['part']}", buckets, r["rows"], r["fullest"])
        for r in found.orderBy("part").collect()
    ]


def write_listing(spark: SparkSession, path: str, parts: Sequence[Part]) -> None:
    rows = [(p.part, p.location, p.buckets, p.rows, p.fullest) for p in parts]
    spark.createDataFrame(rows, LISTING).coalesce(1).write.mode("overwrite").json(f"{path}/_parts")


def read_listing(spark: SparkSession, path: str) -> list[Part]:
    """Parts of a version; it is an error when its folder is gone."""
    rows = spark.read.schema(LISTING).json(f"{path}/_parts").orderBy("part").collect()
    return [Part(*r) for r in rows]


def uneven(table: str, parts: Sequence[Part]) -> bool:
    """Whether one bucket of a table has far more rows than the others: a day's parts add up, a dimension's are buckets."""
    together = sum if table in schemas.DATE_COLUMN else max
    mean = sum(p.rows for p in parts) / parts[0].buckets
    return together(p.fullest for p in parts) > max(UNEVEN * mean, LARGE)


def read_parts(spark: SparkSession, table: str, parts: Sequence[Part]) -> DataFrame:
    """Some parts as plain files; it is an error when one is gone."""
    schema = stored_schema(table)
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[p.location for p in parts])


def read_published(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A published table with its lineage, as buckets of its key; it is an error when a part is gone."""
    parts = read_listing(spark, path)
    plain = read_parts(spark, table, parts)
    if not parts or uneven(table, parts) or len({p.buckets for p in parts}) > 1:
        return plain
    return spark.table(_registered(spark, path, table, parts)).drop("part")


def _registered(spark: SparkSession, path: str, table: str, parts: Sequence[Part]) -> str:
    """Name of an external table over the parts. A version never changes, so its table is made once a catalog."""
    key = schemas.PRIMARY_KEY[table]
    name = f"sootledger_{table.lower()}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if spark.catalog.tableExists(name):
        return name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(table).fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, part STRING) USING parquet PARTITIONED BY (part) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {parts[0].buckets} BUCKETS LOCATION '{path}'"
    )
    for i in range(0, len(parts), 500):
        some = " ".join(f"PARTITION (part = '{p.part}') LOCATION '{p.location}'" for p in parts[i : i + 500])
        spark.sql(f"ALTER TABLE {name} ADD {some}")
    return name
