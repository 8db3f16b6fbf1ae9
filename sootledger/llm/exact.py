"""Exact de-duplication as a stateful stream: digests in disk-backed state, full bytes checked on hits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.files import or_empty
from sootledger.llm.rules import flagged
from sootledger.llm.shared import cut, shared_folder, written

# State on the executors' disks, bounded memory, uploads of changes only. No watermark: state never expires.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Without it each partition of the state holds 4 MB of disk in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# The bitmap that tells which rows may have a copy: so many slots for each repeated digest, 2^29 (64 MB) at most.
SLOTS, MAP_BITS = 64, 29


def content(text: Column) -> Column:
    """What is compared: the text as it is; NULL is empty."""
    return F.coalesce(text, F.lit(""))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(df: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows (digest, at, text): `at` is the row's id and its place, the file and the row's number in it."""
    path = F.regexp_replace("_metadata.file_path", "^([a-zA-Z0-9]+):/+", "$1:/")
    at = F.struct(F.col(key).alias("doc_id"), path.alias("path"), F.col("_metadata.row_index").alias("row"))
    body = content(F.col(text))
    return df.select(digest(body).alias("digest"), at.alias("at"), body.alias("text"))


def _exactly(path: str) -> str:
    """A pattern that only this path matches: a stream takes a folder, or a pattern that may meet one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def ingest(
    spark: SparkSession,
    source: str,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    max_bytes: int = 1 << 40,
) -> None:
    """Take all files of a Parquet table that are new since the last call into the state.

    The state holds one row for each digest, ever: how many rows had it, and of the row with the largest id
    (then the last place) the id and the place of its content. A trigger takes files of about `max_bytes`;
    its changed rows of the state go to `groups/`, a folder for each batch that a repeated batch replaces.
    """
    schema = spark.read.parquet(source).select(key, text).schema
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes)).parquet(_exactly(source))
    rows = _located(stream, key, text, digest)
    state = rows.groupBy("digest").agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("n"))

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/groups/batch={batch}")

    before = {name: spark.conf.get(name, None) for name in STATE}
    try:
        for name, value in STATE.items():
            spark.conf.set(name, value)
        query = (
            state.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()


def repeated(spark: SparkSession, folder: str, id_type: str) -> DataFrame:
    """Digests seen more than once: (digest, keep, n). Of the batches that changed one, the largest count is the last."""
    schema = f"digest binary, keep struct<doc_id: {id_type}, path: string, row: bigint>, n bigint"
    # The schema is given, so an untouched folder is no special case; rows of a batch lie below batch=….
    empty = spark.createDataFrame([], schema)
    groups = or_empty(spark, lambda: spark.read.schema(schema).parquet(f"{folder}/groups"), empty.schema)
    last = groups.where("n > 1").groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("last"))
    return cut(last.select("digest", "last.keep", "last.n"))


def resolved(
    spark: SparkSession,
    source: str,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """What became of each row of the files taken in: (at, keep, n, sha).

    A row whose digest no other row has stays where it is read: a bitmap of the repeated digests, broadcast in a
    bounded size, tells it from the others. All others, the hits, meet the content of the row that stays,
    fetched by its place, and are compared byte by byte. Digests under which contents differ are grouped anew
    by the contents themselves. A hot group is split by adaptive execution: nothing is aggregated beside the texts.
    """
    rows = _located(spark.read.parquet(source), key, text, digest)
    more = repeated(spark, folder, rows.schema["at"].dataType["doc_id"].dataType.simpleString())
    bits = min(MAP_BITS, (SLOTS * more.count()).bit_length())
    slot = F.pmod(F.xxhash64("digest"), F.lit(1 << bits)).alias("doc_id")
    marked = flagged(rows.select("*", slot), more.select(slot)).drop("doc_id")
    sha = F.sha2("text", 256).alias("sha")
    hits = marked.where("trusted").drop("trusted")
    kept = more.join(
        hits.select(F.col("digest").alias("_digest"), F.col("at").alias("_at"), F.col("text").alias("_text")),
        (F.col("digest") == F.col("_digest"))
        & (F.col("keep.path") == F.col("_at.path")) & (F.col("keep.row") == F.col("_at.row")),
    ).select("digest", "keep", "n", "_text")
    met = hits.join(kept, "digest", "left")
    # Without a match the bitmap's slot was shared by another digest: the row is alone.
    checked = written(
        met.select(
            "digest", "at", F.coalesce("keep", "at").alias("keep"), F.coalesce("n", F.lit(1)).alias("n"),
            F.coalesce(F.col("text") == F.col("_text"), F.lit(True)).alias("same"), sha,
        ),
        "exact-hits",
    )
    alone = marked.where(~F.col("trusted")).select("at", F.col("at").alias("keep"), F.lit(1).cast("long").alias("n"), sha)
    clash = checked.where("not same").select("digest").distinct()
    if clash.isEmpty():
        return alone.unionByName(checked.select(*alone.columns))
    both = hits.join(clash, "digest", "left_semi")
    groups = both.groupBy("text").agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("n"))
    again = both.join(groups, "text").select("at", "keep", "n", sha)
    rest = checked.join(clash, "digest", "left_anti").select(*alone.columns)
    return alone.unionByName(rest).unionByName(again)


def unique_rows(spark: SparkSession, source: str, folder: str, **options) -> DataFrame:
    """The table without the rows that go, all its columns as they were, whatever their names."""
    gone = resolved(spark, source, folder, **options).where(~F.col("at").eqNullSafe(F.col("keep"))).select("at.path", "at.row")
    table = spark.read.parquet(source)
    path = F.regexp_replace("_metadata.file_path", "^([a-zA-Z0-9]+):/+", "$1:/").alias("path")
    rows = table.select(F.struct(*table.columns).alias("_kept"), path, F.col("_metadata.row_index").alias("row"))
    stay = rows.join(gone, ["path", "row"], "left_anti")
    return stay.select(*(F.col("_kept").getField(c).alias(c) for c in table.columns))


def digest_rows(found: DataFrame) -> DataFrame:
    """One row for each row of the table: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; of equal ids the one in the last place (file, row), so one row
    of a group stays even if rows repeat. NULL ids come last, NULL texts equal empty ones.
    """
    return found.select(
        F.col("at.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("at").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, folder = f"{sf_dir}/documents.parquet", shared_folder(spark, "exact")
    ingest(spark, source, folder)
    return digest_rows(resolved(spark, source, folder))


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
