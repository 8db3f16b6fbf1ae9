"""Token ids in Parquet: list columns, chosen encodings, bounded row groups and page indexes."""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.packing import vocabulary
from sootledger.llm.shared import documents, shared_folder
from sootledger.llm.tokens import encoded

# Token ids repeat, so they get a dictionary; rising columns are stored as deltas. Every page
# has its range in the column index, so readers of a few documents skip the other pages.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(64 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#offset": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> None:
    """Write the ids of all texts in ascending order of doc_id.

    Columns: doc_id, offset (ids before it in its file), n_tokens, tokens (list of ids, the end id
    last). File names follow the order. NULL texts count as empty; NULL ids come first; rows with
    the same id follow the hash of their text.
    """
    ordered = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def each(batches):
        offset = 0
        for batch in batches:
            for first, ids in encoded(batch.column("text"), path, end_id):
                sizes = np.array([len(b) // 4 for b in ids], dtype=np.int64)
                ends = np.cumsum(sizes)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                marks = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(ids)),
                        pa.array(offset + ends - sizes),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(marks, flat),
                    ],
                    names=["doc_id", "offset", "n_tokens", "tokens"],
                )
                offset += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = ordered.mapInArrow(each, f"doc_id {kind}, offset long, n_tokens long, tokens array<int>")
    rows.write.options(**WRITER).parquet(folder)


def read_tokens(spark: SparkSession, folder: str, columns: tuple = ("doc_id", "n_tokens", "tokens")) -> DataFrame:
    """The chosen columns and `start`, the ids of all documents before this one, over all files.

    Reads one range of each file's offsets first; the driver gets one row per file.
    """
    files = spark.read.parquet(folder)
    name = F.col("_metadata.file_name")
    sums = files.groupBy(name.alias("file")).agg(F.max(F.col("offset") + F.col("n_tokens")).alias("n")).collect()
    sums = sorted((r[0], r[1]) for r in sums)
    if not sums:
        return files.select(*columns, F.lit(0).cast("long").alias("start"))
    before = list(accumulate([0] + [n for _, n in sums]))
    base = spark.createDataFrame([(f, b) for (f, _), b in zip(sums, before)], "file string, base long")
    # One row per file of the table, all of which the driver has just seen: safe to broadcast.
    return (
        files.withColumn("file", name)
        .join(F.broadcast(base), "file")
        .select(*columns, (F.col("base") + F.col("offset")).alias("start"))
    )


def with_crc32(tokens: DataFrame) -> DataFrame:
    """Replace the list of ids by ids_crc32, over little-endian unsigned 32-bit integers."""
    kept = [c for c in tokens.columns if c != "tokens"]

    def each(batches):
        for batch in batches:
            lists = batch.column("tokens")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()]).tolist()
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(crc, pa.int64())], names=[*kept, "ids_crc32"]
            )

    return tokens.mapInArrow(each, tokens.select(*kept).withColumn("ids_crc32", F.lit(0).cast("long")).schema)


def op9_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-file")
    write_tokens(documents(spark, sf_dir), folder, vocabulary())
    return with_crc32(read_tokens(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32")
