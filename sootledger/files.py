"""Helpers shared by the file readers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# How delimited files are read: a doubled quote inside quotes is one quote, a backslash is
# itself, blanks around a cell stay. A line break ends a row also inside quotes, so that large
# files can be split.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "quote": '"', "escape": '"'}

# The same for writing, so that what is written reads back as it was.
CSV_WRITE_OPTIONS = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def row_position(block_start: Column) -> Column:
    """Place of a row in its file.

    A split is one scan partition or part of one, and a partition holds at most
    one split length of bytes, so split offset + row number inside the partition
    grows with the row's place in the file.
    """
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return block_start + in_partition


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str,
    schema: T.StructType | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Text columns from delimited files with a header.

    The header of each file is checked against the schema: a file with other
    columns fails loudly instead of being read by position. Without a schema the
    column names come from the header, every column is text.
    """
    reader = spark.read.option("sep", sep).options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.csv(path)


def folders_below(spark: SparkSession, root: str, wanted: Callable[[str], bool]) -> list[str]:
    """Folders whose name is wanted, anywhere below a root; what lies in them is not listed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    found, level = [], [path] if fs.exists(path) else []
    while level:
        below = [f.getPath() for folder in level for f in fs.listStatus(folder) if f.isDirectory()]
        found += [str(f) for f in below if wanted(f.getName())]
        level = [f for f in below if not wanted(f.getName())]
    return sorted(found)


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of some files that are there; each is asked for by name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [str(p) for p in named if p.getFileSystem(conf).exists(p)]


def or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """Run a reader; an absent path gives an empty frame with the schema."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
