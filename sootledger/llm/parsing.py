"""Document fingerprints by locally consistent parsing."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import documents

# Odd multipliers of a 64-bit mixing function.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
KEPT = 64
LEVELS = 40


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _toss_table(values: int) -> np.ndarray:
    """Coin toss of two symbols below `values`: twice the lowest place where they differ, plus the right one's bit there."""
    left, right = np.meshgrid(np.arange(values), np.arange(values), indexing="ij")
    apart = left ^ right
    place = np.zeros_like(apart)
    for bit in range(values.bit_length() - 1, -1, -1):
        place = np.where(apart >> bit & 1, bit, place)
    return (2 * place + (right >> place & 1)).astype(np.uint8).ravel()


_BYTES, _WIDE, _NARROW = _toss_table(256), _toss_table(128), _toss_table(16)


def _tossed(table: np.ndarray, bits: int, x: np.ndarray) -> np.ndarray:
    out = np.empty_like(x)
    out[0] = x[0]
    np.take(table, (x[:-1].astype(np.uint16) << bits) | x[1:], out=out[1:])
    return out


def _landmarks(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """True where a phrase begins. No two neighbours of one document are equal.

    Tosses leave labels of at most six values in which neighbours still differ; phrases begin
    at local maxima, and these depend on a few neighbours only. `starts` holds the first place of each
    document: nothing there looks back, and nothing at the end looks ahead.
    """
    if names.dtype == np.uint8:
        labels = _tossed(_BYTES, 8, names)
    else:
        apart = names[1:] ^ names[:-1]
        lowest = np.frexp((apart & (~apart + np.uint64(1))).astype(np.float64))[1] - 1
        lowest = np.maximum(lowest, 0)
        labels = np.zeros(len(names), dtype=np.uint8)
        labels[1:] = 2 * lowest + ((names[1:] >> lowest.astype(np.uint64)) & np.uint64(1)).astype(np.int64)
        labels[starts] = 0
        labels = _tossed(_WIDE, 7, labels)
    for _ in range(2):
        labels[starts] = 0
        labels = _tossed(_NARROW, 4, labels & 15)
    labels[starts] = 0
    top = np.zeros(len(names), dtype=bool)
    top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    top[starts[1:] - 1] = False
    top[starts] = True
    return top


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])


def _level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of one level, and the document of each."""
    # A run of one symbol becomes one symbol that knows its length.
    fresh = np.empty(len(names), dtype=bool)
    np.not_equal(names[1:], names[:-1], out=fresh[1:])
    fresh[_starts(owner)] = True
    at = np.flatnonzero(fresh)
    if len(at) < len(names):
        length = np.diff(at, append=len(names))
        if names.dtype == np.uint8:
            # Bytes stay bytes for the tosses; the length enters the name of the phrase.
            runs_of = length
            tossed, names = names[at], names[at]
        else:
            runs_of = length
            names = np.where(length > 1, mix(names[at] + length.astype(np.uint64) * _M2), names[at])
            tossed = names
        owner = owner[at]
    else:
        runs_of, tossed = None, names
    at = np.flatnonzero(_landmarks(tossed, _starts(owner)))
    inside = (np.arange(len(names)) - np.repeat(at, np.diff(at, append=len(names)))).astype(np.uint64)
    wide = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    if runs_of is not None and tossed.dtype == np.uint8:
        wide += (runs_of.astype(np.uint64) - np.uint64(1)) << np.uint64(8)
    scaled = mix(wide) * (np.uint64(2) * inside + np.uint64(0xA0761D65))
    return mix(np.add.reduceat(scaled, at)), owner[at]


def signatures(texts: list[bytes], kept: int = KEPT) -> list[np.ndarray]:
    """For each text the `kept` smallest hashed names among its phrases of all levels above the first."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    names = np.frombuffer(b"".join(texts), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    for level in range(LEVELS):
        if len(names) == 0:
            break
        names, owner = _level(names, owner)
        counts = np.bincount(owner, minlength=len(texts))
        hashed = mix(names ^ np.uint64(level + 1)) >> np.uint64(32)
        ends = np.cumsum(counts)
        for i in np.flatnonzero(counts):
            own = hashed[ends[i] - counts[i] : ends[i]]
            if level == 0 and counts[i] > 1:  # phrases of a few characters are common to most texts
                continue
            if len(own) > 4 * kept:
                least = np.unique(np.partition(own, 4 * kept)[: 4 * kept])
                # Names that repeat very often may fill that part: then all of the level are looked at.
                own = least if len(least) >= kept else np.unique(own)[:kept]
            found[i].append(own)
        more = counts[owner] > 1
        names, owner = names[more], owner[more]
    return [np.unique(np.concatenate(f))[:kept] if f else np.zeros(0, np.uint64) for f in found]


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Share of common names among the smallest names of both: the likeness of the two sets of phrases."""
    if len(a) == 0 and len(b) == 0:
        return 1.0
    both = np.union1d(a, b)[:kept]
    common = np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)
    return len(common) / len(both)


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").astype(np.uint64)


def fingerprints(docs: DataFrame, text: str = "text", kept: int = KEPT) -> DataFrame:
    """Every column but the text, and `fingerprint`; NULL texts count as empty, whose fingerprint is ''."""
    names = [c for c in docs.columns if c != text]

    def each(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(text).cast(pa.binary())]
            found = [as_text(s) for run in runs(texts) for s in signatures(run, kept)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.string())],
                                             names=[*names, "fingerprint"])

    return docs.mapInArrow(each, docs.select(*names).withColumn("fingerprint", F.lit("")).schema)


def runs(texts: list[bytes], size: int = 1_000_000):
    """The texts in runs of about `size` bytes; a longer text is a run of its own."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def beside_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """Rows (doc_id, text, range, extra), in partitions sorted so that the next document follows.

    Texts move once. A pass over the ids alone sets the limits of ranges of ids; the first row of
    each range goes to the end of the range before it too (`extra`), the first of all to the end of
    the last. The driver gets one limit and one head per range, `per_partition` ranges for each
    shuffle partition. NULL ids come first; rows with one id follow the hash of their text.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    wanted = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0]
    limits = np.array(sorted(set(found or [])), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        filled = ids.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
        return pd.Series(np.searchsorted(limits, filled, side="right").astype(np.int32))

    place = [F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie"]
    heads = rows.select("doc_id", "tie", range_of("doc_id").alias("range"))
    heads = heads.groupBy("range").agg(F.min(F.struct(*place)).alias("h")).collect()
    heads = sorted((h[0], h[1]["doc_id"], h[1]["tie"]) for h in heads)
    before = [(i, t, heads[k - 1][0]) for k, (_, i, t) in enumerate(heads)]
    before = spark.createDataFrame(before, "head_id long, head_tie long, before int")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    # One row per range: its number is set above.
    ranged = rows.withColumn("range", range_of("doc_id")).join(F.broadcast(before), is_head, "left")
    own = F.struct(F.col("range"), F.lit(False).alias("extra"))
    again = F.struct(F.col("before").alias("range"), F.lit(True).alias("extra"))
    placed = ranged.select(
        "doc_id", "text", "tie",
        F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, again))).alias("p"),
    ).select("doc_id", "text", "tie", "p.range", "p.extra")
    return placed.repartition("range").sortWithinPartitions("range", "extra", F.col("doc_id").asc_nulls_first(), "tie")


def edited_likeness(docs: DataFrame, kept: int = KEPT) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness.

    The edited text ends in the beginning of the next document instead of its own second half.
    NULL texts count as empty. Two empty texts are alike (1), an empty and another text are not (0).
    """

    def finish(rows, signs):
        """Result rows of all but the last of the given (doc_id, text, range, extra)."""
        pairs = [(i, a, b) for i, (a, b) in enumerate(zip(rows, rows[1:])) if not a[3] and a[2] == b[2]]
        cuts = [len(a[1]) // 2 for _, a, _ in pairs]
        edited = [(a[1][: len(a[1]) - c] + b[1][:c]).encode() for (_, a, b), c in zip(pairs, cuts)]
        marks = signatures(edited, kept)
        return [
            {
                "doc_id": a[0],
                "n_chars": len(a[1]),
                "edited_sha256": hashlib.sha256(e).hexdigest(),
                "fingerprint": as_text(signs[i]),
                "edited_fingerprint": as_text(m),
                "near_edited": likeness(signs[i], m, kept),
                "near_next": likeness(signs[i], signs[i + 1], kept),
            }
            for (i, a, _), e, m in zip(pairs, edited, marks)
        ]

    def each(batches):
        rows, signs, held = [], [], 0
        for batch in batches:
            for r in zip(*(batch.column(c) for c in ("doc_id", "text", "range", "extra"))):
                r = (r[0].as_py(), r[1].as_py() or "", r[2].as_py(), r[3].as_py())
                rows.append(r)
                held += len(r[1])
                if held >= 1_000_000:
                    signs += signatures([t[1].encode() for t in rows[len(signs):]], kept)
                    if done := finish(rows, signs):
                        yield pa.RecordBatch.from_pylist(done, schema)
                    rows, signs, held = rows[-1:], signs[-1:], 0
        if rows:
            signs += signatures([t[1].encode() for t in rows[len(signs):]], kept)
            if done := finish(rows, signs):
                yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    return beside_next(docs).mapInArrow(
        each,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op10_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))
