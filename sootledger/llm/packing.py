"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import documents, running_start, written
from sootledger.llm.tokens import encoded, forget

HASHED = 512
DIMENSIONS = 3
DEPTH = 16


def projection(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(HASHED, DIMENSIONS))


def hashed_vectors(ids: list[np.ndarray]) -> np.ndarray:
    """For each document its counts of token ids in hashed places, of length one."""
    places = (np.concatenate(ids).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 9)
    owner = np.repeat(np.arange(len(ids)), [len(a) for a in ids])
    counts = np.bincount(owner * HASHED + places.astype(np.int64), minlength=len(ids) * HASHED)
    counts = counts.reshape(len(ids), HASHED).astype(np.float64)
    return counts / np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1.0)


def hilbert_key(points: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Position along the Hilbert curve of integer points (rows), each coordinate of `depth` bits.

    From the highest bit down, each cell's reflection and exchange of axes is undone on the lower
    bits; the coordinates, turned into Gray code, are then interleaved.
    """
    x = [points[:, k].astype(np.int64).copy() for k in range(points.shape[1])]
    axes = len(x)
    for bit in range(depth - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(axes):
            mirrored = (x[k] >> bit & 1).astype(bool)
            changed = (x[0] ^ x[k]) & low
            x[0] = np.where(mirrored, x[0] ^ low, x[0] ^ changed)
            if k:
                x[k] = np.where(mirrored, x[k], x[k] ^ changed)
    for k in range(1, axes):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    for bit in range(depth - 1, 0, -1):
        flip ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for k in range(axes):
            key = key << 1 | ((x[k] ^ flip) >> bit & 1)
    return key


def tokens_with_key(docs: DataFrame, path: str, end_id: int, remember: bool = True) -> DataFrame:
    """Rows (doc_id, ids, n, curve, row): ids as binary, place on the curve, and a row number of its own.

    Workers keep the words they have met from task to task; without `remember` each task gives them back.
    """
    grid, top = projection(), (1 << DEPTH) - 1

    def each(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, ids in encoded(batch.column("text"), path, end_id):
                arrays = [np.frombuffer(b, dtype="<u4") for b in ids]
                spots = hashed_vectors(arrays) @ grid
                cells = np.clip((spots + 3) / 6 * top, 0, top).astype(np.int64)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n),
                        pa.array(ids, pa.binary()),
                        pa.array([len(a) for a in arrays], pa.int64()),
                        pa.array(hilbert_key(cells)),
                        pa.array(np.arange(row, row + n)),
                    ],
                    names=["doc_id", "ids", "n", "curve", "row"],
                )
                row += n
        if not remember:
            forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        each, f"doc_id {kind}, ids binary, n long, curve long, row long"
    )


def pack(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, remember: bool = True) -> DataFrame:
    """Pieces of all documents, packed into sequences of `length` tokens along the Hilbert curve.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset. The documents, range-sorted by their key, form one stream that is cut at each multiple
    of the length, so only the last sequence may be short. NULL texts count as empty and give the
    end id alone; NULL and repeated ids are packed like any other row; copies lie side by side.
    """
    tokens = written(tokens_with_key(docs, path, end_id, remember), "tokens")
    placed = running_start(tokens.select("curve", "row", "n"), ["curve", "row"], "n", "begin").select("row", "begin")

    def slices(batches):
        for batch in batches:
            out = {k: [] for k in ("at", "start", "length", "ids", "sequence_id", "offset")}
            rows = zip(batch.column("begin").to_pylist(), batch.column("n").to_pylist(), batch.column("ids"))
            for i, (begin, n, ids) in enumerate(rows):
                raw, done = ids.as_py(), 0
                while done < n:
                    offset = (begin + done) % length
                    take = min(n - done, length - offset)
                    for k, v in zip(out, (i, done, take, raw[4 * done : 4 * (done + take)], (begin + done) // length, offset)):
                        out[k].append(v)
                    done += take
            at = pa.array(out.pop("at"), pa.int64())
            longs = {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").take(at), **longs, "doc_tokens": batch.column("n").take(at)}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return tokens.select("row", "doc_id", "ids", "n").join(placed, "row").mapInArrow(
        slices,
        f"doc_id {kind}, start long, length long, ids binary, sequence_id long, offset long, doc_tokens long",
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(documents(spark, sf_dir), vocabulary()))
