"""Quality by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import bounded_sample, column_named, documents, held_out, packed, unpacked

TERMS = 1024
WORDS = 2048
LATENT = 32
NEIGHBOURS = 25
BLOCK = 1024
REPEATS = 4
WIDTH = TERMS + REPEATS + WORDS
# Classes of bytes: letters of either case, digits, white space; other ASCII stands for itself.
_KIND = bytes(
    ord("a") if c >= 0x80 or chr(c).islower()
    else ord("A") if chr(c).isupper()
    else ord("0") if chr(c).isdigit()
    else 10 if c == 10
    else 32 if chr(c).isspace()
    else c
    for c in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _units(data: np.ndarray, breaks: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each unit (run of bytes between breaks, within one text), and the text it belongs to."""
    held = ~breaks
    begins = held.copy()
    begins[1:] &= breaks[:-1] | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    before = np.zeros(starts[0], np.int64)
    inside = np.arange(len(data)) - np.concatenate([before, np.repeat(starts, np.diff(starts, append=len(data)))])
    mixed = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    mixed ^= mixed >> np.uint64(29)
    mixed *= 2 * inside.astype(np.uint64) + np.uint64(0xBF58476D1CE4E5B9)
    return np.add.reduceat(np.where(held, mixed, np.uint64(0)), starts), owner[starts]


def _repeats(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of units equal to the unit before, and equal to any earlier one."""
    count = np.maximum(np.bincount(of, minlength=n), 1)
    next_same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((hashes, of))
    again = (hashes[order][1:] == hashes[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.bincount(of[1:][next_same], minlength=n) / count, np.bincount(of[order][1:][again], minlength=n) / count


def _wording(hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Shares of hashed words and of hashed pairs of neighbouring words."""
    beside = of[1:] == of[:-1]
    pairs = hashes[:-1] * np.uint64(31) + hashes[1:] * _ODD
    found = np.concatenate([hashes * _ODD, (pairs * np.uint64(0xBF58476D1CE4E5B9))[beside]])
    owners = np.concatenate([of, of[1:][beside]])
    place = (found >> np.uint64(64 - (WORDS - 1).bit_length())).astype(np.int64)
    counts = np.bincount(owners * WORDS + place, minlength=n * WORDS).reshape(n, WORDS)
    return counts / np.maximum(np.bincount(owners, minlength=n), 1)[:, None]


def terms(texts: list[bytes]) -> np.ndarray:
    """One row per text: shares of hashed n-grams of character classes, of repeated words and lines, and of
    hashed words and word pairs, ASCII letters in lower case."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    raw = b"".join(texts)
    if not raw:
        return out
    data, kinds = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_KIND), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    fresh = np.ones(len(kinds), dtype=bool)
    fresh[1:] = (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
    seen, of = kinds[fresh].astype(np.uint64), owner[fresh]
    total = np.zeros(n)
    code = np.zeros(len(seen), np.uint64)
    counts = np.zeros(n * TERMS)
    for k in range(4):
        if k >= len(seen):
            break
        code = (code[: len(seen) - k] << np.uint64(8)) | seen[k:]
        whole = of[: len(code)] == of[k:]
        place = ((code ^ np.uint64(k << 60)) * _ODD) >> np.uint64(54)
        counts += np.bincount((of[: len(code)] * TERMS + place.astype(np.int64))[whole], minlength=n * TERMS)
        total += np.bincount(of[: len(code)][whole], minlength=n)
    out[:, :TERMS] = np.sqrt(counts.reshape(n, TERMS) / np.maximum(total, 1)[:, None])
    space = (kinds == 32) | (kinds == 10)
    for at, breaks in ((TERMS, space), (TERMS + 2, kinds == 10)):
        beside, ever = _repeats(*_units(data, breaks, owner), n)
        out[:, at], out[:, at + 1] = np.sqrt(beside), np.sqrt(ever)
    small = np.frombuffer(raw.lower(), np.uint8)
    out[:, TERMS + REPEATS :] = np.sqrt(_wording(*_units(small, space, owner), n))
    return out


def runs(texts: list[bytes], size: int = 500_000):
    """The texts in runs of about `size` bytes and at most BLOCK texts."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t)
        if held >= size or len(run) == BLOCK:
            yield run
            run, held = [], 0
    if run:
        yield run


def _leading(gram: np.ndarray, k: int) -> np.ndarray:
    """The k leading directions of a symmetric matrix by orthogonal iteration, which needs no second matrix of its size."""
    basis = np.random.default_rng(7).normal(size=(len(gram), k + 16)).astype(gram.dtype)
    for _ in range(60):
        basis, _ = np.linalg.qr(gram @ basis)
    _, turn = np.linalg.eigh((basis.T @ gram @ basis).astype(np.float64))
    return (basis @ turn[:, ::-1][:, :k]).astype(np.float32)


@dataclass
class Model:
    """Weights of the terms, the latent directions, and the labelled vectors, all of bounded size."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, texts: list[bytes]) -> np.ndarray:
        latent = (terms(texts) * self.idf) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Mean label of the nearest labelled vectors, weighted by a power of their cosine."""
        if len(self.labels) == 0:
            return np.full(len(texts), 0.5)
        out = np.zeros(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, len(texts), BLOCK):
            own = self.embed(texts[begin : begin + BLOCK])
            cosine = own @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-3).astype(np.float64) ** 16
            out[begin : begin + BLOCK] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def train(texts: list[bytes], labels: list[int]) -> Model:
    if len(texts) == 0:
        return Model(np.zeros(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    found = sum((terms(run) > 0).sum(axis=0) for run in runs(texts))
    idf = np.log((1 + len(texts)) / (1 + found)).astype(np.float32) + 0.2
    gram = np.zeros((WIDTH, WIDTH), np.float32)
    for run in runs(texts):
        weighted = terms(run) * idf
        gram += weighted.T @ weighted
    directions = _leading(gram, LATENT)
    model = Model(idf, directions, np.zeros((0, LATENT), np.float32), np.array(labels, dtype=np.float64))
    model.vectors = np.concatenate([model.embed(run) for run in runs(texts)])
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 2500, most_bytes: int = 20_000_000) -> Model:
    """Learn from at most `per_label` rows of each label, of at most `most_bytes` bytes together, shorter ones first.

    Held-out rows, NULL labels and NULL texts are never looked at. Rows of an id with several labels
    are all candidates; repeated labels of an id count once.
    """
    marked = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    # Sampled by id before the join: what meets the texts is at most two bounded sets of ids.
    marked = marked.where(~held_out(F.col("doc_id"))).distinct()
    ids = bounded_sample(marked, "quality", "doc_id", per_label)
    wanted = marked.sparkSession.createDataFrame([(r[0], r[1]) for r in ids], "doc_id long, quality int")
    known = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    rows = bounded_sample(known, "quality", "doc_id", per_label, "text", most_bytes)
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["quality"]))
    return train([r["text"].encode() for r in rows], [r["quality"] for r in rows])


def judged(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `score`, the neighbours' vote for good quality, in place of a column of that name.

    NULL and empty texts count as empty. All other columns stay as they were, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(column: pd.Series) -> pd.Series:
        texts = [b"" if t is None else t.encode() for t in column.tolist()]
        out = [shared.value.score(run) for run in runs(texts)] or [np.zeros(0)]
        return pd.Series(np.concatenate(out))

    columns = docs.drop("score").columns
    return docs.select(packed(columns).alias("_row"), vote(column_named(text)).alias("score")).select(*unpacked(columns), "score")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
