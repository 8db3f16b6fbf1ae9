"""Whitening of embedding vectors by shifted CholeskyQR: Gram passes, composed R factors, SVD of R."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
PASSES = 3
MOST_DIMENSIONS = 4096  # the driver holds matrices of this many rows and columns
LONG = 2**63
SCHEMA = "n long, deviation long, component int, whitened double, explained double, identity_error double"


def entries(batch: pa.RecordBatch, vector: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that count, and their entries as whole numbers, one row each."""
    lists = batch.column(vector)
    right = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), width), False).to_numpy(zero_copy_only=False))
    values = lists.take(pa.array(right)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values.reshape(-1, width) * SCALE)
        fine = (np.abs(x) < LONG - 2 * OFFSET).all(axis=1)  # false for NaN and infinity too
    return right[fine], x[fine].astype(np.int64) + OFFSET


@dataclass
class Centre:
    """Number of rows, sums of the dimensions and the largest entry: all exact."""

    n: int
    sums: list[int]
    most: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums; Python's integers where 64 bits may not hold them."""
        if self.n * self.most < LONG // 2:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row, None where a long can't hold it."""
    most = int(np.abs(deviations).max(initial=0))
    if deviations.dtype != object and deviations.shape[1] * most**2 < LONG:
        return (deviations**2).sum(axis=1).tolist()
    exact = (deviations.astype(object) ** 2).sum(axis=1)
    return [v if v < LONG else None for v in exact]


def most_common_width(rows: DataFrame, vector: str) -> int:
    """The most frequent length of a vector, the longer one of two; 0 without any vector."""
    found = (
        rows.where(F.col(vector).isNotNull())
        .groupBy(F.size(vector).alias("width")).count()
        .orderBy(F.desc("count"), F.desc("width")).first()
    )
    return found["width"] if found else 0


def centre_of(rows: DataFrame, vector: str, width: int) -> Centre:
    """One pass: tasks add up whole numbers, Spark adds up the tasks' sums as decimals."""

    def add(batches):
        n, most, total = 0, 0, np.zeros(width, dtype=object)
        for batch in batches:
            _, x = entries(batch, vector, width)
            if len(x):
                peak = max(int(x.max()), -int(x.min()))
                n, most = n + len(x), max(most, peak)
                total = total + (x if peak * len(x) < LONG else x.astype(object)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict(
            {"dim": range(width), "n": [n] * width, "total": [str(t) for t in total], "most": [str(most)] * width}
        )

    parts = rows.select(vector).mapInArrow(add, "dim long, n long, total string, most string")
    exact = "decimal(38, 0)"
    sums = parts.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast(exact)).alias("total"), F.max(F.col("most").cast(exact)).alias("most")
    )
    found = sorted(sums.collect())
    return Centre(found[0]["n"] or 0, [int(r["total"]) for r in found], int(found[0]["most"]))


def gram(rows: DataFrame, vector: str, width: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of A^T A over all rows, where `of` maps a block of entries to its rows A of `size` columns.

    A task sends one matrix, the cells are added up on the cluster, and the driver gets size^2 numbers.
    """

    def multiply(batches):
        total = np.zeros((size, size))
        for batch in batches:
            _, x = entries(batch, vector, width)
            if len(x):
                a = of(x)
                total += a.T @ a
        yield pa.RecordBatch.from_pydict({"cell": np.arange(size * size), "v": total.ravel()})

    cells = rows.select(vector).mapInArrow(multiply, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(size * size)
    for cell, v in cells.collect():
        out[cell] = v
    return out.reshape(size, size)


def cholesky(g: np.ndarray, shift: bool) -> np.ndarray:
    """Upper R with R^T R = g, or g raised on its diagonal where asked for or where g is not definite."""
    size, unit = len(g), np.finfo(np.float64).eps
    least = 11 * size * (size + 1) * unit * max(np.trace(g), np.finfo(np.float64).tiny)
    raised = least if shift else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + raised * np.eye(size)).T
        except np.linalg.LinAlgError:
            raised = max(10 * raised, least)


def solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows of a, through one triangular solve after the other."""
    for r in factors:
        a = np.linalg.solve(r.T, a.T).T
    return a


@dataclass
class Whitening:
    """Where the vectors are centred, and how they are projected: columns of `project` for each component."""

    width: int
    centre: Centre
    project: np.ndarray
    explained: np.ndarray
    identity_error: float

    def components(self) -> int:
        return self.project.shape[1]


def fit(rows: DataFrame, vector: str = "embedding", most: int = 8) -> Whitening | None:
    """Components of the covariance of all vectors, by falling eigenvalue; None without any vector.

    The centred rows are made orthogonal three times: their Gram matrix gives a triangular R (raised
    by a shift in the first pass, and later where the rows have a lower rank), and the next pass reads
    the rows again through the triangular solves so far. The product of the R has the singular values
    and right vectors of the centred rows, so the covariance is never formed. Directions without
    variance, and so components beyond the rank, are left out.
    """
    width = most_common_width(rows, vector)
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} dimensions; at most {MOST_DIMENSIONS}")
    centre = centre_of(rows, vector, width) if width else Centre(0, [], 0)
    if centre.n == 0:
        return None
    factors: list[np.ndarray] = []
    product = np.eye(width)
    for k in range(PASSES):
        g = gram(rows, vector, width, lambda x, f=tuple(factors): solved(centre.centred(x), f), width)
        factors.append(cholesky(g, shift=k == 0))
        product = factors[-1] @ product
    _, s, right = np.linalg.svd(product)
    rank = int((s > s[0] * 100 * width * np.finfo(np.float64).eps).sum()) if s[0] > np.sqrt(np.finfo(np.float64).tiny) else 0
    k = min(rank, most)
    s, directions = s[:k], right[:k]
    lead = np.abs(directions).argmax(axis=1)
    directions = directions * np.sign(directions[np.arange(k), lead])[:, None]
    project = directions.T * (np.sqrt(centre.n) / s) if k else np.zeros((width, 0))
    total = float((np.linalg.svd(product, compute_uv=False) ** 2).sum())
    explained = s**2 / total if k else np.zeros(0)
    error = 0.0
    if k:
        seen = gram(rows, vector, width, lambda x: centre.centred(x) @ project, k) / centre.n
        error = float(np.abs(seen - np.eye(k)).max())
    return Whitening(width, centre, project, explained, error)


def applied(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row that counts and component: key, n, deviation, component, whitened and two figures of the fit.

    A row counts unless its vector is NULL, has NULL, non-finite or (times 1,024) more than 64-bit
    entries, or another length than most vectors have. Repeated rows give repeated results, a NULL key stays
    NULL; other columns are not returned, whatever their names. deviation is the exact sum of squares of
    n * x - S, NULL where a long can't hold it.
    """
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, {SCHEMA}"
    if model is None or model.components() == 0:
        return rows.sparkSession.createDataFrame([], schema)
    k, centre = model.components(), model.centre
    names = [key, *(c.split()[0] for c in SCHEMA.split(", "))]

    def project(batches):
        for batch in batches:
            kept, x = entries(batch, vector, model.width)
            if len(x) == 0:
                continue
            off = centre.deviations(x)
            rows_of = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(kept[rows_of])),
                    pa.array(np.full(len(rows_of), centre.n)),
                    pa.array(squares(off), pa.int64()).take(pa.array(rows_of)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(((off / centre.n).astype(np.float64) @ model.project).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(rows_of), model.identity_error)),
                ],
                names=names,
            )

    return rows.select(key, vector).mapInArrow(project, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return applied(rows, fit(rows)).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
