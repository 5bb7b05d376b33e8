"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Products with the centred matrix Z of all rows are taken where the rows are; the driver holds vectors as long as one
embedding. A left vector u has an entry for each row, so it is never stored: it is Zw for a w as long as an embedding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import scratch, table

COMPONENTS = 32
#: Entries of a block of rows.
BLOCK = 1 << 18
#: Deviations below this part of the largest are rounding, not components.
LEAST_PART = 1e-11
#: A left vector with a larger part in those before is orthogonalised once more.
ORTHOGONAL = 1e-8
#: Entries beyond this, either way, are set to it, so that whole numbers of 64 bits hold all sums of a block.
MOST = 1 << 44


def lattice(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 of each entry."""
    return np.clip(np.floor(vectors * 64.0), -MOST, MOST).astype(np.int64) + 1_000_000


def usable(vector_col: str) -> Column:
    """Neither null nor empty, and no entry that is null, NaN or infinite."""
    bad = F.exists(F.col(vector_col).cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~F.coalesce(bad, F.lit(True))


@dataclass
class Blocks:
    """Rows of whole numbers in blocks, written once: ids (list of longs) and x (32 or 64 bits an entry, row by row)."""

    rows: DataFrame
    size: int
    n: int
    sums: list[int]

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The mean as whole part, rest of the division by n, and that rest as whole numbers."""
        whole = [s // self.n for s in self.sums]
        rest = [s - self.n * w for s, w in zip(self.sums, whole)]
        return np.array(whole, np.int64), np.array([r / self.n for r in rest]), rest


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for ids, x in zip(batch.column(0), batch.column(1)):
            raw = x.as_buffer()
            width = 4 if raw.size == 4 * size * len(ids) else 8
            yield ids.values, np.frombuffer(raw, f"<i{width}").reshape(-1, size).astype(np.int64)


def blocks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Blocks | None:
    """The usable rows of the most usual length (of equally usual ones the least); None if there are none."""
    rows = vectors.where(usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usual = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if usual is None:
        return None
    size = usual["size"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // size)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = lattice(np.asarray(part.column(1).flatten()).reshape(-1, size))
                small = np.abs(x).max() < 1 << 31
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.astype("<i4" if small else "<i8").tobytes()], pa.binary())], ["ids", "x"])

    spark, out = vectors.sparkSession, scratch(vectors.sparkSession, "vectors")
    rows.where(F.size("v") == size).mapInArrow(pack, "ids array<long>, x binary").write.parquet(out)
    packed = Blocks(spark.read.parquet(out), size, 0, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In two halves, so that no sum of whole numbers overflows.
        high, low, n = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64), 0
        for ids, x in _matrices(batches, size):
            high[:size] += (x >> 24).sum(axis=0)
            low[:size] += (x & 0xFFFFFF).sum(axis=0)
            n += len(ids)
        low[size] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(high), pa.array(low)], ["at", "high", "low"])

    found = packed.rows.mapInArrow(run, "at long, high long, low long").groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums = {r["at"]: (r["high"] << 24) + r["low"] for r in found}
    packed.n = sums.pop(size)
    packed.sums = [sums[i] for i in range(size)]
    return packed


def summed(data: Blocks, count: int, of: Callable[[np.ndarray, object], np.ndarray], sent: object) -> np.ndarray:
    """`count` sums over all blocks of what `of` makes of a block's centred rows and of what is sent along."""
    size, (whole, rest, _) = data.size, data.centre
    value = data.rows.sparkSession.sparkContext.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for _, x in _matrices(batches, size):
            total += of((x - whole) - rest, value.value)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(total)], ["at", "x"])

    out = np.zeros(count)
    for r in data.rows.select("ids", "x").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    value.unpersist()
    return out


def _step(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """w: the candidate in its first column, then those of the left vectors so far. Zᵀu, uᵀu and the parts of u in those."""
    left = z @ w
    u = left[:, 0]
    return np.concatenate([z.T @ u, left.T @ u])


def _apart(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """v without its part in the others, twice."""
    if others:
        basis = np.stack(others, axis=1)
        for _ in range(2):
            v = v - basis @ (basis.T @ v)
    return v


def bidiagonalised(data: Blocks, steps: int | None = None, tolerance: float | None = None, components: int = COMPONENTS):
    """V (orthonormal columns) and upper bidiagonal B with Z V = U B and orthonormal U.

    Each step takes one pass over the rows: u = Zv - beta u_before, its parts in all left vectors so far, and Zᵀu.
    All steps (as many as dimensions) give the whole decomposition; fewer, by number or by a tolerance on the
    residuals of the leading components, give those that have settled, a repeated eigenvalue then maybe once.
    A direction without any deviation ends a chain; the next one starts from noise, apart from all before.
    """
    size, noise = data.size, np.random.default_rng(13)
    rights: list[np.ndarray] = []
    lefts, images = [], []  # w of each left vector, and Zᵀu of it
    alphas, betas = [], []
    v, beta, scale = noise.standard_normal(size), 0.0, 0.0
    v /= np.linalg.norm(v)
    for k in range(min(size, steps or size)):
        rights.append(v)
        w = v - beta * lefts[-1] if beta else v
        while True:
            found = summed(data, size + 1 + k, _step, np.stack([w, *lefts], axis=1))
            image, square, parts = found[:size], found[size], found[size + 1:]
            scale = max(scale, np.sqrt(square))
            if k:
                w = w - np.stack(lefts, axis=1) @ parts
                image = image - np.stack(images, axis=1) @ parts
            left = square - parts @ parts
            if left <= (LEAST_PART * scale) ** 2 or parts @ parts <= ORTHOGONAL**2 * square:
                break
        if left <= (LEAST_PART * scale) ** 2:  # Zv lies in the left vectors before
            alpha, w, image = 0.0, np.zeros(size), np.zeros(size)
        else:
            alpha = float(np.sqrt(left))
            w, image = w / alpha, image / alpha
        lefts.append(w)
        images.append(image)
        alphas.append(alpha)
        following = _apart(image - alpha * v, rights)
        beta = float(np.linalg.norm(following))
        if tolerance is not None and len(alphas) > components and _residuals(alphas, betas, beta)[:components].max() <= tolerance:
            break
        if k + 1 < size and beta <= LEAST_PART * scale:
            beta, following = 0.0, _apart(noise.standard_normal(size), rights)
        if k + 1 < size:
            v = following / np.linalg.norm(following)
            betas.append(beta)
    steps_made = len(alphas)
    return np.stack(rights, axis=1), np.diag(alphas) + np.diag(betas[:steps_made - 1], 1)


def _residuals(alphas: list[float], betas: list[float], beta: float) -> np.ndarray:
    left, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1))
    return beta * np.abs(left[-1]) / max(values[0], 1e-300)


@dataclass
class Whitening:
    """components: orthonormal columns; eigenvalues and their parts of the trace, falling."""

    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def fitted(data: Blocks, components: int = COMPONENTS, steps: int | None = None, tolerance: float | None = None) -> Whitening:
    """The leading components that deviate at all, so none if all rows are equal."""
    rights, band = bidiagonalised(data, steps, tolerance, components)
    _, deviations, turned = np.linalg.svd(band)
    kept = int((deviations[:components] > LEAST_PART * max(deviations[0], 1e-300)).sum()) if deviations[0] > 0 else 0
    axes, values = rights @ turned[:kept].T, deviations[:kept] ** 2 / data.n

    def moments(z: np.ndarray, axes: np.ndarray) -> np.ndarray:
        y = z @ axes
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel(), [np.einsum("ij,ij->", z, z)]])

    found = summed(data, kept + kept * kept + 1, moments, axes / np.sqrt(values))
    mean = found[:kept] / data.n
    error = found[kept:-1].reshape(kept, kept) / data.n - np.outer(mean, mean) - np.eye(kept)
    trace = found[-1] / data.n
    return Whitening(axes, values, values / trace if kept else values, float(np.abs(error).max(initial=0.0)))


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row: vec_id, n, deviation (decimal), whitened (list by component), explained (list), identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are those of another
    length than the most usual one. Repeated rows count and come as often as they are there; a null id stays null;
    ties of eigenvalues come in either order; other columns are ignored. An empty table gives an empty one, equal
    rows empty lists. A deviation of more than 38 digits is null.
    """
    data = blocks(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    if data is None:
        return spark.createDataFrame([], "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
    fit = fitted(data, components)
    size, n, (whole, rest, over) = data.size, data.n, data.centre
    axes = fit.components / np.sqrt(fit.eigenvalues)
    squares = sum(r * r for r in over)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, size):
            y = x - whole
            most = int(np.abs(y).max())
            # (n y - over)² summed, in whole numbers of 64 bits where they suffice.
            wide = y.astype(object) if size * most * max(most, n) >= 1 << 63 else y
            own, mixed = (wide * wide).sum(axis=1).tolist(), (wide @ np.array(over, wide.dtype)).tolist()
            found = [n * n * a - 2 * n * b + squares for a, b in zip(own, mixed)]
            places = (y - rest) @ axes
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * axes.shape[1], pa.int32()), pa.array(places.ravel(), pa.float64()))
            exact = pa.array([Decimal(f) if f < 10**38 else None for f in found], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([ids, exact, lists], ["vec_id", "deviation", "whitened"])

    rows = data.rows.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(float(x)) for x in fit.explained]).cast("array<double>")
    return rows.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(fit.identity_error).alias("identity_error"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitened(table(spark, folder, "embeddings"))
    return rows.select("*", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"), F.get("explained", F.col("at")).alias("explained"), "identity_error")
