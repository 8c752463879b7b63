"""Whitening of embeddings by principal components, from exact bit-sliced cross-products.

1. Components become integers.  The fit list holds each distinct vector once.
2. In a task, each dimension is shifted to begin at zero and cut into bit planes; a plane is packed
   across the rows into words.  The cross-product of two dimensions is the sum over their planes of
   ``2**(a + b)`` times the bits set in both, so nothing is rounded.  A dimension of ones rides
   along: its products are the sums and the number of vectors.
3. Spark adds the products of the tasks in limbs of ``LIMB`` bits, which no number of tasks
   overflows.  The driver gets the square of the width, whatever the number of rows.
4. Products are centred as integers, n C - S S', and only then divided; the eigenvectors of that
   covariance, by falling eigenvalue, project the centred vectors of all rows.

Defined results: rows whose vector is null or holds a null, NaN or infinite component are dropped,
and so are those with a component of ``LARGEST`` or more in magnitude, which no long would hold.  A
shorter vector counts as padded with components of zero.  Rows with a null id, and repeated rows,
are projected like any other.  A component whose eigenvalue is zero, to double precision, has null
for whitened values; if all vectors are equal, ``explained`` and ``identity_error`` are null too.
Vectors of width zero have no component, and an empty table gives no row.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.llm.common import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Magnitude that components stay below: 64 times it fits a long, and so do differences.
LARGEST = 2.0**55
#: Rows whose bits are packed at once, words of an intermediate result, bits of a limb.
ROWS, WORDS, LIMB = 4096, 1 << 20, 40
PRODUCTS = "i int, j int, limb int, value long"


@dataclass
class Whitening:
    """What the fit list gives: its size, the least value and the shifted sum of each dimension,
    and by component the share of the variance and the projection to unit variance."""

    n: int
    least: np.ndarray
    sums: list[int]
    explained: list[float | None]
    projection: np.ndarray
    positive: np.ndarray


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, all of one width, and that width."""
    wide = F.col(vector).cast("array<double>")
    good = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    kept = vectors.filter(F.col(vector).isNotNull() & good)
    x = F.transform(wide, lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    rows = stored(kept.select(F.col(vec_id).alias("vec_id"), x.alias("x")), "whitening-rows")
    spread = rows.agg(F.max(F.size("x")).alias("most"), F.min(F.size("x")).alias("least")).first()
    width = spread["most"] or 0
    if spread["least"] != spread["most"]:
        padding = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x"))
        rows = rows.withColumn("x", F.concat("x", padding))
    return rows, width


def _matrices(batches: Iterator[pa.RecordBatch], width: int, rows: int = ROWS) -> Iterator[np.ndarray]:
    """The vectors of a task, ``rows`` at a time."""
    waiting: list[np.ndarray] = []
    for b in batches:
        waiting.append(b.column(b.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
        if sum(map(len, waiting)) >= rows:
            whole = np.concatenate(waiting)
            full = len(whole) // rows * rows
            yield from np.split(whole[:full], full // rows)
            waiting = [whole[full:]]
    if sum(map(len, waiting)):
        yield np.concatenate(waiting)


def bounds(fit: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for x in _matrices(batches, width):
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(low), pa.array(high)], ["i", "low", "high"])

    found = fit.mapInArrow(extremes, "i int, low long, high long").groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    return np.array([r["low"] for r in found], np.int64), np.array([r["high"] for r in found], np.int64)


def planes(x: np.ndarray, bits: int) -> np.ndarray:
    """(bits, dimensions, words): bit ``k`` of each dimension, packed across the rows."""
    columns = np.ascontiguousarray(x.T)
    out = np.zeros((bits, len(columns), -(-len(x) // 64)), np.uint64)
    for k in range(bits):
        packed = np.packbits(((columns >> k) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[k].view(np.uint8)[:, : packed.shape[1]] = packed
    return out


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits set in both, for each dimension of ``a`` with each of ``b``."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, WORDS // max(1, b.size))
    for at in range(0, len(a), step):
        out[at : at + step] = np.bitwise_count(a[at : at + step, None] & b[None]).sum(2, dtype=np.int64)
    return out


def cross_products(matrices: Iterator[np.ndarray], bits: int, size: int) -> list[np.ndarray]:
    """Limbs of X'X, least first, for matrices of numbers from 0 to below ``2**bits``."""
    limbs = [np.zeros((size, size), np.int64) for _ in range(-(-(2 * bits + 63) // LIMB))]
    for x in matrices:
        p = planes(x, bits)
        used = [k for k in range(bits) if p[k].any()]
        for a in used:
            for b in used:
                if a <= b:
                    both = common_bits(p[a], p[b])
                    both = both + both.T if a < b else both
                    limbs[(a + b) // LIMB] += both << ((a + b) % LIMB)
        for low, high in zip(limbs, limbs[1:], strict=False):
            high += low >> LIMB
            low &= (1 << LIMB) - 1
    return limbs


def products(fit: DataFrame, least: np.ndarray, bits: int) -> list[list[int]]:
    """Exact cross-products of the shifted dimensions and of a last one of ones."""
    width = len(least)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = (np.column_stack([x - least, np.ones(len(x), np.int64)]) for x in _matrices(batches, width))
        for k, limb in enumerate(cross_products(ones, bits, width + 1)):
            i, j = np.nonzero(np.triu(limb))
            if len(i):
                columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), k), pa.int32()), pa.array(limb[i, j])]
                yield pa.RecordBatch.from_arrays(columns, ["i", "j", "limb", "value"])

    total = [[0] * (width + 1) for _ in range(width + 1)]
    for r in fit.mapInArrow(summed, PRODUCTS).groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():
        total[r["i"]][r["j"]] += r["value"] << (LIMB * r["limb"])
    for i in range(width + 1):
        for j in range(i):
            total[i][j] = total[j][i]
    return total


def solved(total: list[list[int]], least: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Covariance, centred as integers, and its leading components; their signs are such that the
    entry of largest magnitude, the first of equal ones, is positive."""
    width = len(least)
    n, sums = total[-1][-1], total[-1][:-1]
    cov = np.array([[(n * total[i][j] - sums[i] * sums[j]) / (n * n) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    trace = float(np.trace(cov))
    positive = values > max(width * np.finfo(float).eps * float(values[0]), 0.0)
    projection = vectors / np.sqrt(np.where(positive, values, 1.0))
    explained = [max(float(v), 0.0) / trace if trace else None for v in values]
    return Whitening(n, least, sums, explained, projection, positive)


def fitted(rows: DataFrame, width: int, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of (vec_id, x), and the fit list; a task sends a vector once."""
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    least, most = bounds(fit, width)
    bits = max(1, int((most - least).max()).bit_length())
    return solved(products(fit, least, bits), least, components), fit


def projected(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n x - S, exact in integers, and the whitened values."""
    shifted = x - model.least
    sums = np.array(model.sums, object)
    far = max((abs(model.n * int(v) - s) for v, s in zip(shifted.max(0), model.sums, strict=True)), default=0)
    if max(far, max(model.sums, default=0)) < 1 << 62:
        apart = shifted * np.int64(model.n) - sums.astype(np.int64)
    else:
        apart = shifted.astype(object) * model.n - sums
    whitened = (apart / model.n).astype(float) @ model.projection
    return apart, np.where(model.positive, whitened, np.nan)


def squares(apart: np.ndarray) -> list[int]:
    """Exact sums of squares by row: halves of 26 bits where the numbers allow, else Python's integers."""
    if apart.dtype == object or np.abs(apart).max(initial=0) >= 1 << 52 or apart.shape[1] > 1 << 10:
        return [sum(int(v) ** 2 for v in row) for row in apart]
    high, low = np.divmod(np.abs(apart), 1 << 26)
    parts = [(a * b).sum(1).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 52) + (hl << 27) + ll for hh, hl, ll in zip(*parts, strict=True)]


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured on it."""
    k, width = int(model.positive.sum()), len(model.least)
    if not k:
        return None

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _matrices(batches, width):
            y = projected(model, x)[1][:, model.positive]
            total[:k] += y.T @ y
            total[k] += y.sum(0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (i, j, total)], ["i", "j", "value"])

    total = np.zeros((k + 1, k))
    for r in fit.mapInArrow(summed, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] = r["value"]
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained and identity_error, a row for
    each row that takes part and component."""
    rows, width = quantised(vectors, vec_id, vector)
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not width:
        empty = StructType([rows.schema["vec_id"], *StructType.fromDDL(schema).fields])
        return vectors.sparkSession.createDataFrame([], empty)
    model, fit = fitted(rows, width, components)
    error = identity_error(fit, model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (x,) = list(_matrices(iter([b]), width, max(1, b.num_rows))) or [np.zeros((0, width), np.int64)]
            apart, values = projected(model, x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(str, squares(apart)), pa.string()), lists], ["vec_id", "deviation", "values"])

    out = StructType([rows.schema["vec_id"], StructField("deviation", StringType()), *StructType.fromDDL("values array<double>").fields])
    found = rows.select("vec_id", "x").mapInArrow(project, out)
    shares = F.lit(model.explained) if all(v is not None for v in model.explained) else F.array_repeat(F.lit(None).cast("double"), len(model.explained))
    found = found.select("vec_id", F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"), F.posexplode("values").alias("at", "value"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.nanvl("value", F.lit(None).cast("double")).alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def digest(vectors: DataFrame) -> DataFrame:
    """All rows on the first 16 components; a deviation beyond a long is null."""
    rows = whitened(vectors.select("vec_id", "embedding"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
