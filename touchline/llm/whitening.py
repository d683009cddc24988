"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver (op 13).

1. Entries become integers (``floor(scale * c) + offset``), so that equal vectors are equal
   whatever their rounding; the fit list holds each distinct vector once (combined map-side, so
   a vector with a third of all rows is one row per task).
2. Sums per dimension are taken in integers: exact partial sums per task, added as decimals.
3. Rows of the fit list, centred in integers before anything is rounded, are reduced to one
   triangle R per task by QR of blocks; triangles are joined in groups of ``FAN``, round by
   round, so no task holds more than ``FAN`` of them and the driver sees one.  R'R is n times
   the covariance, which is never formed.
4. On that one triangle, as large as the vectors have dimensions: Householder bidiagonal form,
   dqds for the singular values, twisted factorisations for the directions
   (``bidiagonal.right_singular``).
5. The covariance of the whitened fit list is measured, and all rows are projected.

Result: one row per vector and component, by falling eigenvalue.  Components end at the
numerical rank of the covariance, where whitening is not defined; so equal vectors only, or
one vector only, give no rows.

Edge cases: rows with a null vector, an empty one, or null or non-finite entries are dropped,
and so are entries whose integer would not fit (magnitude of 2^52 or more); vectors must agree
in their number of dimensions, and those that differ from the most frequent number (ties: the
larger) are dropped; repeated rows and repeated or null ids are projected like others; an empty
table gives no rows; other columns are not read.  ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.bidiagonal import right_singular
from touchline.scratch import spill

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BLOCK = 4096
FAN = 32
_LIMIT = float(1 << 52)
_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """What a fit leaves: per-dimension sums, directions and eigenvalues (all of them)."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # dimensions x components, divided by the root of the eigenvalue
    eigenvalues: np.ndarray
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.eigenvalues.sum()


def whole_vectors(rows: DataFrame, vector: str, id_column: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x) of the usable rows; x holds long integers."""
    c = F.col(vector).cast("array<double>")

    def usable(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < _LIMIT)

    return (
        rows.select(F.col(id_column).cast("long").alias("vec_id"), c.alias("c"))
        .filter(F.col("c").isNotNull() & (F.size("c") > 0))
        .filter(F.forall("c", lambda v: F.coalesce(usable(v), F.lit(False))))
        .select(
            "vec_id",
            F.transform("c", lambda v: F.floor(v * scale) + F.lit(offset).cast("long")).alias("x"),
        )
    )


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums; high and low halves add up apart, so nothing overflows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            columns = [np.arange(d), np.full(d, len(x)), (x >> 26).sum(axis=0), (x & 0x3FFFFFF).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "n", "high", "low"])

    total = (
        fit.mapInArrow(partial, "dim long, n long, high long, low long")
        .groupBy("dim")
        .agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")))
        .orderBy("dim")
        .collect()  # one row per dimension
    )
    if not total:
        return 0, []
    return total[0]["n"], [(int(r["high"]) << 26) + int(r["low"]) for r in total]


class _Centre:
    """x - S / n in double, subtracting the whole part in integers first."""

    def __init__(self, n: int, sums: tuple[int, ...]) -> None:
        self.whole = np.array([s // n for s in sums], "i8")
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest


def _triangle(blocks: np.ndarray, d: int) -> np.ndarray:
    r = np.linalg.qr(blocks, mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def _reduced(fit: DataFrame, d: int, centre: _Centre) -> np.ndarray:
    """The triangle R of the centred fit list."""

    def joined(held: list[np.ndarray], task: int) -> pa.RecordBatch:
        r = _triangle(np.vstack(held), d)
        return pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["task", "r"]
        )

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, task = [], None
        for batch in batches:
            if not len(batch):
                continue
            task = batch.column(1)[0].as_py() if task is None else task
            x = _matrix(batch.column(0), d)
            for k in range(0, len(x), BLOCK):
                held = [_triangle(np.vstack([*held, centre(x[k : k + BLOCK])]), d)]
        if held:
            yield joined(held, task)

    def of_triangles(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            np.frombuffer(r, float).reshape(d, d)
            for batch in batches
            for r in batch.column(1).to_pylist()
        ]
        yield joined(held, key[0].as_py())

    layout = "task long, r binary"
    numbered = fit.withColumn("task", F.spark_partition_id().cast("long"))
    found = spill(numbered.mapInArrow(of_rows, layout), "whitening-triangles")
    while True:
        many = found.agg(F.count(F.lit(1)), F.max("task")).first()
        if many[0] <= FAN:
            break
        grouped = found.select((F.col("task") / F.lit(FAN)).cast("long").alias("task"), "r")
        found = spill(grouped.groupBy("task").applyInArrow(of_triangles, layout), "whitening-triangles")
    parts = [np.frombuffer(row["r"], float).reshape(d, d) for row in found.orderBy("task").collect()]
    return _triangle(np.vstack(parts), d)


def _identity_error(fit: DataFrame, d: int, centre: _Centre, directions: np.ndarray, n: int) -> float:
    """Largest entry of the whitened covariance minus the identity, measured on the fit list."""
    k = directions.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, gram = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = centre(_matrix(batch.column(0), d)) @ directions
            total += w.sum(axis=0)
            gram += w.T @ w
        columns = [np.arange(k * (k + 1)), np.concatenate([total, gram.ravel()])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "value"])

    sums = fit.mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    values = np.array([r["value"] for r in sums.orderBy("at").collect()])  # components squared
    mean, gram = values[:k] / n, values[k:].reshape(k, k) / n
    # The rows are centred up to rounding; what is left of their mean goes here.
    return float(np.abs(gram - np.outer(mean, mean) - np.eye(k)).max())


def fitted(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in ``x`` (x); None where no direction varies."""
    fit = spill(x.select("x").groupBy("x").agg(F.lit(1).alias("__one")).select("x"), "whitening-fit")
    d = len(fit.first()["x"]) if not fit.isEmpty() else 0
    n, sums = _sums(fit, d) if d else (0, [])
    if not n:
        return None
    centre = _Centre(n, tuple(sums))
    squares, directions = right_singular(_reduced(fit, d, centre), components)
    k = directions.shape[1]
    if not k:
        return None
    eigenvalues = np.maximum(squares, 0.0) / n
    directions = directions / np.sqrt(eigenvalues[:k])
    error = _identity_error(fit, d, centre, directions, n)
    return Whitening(n, tuple(sums), directions, eigenvalues, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n * x - S)^2 per row in exact integers; null beyond a long."""
    top = 1 << 63
    largest = max(int(np.abs(x).max()), 1) * n + max(abs(s) for s in sums)
    if largest < top:
        gap = x * n - np.array(sums, "i8")
        if int(np.abs(gap).max()) ** 2 * x.shape[1] < top:
            return (gap**2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < top else None for v in exact]


def projected(x: DataFrame, model: Whitening) -> DataFrame:
    """Rows of (vec_id, x) on the model's directions, long form."""
    k, d = model.directions.shape[1], model.directions.shape[0]
    centre = _Centre(model.n, model.sums)
    explained = model.explained[:k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column(1), d)
            w = centre(rows) @ model.directions
            m = len(rows)
            times = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(times)),
                pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(_deviations(rows, model.n, model.sums), pa.int64()).take(pa.array(times)),
                pa.array(w.ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            names = [c.split()[0] for c in _RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return x.select("vec_id", "x").mapInArrow(run, _RESULT)


def whitened(
    rows: DataFrame,
    vector: str = "embedding",
    id_column: str = "vec_id",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    x = whole_vectors(rows, vector, id_column, scale, offset)
    size = F.size("x")
    common = x.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("times"))
    best = common.orderBy(F.desc("times"), F.desc("d")).first()
    model = None
    if best is not None:
        x = x.filter(size == best["d"])
        model = fitted(x, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], _RESULT)
    return projected(x, model)
