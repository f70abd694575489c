"""L2 logistic regression over sparse rows: fitted on all rows, in passes over blocks of them, scored in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import let

MEMORY = 10                  # steps that shape the search direction
BLOCK_CELLS = 1 << 17        # of the rows that make a block
ONE_TASK_CELLS = 4_000_000   # that one task fits; with more, every step is a pass over all blocks
PIECE = 1 << 13              # numbers of a gradient that travel together
SENT_BYTES = 64 << 20        # of the tasks' gradients that the driver adds up; more are added up in tasks
_BLOCKS = "label binary, counts binary, indices binary, values binary, tally array<long>"
_PIECES = "piece int, numbers binary"
_FITTED = "coefficients array<array<double>>, intercepts array<double>, iterations int, rows long"


class SparseRows:
    """Rows of (index, value) pairs with products in both directions."""

    def __init__(self, indices: np.ndarray, values: np.ndarray, counts: np.ndarray, width: int):
        self.indices, self.values, self.width, self.height = indices, values, width, len(counts)
        self.row = np.repeat(np.arange(len(counts)), counts)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.indices], self.height)

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.indices, self.values * r[self.row], self.width)


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """Product of two vectors on this thread: BLAS would start one on every core of the driver, for microseconds of work."""
    return np.einsum("i,i->", a, b)


def minimise(f: Callable, x: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, int]:
    """Limited-memory quasi-Newton steps on a convex ``f``, which returns value and gradient.

    Stops when no part of the gradient is above ``tol``, or after ``max_iter`` steps.
    """
    value, gradient = f(x)
    past: list[tuple] = []
    for step in range(max_iter):
        if np.abs(gradient).max(initial=0.0) <= tol:
            return x, step
        direction, weights = -gradient, []
        for s, y, rho in reversed(past):
            a = rho * _dot(s, direction)
            weights.append(a)
            direction = direction - a * y
        if past:
            s, y, _ = past[-1]
            direction = direction * (_dot(s, y) / _dot(y, y))
        for (s, y, rho), a in zip(past, reversed(weights)):
            direction = direction + (a - rho * _dot(y, direction)) * s
        slope = _dot(gradient, direction)
        length = 1.0 if past else 1.0 / max(1.0, _dot(gradient, gradient) ** 0.5)
        while True:
            moved, new = f(x + length * direction)
            if moved <= value + 1e-4 * length * slope:
                break
            length /= 2
            if length < 1e-12:
                return x, step                               # no progress left in double precision
        s, y = length * direction, new - gradient
        if _dot(s, y) > 1e-300:
            past = [*past, (s, y, 1.0 / _dot(s, y))][-MEMORY:]
        x, value, gradient = x + s, moved, new
    return x, max_iter


def _loss(rows: SparseRows, label: np.ndarray, weight: np.ndarray, classes: int, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of the weighted losses of ``rows`` and its gradient; two classes share one vector."""
    vectors, d = (1 if classes == 2 else classes), rows.width
    w, b = theta[:vectors * d].reshape(vectors, d), theta[vectors * d:]
    margin = np.stack([rows.times(w[k]) + b[k] for k in range(vectors)], axis=1)
    if classes == 2:
        signed = np.where(label == 1, margin[:, 0], -margin[:, 0])
        loss = np.logaddexp(0.0, -signed)
        off = (np.exp(-np.logaddexp(0.0, -margin[:, 0])) - label)[:, None]
    else:
        top = margin.max(axis=1, keepdims=True)
        share = np.exp(margin - top)
        norm = share.sum(axis=1, keepdims=True)
        loss = (np.log(norm) + top)[:, 0] - margin[np.arange(len(label)), label]
        off = share / norm
        off[np.arange(len(label)), label] -= 1.0
    off = off * weight[:, None]
    return weight @ loss, np.concatenate([rows.transposed_times(off[:, k]) for k in range(vectors)] + [off.sum(axis=0)])


def _objective(loss: Callable, width: int, vectors: int, c: float, total: float) -> Callable:
    """Mean of the losses that ``loss`` adds up, plus the penalty on the coefficients."""
    def f(theta: np.ndarray):
        value, gradient = loss(theta)
        w = theta[:vectors * width]
        return (value + _dot(w, w) / (2 * c)) / total, (gradient + np.append(w / c, np.zeros(vectors))) / total
    return f


def _packed(classes: int):
    """Rows in blocks of about ``BLOCK_CELLS`` cells, with the number of rows of every class and of cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy().astype(np.int32)
            counts = np.array(batch.column("indices").value_lengths().to_numpy(), np.int32)
            indices, values = (batch.column(c).flatten().to_numpy() for c in ("indices", "values"))
            upto = np.append(0, np.cumsum(counts, dtype=np.int64))
            ends = np.append(np.flatnonzero(np.diff(upto[1:] // BLOCK_CELLS)) + 1, len(label))
            for i, j in zip(np.append(0, ends), ends):
                if i < j:
                    cells = slice(upto[i], upto[j])
                    yield pa.RecordBatch.from_pylist([{
                        "label": label[i:j].tobytes(), "counts": counts[i:j].tobytes(),
                        "indices": indices[cells].astype(np.int32).tobytes(), "values": values[cells].astype(np.float64).tobytes(),
                        "tally": [*np.bincount(label[i:j], minlength=classes).tolist(), int(upto[j] - upto[i])]}], pa.schema([
                            *[(c, pa.binary()) for c in ("label", "counts", "indices", "values")], ("tally", pa.list_(pa.int64()))]))
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(label, counts, indices, values)`` of every block."""
    for batch in batches:
        for block in zip(*[batch.column(c) for c in ("label", "counts", "indices", "values")]):
            yield tuple(np.frombuffer(x.as_buffer(), kind) for x, kind in zip(block, (np.int32, np.int32, np.int32, np.float64)))


def _fit(classes: int, width: int, c: float, max_iter: int, tol: float, balance: np.ndarray, x: np.ndarray):
    """All steps in one task, which has all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, counts, indices, values = (np.concatenate(part) for part in zip(*_unpacked(batches)))
        rows, weight = SparseRows(indices.astype(np.int64), values, counts, width), balance[y]
        vectors = 1 if classes == 2 else classes
        f = _objective(lambda theta: _loss(rows, y, weight, classes, theta), width, vectors, c, weight.sum())
        found, steps = minimise(f, x, max_iter, tol)
        yield pa.RecordBatch.from_pylist([{
            "coefficients": found[:vectors * width].reshape(vectors, width).tolist(), "intercepts": found[vectors * width:].tolist(),
            "iterations": steps, "rows": len(y)}], pa.schema([
                ("coefficients", pa.list_(pa.list_(pa.float64()))), ("intercepts", pa.list_(pa.float64())),
                ("iterations", pa.int32()), ("rows", pa.int64())]))
    return run


def _pieces(numbered: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for piece, numbers in numbered:
        yield pa.RecordBatch.from_pylist([{"piece": piece, "numbers": numbers.tobytes()}],
                                         pa.schema([("piece", pa.int32()), ("numbers", pa.binary())]))


def _partial(classes: int, width: int, balance: np.ndarray, theta: np.ndarray):
    """Loss and gradient of a task's blocks, added up, in pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for label, counts, indices, values in _unpacked(batches):
            value, gradient = _loss(SparseRows(indices, values, counts, width), label, balance[label], classes, theta)
            if total is None:
                total = np.zeros(len(gradient) + 1)
            total[0] += value
            total[1:] += gradient
        if total is not None:
            yield from _pieces((at // PIECE, total[at:at + PIECE]) for at in range(0, len(total), PIECE))
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal pieces of all tasks' gradients, added up."""
    found: dict = {}
    for batch in batches:
        for piece, numbers in zip(batch.column("piece").to_pylist(), batch.column("numbers")):
            found[piece] = found.get(piece, 0.0) + np.frombuffer(numbers.as_buffer())
    yield from _pieces(found.items())


def _passes(blocks: DataFrame, classes: int, width: int, balance: np.ndarray, size: int) -> Callable:
    """Sum of the losses of all rows and its gradient, ``size`` numbers, by one pass over the blocks."""
    many = blocks.rdd.getNumPartitions() * 8 * (size + 1) > SENT_BYTES

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        parts = blocks.mapInArrow(_partial(classes, width, balance, theta), _PIECES)
        if many:
            parts = parts.repartition("piece").mapInArrow(_added, _PIECES)
        total = np.zeros(size + 1)
        for r in parts.collect():
            numbers = np.frombuffer(r["numbers"])
            total[r["piece"] * PIECE:][:len(numbers)] += numbers
        return total[0], total[1:]
    return loss


def _margins(coefficients: np.ndarray, intercepts: np.ndarray):
    """For each vector of coefficients its product with a sparse row, added up in the row's order from the intercept on."""
    @F.arrow_udf("array<double>")
    def weighed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for indices, values in batches:
            n, vectors = len(indices), len(coefficients)
            lengths = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at, x = indices.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)
            row = np.concatenate([np.arange(n), np.repeat(np.arange(n), lengths)])
            found = np.stack([np.bincount(row, np.concatenate([np.full(n, b), x * w[at]]), n)
                              for w, b in zip(coefficients, intercepts)], axis=1)
            missing = indices.is_null().to_numpy(zero_copy_only=False)
            yield pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * vectors), pa.array(
                found.ravel(), mask=np.repeat(missing, vectors)))
    return weighed


@dataclass(frozen=True, eq=False)
class Classifier:
    """Labels in order and a coefficient vector for each (for two labels one, of the second)."""

    labels: tuple
    coefficients: np.ndarray
    intercepts: np.ndarray
    iterations: int = 0
    rows: int = 0               # that it was fitted on

    @staticmethod
    def fit(rows: DataFrame, labels, width: int, c: float = 1.0, max_iter: int = 1000, tol: float = 1e-6,
            start: "Classifier | None" = None) -> "Classifier":
        """Fit all rows (label, features) with balanced class weights.

        Rows are packed into blocks once. Few of them go to one task that does all steps; else every step is a pass, in
        which tasks add up the gradients of their blocks, and the driver moves the coefficients. The optimum is the only
        one: ``start``, a model of the same labels and width, saves steps.
        """
        labels = tuple(labels)
        classes, vectors = len(labels), 1 if len(labels) == 2 else len(labels)
        x = np.zeros(vectors * (width + 1))
        if start is not None and start.labels == labels and start.coefficients.shape[1] == width:
            x = np.concatenate([start.coefficients.ravel(), start.intercepts])
        number = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
        blocks = rows.select(
            number.cast("long").alias("label"), F.col("features.indices").alias("indices"),
            F.col("features.values").alias("values")).mapInArrow(_packed(classes), _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tally = blocks.select(F.posexplode("tally").alias("of", "n")).groupBy("of").agg(F.sum("n").alias("n")).orderBy("of")
            *sizes, cells = [r["n"] for r in tally.collect()]
            n, sizes = sum(sizes), np.maximum(sizes, 1)
            balance = n / (classes * sizes)
            if cells <= ONE_TASK_CELLS:
                row = blocks.repartition(1).mapInArrow(_fit(classes, width, c, max_iter, tol, balance, x), _FITTED).head()
                return Classifier(labels, np.array(row["coefficients"]), np.array(row["intercepts"]), row["iterations"], row["rows"])
            loss = _passes(blocks, classes, width, balance, len(x))
            x, steps = minimise(_objective(loss, width, vectors, c, balance @ sizes), x, max_iter, tol)
            return Classifier(labels, x[:vectors * width].reshape(vectors, width), x[vectors * width:], steps, n)
        finally:
            blocks.unpersist()

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``probability``, an array in the order of ``labels``, and ``prediction_label``."""
        margins = _margins(self.coefficients, self.intercepts)(F.col(f"{features}.indices"), F.col(f"{features}.values"))

        def shares(m: Column) -> Column:
            if len(self.labels) == 2:
                p = 1.0 / (1.0 + F.exp(-m[0]))
                return F.array(1.0 - p, p)
            powers = let(F.array_max(m), lambda top: F.transform(m, lambda x: F.exp(x - top)))
            return let(powers, lambda e: let(F.aggregate(e, F.lit(0.0), lambda s, x: s + x),
                                             lambda total: F.transform(e, lambda x: x / total)))
        scored = df.withColumn("probability", let(margins, shares))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return scored.withColumn("prediction_label", F.element_at(F.array(*map(F.lit, self.labels)), best))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(
            [(list(self.labels), self.coefficients.tolist(), [float(b) for b in self.intercepts], self.iterations, self.rows)],
            "labels array<string>, " + _FITTED).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Classifier":
        row = spark.read.parquet(path).head()
        return Classifier(tuple(row["labels"]), np.array(row["coefficients"]), np.array(row["intercepts"]),
                          row["iterations"], row["rows"])
