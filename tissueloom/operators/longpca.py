"""Principal components of a long table, without dense vectors, and the cells that they place in space."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.operators.reduce import N_COMPONENTS
from tissueloom.operators.spots import add_z
from tissueloom.sources.storage import materialise

#: Columns of the block beyond the components asked for, and the relative change at which the block has settled.
EXTRA, TOLERANCE = 8, 1e-9


@dataclass(frozen=True)
class LongComponents:
    """``loadings``: ``gene, vec``; ``scores``: ``by…, X_pca``; the variance ``share`` of each component; the ``rounds``
    done and whether the block ``settled`` within them."""

    loadings: DataFrame
    scores: DataFrame
    share: np.ndarray
    rounds: int
    settled: bool


def _multiply(values: DataFrame, factor: DataFrame, on: list[str], out: list[str], width: int, shift: Sequence[float]) -> DataFrame:
    """``out…, q``: for every row of the long matrix the sum of value times the other side's row, minus ``shift``."""
    terms = [F.sum(F.col("value") * F.col("q")[i]).alias(f"_{i}") for i in range(width)]
    sums = values.join(factor.select(*on, "q"), on).groupBy(*out).agg(F.count("*"), *terms)
    row = F.array(*[F.col(f"_{i}") - F.lit(float(s)) for i, s in enumerate(shift)])
    return sums.select(*out, row.cast("array<double>").alias("q"))


def _gram(table: DataFrame, width: int) -> np.ndarray:
    """Products of all columns of ``q``: a matrix per task, summed by Spark; ``width``^2 numbers reach the driver."""

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            rows = batch.column("q").flatten().to_numpy().reshape(-1, width)
            total += rows.T @ rows
        i, j = np.indices((width, width))
        columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    sums = table.select("q").mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in sums.collect():
        out[r.i, r.j] = r.v
    return (out + out.T) / 2


def _rotate(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``q`` times ``matrix``; other columns stay."""
    width = matrix.shape[0]
    at = table.columns.index("q")

    def run(batches):
        for batch in batches:
            rows = batch.column("q").flatten().to_numpy().reshape(batch.num_rows, width) @ matrix
            cuts = pa.array(np.arange(len(rows) + 1) * matrix.shape[1], pa.int32())
            yield batch.set_column(at, "q", pa.ListArray.from_arrays(cuts, pa.array(rows.ravel())))

    return table.mapInArrow(run, table.schema)


def fit_pca_long(
    values: DataFrame, k: int = N_COMPONENTS, by: Sequence[str] = ("slice", "cell"), extra: int = EXTRA,
    tolerance: float = TOLERANCE, rounds: int = 100, seed: int = 7,
) -> LongComponents:
    """Components of the centred matrix cells x genes given as ``by…, gene, value``; absent entries are 0.

    Block power iteration from a seeded random block of ``k + extra`` columns (at most as many as genes): a round is
    two keyed aggregations of the long table, matrix times block and transposed matrix times that, and the
    block is made orthonormal by its small product matrix.  Means are taken off the products, never off
    the entries.  Rounds end when the components' variances settle within ``tolerance``; a caller sees in
    ``settled`` whether they did.  Cells are those of the table; (``by``, gene) must be unique.  Without any
    variance there are no components.  The sign of a component is arbitrary.
    """
    by = list(by)
    values = materialise(values.select(*by, "gene", F.col("value").cast("double").alias("value")).filter("value IS NOT NULL"), "values")
    n = values.select(*by).distinct().count()
    genes = values.groupBy("gene").agg((F.sum("value") / F.lit(float(max(n, 1)))).alias("mean"), F.sum(F.col("value") ** 2).alias("square"))
    genes = materialise(genes, "genes")
    total, count = genes.agg(F.sum(F.col("square") - n * F.col("mean") ** 2), F.count("*")).first()
    width = min(k + extra, count)
    start = [F.pmod(F.xxhash64("gene", F.lit(seed), F.lit(i)), F.lit(1 << 20)) / F.lit(float(1 << 19)) - 1.0 for i in range(width)]
    factor = materialise(genes.select("gene", "mean", F.array(*start).cast("array<double>").alias("q")), "factor")
    last, settled, done = np.inf, False, 0
    while True:
        shift = factor.agg(*[F.sum(F.col("mean") * F.col("q")[i]) for i in range(width)]).first() if width else ()
        placed = materialise(_multiply(values, factor, ["gene"], by, width, [s or 0.0 for s in shift]), "placed")
        if settled or done == rounds or not width:
            break
        back = _multiply(values, placed, by, ["gene"], width, [0.0] * width)
        # the columns of ``placed`` sum to zero, so the means need not be taken off again
        back = materialise(genes.select("gene", "mean").join(back, "gene").select("gene", "mean", "q"), "back")
        size, vectors = np.linalg.eigh(_gram(back, width))
        kept = size > 1e-20 * max(size.max(initial=0), 1e-300)
        size, vectors = size[kept][::-1], vectors[:, kept][:, ::-1]
        factor = materialise(_rotate(back, vectors / np.sqrt(size)), "factor")
        width = len(size)
        now = np.sqrt(size[:k]).sum()
        settled, last, done = bool(abs(now - last) <= tolerance * now), now, done + 1
    variance, turn = np.linalg.eigh(_gram(placed, width)) if width else (np.zeros(0), np.zeros((0, 0)))
    variance, turn = variance[::-1][:k], turn[:, ::-1][:, :k]
    share = np.maximum(variance, 0) / total if total else np.zeros(0)
    return LongComponents(
        _rotate(factor.select("gene", "q"), turn).withColumnRenamed("q", "vec"),
        _rotate(placed, turn).withColumnRenamed("q", "X_pca"),
        share, done, settled,
    )


def numbered_cells(scores: DataFrame, cells: DataFrame) -> DataFrame:
    """``cell, slice, slice_cell, vec, xyz``: every (slice, cell) under a number of its own, with its scores and 3-D place.

    ``scores``: ``slice, cell, X_pca``; ``cells``: ``slice, cell, x, y``.  Cell ids may repeat between slices; the third
    coordinate comes from the slice's name.  Cells without a place drop out.
    """
    placed = add_z(cells.select("slice", "cell", "x", "y"))
    located = scores.join(placed, ["slice", "cell"]).select(
        F.monotonically_increasing_id().alias("number"), "slice", F.col("cell").alias("slice_cell"), F.col("X_pca").alias("vec"),
        F.array(*[F.col(c).cast("double") for c in "xyz"]).alias("xyz"),
    )
    return materialise(located.withColumnRenamed("number", "cell"), "cells")


def by_number(values: DataFrame, numbered: DataFrame) -> DataFrame:
    """``cell, gene, value`` of long ``slice, cell, gene, value`` under the numbers of ``numbered_cells``."""
    names = numbered.select("slice", F.col("slice_cell").alias("cell"), F.col("cell").alias("number"))
    return values.join(names, ["slice", "cell"]).select(F.col("number").alias("cell"), "gene", "value")
