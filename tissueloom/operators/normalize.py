"""Analytic Pearson residuals and stacking of slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.sources.storage import materialise

CELL = ["slice", "cell"]


# genes per block when zeros are filled in
BLOCK = 64


def dense_counts(counts: DataFrame) -> DataFrame:
    """Cell x gene counts of each slice with explicit zeros, plus all sums the residuals need.

    The dense table is never shuffled.  Per cell the stored genes are put in gene order; each
    one, and one marker row in front, stands for itself and the zeros up to the next stored gene.
    Such a run is cut at block borders, joined to blocks of consecutive genes, and only then
    widened to dense rows.  A window partition is one cell (at most as long as the genome).
    Returns ``slice, cell, gene, cnt, cell_sum, gene_sum, total, n_cells``.
    """
    counts = materialise(counts.select(*CELL, "gene", "cnt"), "sparse")
    by_gene = Window.partitionBy("slice").orderBy("gene")
    genes = materialise(
        counts.groupBy("slice", "gene")
        .agg(F.sum("cnt").alias("gene_sum"))
        .withColumn("idx", F.row_number().over(by_gene) - 1),
        "genes",
    )
    blocks = materialise(
        genes.groupBy("slice", F.floor(F.col("idx") / BLOCK).cast("int").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "gene", "gene_sum"))).alias("genes")
        ),
        "blocks",
    )
    cells = counts.groupBy(*CELL).agg(F.sum("cnt").alias("cell_sum"))
    slices = materialise(
        cells.groupBy("slice")
        .agg(F.sum("cell_sum").alias("total"), F.count("*").alias("n_cells"))
        .join(genes.groupBy("slice").agg(F.max("idx").alias("last")), "slice"),
        "slices",
    )
    stored = counts.join(genes.select("slice", "gene", "idx"), ["slice", "gene"]).select(
        *CELL, "idx", "cnt"
    )
    markers = counts.select(*CELL).distinct().select(*CELL, F.lit(-1).alias("idx"), F.lit(0).alias("cnt"))
    in_cell = Window.partitionBy(*CELL)
    runs = (
        stored.unionByName(markers)
        .withColumn("cell_sum", F.sum("cnt").over(in_cell))
        .withColumn("_next", F.lead("idx").over(in_cell.orderBy("idx")))
        .join(slices, "slice")
        .withColumn("_from", F.greatest("idx", F.lit(0)))
        .withColumn("_to", F.coalesce(F.col("_next") - 1, F.col("last")))
        .filter("_from <= _to")
        .withColumn("block", F.explode(F.expr(f"sequence(_from div {BLOCK}, _to div {BLOCK})")))
        .withColumn("block", F.col("block").cast("int"))
    )
    inside = F.filter("genes", lambda g: (g.idx >= F.col("_from")) & (g.idx <= F.col("_to")))
    return (
        runs.join(blocks, ["slice", "block"])
        .select(*CELL, "cell_sum", "total", "n_cells", F.col("idx").alias("_at"), "cnt", F.inline(inside))
        .select(
            *CELL,
            "gene",
            F.when(F.col("idx") == F.col("_at"), F.col("cnt")).otherwise(0).alias("cnt"),
            "cell_sum",
            "gene_sum",
            "total",
            "n_cells",
        )
    )


def pearson_resid(counts: DataFrame, theta: float = 100.0) -> DataFrame:
    """Negative-binomial Pearson residuals per slice, clipped to +-sqrt(cells).

    Raw count and residual stay side by side in one dense long table.  Where a cell, a gene or a
    slice sums to zero nothing is expected, and the residual is 0.
    """
    mu = F.try_divide(F.col("cell_sum") * F.col("gene_sum"), F.col("total"))
    z = F.coalesce(F.try_divide(F.col("cnt") - mu, F.sqrt(mu + mu * mu / F.lit(float(theta)))), F.lit(0.0))
    limit = F.sqrt("n_cells")
    return dense_counts(counts).select(
        *CELL, "gene", "cnt", F.greatest(F.least(z, limit), -limit).alias("resid")
    )


def map_counts(norm: DataFrame, raw: DataFrame, key_added: str = "raw_cnt") -> DataFrame:
    """Attach the raw count of the same (slice, cell, gene); absent means zero."""
    keys = ["slice", "cell", "gene"]
    raw = raw.select(*keys, F.col("cnt").alias(key_added))
    return norm.join(raw, keys, "left").fillna(0, [key_added])


def integrate(*tables: DataFrame) -> DataFrame:
    """Stack the long tables of several slices; the slice name is the batch key.

    A gene missing from a slice needs no row: absent already means zero.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def check_batches(stacked: DataFrame) -> DataFrame:
    """(slice, cell, gene) keys that occur more than once after stacking; empty when sound."""
    return stacked.groupBy("slice", "cell", "gene").count().filter("count > 1")
