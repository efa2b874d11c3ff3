"""Quality statistics and filters per cell, gene and slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.functions.columns import MITO_PREFIX, is_mito
from tissueloom.operators.ranking import exact_quantiles
from tissueloom.sources.storage import materialise

CELL = ["slice", "cell"]


def basic_stats(counts: DataFrame, mito_prefix: str = MITO_PREFIX) -> DataFrame:
    """Expressed genes, counts and mitochondrial share per cell (null share for empty cells)."""
    sums = counts.groupBy(*CELL).agg(
        F.count_if(F.col("cnt") > 0).alias("n_genes"),
        F.sum("cnt").alias("n_counts"),
        F.sum(F.when(is_mito(F.col("gene"), mito_prefix), F.col("cnt")).otherwise(0)).alias("mt_counts"),
    )
    return sums.withColumn("p_mito", F.expr("try_divide(mt_counts, n_counts)"))


def qc_cells(
    stats: DataFrame, props: DataFrame, max_mito: float = 0.1, min_area: int = 20, min_genes: int = 20
) -> DataFrame:
    """Cells with a low mitochondrial share, enough area and enough expressed genes."""
    good = stats.filter((F.col("p_mito") < max_mito) & (F.col("n_genes") >= min_genes))
    large = props.filter(F.col("area") >= min_area).select(*CELL, "area")
    return good.join(large, CELL)


def qc_genes(counts: DataFrame, cells: DataFrame, min_cells: int = 3, min_counts: int = 1) -> DataFrame:
    """Per slice, the genes seen in enough of the cells that passed."""
    kept = counts.join(cells.select(*CELL), CELL, "left_semi")
    return (
        kept.groupBy("slice", "gene")
        .agg(F.count_if(F.col("cnt") > 0).alias("n_cells"), F.sum("cnt").alias("n_counts"))
        .filter((F.col("n_cells") >= min_cells) & (F.col("n_counts") >= min_counts))
    )


def qc_filter(counts: DataFrame, props: DataFrame, **limits) -> DataFrame:
    """Cell filters, then gene filters, each once; returns the surviving counts."""
    cell_limits = {k: v for k, v in limits.items() if k in ("max_mito", "min_area", "min_genes")}
    gene_limits = {k: v for k, v in limits.items() if k in ("min_cells", "min_counts")}
    cells = materialise(qc_cells(basic_stats(counts), props, **cell_limits).select(*CELL), "cells")
    genes = materialise(qc_genes(counts, cells, **gene_limits).select("slice", "gene"), "genes")
    return counts.join(cells, CELL, "left_semi").join(genes, ["slice", "gene"], "left_semi")


def _stacked(stats: DataFrame, metrics: list[str], *keep: str) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    return stats.select(*keep, F.inline(pairs))


def qc_box(before: DataFrame, after: DataFrame) -> DataFrame:
    """Box-plot numbers of genes, counts and mitochondrial share per slice and phase."""
    metrics = ["n_genes", "n_counts", "p_mito"]
    both = before.withColumn("phase", F.lit("before")).unionByName(
        after.withColumn("phase", F.lit("after"))
    )
    long = materialise(_stacked(both, metrics, "slice", "phase"), "metrics")
    by = ["slice", "phase", "metric"]
    ends = long.groupBy(*by).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    quart = exact_quantiles(long, by, "value", [0.25, 0.5, 0.75])
    wide = quart.groupBy(*by).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
    )
    return ends.join(wide, by, "left").select(*by, "low", "q1", "median", "q3", "high", "mean")


def qc_summary(stats: DataFrame, props: DataFrame) -> DataFrame:
    """One row per slice: cells, and mean/median of area, genes and counts."""
    metrics = ["area", "n_genes", "n_counts"]
    cells = materialise(
        props.select(*CELL, "area")
        .join(stats.select(*CELL, "n_genes", "n_counts"), CELL, "left")
        .fillna(0, ["n_genes", "n_counts"]),
        "cells",
    )
    medians = exact_quantiles(_stacked(cells, metrics, "slice"), ["slice", "metric"], "value", [0.5])
    wide = medians.groupBy("slice").agg(
        *[
            F.max(F.when(F.col("metric") == m, F.col("quantile"))).alias(f"median_{m}")
            for m in metrics
        ]
    )
    means = cells.groupBy("slice").agg(
        F.count("*").alias("n_cells"),
        *[F.avg(m).alias(f"mean_{m}") for m in metrics],
        F.sum("n_counts").alias("total_counts"),
    )
    return means.join(wide, "slice")


def center_distance(cells: DataFrame) -> DataFrame:
    """Distance of each cell to the mean position of its slice."""
    centre = materialise(
        cells.groupBy("slice").agg(F.avg("x").alias("_cx"), F.avg("y").alias("_cy")), "centre"
    )
    gap = F.hypot(F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy"))
    return cells.join(centre, "slice").withColumn("distance", gap).drop("_cx", "_cy")


def nan_check(values: DataFrame) -> DataFrame:
    """Entries that are NaN or missing after the cast to double."""
    v = F.col("value").cast("double")
    return values.withColumn("value", v).filter(F.isnan(v) | v.isNull())
