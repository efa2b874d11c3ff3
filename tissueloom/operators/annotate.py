"""Cluster annotation by marker-set enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.functions.stats import log_hypergeom_tail
from tissueloom.sources.storage import materialise


def gene_to_tissue(
    markers: DataFrame, gene_map: DataFrame, tissue_map: DataFrame, times: Sequence[str]
) -> DataFrame:
    """Markers with gene id and tissue; unmapped symbols keep nulls, a gene may have many tissues."""
    with_id = markers.join(gene_map.withColumnRenamed("symbol", "gene"), "gene", "left")
    at_time = tissue_map.filter(F.col("stage").isin(list(times))).select("gene_id", "tissue").distinct()
    return with_id.join(at_time, "gene_id", "left")


def enrich(
    markers: DataFrame,
    gene_map: DataFrame,
    tissue_map: DataFrame,
    times: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Upper-tail hypergeometric p of each (group, tissue) with at least one shared gene.

    Population: genes annotated at the wanted stages.  ``markers``: ``by…, group, gene``, with
    ``by`` the columns besides the number that name a group (the resolution).  ``log_pval`` is
    exact where ``pval`` is too small for a double.
    """
    group = [*by, "group"]
    known = materialise(
        tissue_map.filter(F.col("stage").isin(list(times))).select("gene_id", "tissue").distinct(),
        "known",
    )
    population = known.select("gene_id").distinct()
    tissue_size = known.groupBy("tissue").agg(F.count("*").alias("marked"))
    mapped = materialise(
        markers.select(*group, "gene")
        .join(gene_map.withColumnRenamed("symbol", "gene"), "gene")
        .join(population, "gene_id", "left_semi")
        .select(*group, "gene_id")
        .distinct(),
        "mapped",
    )
    drawn = mapped.groupBy(*group).agg(F.count("*").alias("drawn"))
    hits = mapped.join(known, "gene_id").groupBy(*group, "tissue").agg(F.count("*").alias("hits"))
    total = population.count()
    return (
        hits.join(drawn, group)
        .join(tissue_size, "tissue")
        .withColumn("total", F.lit(total))
        .withColumn("log_pval", log_hypergeom_tail("total", "marked", "drawn", "hits"))
        .withColumn("pval", F.exp("log_pval"))
        .select(*group, "tissue", "total", "marked", "drawn", "hits", "pval", "log_pval")
    )


def best_annotation(enriched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One tissue per group: smallest p, then more shared genes, then name.

    Compared by ln p to nine decimals: p of any size differ unless they are equal up to a
    relative error of the arithmetic.
    """
    key = F.struct(F.round("log_pval", 9), -F.col("hits"), F.col("tissue"))
    return enriched.groupBy(*by, "group").agg(
        F.min_by(F.struct("tissue", "hits", "pval"), key).alias("_b")
    ).select(*by, "group", "_b.tissue", "_b.hits", "_b.pval")


def annotate_cells(
    cells: DataFrame, annotation: DataFrame, key: str = "cluster", by: Sequence[str] = ()
) -> DataFrame:
    """Write each cluster's label back on its cells; clusters without one give null."""
    labels = materialise(
        annotation.select(*by, F.col("group").alias(key), F.col("tissue").alias("auto_anno")), "labels"
    )
    return cells.join(labels, [*by, key], "left")


def annotate(
    markers: DataFrame,
    gene_map: DataFrame,
    tissue_map: DataFrame,
    times: Sequence[str],
    n_genes: int = 50,
    by: Sequence[str] = (),
) -> DataFrame:
    top = markers.filter(F.col("rank") <= n_genes)
    return best_annotation(enrich(top, gene_map, tissue_map, times, by), by)
