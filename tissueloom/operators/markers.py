"""Marker genes per group: Welch test, multiple-testing correction, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.functions.columns import clipped
from tissueloom.functions.stats import t_pvalue
from tissueloom.sources.storage import materialise


def group_sums(values: DataFrame, groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by…, group, gene, n, s1, m2``: one pass over the values; absent values count as zero.

    ``values``: ``cell, gene, value``; ``groups``: ``by…, cell, group``.  Where both tables have a
    ``slice``, a cell is named by (slice, cell).  ``m2`` is the sum of squares around the group's
    mean, taken without the difference of two large sums.
    """
    cell = [c for c in ("slice", "cell") if c in values.columns and c in groups.columns and c not in by]
    # without a grouping column a written constant stands in, so that all joins have a key
    keys = list(by) or ["_all"]
    if not by:
        groups = groups.withColumn("_all", F.lit(1))
    sizes = materialise(groups.groupBy(*keys, "group").agg(F.count("*").alias("n")), "sizes")
    sums = materialise(
        values.join(groups.select(*keys, *cell, "group"), [*cell, *(c for c in by if c in values.columns)])
        .groupBy(*keys, "group", "gene")
        .agg(
            F.sum("value").alias("s1"),
            F.count("value").alias("_c"),
            (F.var_pop("value") * F.count("value")).alias("m2"),
        ),
        "sums",
    )
    # every group gets every gene, also one that is zero throughout the group: the genes stay spread over
    # tasks, and each meets the short list of groups
    listed = sizes.groupBy(*keys).agg(F.collect_list(F.struct("group", "n")).alias("_groups"))
    genes = sums.select(*keys, "gene").distinct()
    frame = genes.join(materialise(listed, "groups"), keys).select(*keys, "gene", F.inline("_groups"))
    full = frame.join(sums, [*keys, "group", "gene"], "left").fillna(0.0, ["s1", "m2"]).fillna(0, ["_c"])
    # the stored values and the zeros are two samples; merge their moments
    zeros = F.expr("coalesce(try_divide(s1 * s1, _c) * (n - _c) / n, 0D)")
    full = full.withColumn("m2", F.col("m2") + zeros).drop("_c")
    return full if by else full.drop("_all")


def welch(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Group against all other cells, from the group moments alone.

    The moments of the others are merged around the mean of all cells, so values far from zero
    lose no digits.
    """
    by = list(by)
    total = Window.partitionBy(*by, "gene")
    both = (
        sums.withColumn("n1", F.col("n"))
        .withColumn("n2", F.sum("n").over(total) - F.col("n"))
        .withColumn("mean1", F.col("s1") / F.col("n1"))
        .withColumn("off", F.col("mean1") - F.sum("s1").over(total) / F.sum("n").over(total))
        .withColumn("off2", F.expr("try_divide(-n1 * off, n2)"))  # mean of the others, same origin
        .withColumn("mean2", F.col("mean1") - F.col("off") + F.col("off2"))
        .withColumn("between", F.sum(F.expr("n1 * off * off")).over(total) - F.expr("n1 * off * off"))
        .withColumn("rest", F.sum("m2").over(total) - F.col("m2") + F.expr("between - n2 * off2 * off2"))
        .withColumn("e1", F.expr("try_divide(greatest(m2, 0D), n1 - 1) / n1"))
        .withColumn("e2", F.expr("try_divide(try_divide(greatest(rest, 0D), n2 - 1), n2)"))
    )
    fold = F.expr("try_divide(exp(mean1) - 1 + 1e-9D, exp(mean2) - 1 + 1e-9D)")
    return both.select(
        *by,
        "group",
        "gene",
        F.expr("coalesce(try_divide(off - off2, sqrt(e1 + e2)), 0D)").alias("score"),
        F.when(fold > 0, F.log2(fold)).alias("logfc"),
        F.expr(
            "try_divide((e1 + e2) * (e1 + e2), try_divide(e1 * e1, n1 - 1) + try_divide(e2 * e2, n2 - 1))"
        ).alias("df"),
        F.col("mean1").alias("mean"),
    )


def bh_adjust(df: DataFrame, p: str, by: Sequence[str], tie: str, out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg over each group (one row per gene or term)."""
    group = Window.partitionBy(*by)
    up = group.orderBy(F.col(p), F.col(tie))
    down = group.orderBy(F.desc(p), F.desc(tie)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_raw", F.col(p) * F.count("*").over(group) / F.row_number().over(up))
        .withColumn(out, F.least(F.min("_raw").over(down), F.lit(1.0)))
        .drop("_raw")
    )


def welch_table(values: DataFrame, groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Welch statistics, p and adjusted p for every gene of every group."""
    tested = welch(group_sums(values, groups, by), by).withColumn(
        "pval", t_pvalue(F.col("score"), F.col("df"))
    )
    return bh_adjust(tested, "pval", [*by, "group"], "gene")


def top_genes(tested: DataFrame, n_genes: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """The ``n_genes`` genes with the highest score per group; equal scores in gene order."""
    order = Window.partitionBy(*by, "group").orderBy(F.desc("score"), "gene")
    return tested.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_genes)


def rank_markers(
    values: DataFrame, groups: DataFrame, n_genes: int = 50, by: Sequence[str] = ()
) -> DataFrame:
    return top_genes(welch_table(values, groups, by), n_genes, by)


def marker_set(markers: DataFrame, n: int = 20) -> DataFrame:
    """Distinct names among the first ``n`` markers of any group (and any resolution)."""
    return markers.filter(F.col("rank") <= n).select("gene").distinct()


def heatmap_table(
    markers: DataFrame,
    sums: DataFrame,
    n_genes: int = 10,
    low: float = 0.3,
    high: float = 3.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Clipped mean of every group for the top genes of any group (of the same ``by``)."""
    genes = markers.filter(F.col("rank") <= n_genes).select(*by, "gene").distinct()
    return sums.join(genes, [*by, "gene"], "left_semi").select(
        *by, "group", "gene", clipped(F.col("s1") / F.col("n"), low, high).alias("value")
    )


def group_corr(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of mean profiles for every unordered pair of groups (of one ``by``)."""
    profile = materialise(
        sums.select(*by, "group", "gene", (F.col("s1") / F.col("n")).alias("m")), "profile"
    )
    a = profile.select(*by, F.col("group").alias("group_a"), "gene", F.col("m").alias("ma"))
    b = profile.select(*by, F.col("group").alias("group_b"), "gene", F.col("m").alias("mb"))
    return (
        a.join(b, [*by, "gene"])
        .filter("group_a < group_b")
        .groupBy(*by, "group_a", "group_b")
        .agg(F.corr("ma", "mb").alias("corr"))
        .withColumn("distance", 1 - F.col("corr"))
    )


def cluster_and_rank(cells: DataFrame, values: DataFrame, resolutions: Sequence[float], **sizes):
    """Clusters at every resolution and their ranked markers.

    ``cells``: ``cell, vec, xyz``; returns (clusters, markers), both keyed by resolution.
    """
    from tissueloom.operators.communities import communities
    from tissueloom.operators.neighbors import knn_graph, symmetric_edges

    edges = symmetric_edges(knn_graph(cells, **sizes))
    clusters = materialise(
        communities(edges, resolutions).select(
            "resolution", F.col("node").alias("cell"), F.col("community").alias("cluster")
        ),
        "clusters",
    )
    markers = rank_markers(values, clusters.withColumnRenamed("cluster", "group"), by=["resolution"])
    return clusters, markers
