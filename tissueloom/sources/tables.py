"""Readers and writers of the file layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File schemas, and the suffix that follows the slice name in a spot file's name.
SPOT_SCHEMA = "gene string, x int, y int, cnt bigint"
PARAM_SCHEMA = (
    "stage string, slice string, dilation_distance double, amount double, block_size int, "
    "radius double, otsu_class int, otsu_index int"
)
EDGE_SCHEMA = "parent string, child string, prob double"
LABEL_SCHEMA = "slice string, x int, y int, label bigint"
GENE_MAP_SCHEMA = "symbol string, gene_id string"
TISSUE_MAP_SCHEMA = "gene_id string, stage string, tissue string"
SPOT_SUFFIX = r"_bin1_final\.gem\.gz$"


def scan_spots(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """Read gzip TSV spot files with a header.

    Columns are taken by position, so either spelling of the count column works.  The slice
    comes from a ``slice=`` folder, else from the file name.  A gzip file is read by one task;
    ``spread`` re-partitions after the scan.
    """
    raw = spark.read.schema(SPOT_SCHEMA).csv(path, sep="\t", header=True)
    if "slice" in raw.columns:  # folder names are text: 007 stays 007
        raw = spark.read.schema(f"{SPOT_SCHEMA}, slice string").csv(path, sep="\t", header=True)
    name = F.regexp_replace(F.substring_index("_metadata.file_path", "/", -1), SPOT_SUFFIX, "")
    from_folder = F.col("slice") if "slice" in raw.columns else name
    spots = raw.select(from_folder.alias("slice"), "gene", "x", "y", "cnt")
    return spots.repartition(spread) if spread else spots


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys brought together before a partitioned write: a folder gets few files instead of one from every
    task.  Spark splits keys that are large, so one slice with a third of all rows is still written by many tasks."""
    return df.hint("rebalance", *keys)


def write_spots(spots: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzip TSV with header, one folder per slice."""
    (
        gathered(spots.select("slice", "gene", "x", "y", F.col("cnt").alias("MIDCounts")), "slice")
        .write.mode(mode)
        .partitionBy("slice")
        .csv(path, sep="\t", header=True, compression="gzip")
    )


def write_labels(labels: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Long label table as gzip TSV, sorted by (label, x, y) across and within the files."""
    order = ["slice", "label", "x", "y"]
    labels.select("slice", "x", "y", "label").repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).csv(
        path, sep="\t", header=True, compression="gzip"
    )


def scan_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label table as ``write_labels`` leaves it."""
    return spark.read.schema(LABEL_SCHEMA).csv(path, sep="\t", header=True)


def write_by(df: DataFrame, path: str, *keys: str) -> None:
    """Parquet partitioned by keys; re-writing replaces only the partitions present in ``df``."""
    gathered(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_matrix(path: str, **parts: DataFrame) -> None:
    """Annotated matrix as a set of long tables (``cells``, ``genes``, ``counts``, ``vectors`` …).

    One folder per table, partitioned by slice: reading one slice touches only its files, and
    writing slices again replaces just those.
    """
    for name, part in parts.items():
        write_by(part, f"{path}/{name}", "slice")


def scan_matrix(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """One table of an annotated matrix; filters on ``slice`` prune folders."""
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def write_lineage(transitions: DataFrame, median: DataFrame, path: str) -> None:
    """All replicates and the medians, one folder per time pair."""
    for name, part in (("replicates", transitions), ("median", median)):
        write_by(part, f"{path}/{name}", "pre_stage", "nex_stage")


def scan_lineage(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """``replicates`` or ``median`` as ``write_lineage`` leaves them; filters on the stages prune folders."""
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_image(pixels: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Byte-valued pixel table."""
    levels = gathered(pixels.withColumn("value", F.col("value").cast("short")), "slice")
    levels.write.mode(mode).partitionBy("slice").parquet(path)


def scan_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAM_SCHEMA).csv(path, header=True)


def scan_gene_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GENE_MAP_SCHEMA).csv(path, sep="\t", header=True)


def scan_tissue_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TISSUE_MAP_SCHEMA).csv(path, header=True)


def scan_cells(spark: SparkSession, path: str) -> DataFrame:
    """Single-cell table with metadata and an embedding column."""
    return spark.read.schema(
        "cell_id bigint, assay string, stage int, state string, emb array<double>"
    ).parquet(path)


def write_edges(edges: DataFrame, path: str, mode: str = "errorifexists") -> None:
    edges.select("parent", "child", "prob").write.mode(mode).csv(path, sep="\t")


def edge_scan(spark: SparkSession, path: str) -> DataFrame:
    """Headerless edge list; both ends are split at the first colon (states may hold any text)."""
    raw = spark.read.schema(EDGE_SCHEMA).csv(path, sep="\t")
    part = lambda end, i: F.split(end, ":", 2).getItem(i)
    return raw.select(
        part("parent", 0).alias("pre_stage"),
        part("parent", 1).alias("pre_state"),
        part("child", 0).alias("nex_stage"),
        part("child", 1).alias("nex_state"),
        "prob",
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path``; only their names are read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
