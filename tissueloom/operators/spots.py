"""Spot tables: cropping, re-basing, count images, binning, assignment to cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.functions.columns import (
    COUNT_CLIP,
    NAN_GENE,
    SLICE_SPACING,
    bin_centre,
    bin_index,
    count_byte,
    filled_gene,
    gene_file_key,
    slice_z,
    stage_token,
)
from tissueloom.sources.storage import materialise

PIXEL = ["slice", "x", "y"]


def crop_spots(spots: DataFrame, mask: DataFrame) -> DataFrame:
    """Keep the spots whose pixel is inside (value > 0) the mask of their slice."""
    inside = mask.filter("value > 0").select(*PIXEL)
    return spots.join(inside, PIXEL, "left_semi")


def slice_origin(spots: DataFrame) -> DataFrame:
    """Smallest coordinates per slice, needed to get back to the raw frame."""
    return spots.groupBy("slice").agg(
        F.min("x").cast("int").alias("min_x"), F.min("y").cast("int").alias("min_y")
    )


def rebase_spots(spots: DataFrame, origin: DataFrame | None = None) -> DataFrame:
    """Shift every slice to start at (0, 0).

    The origin has one row per slice and is written first: the spots themselves are not
    shuffled as long as it is below the broadcast threshold.
    """
    origin = materialise(slice_origin(spots), "origin") if origin is None else origin
    return (
        spots.join(origin, "slice")
        .withColumn("x", (F.col("x") - F.col("min_x")).cast("int"))
        .withColumn("y", (F.col("y") - F.col("min_y")).cast("int"))
        .select(*spots.columns)
    )


def fill_gene(spots: DataFrame, gene: str = NAN_GENE) -> DataFrame:
    return spots.withColumn("gene", filled_gene(F.col("gene"), gene))


def prepare_spots(spots: DataFrame, mask: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Crop, re-base and clean all slices at once; returns the spots and their origins."""
    cropped = materialise(crop_spots(spots, mask), "cropped")
    origin = materialise(slice_origin(cropped), "origin")
    return fill_gene(rebase_spots(cropped, origin)), origin


def count_image(spots: DataFrame) -> DataFrame:
    """Total count per pixel; absent pixels are zero."""
    return spots.groupBy(*PIXEL).agg(F.sum("cnt").alias("cnt"))


def count_image_byte(spots: DataFrame, clip: int = COUNT_CLIP) -> DataFrame:
    return count_image(spots).select(*PIXEL, count_byte(F.col("cnt"), clip).alias("value"))


def count_image_dense(spots: DataFrame) -> DataFrame:
    """Count image with explicit zeros over each slice's bounding box.

    Rows of the box are spread over the cluster before they are widened to pixels, so that one
    large slice is not produced by one task.
    """
    image = materialise(count_image(spots), "image")
    box = image.groupBy("slice").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    rows = box.select("slice", "y0", "y1", F.explode(F.sequence("x0", "x1")).alias("x"))
    grid = rows.repartition("slice", "x").select(
        "slice", "x", F.explode(F.sequence("y0", "y1")).alias("y")
    )
    return grid.join(image, PIXEL, "left").select(*PIXEL, F.coalesce("cnt", F.lit(0)).alias("cnt"))


def bin_spots(spots: DataFrame, size: int = 20) -> DataFrame:
    """Sum counts per gene in size x size squares; ``x``/``y`` are the square's centre."""
    binned = spots.groupBy(
        "slice", bin_index(F.col("x"), size).alias("bx"), bin_index(F.col("y"), size).alias("by"), "gene"
    ).agg(F.sum("cnt").alias("cnt"))
    return binned.select(
        "slice",
        "bx",
        "by",
        bin_centre(F.col("bx"), size).alias("x"),
        bin_centre(F.col("by"), size).alias("y"),
        "gene",
        "cnt",
    )


def label_long(raster: DataFrame) -> DataFrame:
    """Label raster rows (``slice, x, labels array``) to one row per labelled pixel."""
    return raster.select("slice", "x", F.posexplode("labels").alias("y", "label")).filter("label <> 0")


def cellbin_counts(spots: DataFrame, labels: DataFrame) -> DataFrame:
    """Cell x gene counts: spots take the label of their pixel, unlabelled pixels drop out."""
    cells = labels.filter("label <> 0").select(*PIXEL, F.col("label").alias("cell"))
    return spots.join(cells, PIXEL).groupBy("slice", "cell", "gene").agg(F.sum("cnt").alias("cnt"))


def cell_props(labels: DataFrame) -> DataFrame:
    """Area, centroid and bounding box of every labelled cell."""
    return (
        labels.filter("label <> 0")
        .groupBy("slice", F.col("label").alias("cell"))
        .agg(
            F.count("*").alias("area"),
            F.avg("x").alias("x"),
            F.avg("y").alias("y"),
            F.min("x").alias("x_min"),
            F.max("x").alias("x_max"),
            F.min("y").alias("y_min"),
            F.max("y").alias("y_max"),
        )
    )


def slice_index(slices: DataFrame) -> DataFrame:
    """Position of each slice in name order, from 0 (one row per slice, so one small window)."""
    names = slices.select("slice").distinct()
    return names.select(
        "slice", (F.row_number().over(Window.orderBy("slice")) - 1).alias("slice_idx")
    )


def add_z(cells: DataFrame, spacing: int = SLICE_SPACING) -> DataFrame:
    """Third coordinate from the slice number in the slice name."""
    return cells.withColumn("z", slice_z(F.col("slice"), spacing))


def gene_keys(spots: DataFrame) -> DataFrame:
    """Distinct genes with a file-safe name."""
    return spots.filter("gene is not null").select("gene").distinct().withColumn(
        "file_key", gene_file_key(F.col("gene"))
    )


def param_join(cells: DataFrame, params: DataFrame) -> DataFrame:
    """Attach the parameter row of (stage, slice) to every cell; one row drives one slice."""
    return cells.withColumn("stage", stage_token(F.col("slice"))).join(params, ["stage", "slice"])
