"""Local brightness: box means by tiles with halos, sharpening, and a cut against the surroundings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.operators.pixels import TILE_SIDE, expand_labels, foreground, label_components
from tissueloom.operators.spots import PIXEL
from tissueloom.sources.storage import materialise


def box_means(pixels: DataFrame, value: str = "value", reach: str = "reach") -> DataFrame:
    """``slice, x, y, value, mean``: mean over the pixels at most ``reach`` columns and rows away, itself included.

    ``reach``, a whole number of at least 0, is a column with one value per slice.  The slice is cut into square tiles;
    a pixel goes to its own tile and to those whose pixels it is near to.  A task sums one tile with its halo by
    summed areas, so the work does not depend on the reach.  Missing pixels count nowhere.
    """
    side = TILE_SIDE

    def tiles(axis: str):
        first, last = (F.floor((F.col(axis) + sign * F.col(reach)) / side).cast("int") for sign in (-1, 1))
        return F.explode(F.sequence(first, last))

    spread = pixels.select(*PIXEL, F.col(value).cast("double").alias("value"), F.col(reach).cast("int").alias("reach"))
    spread = spread.withColumn("tx", tiles("x")).withColumn("ty", tiles("y"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        r = int(pdf["reach"].iloc[0])
        corner = np.array([pdf["tx"].iloc[0], pdf["ty"].iloc[0]]) * side
        at = pdf[["x", "y"]].to_numpy() - corner
        area = np.zeros((2, side + 2 * r + 1, side + 2 * r + 1))
        area[0, at[:, 0] + r + 1, at[:, 1] + r + 1] = pdf["value"].to_numpy()
        area[1, at[:, 0] + r + 1, at[:, 1] + r + 1] = 1
        area = area.cumsum(axis=1).cumsum(axis=2)
        own = ((at >= 0) & (at < side)).all(axis=1)
        x, y = at[own].T
        n = 2 * r + 1
        total, count = area[:, x + n, y + n] - area[:, x, y + n] - area[:, x + n, y] + area[:, x, y]
        return pdf.loc[own, [*PIXEL, "value"]].assign(mean=total / count)

    fields = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in PIXEL) + ", value double, mean double"
    return spread.groupBy("slice", "tx", "ty").applyInPandas(sums, schema)


def sharpen(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """``slice, x, y, value``: each pixel raised by ``amount`` times its difference to the mean within ``radius``.

    Results are rounded to 6 digits and stay within 0 and 255; slices without parameters drop out.
    """
    own = materialise(params.select("slice", "amount", F.floor("radius").cast("int").alias("reach")), "params")
    smooth = box_means(pixels.join(own.select("slice", "reach"), "slice"))
    raised = F.col("value") + F.col("amount") * (F.col("value") - F.col("mean"))
    return smooth.join(own, "slice").select(*PIXEL, F.greatest(F.least(F.round(raised, 6), F.lit(255.0)), F.lit(0.0)).alias("value"))


def local_foreground(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """Pixels brighter than the mean of the ``block_size`` x ``block_size`` pixels around them (rounded to 6 digits)."""
    reach = materialise(params.select("slice", F.floor(F.col("block_size") / 2).cast("int").alias("reach")), "params")
    means = box_means(pixels.join(reach, "slice"))
    return means.filter(F.round("value", 6) > F.round("mean", 6)).select(*PIXEL)


def segment_cells_locally(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """Cell labels by all parameters of a slice; background is label 0.

    Pixels are sharpened (``amount, radius``); foreground are those above the slice's cut of the original brightness
    (``otsu_class, otsu_index``) that are also above their surroundings (``block_size``).  Components get labels, which
    then grow by ``dilation_distance``.  Slices without parameters drop out.
    """
    params = materialise(params, "params")
    local = local_foreground(sharpen(pixels, params), params)
    bright = foreground(pixels, params)
    labelled = label_components(bright.join(local, PIXEL, "left_semi"))
    every = pixels.select(*PIXEL).join(params.select("slice"), "slice", "left_semi").join(labelled, PIXEL, "left")
    labels = materialise(every.select(*PIXEL, F.coalesce(F.col("label") + 1, F.lit(0)).cast("long").alias("label")), "labels")
    distances = sorted({r[0] for r in params.select(F.coalesce("dilation_distance", F.lit(0.0))).distinct().collect()})
    grown = []
    for distance in distances:  # few: parameters of the table of slices
        own = params.filter(F.coalesce("dilation_distance", F.lit(0.0)) == distance).select("slice")
        part = labels.join(own, "slice", "left_semi")
        grown.append(expand_labels(part, distance) if distance >= 1 else part)
    out = grown[0] if grown else labels
    for more in grown[1:]:
        out = out.unionByName(more.select(*out.columns))
    return out
