"""Touching cells: depth inside the foreground, and basins of the depth that a shallow enough pass joins again.

A blob of several cells has a hill of depth for each of them.  Every pixel belongs to the hill that the steepest way up
leads to; a hill goes into its neighbour where it rises less than ``rise`` above the highest pass between them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.operators.pixels import TILE_SIDE, connected_components
from tissueloom.operators.spots import PIXEL
from tissueloom.sources.storage import materialise


def pixel_depths(pixels: DataFrame) -> DataFrame:
    """``slice, x, y, depth``: steps (left, right, up, down) from each pixel to the nearest place not in the table.

    ``pixels``: distinct ``slice, x, y``.  Two passes, along x and then along y, as the nearest place of each column is
    all that the other columns need.  A window holds one line of one slice.
    """
    cells = pixels.select(*PIXEL)
    for axis, other in (("y", "x"), ("x", "y")):
        line = Window.partitionBy("slice", other).orderBy(axis)
        # pixels without a gap between them share the difference of place and rank
        cells = cells.withColumn("_run", F.col(axis) - F.row_number().over(line))
        run = Window.partitionBy("slice", other, "_run").orderBy(axis)
        before = run.rowsBetween(Window.unboundedPreceding, 0)
        after = run.rowsBetween(0, Window.unboundedFollowing)
        edge = F.least(F.col(axis) - F.min(axis).over(before), F.max(axis).over(after) - F.col(axis)) + 1
        if axis == "y":
            cells = cells.withColumn("depth", edge.cast("int"))
        else:
            up = F.min(F.col("depth") - F.col(axis)).over(before) + F.col(axis)
            down = F.min(F.col("depth") + F.col(axis)).over(after) - F.col(axis)
            cells = cells.withColumn("depth", F.least(edge, up, down).cast("int"))
    return cells.select(*PIXEL, "depth")


def _numbered(depths: DataFrame) -> DataFrame:
    """``slice, x, y, depth, id``: pixels numbered by row and column from the lowest of the slice (or 0)."""
    low_y = F.least(F.min("y"), F.lit(0)).cast("long")
    frame = depths.groupBy("slice").agg(
        F.least(F.min("x"), F.lit(0)).cast("long").alias("_x"),
        low_y.alias("_y"),
        (F.max("y") + 1 - low_y).cast("long").alias("_w"),
    )
    return depths.join(materialise(frame, "frame"), "slice").select(
        *PIXEL, "depth", ((F.col("x") - F.col("_x")) * F.col("_w") + F.col("y") - F.col("_y")).alias("id")
    )


def _tile_ascents(numbered: DataFrame) -> DataFrame:
    """``slice, x, y, depth, id, top, next``: the last pixel of the way up inside the tile, and the one that follows it.

    ``next`` is null at a summit.  Each pixel steps to the highest of its four neighbours that is above it, of equal
    depths the one with the smaller id; equal neighbours count as above it if their id is smaller.
    """
    side = TILE_SIDE

    def tiles(axis: str):
        first, last = (F.floor((F.col(axis) + by) / side).cast("int") for by in (-1, 1))
        return F.explode(F.sequence(first, last))

    spread = numbered.withColumn("tx", tiles("x")).withColumn("ty", tiles("y"))
    fields = {f.name: f.dataType.simpleString() for f in numbered.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in [*PIXEL, "depth", "id"]) + ", top bigint, next bigint"

    def climb(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["depth", "id"], ascending=[False, True], ignore_index=True)  # best first
        at = pdf[["x", "y"]].to_numpy() - np.array([pdf["tx"].iloc[0], pdf["ty"].iloc[0]]) * side + 1
        own = ((at > 0) & (at <= side)).all(axis=1)
        n = len(pdf)
        place = np.full((side + 4, side + 4), n)
        i, j = at.T + 1
        place[i, j] = np.arange(n)
        near = np.minimum.reduce([place[i + 1, j], place[i - 1, j], place[i, j + 1], place[i, j - 1]])
        step = np.minimum(near, np.arange(n))
        step[~own] = np.flatnonzero(~own)  # the halo is where a way leaves the tile
        ids = pdf["id"].to_numpy()
        goes = own & (step != np.arange(n))
        leaves = goes & ~own[step]
        inside = np.where(leaves, np.arange(n), step)
        while True:
            further = inside[inside]
            if (further == inside).all():
                break
            inside = further
        following = pd.array(ids[step[inside]], dtype="Int64")
        following[~leaves[inside]] = pd.NA
        return pdf[[*PIXEL, "depth", "id"]].assign(top=ids[inside], next=following)[own]

    return spread.groupBy("slice", "tx", "ty").applyInPandas(climb, schema)


def _renamed(table: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``table`` with ``column`` replaced by its root where ``names`` (``slice, node, root``) has one."""
    to = names.select("slice", F.col("node").alias(column), F.col("root").alias("_root"))
    return table.join(to, ["slice", column], "left").withColumn(column, F.coalesce("_root", column)).select(*table.columns)


def split_touching(pixels: DataFrame, rise: int = 2) -> DataFrame:
    """Label foreground pixels, touching cells apart: ``slice, x, y, label``, the smallest number of the cell's pixels.

    ``pixels``: distinct ``slice, x, y``; numbers are those of ``label_components``.  Hills are compared by the depth of
    their summit, of equal ones the smaller id is higher; passes by the smaller depth of two touching pixels, of
    equal ones the pair with the smaller ids is higher.  A hill joins the one beyond its highest pass if that one is
    higher and the hill rises less than ``rise`` above the pass; this goes on until no hill does, which leaves what
    joining passes one by one from the highest would.  With ``rise`` of at least 1, a blob without a waist stays whole.

    Ways up are followed inside tiles; what spans the cluster has a node per hill and tile.  No rounds are limited.
    """
    if rise < 1:
        raise ValueError("rise must be at least 1")
    climbed = materialise(_tile_ascents(_numbered(pixel_depths(pixels))), "climbed")
    # ways that leave a tile go on from the pixel beyond its border
    leaving = climbed.filter("next IS NOT NULL").select("slice", "top", "next").distinct()
    beyond = climbed.select("slice", F.col("id").alias("next"), F.col("top").alias("b"))
    ways = leaving.join(beyond, ["slice", "next"]).select("slice", F.col("top").alias("a"), "b")
    roots = materialise(connected_components(ways, ["slice"]), "roots")
    hilly = materialise(_renamed(climbed.select(*PIXEL, "depth", "id", F.col("top").alias("hill")), roots, "hill"), "hilly")

    height = F.max(F.struct("depth", (-F.col("id")).alias("id")))
    summits = materialise(hilly.groupBy("slice", "hill").agg(height.alias("summit")), "summits")
    passes = None
    for axis, other in (("x", "y"), ("y", "x")):
        line = Window.partitionBy("slice", other).orderBy(axis)
        pairs = hilly.select("slice", axis, "hill", "depth", "id", *[F.lead(c).over(line).alias(f"_{c}") for c in (axis, "hill", "depth", "id")])
        touching = pairs.filter(f"_{axis} = {axis} + 1 AND _hill <> hill").select(
            "slice",
            F.least("hill", "_hill").alias("a"),
            F.greatest("hill", "_hill").alias("b"),
            F.struct(F.least("depth", "_depth").alias("depth"), (-F.col("id")).alias("id"), (-F.col("_id")).alias("other")).alias("pass"),
        )
        passes = touching if passes is None else passes.unionByName(touching)
    passes = materialise(passes.groupBy("slice", "a", "b").agg(F.max("pass").alias("pass")), "passes")

    members = summits.select("slice", F.col("hill").alias("id"), "hill")
    while True:
        both = passes.select("slice", "pass", F.inline(F.array(
            F.struct(F.col("a").alias("hill"), F.col("b").alias("to")), F.struct(F.col("b").alias("hill"), F.col("a").alias("to")),
        )))
        best = both.groupBy("slice", "hill").agg(F.max(F.struct("pass", "to")).alias("best")).select("slice", "hill", "best.pass", "best.to")
        beyond = summits.select("slice", F.col("hill").alias("to"), F.col("summit").alias("other"))
        joins = materialise(
            best.join(summits, ["slice", "hill"]).join(beyond, ["slice", "to"])
            .filter((F.col("other") > F.col("summit")) & (F.col("summit.depth") - F.col("pass.depth") < rise))
            .select("slice", F.col("hill").alias("a"), F.col("to").alias("b")),
            "joins",
        )
        if not joins.limit(1).count():
            break
        names = materialise(connected_components(joins, ["slice"]), "names")
        members = materialise(_renamed(members, names, "hill"), "members")
        summits = materialise(_renamed(summits, names, "hill").groupBy("slice", "hill").agg(F.max("summit").alias("summit")), "summits")
        ends = _renamed(_renamed(passes, names, "a"), names, "b").filter("a <> b").select(
            "slice", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "pass"
        )
        passes = materialise(ends.groupBy("slice", "a", "b").agg(F.max("pass").alias("pass")), "passes")

    cells = materialise(
        hilly.withColumnRenamed("hill", "h").join(members.withColumnRenamed("id", "h"), ["slice", "h"]).select(*PIXEL, "id", "hill"),
        "cells",
    )
    labels = materialise(cells.groupBy("slice", "hill").agg(F.min("id").alias("label")), "labels")
    return cells.join(labels, ["slice", "hill"]).select(*PIXEL, "label")
