"""Cropping by outlines: polygons covered by grid cells, edges looked at only near the border.

A slice's outline is any number of closed rings; a place is inside by the even-odd rule over all of them, so a ring
inside another is a hole.  Grid cells that no edge touches are inside or outside as a whole.  In the others a point is
compared with the edges of its own cell only: the path from the cell's corner up its left side and then across to the
point crosses the outline as often as the two differ.  Points meet cells in an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.operators.spots import PIXEL

#: Side of a grid cell, and the place of its lines: whole and half coordinates never lie on them.
CELL_SIDE, LINE_SHIFT = 16, 0.3183098861837907


def outline_edges(outline: DataFrame) -> DataFrame:
    """``slice, x1, y1, x2, y2`` of the rings ``slice, ring, seq, x, y``; the last vertex is joined to the first."""
    order = Window.partitionBy("slice", "ring").orderBy("seq")
    ring = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = lambda c: F.coalesce(F.lead(c).over(order), F.first(c).over(ring)).cast("double")
    edges = outline.select(
        "slice", F.col("x").cast("double").alias("x1"), F.col("y").cast("double").alias("y1"), after("x").alias("x2"), after("y").alias("y2")
    )
    return edges.filter("x1 <> x2 OR y1 <> y2")


def _index(value, side: int):
    return F.floor((value - F.lit(LINE_SHIFT)) / F.lit(side)).cast("int")


def _line(index, side: int):
    return index * F.lit(side) + F.lit(LINE_SHIFT)


#: Where an edge meets the horizontal line ``at``; only used where the edge crosses it.
def _x_at(at):
    return F.col("x1") + (at - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))


def border_cells(edges: DataFrame, side: int = CELL_SIDE) -> DataFrame:
    """``slice, cx, cy, x1, y1, x2, y2``: every edge with each cell that it touches."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(_index(low, side), _index(high, side))))
    # the part of the edge inside this row of cells
    bottom, top = F.greatest(low, _line(F.col("cy"), side)), F.least(high, _line(F.col("cy") + 1, side))
    level = F.col("y1") == F.col("y2")
    a = F.when(level, F.col("x1")).otherwise(_x_at(bottom))
    b = F.when(level, F.col("x2")).otherwise(_x_at(top))
    # one more cell at either end covers the rounding of the cut
    span = F.sequence(_index(F.least(a, b) - 1e-6, side), _index(F.greatest(a, b) + 1e-6, side))
    return rows.withColumn("cx", F.explode(span)).select("slice", "cx", "cy", "x1", "y1", "x2", "y2")


def inside_corners(edges: DataFrame, side: int = CELL_SIDE) -> DataFrame:
    """``slice, cx, cy`` of the cells whose lower left corner is inside: runs between the 1st and 2nd, 3rd and 4th…
    crossing of a grid line."""
    first, last = _index(F.least("y1", "y2"), side) + 1, _index(F.greatest("y1", "y2"), side)
    crossing = (
        edges.filter(first <= last)
        .withColumn("cy", F.explode(F.sequence(first, last)))
        .select("slice", "cy", _x_at(_line(F.col("cy"), side)).alias("x"))
    )
    along = Window.partitionBy("slice", "cy").orderBy("x")  # the crossings of one line
    runs = crossing.withColumn("n", F.row_number().over(along)).withColumn("end", F.lead("x").over(along)).filter("n % 2 = 1")
    start, stop = _index(F.col("x"), side) + 1, _index(F.col("end"), side)
    return runs.filter(start <= stop).select("slice", F.explode(F.sequence(start, stop)).alias("cx"), "cy")


def inside_outline(pixels: DataFrame, outline: DataFrame, side: int = CELL_SIDE) -> DataFrame:
    """The distinct ``slice, x, y`` inside the slice's outline; points on an edge are inside.

    Slices without an outline have nothing inside.  Rings of fewer than three vertices enclose nothing, but
    points on them count.  Coordinates are whole or half numbers (others may meet a grid line).
    """
    edges = outline_edges(outline)
    border, corners = border_cells(edges, side), inside_corners(edges, side)
    points = pixels.select(*PIXEL).distinct()
    points = points.withColumns({"cx": _index(F.col("x"), side), "cy": _index(F.col("y"), side)})
    cell = ["slice", "cx", "cy"]
    whole = corners.join(border.select(*cell).distinct(), cell, "left_anti")
    x0, y0 = _line(F.col("cx"), side), _line(F.col("cy"), side)
    px, py = F.col("x").cast("double"), F.col("y").cast("double")
    cross = (F.col("x2") - F.col("x1")) * (py - F.col("y1")) - (F.col("y2") - F.col("y1")) * (px - F.col("x1"))
    on_edge = (cross == 0) & px.between(F.least("x1", "x2"), F.greatest("x1", "x2")) & py.between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    # up the left side of the cell, then across just above the point's height; each counts an edge that it crosses
    y_at = F.col("y1") + (x0 - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    up = F.when((F.col("x1") > x0) != (F.col("x2") > x0), (y_at > y0) & (y_at <= py)).otherwise(False)
    x_at = _x_at(py)
    right = F.when((F.col("y1") > py) != (F.col("y2") > py), (x_at > x0) & (x_at < px)).otherwise(False)
    near = (
        points.join(border, cell)
        .groupBy(*PIXEL, "cx", "cy")
        .agg(F.sum(up.cast("int") + right.cast("int")).alias("crossed"), F.max(on_edge).alias("on_edge"))
        .join(corners.withColumn("corner", F.lit(1)), cell, "left")
        .filter(F.col("on_edge") | ((F.col("crossed") + F.coalesce("corner", F.lit(0))) % 2 == 1))
    )
    return points.join(whole, cell, "left_semi").select(*PIXEL).unionByName(near.select(*PIXEL))


def crop_to_outline(spots: DataFrame, outline: DataFrame, side: int = CELL_SIDE) -> DataFrame:
    """The spots whose pixel is inside the outline of their slice."""
    return spots.join(inside_outline(spots, outline, side), PIXEL, "left_semi")
