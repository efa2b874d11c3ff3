"""Rigid registration of consecutive slices and carrying a transform to other tables."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.functions.columns import draw_key
from tissueloom.operators.neighbors import knn_join
from tissueloom.operators.ranking import draw_threshold
from tissueloom.sources.storage import lookup_table, materialise

# Points sampled per slice, and the sampling grid.
N_SAMPLING = 2000
SAMPLING_GRID = 16


def spatial_sample(
    cells: DataFrame, n: int = N_SAMPLING, grid: int = SAMPLING_GRID, seed: int = 0
) -> DataFrame:
    """At most ``n`` space-filling points per slice: round-robin over grid squares.

    No square can contribute more than its first ``n`` points; they are cut off by a key
    threshold before anything is shuffled, so the rankings see at most ``grid * grid * n`` rows
    per slice.
    """
    box = materialise(
        cells.groupBy("slice").agg(
            F.min("x").alias("_x0"), F.max("x").alias("_x1"),
            F.min("y").alias("_y0"), F.max("y").alias("_y1"),
        ),
        "box",
    )

    def square(v: str, lo: str, hi: str):
        share = F.expr(f"try_divide({v} - {lo}, {hi} - {lo})")
        return F.coalesce(F.least(F.floor(share * grid), F.lit(grid - 1)), F.lit(0))

    keyed = (
        cells.join(box, "slice")
        .withColumn("_gx", square("x", "_x0", "_x1"))
        .withColumn("_gy", square("y", "_y0", "_y1"))
        .withColumn("_key", draw_key(F.col("cell"), seed))
        .drop("_x0", "_x1", "_y0", "_y1")
    )
    square_key = ["slice", "_gx", "_gy"]
    take = F.least(F.col("n"), F.lit(n))
    cuts = lookup_table(draw_threshold(keyed, square_key, "_key", take).select(*square_key, "cut"), "cuts")
    inside = Window.partitionBy(*square_key).orderBy("_key", "cell")
    across = Window.partitionBy("slice").orderBy("_turn", "_key", "cell")
    return (
        keyed.join(cuts, square_key)
        .filter("_key <= cut")
        .withColumn("_turn", F.row_number().over(inside))
        .withColumn("_pos", F.row_number().over(across))
        .filter(F.col("_pos") <= n)
        .select(*cells.columns)
    )


def rigid_fit(pairs: DataFrame, by: str = "slice_idx") -> DataFrame:
    """Weighted 2-D rotation + shift that carries (ax, ay) onto (bx, by), per group.

    Two aggregates: weighted means first, then the cross sums of centred points, which keeps
    precision when coordinates are large.  Returns ``by, theta, tx, ty``.
    """
    pairs = pairs if "w" in pairs.columns else pairs.withColumn("w", F.lit(1.0))
    mean = lambda c: (F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m_{c}")
    means = materialise(
        pairs.groupBy(by).agg(mean("ax"), mean("ay"), mean("bx"), mean("by")), "means"
    )
    cross = (
        pairs.join(means, by)
        .groupBy(by, "m_ax", "m_ay", "m_bx", "m_by")
        .agg(
            F.expr("sum(w * ((ax - m_ax) * (bx - m_bx) + (ay - m_ay) * (`by` - m_by)))").alias("sc"),
            F.expr("sum(w * ((ax - m_ax) * (`by` - m_by) - (ay - m_ay) * (bx - m_bx)))").alias("ss"),
        )
        .withColumn("theta", F.atan2("ss", "sc"))
    )
    return cross.select(
        by,
        "theta",
        F.expr("m_bx - (cos(theta) * m_ax - sin(theta) * m_ay)").alias("tx"),
        F.expr("m_by - (sin(theta) * m_ax + cos(theta) * m_ay)").alias("ty"),
    )


def apply_transform(cells: DataFrame, transforms: DataFrame, key: str = "slice_idx") -> DataFrame:
    """Add ``align_x, align_y``; slices without a transform keep their coordinates."""
    moved = cells.join(transforms.select(key, "theta", "tx", "ty"), key, "left")
    return moved.select(
        *cells.columns,
        F.expr("coalesce(cos(theta) * x - sin(theta) * y + tx, x)").alias("align_x"),
        F.expr("coalesce(sin(theta) * x + cos(theta) * y + ty, y)").alias("align_y"),
    )


def check_pairing(coarse: DataFrame, fine: DataFrame) -> None:
    """Raise when the two tables do not hold the same slices."""
    a, b = coarse.select("slice").distinct(), fine.select("slice").distinct()
    odd = a.exceptAll(b).union(b.exceptAll(a))
    if odd.limit(1).count():
        raise ValueError("coarse and fine tables hold different slices")


def compose_along(steps: DataFrame) -> DataFrame:
    """Chain slice-to-predecessor transforms into slice-to-first ones.

    Rotations add up, and each shift is turned by the rotation before it, so both parts are
    running sums over ``slice_idx`` (one row per slice).
    """
    upto = Window.orderBy("slice_idx").rowsBetween(Window.unboundedPreceding, 0)
    return (
        steps.withColumn("_turn", F.sum("theta").over(upto))
        .withColumn("_before", F.col("_turn") - F.col("theta"))
        .select(
            "slice_idx",
            F.col("_turn").alias("theta"),
            F.sum(F.expr("cos(_before) * tx - sin(_before) * ty")).over(upto).alias("tx"),
            F.sum(F.expr("sin(_before) * tx + cos(_before) * ty")).over(upto).alias("ty"),
        )
    )


def _mutual_nearest(moving: DataFrame, fixed: DataFrame) -> DataFrame:
    """``pair, src, dst`` of points that are each other's nearest by ``vec``."""
    there = knn_join(moving, fixed, 1, by=["pair"])
    back = knn_join(fixed, moving, 1, by=["pair"]).select(
        "pair", F.col("dst").alias("src"), F.col("src").alias("dst")
    )
    return there.join(back, ["pair", "src", "dst"], "left_semi").select("pair", "src", "dst")


def register_slices(
    cells: DataFrame, n_sampling: int = N_SAMPLING, rounds: int = 10, seed: int = 0,
    start: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Align every slice to its predecessor; slice 0 is fixed.

    ``cells``: ``slice, slice_idx, cell, x, y, vec``.  All slice pairs run at once: pairing by
    mutual nearest neighbours of ``vec`` gives the first fit, then up to ``rounds`` rounds of
    nearest point in space refine it.  Relative fits do not depend on where the predecessor
    ends up, so they are chained at the end.  A warning is logged if the nearest points still change after the last
    round.  ``start`` may give the first fit instead: it takes the moving and the fixed points (``pair, cell, x, y, vec``)
    and returns ``pair, theta, tx, ty``.  Returns ``slice_idx, theta, tx, ty``.
    """
    pts = materialise(
        spatial_sample(cells, n_sampling, seed=seed).select("slice_idx", "cell", "x", "y", "vec"),
        "points",
    )
    moving = pts.filter("slice_idx > 0").withColumnRenamed("slice_idx", "pair")
    fixed = pts.withColumn("pair", F.col("slice_idx") + 1).drop("slice_idx")
    a = moving.select("pair", F.col("cell").alias("src"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = fixed.select("pair", F.col("cell").alias("dst"), F.col("x").alias("bx"), F.col("y").alias("by"))

    def fit(links: DataFrame) -> DataFrame:
        points = links.join(a, ["pair", "src"]).join(b, ["pair", "dst"])
        return materialise(rigid_fit(points, "pair"), "fit")

    if start is None:
        links = materialise(_mutual_nearest(moving, fixed), "mutual")
        steps = fit(links)
    else:
        steps = materialise(start(moving, fixed).select("pair", "theta", "tx", "ty"), "fit")
        links = moving.limit(0).select("pair", F.col("cell").alias("src"), F.col("cell").alias("dst"))
    target = fixed.select("pair", "cell", F.array("x", "y").alias("vec"))
    for _ in range(rounds):
        moved = apply_transform(moving.drop("vec"), steps, "pair").select(
            "pair", "cell", F.array("align_x", "align_y").alias("vec")
        )
        nearest = materialise(knn_join(moved, target, 1, by=["pair"]).select("pair", "src", "dst"), "near")
        steps = fit(nearest)
        if not nearest.exceptAll(links).limit(1).count():
            break
        links = nearest
    else:
        logging.getLogger(__name__).warning("registration has not settled after %d rounds", rounds)
    first = pts.filter("slice_idx = 0").select("slice_idx").distinct()
    zero = [F.lit(0.0).alias(c) for c in ("theta", "tx", "ty")]
    return compose_along(
        first.select("slice_idx", *zero).unionByName(steps.withColumnRenamed("pair", "slice_idx"))
    )
