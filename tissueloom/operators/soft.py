"""Soft correspondences between consecutive slices: entropic scaling of sparse candidate pairs.

Every point of a slice may correspond to several points of the next one, with weights.  Candidates are the nearest
vectors of either side, so a slice of n points has at most ``2 * n * neighbours`` of them, never n * n.  The kernel of a
candidate falls with its cost; two keyed aggregations a round scale it towards one unit of weight per point of either
side.  The sides are only drawn towards one unit (``relax`` below 1), so a point without a counterpart loses its weight
instead of spoiling the fit, and a round shrinks what is left of the error by ``relax * relax``.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.operators.align import apply_transform, register_slices, rigid_fit
from tissueloom.operators.neighbors import knn_join
from tissueloom.sources.storage import materialise

#: Largest cost that the kernel tells apart; beyond it the weight is nothing beside any other.
MAX_COST = 300.0
#: Part of the error in the scaling that may be left.
SCALING_ERROR = 1e-3


def scale_pairs(pairs: DataFrame, by: Sequence[str], relax: float = 0.5) -> DataFrame:
    """``pairs`` with a weight ``w``: ``u * exp(-cost) * v``, one factor for each ``src`` and one for each ``dst``.

    ``pairs``: ``by…, src, dst, cost``, each pair once, cost at least 0.  A round sets ``u`` to
    ``(1 / sum of exp(-cost) * v) ** relax`` and then ``v`` likewise.  The number of rounds follows from ``relax``
    (strictly between 0 and 1).  No pairs give no rows.
    """
    if not 0 < relax < 1:
        raise ValueError("relax must lie between 0 and 1")
    by = list(by)
    kernel = materialise(pairs.withColumn("_k", F.exp(-F.least("cost", F.lit(MAX_COST)))), "kernel")
    sides = kernel.select(*by, "src", "dst", "_k")

    def factors(side: str, name: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by, side).agg(F.pow(1 / F.sum("_m"), F.lit(relax)).alias(name))

    rows = sides.withColumn("_m", F.col("_k"))
    for _ in range(math.ceil(math.log(SCALING_ERROR) / (2 * math.log(relax)))):
        u = factors("src", "_u", rows)
        v = factors("dst", "_v", sides.join(u, [*by, "src"]).withColumn("_m", F.col("_k") * F.col("_u")))
        rows = sides.join(v, [*by, "dst"]).withColumn("_m", F.col("_k") * F.col("_v"))
    v = materialise(v, "factors")  # read twice; until here each table of factors is read once by the next
    u = factors("src", "_u", sides.join(v, [*by, "dst"]).withColumn("_m", F.col("_k") * F.col("_v")))
    weighed = kernel.join(u, [*by, "src"]).join(v, [*by, "dst"])
    return weighed.withColumn("w", F.col("_u") * F.col("_k") * F.col("_v")).select(*pairs.columns, "w")


def candidate_pairs(moving: DataFrame, fixed: DataFrame, neighbours: int) -> DataFrame:
    """``pair, src, dst, cost``: the nearest vectors of either side; cost is the squared distance over its mean in the pair."""
    there = knn_join(moving, fixed, neighbours, by=["pair"]).select("pair", "src", "dst", "d2")
    back = knn_join(fixed, moving, neighbours, by=["pair"]).select(
        "pair", F.col("dst").alias("src"), F.col("src").alias("dst"), "d2"
    )
    found = materialise(there.unionByName(back).groupBy("pair", "src", "dst").agg(F.min("d2").alias("d2")), "found")
    means = materialise(found.groupBy("pair").agg(F.avg("d2").alias("m")), "means")
    return found.join(means, "pair").select("pair", "src", "dst", F.coalesce(F.expr("try_divide(d2, m)"), F.lit(0.0)).alias("cost"))


def soft_steps(
    moving: DataFrame, fixed: DataFrame, neighbours: int = 32, sharpness: float = 2.0, relax: float = 0.3,
    rounds: int = 30, tolerance: float = 1e-3,
) -> DataFrame:
    """Weighted rigid fit of each pair of slices from soft correspondences: ``pair, theta, tx, ty``.

    ``moving, fixed``: ``pair, cell, x, y, vec``.  The first fit weighs candidates by their vectors alone.  Each further
    one adds the squared distance in space after the last fit, measured by half of its weighted mean, so wrong candidates
    fade out (the whole mean would be a fixed point that keeps some of them).  Ends when no fit turns or moves the points by more than ``tolerance`` of their spread; a warning
    tells if ``rounds`` end first.  A pair without candidates has no row.  Where the points form a lattice and the first
    fit is off by half a step of it, the fit can settle on a neighbouring place of the lattice.
    """
    at = lambda side, name, x, y: side.select("pair", F.col("cell").alias(name), F.col("x").alias(x), F.col("y").alias(y))
    found = candidate_pairs(moving, fixed, neighbours).withColumn("cost", F.col("cost") * sharpness)
    pairs = materialise(found.join(at(moving, "src", "ax", "ay"), ["pair", "src"]).join(at(fixed, "dst", "bx", "by"), ["pair", "dst"]), "candidates")
    square = F.expr("pow(cos(theta) * ax - sin(theta) * ay + tx - bx, 2) + pow(sin(theta) * ax + cos(theta) * ay + ty - `by`, 2)")

    def fit(costs: DataFrame) -> DataFrame:
        """Fit, weighted mean of the squares that are left, and the points' spread, one row per pair."""
        weighed = materialise(scale_pairs(costs, ["pair"], relax), "weighed")
        steps = materialise(rigid_fit(weighed, "pair"), "fit")
        left = weighed.join(steps, "pair").withColumn("r2", square).groupBy("pair").agg(
            F.expr("sum(w * r2) / sum(w)").alias("left"),
            F.expr("var_pop(ax) + var_pop(ay)").alias("spread"),
            F.avg("ax").alias("cx"), F.avg("ay").alias("cy"),
        )
        return materialise(steps.join(left, "pair"), "steps")

    steps = fit(pairs)
    for _ in range(rounds):
        # the floor keeps a perfect fit from dividing by nothing
        near = F.greatest(F.col("left") / 2, F.col("spread") * 1e-6, F.lit(1e-12))
        costs = pairs.join(steps, "pair").withColumn("cost", F.col("cost") + square / near).select(*pairs.columns)
        after = fit(costs)
        old = steps.select("pair", *[F.col(c).alias(f"o_{c}") for c in ("theta", "tx", "ty")])
        # how far the points' centre moves, and how far a point at the spread's distance from it turns
        moved = F.expr(
            "pow((cos(theta) - cos(o_theta)) * cx - (sin(theta) - sin(o_theta)) * cy + tx - o_tx, 2)"
            " + pow((sin(theta) - sin(o_theta)) * cx + (cos(theta) - cos(o_theta)) * cy + ty - o_ty, 2)"
            " + spread * (pow(cos(theta) - cos(o_theta), 2) + pow(sin(theta) - sin(o_theta), 2))"
        )
        restless = after.join(old, "pair").filter(moved > F.col("spread") * tolerance**2)
        steps = after
        if not restless.limit(1).count():
            break
    else:
        logging.getLogger(__name__).warning("soft correspondences have not settled after %d rounds", rounds)
    return steps.select("pair", "theta", "tx", "ty")


def register_softly(cells: DataFrame, neighbours: int = 32, **options) -> DataFrame:
    """``register_slices`` that starts from soft correspondences, for vectors too noisy for mutual nearest ones."""
    return register_slices(cells, start=lambda moving, fixed: soft_steps(moving, fixed, neighbours), **options)
