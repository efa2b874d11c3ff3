"""Exact nearest neighbours in the plane or in space by grids of many levels.

Level ``l`` has cubes of side ``unit * 2^l``.  A point first looks at a few points of the smallest cube around it that
holds enough of them; the distance of the k-th is a bound.  Then it looks at the cubes that its ball of that
radius reaches, on the level whose side is at least the radius: at most three in each direction.  Both steps are
equi-joins on (level, cube), so dense regions use small cubes and empty ones large cubes, and nothing is collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.sources.storage import materialise

#: Levels below and above the one with about one answer per cube, and points of a cube that give the first bound,
#: as a multiple of the neighbours wanted.
LEVELS, FIRST = 10, 4


def grid_knn(points: DataFrame, k: int, by: Sequence[str] = (), id_col: str = "cell", coords: str = "xyz") -> DataFrame:
    """``by…, src, dst, rank, d2``: the ``k`` nearest other points of each point, by (distance, id), within its group.

    ``coords``: an array of 1 to 3 finite numbers.  Points without an id or with a null coordinate take no part; a
    group of fewer points gives all that there are.  Ids are unique within a group.  Masses of points at one place
    are reduced to the ``k + 1`` smallest ids, which are the nearest that the others can have.
    """
    by = list(by)
    sound = F.col(id_col).isNotNull() & F.col(coords).isNotNull() & F.forall(coords, lambda v: v.isNotNull() & (F.abs(v) < math.inf))
    base = materialise(points.filter(sound).select(*by, F.col(id_col).alias("id"), F.col(coords).cast("array<double>").alias("v")), "points")
    dims = (base.select(F.max(F.size("v"))).first()[0]) or 1
    axes = range(dims)
    spans = [F.max(F.col("v")[i]) - F.min(F.col("v")[i]) for i in axes]
    shape = base.groupBy(*by).agg(F.count("*").alias("n"), F.greatest(*spans, F.lit(0.0)).alias("span")) if dims > 1 else (
        base.groupBy(*by).agg(F.count("*").alias("n"), spans[0].alias("span"))
    )
    n, span = shape.agg(F.max("n"), F.max("span")).first()
    unit = (span or 1.0) / max(1.0, ((n or 1) / (k + 1)) ** (1 / dims))

    def side(level: Column) -> Column:
        return F.lit(unit) * F.pow(F.lit(2.0), level)

    def cube(level: Column) -> list[Column]:
        return [F.floor(F.col("v")[i] / side(level)).alias(f"c{i}") for i in axes]

    at = [f"c{i}" for i in axes]
    same = Window.partitionBy(*by, "v").orderBy("id")
    thinned = materialise(base.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k + 1).drop("_copy"), "base")
    # cubes of the finest level, and for each the smallest cube around it with enough points
    low, high = F.lit(-LEVELS), F.lit(LEVELS)
    finest = materialise(thinned.select(*by, *cube(low)).groupBy(*by, *at).agg(F.count("*").alias("n")), "finest")
    above = finest.withColumn("level", F.explode(F.sequence(low, high)))
    up = [F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level") - low)).alias(f"u{i}") for i, c in enumerate(at)]
    over = [f"u{i}" for i in axes]
    nested = materialise(above.select(*by, *at, "n", "level", *up), "nested")
    full = nested.groupBy(*by, "level", *over).agg(F.sum("n").alias("n")).filter(F.col("n") > k).drop("n")
    chosen = nested.drop("n").join(full, [*by, "level", *over]).groupBy(*by, *at).agg(F.min(F.struct("level", *over)).alias("home"))
    homes = materialise(chosen.select(*by, *at, "home.level", *[F.col(f"home.{u}") for u in over]), "homes")

    # a few points of each chosen cube bound the distances of all points in it
    used = F.array(*[F.lit(r["level"]) for r in homes.select("level").distinct().collect()] or [F.lit(0)])
    named = [F.col(c).alias(u) for c, u in zip(at, over)]
    spread = thinned.withColumn("level", F.explode(used))
    members = spread.select(*by, "level", F.col("id").alias("o"), F.col("v").alias("w"), *cube(F.col("level"))).select(*by, "level", "o", "w", *named)
    few = Window.partitionBy(*by, "level", *over).orderBy("o")
    cubes = homes.select(*by, "level", *over).distinct()
    members = members.join(cubes, [*by, "level", *over], "left_semi").withColumn("_n", F.row_number().over(few)).filter(F.col("_n") <= FIRST * (k + 1)).drop("_n")
    d2 = sum((F.pow(F.col("v")[i] - F.col("w")[i], 2.0) for i in axes), F.lit(0.0))
    asking = base.select(*by, "id", "v", *cube(low)).join(homes, [*by, *at]).drop(*at)
    near = asking.join(members, [*by, "level", *over]).filter("id <> o").groupBy(*by, "id").agg(F.sort_array(F.collect_list(d2)).alias("d"))
    bounds = near.select(*by, "id", F.sqrt(F.get("d", F.lit(k - 1))).alias("bound")).filter("bound IS NOT NULL")
    # points of groups too small for any full cube see all of their group, which has at most k + 1 places
    limit = F.lit((span or 0.0) * 2 + 1.0)
    radius = F.coalesce("bound", limit) * (1 + 1e-9)
    level = F.greatest(F.ceil(F.log2(F.greatest(radius, F.lit(unit * 2.0**-LEVELS)) / F.lit(unit))), low).cast("int")
    asking = materialise(base.join(bounds, [*by, "id"], "left").withColumn("r", radius).withColumn("level", level).drop("bound"), "asking")
    used = F.array(*[F.lit(r["level"]) for r in asking.select("level").distinct().collect()] or [F.lit(0)])
    reach = asking
    for i in axes:
        ends = (F.floor((F.col("v")[i] + sign * F.col("r")) / side(F.col("level"))) for sign in (-1, 1))
        reach = reach.withColumn(f"c{i}", F.explode(F.sequence(*ends)))
    others = thinned.withColumn("level", F.explode(used)).select(*by, "level", F.col("id").alias("o"), F.col("v").alias("w"), *cube(F.col("level")))
    found = reach.join(others, [*by, "level", *at]).filter("id <> o").withColumn("d2", d2).filter(F.col("d2") <= F.col("r") * F.col("r"))
    order = Window.partitionBy(*by, "id").orderBy("d2", "o")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(*by, F.col("id").alias("src"), F.col("o").alias("dst"), "rank", "d2")
