"""Pixel tables: growing labels, brightness cuts, tile equalisation, connected components."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.operators.spots import PIXEL
from tissueloom.sources.storage import materialise

# Fixed values of the local equalisation.
TILE_GRID = 10
CLIP_LIMIT = 7
LEVELS = 256

# side of the square tiles in which labels grow (more when the distance is large) and connect
TILE_SIDE = 256


def _rings(distance: float) -> list[tuple[int, list[tuple[int, int]]]]:
    """Offsets within ``distance``, grouped by squared length, shortest first."""
    reach = math.floor(distance)
    rings: dict[int, list[tuple[int, int]]] = {}
    for dx in range(-reach, reach + 1):
        for dy in range(-reach, reach + 1):
            d2 = dx * dx + dy * dy
            if 0 < d2 <= distance * distance:
                rings.setdefault(d2, []).append((dx, dy))
    return sorted(rings.items())


def _labels_in_reach(labels: DataFrame, distance: float, nearest_only: bool) -> DataFrame:
    """``slice, x, y, label, d2``: the labels within ``distance`` of each background pixel.

    The raster is cut into square tiles; a labelled pixel also goes to the neighbouring tiles it
    can reach into, a background pixel only to its own.  So each pixel is shuffled once (and a
    few more times near borders) instead of once per offset of the disc, and a task holds one
    tile of bounded size.  ``nearest_only``: one row per background pixel, with the nearest
    label (ties to the smaller one) or 0.
    """
    rings, reach = _rings(distance), math.floor(distance)
    side = max(TILE_SIDE, 4 * reach)

    def tiles(axis: str):
        away = F.when(F.col("label") != 0, F.lit(reach)).otherwise(0)
        first, last = (F.floor((F.col(axis) + sign * away) / side).cast("int") for sign in (-1, 1))
        return F.explode(F.sequence(first, last))

    spread = labels.withColumn("tx", tiles("x")).withColumn("ty", tiles("y"))
    fields = {f.name: f.dataType.simpleString() for f in labels.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in [*PIXEL, "label"]) + ", d2 int"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        origin = np.array([pdf["tx"].iloc[0], pdf["ty"].iloc[0]]) * side - reach
        at = pdf[["x", "y"]].to_numpy() - origin
        value = pdf["label"].to_numpy()
        board = np.zeros((side + 2 * reach, side + 2 * reach), dtype=np.int64)
        board[at[:, 0], at[:, 1]] = value
        free = np.flatnonzero(value == 0)
        hits = []
        for d2, offsets in rings:
            if not len(free):
                break
            seen = np.stack([board[at[free, 0] + dx, at[free, 1] + dy] for dx, dy in offsets])
            if nearest_only:
                low = np.where(seen == 0, np.iinfo(np.int64).max, seen).min(axis=0)
                found = (seen != 0).any(axis=0)
                hits.append((free[found], low[found], np.full(found.sum(), d2)))
                free = free[~found]
            else:
                which, pixel = np.nonzero(seen)
                hits.append((free[pixel], seen[which, pixel], np.full(len(pixel), d2)))
        if nearest_only or not hits:
            rest = free if nearest_only else free[:0]
            hits.append((rest, np.zeros(len(rest), np.int64), np.zeros(len(rest), int)))
        rows, label, d2 = (np.concatenate([h[i] for h in hits]) for i in range(3))
        out = pdf[PIXEL].iloc[rows].assign(label=label, d2=d2.astype("int32"))
        return out.drop_duplicates([*PIXEL, "label"])  # rings come shortest first

    return spread.groupBy("slice", "tx", "ty").applyInPandas(grow, schema)


def expand_labels(labels: DataFrame, distance: float, max_area: int | None = None) -> DataFrame:
    """Give background pixels (label 0) within ``distance`` the nearest label; ties: smaller label.

    With ``max_area`` labels grow in rings of equal distance, and one that has ``max_area``
    pixels when a ring starts takes no pixel of that ring.  Returns the whole raster.
    """
    labels = materialise(labels.select(*PIXEL, "label"), "labels")
    labelled = labels.filter("label <> 0")
    if max_area is None:
        return labelled.unionByName(_labels_in_reach(labels, distance, True).drop("d2"))
    reached = materialise(_labels_in_reach(labels, distance, False), "reached")
    grown = materialise(
        _grow_in_rings(labelled, reached, [d2 for d2, _ in _rings(distance)], max_area), "grown"
    )
    rest = labels.filter("label = 0").join(grown.select(*PIXEL), PIXEL, "left_anti")
    return labelled.unionByName(grown).unionByName(rest)


def _grow_in_rings(labelled: DataFrame, candidates: DataFrame, rings: list[int], max_area: int) -> DataFrame:
    key = ["slice", "label"]
    area = materialise(labelled.groupBy(*key).agg(F.count("*").alias("area")), "area")
    grown = candidates.select(*PIXEL, "label").limit(0)
    for ring in rings:
        growing = area.filter(F.col("area") < max_area).select(*key)
        taken = materialise(
            candidates.filter(F.col("d2") == ring)
            .join(growing, key, "left_semi")
            .join(grown, PIXEL, "left_anti")
            .groupBy(*PIXEL)
            .agg(F.min("label").alias("label")),
            "ring",
        )
        more = taken.groupBy(*key).agg(F.count("*").alias("area"))
        area = materialise(
            area.unionByName(more).groupBy(*key).agg(F.sum("area").alias("area")), "area"
        )
        grown = grown.unionByName(taken)
    return grown


def histogram(pixels: DataFrame) -> DataFrame:
    """Pixels per slice and brightness level (at most 256 rows per slice)."""
    return pixels.groupBy("slice", F.col("value").cast("int").alias("level")).agg(
        F.count("*").alias("n")
    )


def otsu_cuts(pixels: DataFrame, classes: int = 2) -> DataFrame:
    """Brightness cut(s) with the largest between-class variance, as ``slice, otsu_index, cut``.

    Works on the histogram only: prefix sums over at most 256 levels per slice.
    """
    if classes not in (2, 3):
        raise ValueError("classes must be 2 or 3")
    hist = materialise(histogram(pixels), "histogram")
    up = Window.partitionBy("slice").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("slice")
    mass = F.col("level") * F.col("n")
    prefix = hist.select(
        "slice",
        "level",
        F.sum("n").over(up).alias("w"),
        F.sum(mass).over(up).alias("s"),
        F.sum("n").over(whole).alias("wt"),
        F.sum(mass).over(whole).alias("st"),
    )
    if classes == 2:
        gap = F.expr("s / w - (st - s) / (wt - w)")
        scored = prefix.filter("w < wt").withColumn(
            "between", F.round(F.col("w") * 1.0 * (F.col("wt") - F.col("w")) * gap * gap / F.col("wt") / F.col("wt"), 9)
        )
        best = scored.groupBy("slice").agg(
            F.min_by("level", F.struct(-F.col("between"), F.col("level"))).alias("cut")
        )
        return best.select("slice", F.lit(0).alias("otsu_index"), "cut")
    low = prefix.select("slice", F.col("level").alias("t1"), F.col("w").alias("w1"), F.col("s").alias("s1"))
    high = prefix.filter("w < wt").select("slice", F.col("level").alias("t2"), "w", "s", "wt", "st")
    scored = (
        low.join(high, "slice")
        .filter("t1 < t2")
        .withColumn(
            "between",
            F.expr(
                "round((s1 * 1.0D * s1 / w1 + (s - s1) * 1.0D * (s - s1) / (w - w1)"
                " + (st - s) * 1.0D * (st - s) / (wt - w)) / wt, 9)"
            ),
        )
    )
    best = scored.groupBy("slice").agg(
        F.min_by(F.array("t1", "t2"), F.struct(-F.col("between"), F.col("t1"), F.col("t2"))).alias("cuts")
    )
    return best.select("slice", F.posexplode("cuts").alias("otsu_index", "cut"))


def foreground(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """Pixels brighter than the cut their slice's parameters (otsu_class, otsu_index) choose."""
    cuts = [otsu_cuts(pixels, c).withColumn("otsu_class", F.lit(c)) for c in (2, 3)]
    chosen = materialise(
        params.select("slice", "otsu_class", "otsu_index").join(
            cuts[0].unionByName(cuts[1]), ["slice", "otsu_class", "otsu_index"]
        ),
        "cuts",
    )
    return pixels.join(chosen.select("slice", "cut"), "slice").filter("value > cut").select(*PIXEL)


def tile_cdf(pixels: DataFrame, grid: int = TILE_GRID, limit: float = CLIP_LIMIT) -> DataFrame:
    """Clip-limited histogram equalisation per tile, without blending between tiles.

    The cap is ``limit * n / 256`` and the excess is spread evenly over all 256 levels, so the
    cumulative share of a level needs only the levels that occur.
    """
    size = materialise(
        pixels.groupBy("slice").agg(F.max("x").alias("_mx"), F.max("y").alias("_my")), "extent"
    )
    tiled = pixels.join(size, "slice").select(
        *PIXEL,
        F.floor(F.col("x") * grid / (F.col("_mx") + 1)).cast("int").alias("tx"),
        F.floor(F.col("y") * grid / (F.col("_my") + 1)).cast("int").alias("ty"),
        F.col("value").cast("int").alias("level"),
    )
    tile = ["slice", "tx", "ty"]
    up = Window.partitionBy(*tile).orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*tile)
    hist = (
        tiled.groupBy(*tile, "level")
        .agg(F.count("*").alias("n"))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("kept", F.least(F.col("n").cast("double"), F.col("total") * (limit / LEVELS)))
        .withColumn("excess", F.col("total") - F.sum("kept").over(whole))
        .withColumn("cum", F.sum("kept").over(up) + F.col("excess") * (F.col("level") + 1) / LEVELS)
        .select(
            *tile, "level",
            F.floor(F.round(F.col("cum") * (LEVELS - 1) / F.col("total"), 6)).cast("int").alias("value"),
        )
    )
    return tiled.join(materialise(hist, "levels"), [*tile, "level"]).select(*PIXEL, "level", "value")


def connected_components(edges: DataFrame, by: list[str]) -> DataFrame:
    """Smallest node id of every node's component, as ``by…, node, root``.

    ``edges``: ``by…, a, b``.  Alternates two min-steps (every node hands its larger neighbours
    to its smallest one, then its smaller ones), which needs O(log n) rounds also for long
    chains.  Minima are pre-aggregated; joins read written tables, so AQE can split hot nodes.
    """
    edges = materialise(
        edges.filter("a <> b")
        .select(*by, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.select(
            *by, F.inline(F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
                                  F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        )
        low = materialise(both.groupBy(*by, "u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = materialise(
            both.filter("v > u").join(low, [*by, "u"]).select(*by, F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        low = materialise(large.groupBy(*by, "u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, [*by, "u"]).filter("v <> m").select(
            *by, F.col("v").alias("u"), F.col("m").alias("v")
        )
        edges = materialise(
            small.unionByName(low.select(*by, "u", F.col("m").alias("v"))).distinct(), "links"
        )
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64(*by, "u", "v"))).first()
        if now == state:
            stars = edges.select(*by, F.col("u").alias("node"), F.col("v").alias("root"))
            roots = edges.select(*by, F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return stars.unionByName(roots)
        state = now


def _tile_components(pixels: DataFrame) -> DataFrame:
    """Components inside square tiles: ``slice, x, y, part``, the smallest label of a pixel.

    Frames that reach below zero are counted from their lowest x and y, so that labels are unique
    and not negative.
    """
    low_y = F.least(F.min("y"), F.lit(0)).cast("long")
    frame = materialise(
        pixels.groupBy("slice").agg(
            F.least(F.min("x"), F.lit(0)).cast("long").alias("low_x"),
            low_y.alias("low_y"),
            (F.max("y") + 1 - low_y).cast("long").alias("width"),
        ),
        "frame",
    )
    tiled = pixels.select(*PIXEL).join(frame, "slice").withColumns(
        {f"t{c}": F.floor(F.col(c) / TILE_SIDE).cast("int") for c in ("x", "y")}
    )

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].to_numpy(np.int64), pdf["y"].to_numpy(np.int64)
        low_x, low_y, width = (pdf[c].iloc[0] for c in ("low_x", "low_y", "width"))
        name = (x - low_x) * width + y - low_y
        order = np.argsort(name)  # position in this order grows with the label
        place = np.full((TILE_SIDE + 1, TILE_SIDE + 1), -1)
        i, j = (x % TILE_SIDE)[order], (y % TILE_SIDE)[order]
        place[i, j] = np.arange(len(order))
        a = np.tile(np.arange(len(order)), 2)
        b = np.concatenate([place[i + 1, j], place[i, j + 1]])
        a, b = a[b >= 0], b[b >= 0]
        low = np.arange(len(order))
        while True:
            best = np.minimum(low[a], low[b])
            new = low.copy()
            np.minimum.at(new, low[a], best)
            np.minimum.at(new, low[b], best)
            new = new[new]
            if (new == low).all():
                break
            low = new
        part = np.empty(len(order), np.int64)
        part[order] = name[order][low]
        return pdf[PIXEL].assign(part=part)

    fields = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in PIXEL) + ", part bigint"
    return tiled.groupBy("slice", "tx", "ty").applyInPandas(label, schema)


def label_components(pixels: DataFrame) -> DataFrame:
    """Label 4-connected foreground pixels; the label is the smallest ``x * width + y``,
    counted from the lowest x and y of the slice where these are negative.

    Tiles of bounded size are labelled first, so the graph that spans the cluster has one node
    per component and tile, and edges only where a component crosses a tile border.
    """
    parts = materialise(_tile_components(pixels), "parts")
    links = []
    for axis in ("x", "y"):
        edge = F.pmod(F.col(axis), F.lit(TILE_SIDE))
        before = parts.filter(edge == TILE_SIDE - 1).withColumn(axis, F.col(axis) + 1)
        after = parts.filter(edge == 0).withColumnRenamed("part", "b")
        links.append(before.withColumnRenamed("part", "a").join(after, PIXEL).select("slice", "a", "b"))
    joined = connected_components(links[0].unionByName(links[1]), ["slice"])
    roots = materialise(joined.withColumnRenamed("node", "part"), "roots")
    return parts.join(roots, ["slice", "part"], "left").select(
        *PIXEL, F.coalesce("root", "part").alias("label")
    )


def segment_cells(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """Cell labels from brightness: cut, connected components, background kept as label 0."""
    labelled = label_components(foreground(pixels, params))
    # label 0 means background, so component labels start at 1
    return pixels.select(*PIXEL).join(labelled, PIXEL, "left").select(
        *PIXEL, F.coalesce(F.col("label") + 1, F.lit(0)).cast("long").alias("label")
    )
