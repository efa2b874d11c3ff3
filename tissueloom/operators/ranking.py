"""Order statistics of possibly huge groups.

A plain ``row_number`` over a group sends the whole group to one task.  Both operators below
first look at a summary of the sort key (pre-aggregated on the map side, of fixed size per group:
a histogram or a rank sketch), find the interval that holds the wanted rank, and order only the rows of
that interval.  Results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.sources.storage import lookup_table, materialise


def draw_threshold(
    keyed: DataFrame, by: Sequence[str], key: str, take: Column, prefix: int = 3
) -> DataFrame:
    """Per group, the hex key of the ``take``-th smallest row.

    ``take`` is an expression over ``n``, the group size; ``prefix`` hex digits make the buckets.  Rows with ``key <= cut`` are exactly
    the ``take`` smallest ones, so the caller keeps them with a filter instead of a sort.
    Returns ``by…, n, take, cut``.
    """
    by = list(by)
    bucket = F.substring(key, 1, prefix)
    hist = keyed.groupBy(*by, bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    running = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    edge = (
        hist.withColumn("_end", F.sum("_rows").over(running))
        .withColumn("n", F.sum("_rows").over(whole))
        .withColumn("take", take.cast("long"))
        .filter((F.col("_end") >= F.col("take")) & (F.col("_end") - F.col("_rows") < F.col("take")))
        .withColumn("_need", F.col("take") - F.col("_end") + F.col("_rows"))
        .select(*by, "_bucket", "n", "take", "_need")
    )
    inside = keyed.select(*by, key, bucket.alias("_bucket")).join(
        lookup_table(edge, "edge"), [*by, "_bucket"]
    )
    order = Window.partitionBy(*by).orderBy(key)
    return (
        inside.withColumn("_pos", F.row_number().over(order))
        .filter(F.col("_pos") == F.col("_need"))
        .select(*by, "n", "take", F.col(key).alias("cut"))
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], buckets: int = 4096
) -> DataFrame:
    """Exact quantiles with linear interpolation, as ``by…, prob, quantile``.

    A sketch of each group (error: one rank in ``buckets``) names an interval of values that holds the wanted
    ranks, wherever most of the values lie; one pass counts what is below and inside.  Only the values inside,
    some ``4 / buckets`` of a group, are ordered, equal ones as one counted row.  Should an interval miss its
    ranks, it becomes the whole group.
    """
    by, numbers = list(by), range(len(probs))
    values = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    values = materialise(values, "values")
    margin = 2 / buckets
    ends = [min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sketch = values.groupBy(*by).agg(
        F.count("*").alias("_total"), F.percentile_approx("_v", ends, buckets).alias("_ends")
    )
    inside = [(F.col("_v") >= F.get("_ends", F.lit(2 * i))) & (F.col("_v") <= F.get("_ends", F.lit(2 * i + 1))) for i in numbers]
    tallied = values.join(materialise(sketch, "sketch"), by).groupBy(*by).agg(
        F.first("_total").alias("_total"),
        F.first("_ends").alias("_ends"),
        F.array(*[F.count_if(F.col("_v") < F.get("_ends", F.lit(2 * i))) for i in numbers]).alias("_below"),
        F.array(*[F.count_if(x) for x in inside]).alias("_in"),
    )
    intervals = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        below, low, high = F.get("_below", F.lit(i)), F.get("_ends", F.lit(2 * i)), F.get("_ends", F.lit(2 * i + 1))
        holds = (F.floor(place) >= below) & (F.ceil(place) < below + F.get("_in", F.lit(i)))
        intervals.append(
            F.struct(
                F.lit(float(p)).alias("prob"), place.alias("_place"), F.when(holds, low).alias("_low"),
                F.when(holds, high).alias("_high"), F.when(holds, below).otherwise(0).alias("_base"),
            )
        )
    wanted = materialise(tallied.select(*by, F.array(*intervals).alias("_wanted")), "intervals")
    near = F.filter(
        "_wanted", lambda w: w["_low"].isNull() | ((F.col("_v") >= w["_low"]) & (F.col("_v") <= w["_high"]))
    )
    counted = (
        values.join(wanted, by)
        .select(*by, "_v", F.explode(near).alias("_w"))
        .groupBy(*by, "_w.prob", "_w._place", "_w._base", "_v")
        .agg(F.count("*").alias("_rows"))
    )
    running = Window.partitionBy(*by, "prob").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_to", F.col("_base") + F.sum("_rows").over(running)).withColumn(
        "_from", F.col("_to") - F.col("_rows")
    )
    low, high = F.floor("_place"), F.ceil("_place")
    holds = lambda rank: F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v"))
    found = placed.groupBy(*by, "prob").agg(
        F.max(holds(low)).alias("_a"), F.max(holds(high)).alias("_b"), F.first(F.col("_place") - low).alias("_frac")
    )
    return found.select(*by, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")).alias("quantile"))
