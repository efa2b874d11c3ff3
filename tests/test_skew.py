"""A third of all rows on one key: the join splits it, and the result stays whole."""

import re

import pytest
from pyspark.sql import functions as F

from tissueloom.operators import names
from tissueloom.operators import spots as sp
from tissueloom.sources.storage import materialise

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down, so that the test data count as large."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    yield
    for key in CONF:
        spark.conf.unset(key)


def splits(df) -> bool:
    """Run the query once and look for a split skewed partition in its final plan."""
    df.collect()
    return bool(re.search(r"Join\(skew=true\)|isSkew=true|skewed", df._jdf.queryExecution().executedPlan().toString()))


def hot_spots(spark):
    return materialise(
        spark.range(90_000).selectExpr(
            "if(id % 3 = 0, 's1', concat('s', id % 5)) AS slice", "concat('g', id % 997) AS gene",
            "if(id % 3 = 0, 7, cast(id % 300 as int)) AS x", "if(id % 3 = 0, 7, cast(id % 211 as int)) AS y",
            "1L AS cnt",
        )
    )


def test_hot_pixel_in_crop_and_cell_counts(spark, small_partitions):
    spots = hot_spots(spark)
    pixels = materialise(spots.select("slice", "x", "y").distinct())
    cropped = sp.crop_spots(spots, pixels.withColumn("value", F.lit(1)))
    assert splits(cropped) and cropped.count() == 90_000
    labels = pixels.withColumn("label", (F.col("x") % 10 + 1).cast("long"))
    counts = sp.cellbin_counts(spots, labels)
    assert splits(counts)
    assert counts.agg(F.sum("cnt")).first()[0] == 90_000
    hot = counts.filter("slice = 's1' and cell = 8").agg(F.sum("cnt")).first()[0]
    assert hot == spots.filter("slice = 's1' and x % 10 = 7").count()


def test_hot_image_key(spark, small_partitions):
    images = materialise(
        spark.range(60_000).selectExpr("concat('i', id) AS image", "if(id % 3 = 0, 'SShot_a_b', concat('SS', id)) AS chip")
    )
    catalog = materialise(images.selectExpr("split_part(chip, '_', 1) AS key", "chip AS path").distinct())
    found = names.prefix_lookup(images, catalog)
    assert splits(found)
    assert found.filter("chip = 'SShot_a_b' and path = 'SShot_a_b' and matched = 'SShot'").count() == 20_000
    assert found.filter("path is null").count() == 0
