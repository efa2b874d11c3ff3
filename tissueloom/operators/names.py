"""File catalogs and name lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.functions.columns import (
    image_key,
    project_name,
    slice_number,
    stack_name,
    stage_token,
)
from tissueloom.sources.storage import materialise

# Fixed value: length of the suffix that follows the key in a catalogued file name.
KEY_SUFFIX = 7


def file_catalog(files: DataFrame, suffix: int = KEY_SUFFIX) -> DataFrame:
    """key -> path; the key is the file name minus its suffix, the greatest path wins."""
    name = F.substring_index("path", "/", -1)
    key = F.substring(name, F.lit(1), F.length(name) - suffix)
    return files.groupBy(key.alias("key")).agg(F.max("path").alias("path"))


def file_batch(files: DataFrame, size: int | None = 4) -> DataFrame:
    """The first ``size`` files in path order (``None``: all of them)."""
    ordered = files.select("path").distinct().orderBy("path")
    return ordered if size is None else ordered.limit(size)


def parse_slice_name(images: DataFrame) -> DataFrame:
    """Split image names into project, chip key, stage, stack name and slice number."""
    image = F.col("image")
    return (
        images.withColumn("project", project_name(image))
        .withColumn("chip", image_key(image))
        .withColumn("stage", stage_token(F.col("project")))
        .withColumn("stack", stack_name(F.col("project")))
        .withColumn("slice_no", slice_number(F.col("project")))
    )


def prefix_lookup(images: DataFrame, catalog: DataFrame, key: str = "chip") -> DataFrame:
    """Find the longest prefix (in ``_`` tokens) of each key that the catalog knows.

    Each distinct key is looked up once, however many images share it.  Prefixes are exploded
    and joined on equality, so the plan is a hash or merge join.  Unknown keys keep a null path.
    """
    keys = images.select(key).distinct()
    tokens = F.split(F.col(key), r"_\s*")
    prefixes = keys.withColumn("_n", F.explode(F.sequence(F.lit(1), F.size(tokens)))).withColumn(
        "_prefix", F.array_join(F.slice(tokens, F.lit(1), F.col("_n")), "_")
    )
    best = (
        prefixes.join(catalog.withColumnRenamed("key", "_prefix"), "_prefix")
        .groupBy(key)
        .agg(F.max_by(F.struct("_prefix", "path"), "_n").alias("_hit"))
        .select(key, F.col("_hit._prefix").alias("matched"), F.col("_hit.path").alias("path"))
    )
    return images.join(materialise(best, "lookup"), key, "left")
