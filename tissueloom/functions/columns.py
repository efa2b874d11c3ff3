"""Reusable column expressions; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The replacement gene, the words a pandas reader takes for null, the
# mitochondrial prefix, the distance between two slices and the clip of the count image.
NAN_GENE = "CG5842"
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
MITO_PREFIX = "mt:"
SLICE_SPACING = 14
COUNT_CLIP = 10


def draw_key(*parts) -> Column:
    """Seeded pseudo-random sort key: the same text gives the same key on every engine and run."""
    return F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def count_byte(cnt: Column, clip: int = COUNT_CLIP) -> Column:
    """Count -> byte: clip, stretch to 0..255, truncate (integer arithmetic, no rounding error)."""
    return F.floor(F.least(cnt, F.lit(clip)) * 255 / clip).cast("int")


def filled_gene(gene: Column, replacement: str = NAN_GENE) -> Column:
    """Replace null gene names and the texts a reader may have taken for null."""
    return F.when(gene.isNull() | gene.isin(NULL_WORDS), F.lit(replacement)).otherwise(gene)


def gene_file_key(gene: Column) -> Column:
    return F.replace(gene, F.lit(":"), F.lit("_"))


def is_mito(gene: Column, prefix: str = MITO_PREFIX) -> Column:
    return gene.startswith(prefix)


def project_name(image: Column) -> Column:
    """First three tokens of an image name without its 4-character suffix."""
    stem = F.substring(image, F.lit(1), F.length(image) - 4)
    return F.array_join(F.slice(F.split(stem, r"_\s*"), 1, 3), "_")


def image_key(image: Column) -> Column:
    """Chip part of an image name: from the first ``SS`` to one character before ``tif``."""
    return F.regexp_extract(image, r"(SS.+?).tif", 1)


def stage_token(name: Column) -> Column:
    return F.split_part(name, F.lit("_"), F.lit(1))


def stack_name(slice_name: Column) -> Column:
    """Name of the whole stack: the slice name without its ``_S<number>`` token and what follows."""
    return F.regexp_replace(slice_name, r"_S\d+(_.*)?$", "")


def slice_number(slice_name: Column) -> Column:
    digits = F.regexp_extract(slice_name, r"_S(\d+)(_|$)", 1)
    return F.when(digits != "", digits).cast("int")


def slice_z(slice_name: Column, spacing: int = SLICE_SPACING) -> Column:
    return slice_number(slice_name) * spacing


def bin_index(coord: Column, size: int) -> Column:
    """Mathematical floor, so negative coordinates go to negative bins."""
    return F.floor(coord / F.lit(size)).cast("int")


def bin_centre(index: Column, size: int) -> Column:
    return (index + F.lit(0.5)) * F.lit(float(size))


def clipped(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
