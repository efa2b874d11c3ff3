"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts handled together inside a task; a slice also ends when it holds this many characters.
SLICE_ROWS, SLICE_CHARS = 512, 4_000_000

#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def slices(batch: pa.RecordBatch, text: str, most_chars: int = SLICE_CHARS, rows: int = SLICE_ROWS):
    """The batch cut into pieces of bounded rows and characters; a single text is never cut."""
    sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    start = chars = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= rows or chars + n > most_chars):
            yield batch.slice(start, i - start)
            start, chars = i, 0
        chars += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def release() -> None:
    """Hand memory that a task has freed back to the system: a worker lives on for other work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    outputs: str,
    build: Callable[[], Callable],
    text: str = "text",
    most_chars: int = SLICE_CHARS,
) -> DataFrame:
    """One output row per document: the ``keep`` columns, then ``outputs`` (DDL).

    ``build()`` runs once per task and returns a function from a list of texts (``None`` for null)
    to one list or array per output column.
    """
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*docs.select(*keep).schema.fields, *schema_of(outputs).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        work = build()
        for batch in batches:
            for part in slices(batch, "__text", most_chars):
                values = work(part.column("__text").to_pylist())
                columns = [part.column(c) for c in keep]
                for v, field in zip(values, list(arrow)[len(keep) :], strict=True):
                    columns.append(v if isinstance(v, pa.Array) else pa.array(v, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        release()

    return src.mapInArrow(run, schema)


def rewrite(docs: DataFrame, build: Callable[[], Callable], text: str = "text") -> DataFrame:
    """Rows with the same columns; ``build()`` gives a function ``texts -> (keep mask, new texts)``.

    ``new texts`` may be ``None``: texts stay as they are.
    """
    arrow = to_arrow_schema(docs.schema)
    names = docs.columns

    def run(batches):
        work = build()
        for batch in batches:
            for part in slices(batch, text):
                mask, changed = work(part.column(text).to_pylist())
                columns = [part.column(c) for c in names]
                if changed is not None:
                    columns[names.index(text)] = pa.array(changed, pa.string())
                out = pa.RecordBatch.from_arrays(columns, schema=arrow)
                yield out if mask is None else out.filter(pa.array(mask, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where the table has it, follows the text."""
    if "n_chars" not in docs.columns or "text" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(kind))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (multiply and xor-shift) for arrays of ``uint64``; any seed gives a new function."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounded_sample(df: DataFrame, key, rows: int) -> DataFrame:
    """About ``rows`` rows (all, if fewer), chosen by a hash of ``key``: no order, no shuffle.

    The share is taken from a count over the whole table; the expected number is ``rows`` and its
    spread is ``sqrt(rows)``.
    """
    total = df.count()
    if total <= rows:
        return df
    share = rows / total
    return df.filter(F.pmod(F.xxhash64(key, F.lit(41)), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
