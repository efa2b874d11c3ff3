"""Line dedup across documents with levelled sorted runs of line hashes (DataFrame operations only).

Documents are taken in ``doc_id`` order in batches.  A batch's distinct keys are merge-anti-joined with
the runs, so only keys nobody held before remain; with their owner (the batch's smallest document)
they become a new run.  Runs are bucketed and sorted by key, so the run side of a merge join is read in place.
Once a level holds ``FANOUT`` runs they are compacted into one run of the next level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import SPACES, with_length
from tissueloom.sources.storage import fresh_path, materialise

#: Batches of documents, runs of a level that are compacted, code points below which a key is left alone.
BATCHES, FANOUT, MIN_CHARS = 4, 2, 10
#: A key that this share of a batch's lines hold (and so many lines at least) is joined in this many pieces.
HOT_SHARE, HOT_LINES, PIECES = 1_000, 1_000, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Runs:
    """The sorted runs ``key, owner``; a key is in one run only."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.levels = spark, buckets, [[]]
        self.names: list[str] = []

    def _write(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        (
            df.write.format("parquet")
            .bucketBy(self.buckets, "key")
            .sortBy("key")
            .option("path", fresh_path(self.spark, "run"))
            .saveAsTable(name)
        )
        return self.spark.table(name)

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """``batch``: ``key, owner`` with distinct keys; keys that some run holds are left out."""
        for run in self.all():
            batch = batch.join(run.hint("merge"), "key", "left_anti")
        self.levels[0].append(self._write(batch.repartition(self.buckets, "key")))
        at = 0
        while len(self.levels[at]) >= FANOUT:
            merged = self.levels[at][0]
            for run in self.levels[at][1:]:
                merged = merged.unionByName(run)
            self.levels[at] = []
            if at + 1 == len(self.levels):
                self.levels.append([])
            at += 1
            self.levels[at].append(self._write(merged.repartition(self.buckets, "key")))

    def owners(self) -> DataFrame:
        runs = self.all()
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out


    def forget(self) -> None:
        """Take the runs' names out of the catalog; their files go with the scratch folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, version, pos, key``: the lines that can be duplicates; the key is a 128-bit hash.

    ``version`` tells rows apart that share a ``doc_id`` but not the text.
    """
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.posexplode(_lines(F.translate("text", UPPER, LOWER))).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(SPACES))
    return lines.withColumn("line", key).filter(F.char_length("line") >= min_chars).select(
        "doc_id", "version", "pos", F.unhex(F.substring(F.sha2(F.col("line"), 256), 1, 32)).alias("key")
    )


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``doc_id, version, drop``: sorted positions of the lines that an earlier document holds."""
    spark = docs.sparkSession
    keys = line_keys(docs, min_chars)
    cuts = docs.agg(
        F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("c")
    ).first()["c"]
    number = F.lit(0)
    for cut in sorted(set(cuts or [])):
        number = number + F.when(F.col("doc_id") > cut, 1).otherwise(0)
    path = fresh_path(spark, "line-keys")
    keys.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(
        "doc_id bigint, version bigint, pos int, key binary, batch int"
    ).parquet(path)
    runs = Runs(spark, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = []
    for b in range(len(set(cuts or [])) + 1):
        batch = keys.filter(F.col("batch") == b)
        counted = materialise(batch.groupBy("key").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")), "batch")
        least = (counted.agg(F.sum("n")).first()[0] or 0) / HOT_SHARE
        hot.append(counted.filter(F.col("n") > F.greatest(F.lit(least), F.lit(HOT_LINES))).select("key"))
        runs.add(counted.drop("n"))
    # at most HOT_SHARE keys of a batch are hot: a list of bounded size
    common = materialise(reduce(DataFrame.unionByName, hot).distinct(), "hot")
    owners = runs.owners().join(F.broadcast(common.withColumn("hot", F.lit(PIECES))), "key", "left")
    owners = owners.withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("hot", F.lit(1)) - 1))).drop("hot")
    # one row of a key and document, so that a line repeated inside a document is joined once
    held = keys.groupBy("key", "doc_id", "version").agg(F.collect_set("pos").alias("pos"))
    held = held.join(F.broadcast(common.withColumn("hot", F.lit(PIECES))), "key", "left")
    piece = F.pmod(F.xxhash64("doc_id", "version"), F.coalesce("hot", F.lit(1))).cast("int")
    lost = held.withColumn("piece", piece).drop("hot").join(owners, ["key", "piece"]).filter("owner <> doc_id")
    dropped = materialise(
        lost.groupBy("doc_id", "version").agg(F.array_sort(F.flatten(F.collect_list("pos"))).alias("drop")), "drop"
    )
    runs.forget()
    return dropped


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row of ``docs``.

    A null or empty text is one empty line.  Keys of at least ``min_chars`` code points held by two or more
    documents stay in the smallest ``doc_id`` only (all its copies of the line stay).  Rows with a null
    ``doc_id`` keep all lines and own none; rows that share a ``doc_id`` are one document.  Empty tables
    give empty results; other columns are not looked at.
    """
    return _apply(docs.select("doc_id", "text"), min_chars, batches).select("doc_id", "n_lines", "n_dropped", "kept")


def _apply(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    drop = dropped_lines(docs.select("doc_id", "text"), min_chars, batches)
    joined = docs.withColumn("version", F.xxhash64("text")).join(drop, ["doc_id", "version"], "left")
    cut = joined.withColumn("lines", _lines(F.col("text"))).withColumn(
        "cuts", F.concat(F.array(F.lit(-1)), "drop", F.array(F.size("lines")))
    )
    # what stays are the stretches between neighbouring dropped positions
    stretch = F.transform(
        F.sequence(F.lit(1), F.size("cuts") - 1),
        lambda k: F.slice(
            F.col("lines"),
            F.get("cuts", k - 1) + 2,
            F.get("cuts", k) - F.get("cuts", k - 1) - 1,
        ),
    )
    return cut.withColumn("n_lines", F.size("lines").cast("bigint")).withColumn(
        "n_dropped", F.coalesce(F.size("drop"), F.lit(0)).cast("bigint")
    ).withColumn(
        "kept",
        F.when(F.col("drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(
            F.array_join(F.flatten(stretch), "\n")
        ),
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``; untouched texts (nulls too) stay as they are."""
    inner = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    done = _apply(inner, min_chars, batches)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    return with_length(done.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
