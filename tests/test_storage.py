"""Where intermediate tables go."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from tissueloom.sources import storage


def fake(master, conf=None, context_dir=None):
    context = SimpleNamespace(
        master=master, applicationId="app-1", getCheckpointDir=lambda: context_dir
    )
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: (conf or {}).get(key, default)), sparkContext=context
    )


def test_the_cluster_names_the_folder():
    spark = fake("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert storage.shared_dir(spark) == "hdfs:///shared"
    path = storage.fresh_path(spark, "step")
    assert path.startswith("hdfs:///shared/tissueloom-app-1/step-") and path != storage.fresh_path(spark, "step")


def test_a_folder_set_on_the_context_is_used():
    assert storage.shared_dir(fake("yarn", context_dir="s3://bucket/x")) == "s3://bucket/x"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(fake("spark://host:7077"))


def test_lookup_hint_only_below_the_bound(spark):
    small = storage.lookup_table(spark.range(10), max_rows=10)
    large = storage.lookup_table(spark.range(11), max_rows=10)
    hinted = [t._jdf.queryExecution().analyzed().toString() for t in (small, large)]
    assert "broadcast" in hinted[0].lower() and "broadcast" not in hinted[1].lower()


def test_partitioned_writes_leave_few_files(spark, tmp_path):
    from tissueloom.sources import tables

    rows = spark.range(4000).selectExpr("concat('s', id % 5) AS slice", "'g' AS gene", "cast(id AS int) AS x", "1 AS y", "id AS cnt").repartition(16)
    tables.write_spots(rows, f"{tmp_path}/spots")
    tables.write_matrix(f"{tmp_path}/matrix", counts=rows)
    for folder in (f"{tmp_path}/spots", f"{tmp_path}/matrix/counts"):
        files = tables.list_files(spark, folder).filter("path LIKE '%part-%' AND path NOT LIKE '%.crc'").count()
        assert files <= 10  # five folders; sixteen tasks would have left eighty
    assert tables.scan_spots(spark, f"{tmp_path}/spots").count() == 4000


def test_released_tables_are_gone_and_the_session_keeps_its_settings(spark):
    before = spark.conf.get(storage.CLEANUP, None)
    table, other = storage.materialise(spark.range(5), "old"), storage.materialise(spark.range(3), "new")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    storage.release(table)
    assert not folder.exists() and other.count() == 3
    assert spark.conf.get(storage.CLEANUP, None) == before
