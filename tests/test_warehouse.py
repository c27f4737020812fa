"""What the tables of the warehouse leave on disk."""

import glob
import os

from wardlight.plans import warehouse
from wardlight.session import TABLES, settle
from wardlight.sources import files


def _shuffles(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    top = list(manager.localDirsString())
    return {f for d in top for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def test_shuffles_go_when_a_table_is_written(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in TABLES}
    settle(spark, TABLES)
    try:
        there, held = _shuffles(spark), spark.range(1000).repartition(4).rdd
        held.count()
        mine = _shuffles(spark) - there
        files.save_table(spark.range(10_000).repartition(4).groupBy("id").count(), str(tmp_path / "t"))
        assert mine and not _shuffles(spark) - there - mine  # those of an RDD that is in use stay
    finally:
        settle(spark, before)


def test_staged_rows_go_when_their_table_is_stored(spark, tmp_path):
    w = warehouse.Warehouse(spark, "nowhere")
    w.folder = str(tmp_path / "w")
    rows = [(1, "a"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "k long, v string")
    staged = w.staged("t", w.staged("t-rows", df))
    assert staged.columns == df.columns and os.listdir(w.folder) == ["t-staged"]
    stored = w._store("t", staged)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(rows) and os.listdir(w.folder) == ["t"]


def test_tables_are_packed(spark, tmp_path):
    files.save_table(spark.range(10).withColumnRenamed("id", "a"), str(tmp_path / "t"))
    assert all(".zstd." in f for f in spark.read.parquet(str(tmp_path / "t")).inputFiles())
