"""Rows along a curve: order of the cells, and files that a filter on either column skips."""

import os
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import clustering
from wardlight.plans.warehouse import claim_axes, open_warehouse

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _read_rows(spark, df):
    """Rows that the scan gave out, from its metrics: those of row groups it could not skip."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the scan is a leaf of the plan
    try:
        counted = df.groupBy().agg(F.count(F.lit(1)))
        counted.collect()
        scan = counted._jdf.queryExecution().executedPlan().collectLeaves().head()
        return scan.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _interleaved(a, b, bits):
    return int("".join(x + y for x, y in zip(f"{a:0{bits}b}", f"{b:0{bits}b}", strict=True)), 2)


def test_cells_and_order_by_hand(spark):
    edges = [3, 7, 10]
    points = [(a, b) for a in (None, -5, 2, 3, 6, 7, 9, 10, 99) for b in (0, 3, 8, 12)]
    df = spark.createDataFrame(points, "a long, b long")
    cell_a, cell_b = (clustering.cell_of(F.col(c), edges) for c in "ab")
    got = df.select("a", "b", cell_a.alias("x"), cell_b.alias("y"), clustering.morton([cell_a, cell_b], 2).alias("z")).collect()
    for r in got:
        x, y = (sum(v is not None and v >= e for e in edges) for v in (r.a, r.b))
        assert (r.x, r.y, r.z) == (x, y, _interleaved(x, y, 2))


def test_edges_of_a_hot_value_and_of_nothing(spark):
    df = spark.createDataFrame([(5 if i % 3 else i,) for i in range(3000)], "a long")
    edges = clustering.edges_of(df, ["a"], 3)["a"]
    assert 5 in edges and edges == sorted(set(edges)) and len(edges) < 8
    assert clustering.edges_of(df.filter("a < 0"), ["a"])["a"] == []


def test_too_many_edges_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        clustering.save_clustered_by(spark.range(3).toDF("a"), str(tmp_path / "x"), [(F.col("a"), range(32))])


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_filter_on_either_column_skips_most_rows(spark, tmp_path, partitioned):
    rng = random.Random(3)
    rows = [(rng.randrange(30) if rng.random() < 0.7 else 4, rng.randrange(1, 32), rng.random(), i % 2) for i in range(40_000)]
    df = spark.createDataFrame(rows, "payer long, day long, x double, half long").repartition(4)
    path = str(tmp_path / "t")
    spark.conf.set("parquet.block.size", str(16 * 1024))
    try:
        axes = [(F.col("payer"), clustering.edges_of(df, ["payer"])["payer"]), (F.col("day"), range(2, 32))]
        clustering.save_clustered_by(df, path, axes, ["half"] if partitioned else [])
    finally:
        spark.conf.unset("parquet.block.size")
    stored = spark.read.parquet(path)
    assert sorted(stored.select("payer", "day", "x", "half").collect()) == sorted(df.collect())
    assert _read_rows(spark, stored) == len(rows)
    for condition in ("payer = 11", "day = 17"):
        assert stored.filter(condition).count() == df.filter(condition).count()
        assert 0 < _read_rows(spark, stored.filter(condition)) < len(rows) / 3, condition


def test_a_partition_is_a_few_files_and_not_one_of_each_task(spark, tmp_path):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randrange(30), rng.randrange(1, 32), rng.randrange(12)) for _ in range(6000)], "payer long, day long, month long").repartition(4)
    path = str(tmp_path / "t")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # as many tasks as a large table has
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        clustering.save_clustered_by(df, path, [(F.col("payer"), range(1, 30)), (F.col("day"), range(2, 32))], ["month"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = spark.read.parquet(path).inputFiles()
    assert spark.read.parquet(path).count() == 6000 and len(files) <= 12 * 2**clustering.PIECES


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no source tables")
def test_claims_lie_along_the_curve_within_their_months(spark):
    w = open_warehouse(spark, SF_DIR)
    place = clustering.morton([clustering.cell_of(v, e) for v, e in claim_axes(w)])
    rows = w["fact_claim"].select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), place.alias("z"))
    last = {}
    for r in sorted(rows.collect(), key=lambda r: (r.file, r.at)):
        assert r.z >= last.get(r.file, -1)
        last[r.file] = r.z
    assert len(last) > 12
