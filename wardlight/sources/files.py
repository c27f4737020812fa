"""Files in, tables out: CSV loads with lineage, saves, completeness and load reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceFile:
    """One input of the load: its file, and whether it is reference data."""

    name: str
    path: str
    reference: bool = False
    required: bool = True

    @property
    def table(self) -> str:
        return self.name if self.reference else f"{self.name}_raw"


def text_schema(columns: list[str]) -> T.StructType:
    """All columns as text: nothing is inferred, so leading zeros survive."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, through the file system the path belongs to."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def with_lineage(df: DataFrame, source: str, load_ts: Column | None = None) -> DataFrame:
    """Load time, source tag and file of each row."""
    file = F.col("_metadata.file_path") if "_bronze_file" not in df.columns else F.col("_bronze_file")
    return df.withColumns({"_bronze_load_timestamp": F.current_timestamp() if load_ts is None else load_ts,
                           "_bronze_source": F.lit(source), "_bronze_file": file})


def _read(spark: SparkSession, paths: list[str], schema: T.StructType, source: str, load_ts: Column | None) -> DataFrame:
    return with_lineage(spark.read.schema(schema).option("header", True).csv(paths), source, load_ts)


def load_incremental(spark: SparkSession, globs: list[str], schema: T.StructType, load_ts: Column | None = None) -> DataFrame:
    """Incremental files, flat or one level of date folders deep; an empty table if there are none."""
    paths = [p for g in globs for p in matching(spark, g)]
    if paths:
        return _read(spark, paths, schema, "incremental", load_ts)
    lineage = [T.StructField("_bronze_load_timestamp", T.TimestampType()), T.StructField("_bronze_source", T.StringType()), T.StructField("_bronze_file", T.StringType())]
    return spark.createDataFrame([], T.StructType(schema.fields + lineage))


def load_full(spark: SparkSession, base: str, globs: list[str], schema: T.StructType, load_ts: Column | None = None) -> DataFrame:
    """Base file and all incremental files in one table, matched by column name."""
    full = _read(spark, [base], schema, "full", load_ts)
    more = load_incremental(spark, globs, schema, load_ts)
    return full.unionByName(more, allowMissingColumns=True)


def save_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, dynamic: bool = False) -> None:
    """Write a table. ``append`` may bring new columns: readers merge the schemas.

    ``dynamic`` replaces only the partitions that the rows belong to.

    Before a partitioned write the rows are rebalanced on the partition columns, so a
    big partition is split over tasks and small ones do not end in many tiny files.
    Files are packed with zstd: tables of a load lie side by side on disk.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of a table, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name on the same file system."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def save_clustered(df: DataFrame, path: str, cols: list[str], files: int | None = None) -> None:
    """Write in ranges of the columns, sorted within each file, so that readers skip files."""
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def write_scores(df: DataFrame, path: str, run_id: str) -> None:
    """Add the scores of a run; a second write of the same run replaces the first."""
    marked = df.withColumn("scoring_run_id", F.lit(run_id))
    (marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scoring_run_id").parquet(path))


def missing_sources(spark: SparkSession, files: list[SourceFile]) -> DataFrame:
    """Required inputs for which no file is there."""
    rows = [(f.name, f.path, f.required) for f in files]
    expected = spark.createDataFrame(rows, "name string, path string, required boolean")
    there = spark.createDataFrame([(f.name,) for f in files if matching(spark, f.path)], "name string")
    return expected.filter("required").join(there, "name", "left_anti")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, counted while they are written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def load_all(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Save each table and report its rows, or the error that stopped it."""
    report = []
    for name, df in tables.items():
        counted, seen = observed(df, f"load_{name}")
        try:
            save_table(counted, f"{folder}/{name}")
            report.append((name, seen.get["records"], "ok", None))
        except Exception as error:  # the report lists what failed and the load goes on
            report.append((name, None, "failed", str(error).split("\n")[0]))
    return load_report(spark, report)


def load_report(spark: SparkSession, results: list[tuple]) -> DataFrame:
    return spark.createDataFrame(results, "table_name string, records bigint, status string, error string")


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
