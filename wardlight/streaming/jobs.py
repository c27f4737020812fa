"""Structured Streaming jobs. Each shares its transformation with the batch functions."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardlight.operators import rollups
from wardlight.operators.latest import latest_by
from wardlight.operators.rollups import Rollup
from wardlight.sources import landing

WRITERS = 4  # tables of a micro-batch written at the same time
RAW_SCHEMA = T.StructType([T.StructField("body", T.StringType()), T.StructField("ingest_ts", T.TimestampType())])


def landing_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages arriving as files in a folder."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def consume_once(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, archive: str) -> StreamingQuery:
    """Take in the CSV files of a folder that were not taken in before, then archive them."""
    files = (spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
             .option("cleanSource", "archive").option("sourceArchiveDir", archive).csv(folder))
    marked = files.withColumns({"_bronze_source": F.lit("incremental"), "_bronze_file": F.col("_metadata.file_path")})
    return marked.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out)


def _batch_path(folder: str, table: str, batch_id: int) -> str:
    return f"{folder}/{table}/batch_id={batch_id}"


def run_router(stream: DataFrame, out: str, checkpoint: str, tables: Iterable[str] | None = None) -> StreamingQuery:
    """One landing stream to the typed tables and the dead letters.

    Each micro-batch overwrites its own folder of each table, so a batch that is run
    again after a failure leaves the same rows.
    """
    names = list(tables or landing.EVENT_TABLES)

    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = landing.parse_events(batch).persist()
        parts = {name: landing.route(parsed, name) for name in names} | {"dead_letters": landing.split_dead_letter(parsed)[1]}
        try:
            with ThreadPoolExecutor(WRITERS) as pool:  # the writes share one cached batch and do not wait for each other
                list(pool.map(lambda name: parts[name].write.mode("overwrite").parquet(_batch_path(out, name, batch_id)), parts))
        finally:
            parsed.unpersist()

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def routed(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A typed table as the router left it."""
    return spark.read.parquet(f"{out}/{table}").drop("batch_id")


def run_rollup(stream: DataFrame, table: str, rollup: Rollup, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the roll-ups of a typed table as its messages arrive; a repeated micro-batch counts once."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rollups.add_batch(landing.route(landing.parse_events(batch), table), rollup, out, batch_id)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def timed(stream: DataFrame, delay: str, table: str | None = None) -> DataFrame:
    """Parsed events with their time and a watermark."""
    parsed = landing.parse_events(stream).filter(F.col("_corrupt_record").isNull())
    if table:
        parsed = parsed.filter(F.col("_table") == table)
    return parsed.withColumn("event_ts", F.try_to_timestamp("event_timestamp")).filter(F.col("event_ts").isNotNull()).withWatermark("event_ts", delay)


def dedup_stream(stream: DataFrame, delay: str) -> DataFrame:
    """Each event id once, as long as its copies arrive within the delay."""
    return timed(stream, delay).dropDuplicatesWithinWatermark(["event_id"])


def window_counts(stream: DataFrame, delay: str, size: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Events per window and key; a window is given out once the watermark has passed it."""
    window = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    counted = timed(stream, delay).groupBy(window.alias("_w"), *keys).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.select(F.col("_w.start").alias("bin"), *keys, "event_count")


def session_counts(stream: DataFrame, delay: str, gap: str, keys: list[str]) -> DataFrame:
    counted = timed(stream, delay).groupBy(F.session_window("event_ts", gap).alias("_s"), *keys).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.select(F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), *keys, "event_count")


def latest_stream(stream: DataFrame, table: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Latest row per key as a running aggregate: rows of a key are merged before the shuffle.

    Written with ``update``, each micro-batch holds the keys that changed; ``read_latest`` takes
    the last state of each key.
    """
    typed = landing.route(landing.parse_events(stream), table)
    newest = F.max_by(F.struct(*columns), F.struct("event_timestamp", "event_id"))
    return typed.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of each key out of what ``to_table`` wrote with ``update``."""
    written = spark.read.parquet(path)
    return latest_by(written, keys, "batch_id", "batch_id").drop("batch_id")


def enrich(stream: DataFrame, table: str, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Typed events joined with static dimensions."""
    typed = landing.route(landing.parse_events(stream), table)
    for dim, key in dims:
        typed = typed.join(dim, key, "left")
    return typed


def to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over what has arrived. ``update`` results keep the last row of each batch."""
    if mode == "append":
        return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finish(query: StreamingQuery) -> None:
    """Wait until a run over the arrived data has ended."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


