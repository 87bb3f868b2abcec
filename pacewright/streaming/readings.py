"""Readings and events as streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewright.operators import flags, views


def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hour, event_type, n: a watermarked tumbling window over the events, run until what is there is read.

    The parquet file source is a stream. Each batch appends the hours that it changed to a table in the
    session's checkpoint folder (a folder of this machine where none is set and all is local, as in tests; elsewhere that is refused), so that nothing
    passes through the driver; the watermark lets the state of closed hours go. Counts only rise, so an
    hour's largest one is its last.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/event[s].parquet")
    seen = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
    counted = seen.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{shared or tempfile.mkdtemp(prefix='pacewright-')}/hourly_{uuid.uuid4().hex}"
    rows = counted.select(F.floor(F.unix_timestamp("w.start") / 3600).cast("long").alias("hour"), "event_type", "n")

    def append(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/epoch={epoch}")  # a batch that runs again replaces its rows

    running = rows.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema("hour long, event_type string, n long, epoch int").parquet(f"{folder}/rows").groupBy("hour", "event_type").agg(F.max("n").alias("n"))


def check_readings(passings: DataFrame, runs: DataFrame, folder: str, checkpoint: str):
    """Run the checks on every batch of new passings and append their findings; ``passings`` is a stream."""

    def found(batch: DataFrame, epoch: int) -> None:
        inputs = flags.Inputs(batch, views.results(runs))
        flags.run_checks(inputs, ["split-order", "segment-speed"]).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(folder)

    return passings.writeStream.foreachBatch(found).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
