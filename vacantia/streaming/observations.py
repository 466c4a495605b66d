"""The observation history as a stream: the same window and latest row as the batch, kept up incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vacantia.operators.canonical import deduplicate
from vacantia.session import cut
from vacantia.sources.sinks import exists, store_snapshots


def read_observations(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A Parquet file, or a folder of them, as a stream; its schema is that of the files there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
    return reader.parquet(path)


def latest_observations(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Streaming form of deduplicate: minimum, maximum, count and latest row don't depend on arrival order, so late rows need no watermark.

    State is one row per key, as large as the result.
    """
    return deduplicate(stream, key, order)


#: Parts of a streamed table, by hash of the key; a batch rewrites the parts that its keys fall on.
BUCKETS = 64


def run_to_table(df: DataFrame, path: str, checkpoint: str, key: str = "job_key") -> StreamingQuery:
    """Run what is there to the end; each batch puts its keys' new rows in the place of the old ones, in the parts they belong to.

    A row of the batch is the whole state of its key, so a batch that is repeated after a failure changes nothing.
    """
    def publish(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = cut(batch.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")))
        parts = [r[0] for r in new.select("_part").distinct().collect()]  # at most BUCKETS
        if parts and exists(spark, path):
            old = spark.read.parquet(path).where(F.col("_part").isin(parts))
            new = cut(new.unionByName(old.join(new.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)

    return df.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_streamed(spark: SparkSession, path: str) -> DataFrame:
    """The table that run_to_table keeps."""
    return spark.read.parquet(path).drop("_part")


def store_stream(spark: SparkSession, sites: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Collected sites (rows of career_site) as a stream into the raw store; a batch that is repeated after a failure adds nothing twice."""
    return sites.writeStream.foreachBatch(lambda batch, _: store_snapshots(spark, batch, root) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_sightings(stream: DataFrame, time: str = "last_seen_at", delay: str = "7 days") -> DataFrame:
    """(day, n) of sightings per day of event time; rows later than the delay are left out once their day is closed."""
    return stream.where(F.col(time).isNotNull()).withWatermark(time, delay).groupBy(F.window(time, "1 day")["start"].alias("day")).agg(F.count("*").alias("n"))
