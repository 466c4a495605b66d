"""Session and table helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vacantia", master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """A UTC session with adaptive execution, for tests and local runs."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever they run and whatever their working folder is."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vacantia-"), "vacantia.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)  # the driver serves it to the executors
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a costly per-row stage as many partitions as the session has task slots.

    Large inputs already have more partitions than that and stay untouched; only small tables in few files are shuffled.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, named by the cluster in spark.checkpoint.dir.

    Where it is unset, one machine's temporary folder serves a session on that machine only; a cluster's session is refused.
    """
    sc = spark.sparkContext
    if own := sc.getConf().get("spark.checkpoint.dir"):
        return own
    if not sc.master.startswith(("local[", "local-cluster[")) and sc.master != "local":
        raise ValueError("spark.checkpoint.dir isn't set: a cluster needs a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"vacantia-{sc.applicationId}")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder; a folder is set only where the session has none."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
