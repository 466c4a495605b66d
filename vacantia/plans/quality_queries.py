"""Queries of the core data-quality operators: snapshot changes and instants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.operators.instants import read_instants
from vacantia.operators.snapshots import snapshot_changes
from vacantia.session import table

COMPARED = ["title", "department", "location_raw", "workplace_type", "role_level", "job_text_sha256", "application_url"]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "job_snapshots"), "job_key", "snapshot_no", "delivered_at", COMPARED)


def p6_summary(spark: SparkSession, d: str) -> DataFrame:
    return p6_found(spark, d).groupBy("snapshot_no", "change_kind").agg(F.count("*").alias("n_keys"))


def p7_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the three fields with its instant and status."""
    rows = None
    for name, column, key in (("greenhouse_jobs_m2", "updated_at", "id"), ("job_observations", "source_updated_at", "obs_id"), ("snapshot_metadata", "collected_at", "meta_id")):
        own = table(spark, d, name).select(F.lit(name).alias("src_table"), F.lit(column).alias("src_field"), F.col(key).cast("string").alias("record_key"), "source_token", F.col(column).alias("value"))
        rows = own if rows is None else rows.unionByName(own)
    zones = table(spark, d, "sources").where("token is not null").select(F.col("token").alias("source_token"), "tz_name").dropDuplicates(["source_token"])
    return read_instants(rows.join(zones, "source_token", "left"), "value", "tz_name", ["src_table", "source_token"])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_values(spark, d).where("time_status = 'ok'").select("src_table", "src_field", "record_key", "epoch_us")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return p7_values(spark, d).groupBy("src_table", "src_field", "time_status").agg(F.count("*").alias("n_values"))


QUERIES = {f.__name__: f for f in (p6_found, p6_summary, p7_found, p7_report)}

_CHANGES = """
v AS (SELECT snapshot_no AS n, job_key AS k, sha256(concat_ws('|', {parts})) AS h,
             row_number() OVER (PARTITION BY snapshot_no, job_key ORDER BY delivered_at DESC) AS r FROM job_snapshots WHERE job_key IS NOT NULL AND snapshot_no IS NOT NULL),
c AS (SELECT n, k, h FROM v WHERE r = 1),
x AS (SELECT coalesce(b.n, a.n + 1) AS snapshot_no, coalesce(b.k, a.k) AS job_key,
             CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.h <> b.h THEN 'changed' END AS change_kind
      FROM c a FULL JOIN c b ON a.k = b.k AND a.n + 1 = b.n),
found AS (SELECT * FROM x WHERE change_kind IS NOT NULL AND snapshot_no > (SELECT min(n) FROM c) AND snapshot_no <= (SELECT max(n) FROM c))
""".format(parts=", ".join(f"coalesce('=' || {c}, '-')" for c in COMPARED))
ORACLES = {
    "p6_found": f"WITH {_CHANGES} SELECT snapshot_no, job_key, change_kind FROM found",
    "p6_summary": f"WITH {_CHANGES} SELECT snapshot_no, change_kind, count(*) AS n_keys FROM found GROUP BY 1, 2",
}
