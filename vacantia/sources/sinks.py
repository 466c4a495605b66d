"""Sinks: tables, reports and the content-addressed raw store."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions.text import file_stamp
from vacantia.session import cut


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet with zstd; Spark's commit protocol publishes all files or none."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays are joined by " | "."""
    flat = [F.array_join(c, " | ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def report_json(counts: DataFrame, labels: DataFrame | None = None, warnings: DataFrame | None = None, limit: int = 100_000) -> dict:
    """A report document of tidy metrics: {metric: value} and {metric: {label: n}}; at most ``limit`` counts and labels, else an error."""
    values = counts.limit(limit + 1).collect()
    if len(values) > limit:
        raise ValueError(f"more than {limit} counts")
    out: dict = {r.metric: int(r.value) if r.value is not None and float(r.value).is_integer() else r.value for r in values}
    if labels is not None:
        rows = labels.orderBy("metric", "label").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} labels")
        for r in rows:
            out.setdefault(r.metric, {})[r.label] = r.n
    if warnings is not None:
        out["warnings"] = [r.warning for r in warnings.collect()]
    return out


def write_json(path: str, payload: dict) -> None:
    """Indented JSON, written beside its place and moved there, so that readers see the old file or the new one."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False, encoding="utf-8") as f:
        f.write(json.dumps(payload, indent=2, ensure_ascii=False, default=str) + "\n")
    os.replace(f.name, path)


def write_lines(path: str, lines: Iterable[str]) -> None:
    """Text written line by line beside its place and moved there."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False, encoding="utf-8") as f:
        f.writelines(lines)
    os.replace(f.name, path)


#: Of each site of a run: what came of it.
RESULT = "source_provider string, source_name string, source_token string, status string, job_count long, raw_path string, metadata_path string, error string"


def store_snapshots(spark: SparkSession, sites: DataFrame, root: str) -> DataFrame:
    """Write a run's payloads (rows of career_site) to the raw store; one result (RESULT) per site.

    <root>/<provider>/<token>/ has each payload once, named by its digest, and a sidecar for every observation, named by its
    time. Status: written; duplicate where the payload was there before; failed where the site failed, or has a sidecar of
    the same time with another digest, which is never overwritten. The same run again adds nothing. Tasks write their own
    sites, each file beside its place and then moved; what was stored before isn't read, whatever its size.
    """
    ddl = RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["provider"], r["name"], r["token"], *_store(root, r)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in ddl.split(", ")], r)) for r in rows], schema=_RESULT_ARROW)

    return cut(sites.mapInArrow(run, ddl))


_RESULT_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in RESULT.split(", ")])


def _store(root: str, r: dict) -> tuple:
    """(status, job_count, raw_path, metadata_path, error) of one site."""
    if r["error"] is not None:
        return "failed", 0, None, None, r["error"]
    try:
        fs, base = pa.fs.FileSystem.from_uri(root) if "://" in root else (pa.fs.LocalFileSystem(), root)
        folder = f"{base}/{r['provider']}/{r['token']}"
        fs.create_dir(folder, recursive=True)
        raw, meta = f"{r['content_sha256']}.json", f"{folder}/{file_stamp(r['collected_at'])}.metadata.json"
        there = lambda path: fs.get_file_info(path).type != pa.fs.FileType.NotFound
        known = there(f"{folder}/{raw}")
        if there(meta):
            with fs.open_input_stream(meta) as f:
                have = json.loads(f.read())
            if have.get("content_sha256") != r["content_sha256"]:
                return "failed", 0, None, None, f"another payload of this time is stored: {meta}"
            return "duplicate", r["source_job_count"], f"{folder}/{have['raw_file']}", meta, None
        if not known:
            _put(fs, f"{folder}/{raw}", r["payload"])
        at = r["collected_at"] if r["collected_at"].tzinfo else r["collected_at"].replace(tzinfo=UTC)
        value = {
            "source": r["provider"], "source_name": r["name"], "source_token": r["token"], "endpoint": r["endpoint"], "collected_at": at.astimezone(UTC).isoformat(), "http_status": r["http_status"],
            "content_type": r["content_type"], "content_sha256": r["content_sha256"], "byte_count": r["byte_count"], "source_job_count": r["source_job_count"], "raw_file": raw,
            "employer_id": r["employer_id"], "listing_page_count": r["listing_page_count"], "detail_page_count": r["detail_page_count"],
        }
        _put(fs, meta, (json.dumps({k: v for k, v in value.items() if v is not None}, indent=2, ensure_ascii=False) + "\n").encode())
        return "duplicate" if known else "written", r["source_job_count"], f"{folder}/{raw}", meta, None
    except OSError as e:
        return "failed", 0, None, None, f"{type(e).__name__}: {e}"


def _put(fs: pa.fs.FileSystem, path: str, data: bytes) -> None:
    aside = f"{path}.{os.getpid()}.part"
    with fs.open_output_stream(aside) as f:
        f.write(data)
    fs.move(aside, path)


def run_document(results: DataFrame, collected_at: datetime) -> dict:
    """The report of a run: sources that came and failed, jobs in all and by provider, every source's result."""
    rows = [r.asDict() for r in results.orderBy("source_provider", "source_token").toLocalIterator()]
    providers = sorted({r["source_provider"] for r in rows})
    return {
        "collected_at": collected_at.astimezone(UTC).isoformat(), "successful_sources": sum(r["status"] != "failed" for r in rows), "failed_sources": sum(r["status"] == "failed" for r in rows),
        "total_source_jobs": sum(r["job_count"] for r in rows), "provider_job_counts": {p: sum(r["job_count"] for r in rows if r["source_provider"] == p) for p in providers}, "results": rows,
    }


def read_report(path: str, required: Iterable[str]) -> dict:
    """A report document; ValueError if it isn't there, is no JSON object or lacks one of the keys."""
    try:
        with open(path, encoding="utf-8") as f:
            out = json.load(f)
    except (OSError, ValueError) as e:
        raise ValueError(f"no report: {path}") from e
    if missing := sorted(set(required) - set(out if isinstance(out, dict) else ())):
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return out


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header as the columns of ``schema``; an empty table where there is none, broken rows are dropped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
