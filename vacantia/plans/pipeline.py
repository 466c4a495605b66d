"""The batch stages from raw snapshots to marts, each one lazy plan with its checks before it publishes."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions.html import html_detail_fields, html_posting_json
from vacantia.functions.text import file_stamp
from vacantia.operators import audit, canonical, marts
from vacantia.sources import career_site, registry, sinks, snapshots
from vacantia.session import cut


#: Version of the marts' columns.
MART_VERSION = 1


class BuildError(Exception):
    """An input breaks a rule; the message names the first few cases."""


def refuse(violations: DataFrame, what: str) -> None:
    """BuildError with up to five of the violations, if there are any."""
    if rows := violations.limit(5).collect():
        raise BuildError(f"{what}: " + "; ".join(", ".join(map(str, r)) for r in rows))


def observations(spark: SparkSession, sidecars: DataFrame, raw: str, providers: Sequence[str]) -> DataFrame:
    """Canonical observations of the verified payloads of some providers; each provider's folder is read for its own branch only."""
    out = None
    for p in providers:
        payloads = snapshots.read_payloads(spark, sidecars.where(F.col("provider") == p), raw, [p])
        if p in ("greenhouse", "lever"):
            mapped = canonical.from_board(snapshots.board_jobs(payloads)) if p == "greenhouse" else canonical.from_postings(snapshots.posting_jobs(payloads))
        else:
            pages = snapshots.bundle_pages(payloads)
            html = pages.withColumnRenamed("body", "html")
            if p == "successfactors":
                index = F.struct(*[F.col("index")[c].alias(c) for c in ("source_job_id", "title", "location_raw", "published_text")])
                mapped = canonical.from_html_details(html.withColumn("index", index), html_detail_fields("html"))
            elif p == "wp_job_manager":
                mapped = canonical.from_posting_json(html, html_posting_json("html"))
            else:
                mapped = canonical.from_json_details(snapshots.json_details(pages, p), p)
        out = mapped if out is None else out.unionByName(mapped)
    return canonical.canonical_observations(out)


def collect(spark: SparkSession, raw: str, employers: str, sources: str, tokens: list[str] | None = None, timeout: float = 30.0, at: datetime | None = None) -> dict:
    """Read all configured sites, or those of some tokens, into the raw store; the run's report, also written to <raw>/_runs.

    BuildError or ValueError if the configuration breaks a rule; a site's failure is part of the report.
    """
    e, s = registry.read_employers(spark, employers), registry.read_sources(spark, sources, tokens=tokens)
    refuse(registry.employer_violations(e), "registry")
    refuse(registry.source_violations(s, e), "sources")
    now = at or datetime.now(UTC)
    spark.dataSource.register(career_site.CareerSiteSource)
    sites = json.dumps([{k: v for k, v in r.asDict().items() if v is not None} for r in s.orderBy("provider", "token").collect()])
    read = spark.read.format("career_site").option("sites", sites).option("timeout", str(timeout)).option("collected_at", now.isoformat()).load()
    report = sinks.run_document(sinks.store_snapshots(spark, read, raw), now)
    sinks.write_json(f"{raw.removeprefix('file://')}/_runs/{file_stamp(now)}.json", report)
    return report


def build_jobs(spark: SparkSession, raw: str, employers: str, sources: str, out: str) -> DataFrame:
    """Snapshots under ``raw`` to <out>/jobs.parquet and quality-report.json; BuildError if an input breaks a rule."""
    e, s = registry.read_employers(spark, employers), registry.read_sources(spark, sources)
    refuse(registry.employer_violations(e), "registry")
    refuse(registry.source_violations(s, e), "sources")
    sidecars = cut(snapshots.read_sidecars(spark, raw))
    refuse(snapshots.sidecar_violations(sidecars), "sidecars")
    refuse(registry.employer_disagreements(sidecars, s), "employers of snapshots")
    refuse(snapshots.payload_violations(snapshots.read_payloads(spark, sidecars, raw)), "payloads")
    providers = sorted(r.provider for r in sidecars.select("provider").distinct().collect())  # one of six each, see sidecar_violations
    seen = registry.with_employers(observations(spark, sidecars, raw, providers), s, e)
    jobs = canonical.deduplicate(seen, "job_key", ["last_seen_at", "source_updated_at", "source_snapshot_path"], issues="data_quality_issues")
    sinks.write_table(jobs, f"{out}/jobs.parquet")
    jobs = spark.read.parquet(f"{out}/jobs.parquet")
    sinks.write_json(f"{out}/quality-report.json", canonical.snapshot_window(sidecars) | {"target_market_definition": "south_africa_technology_roles"} | sinks.report_json(*canonical.transform_report(jobs, sidecars)))
    return jobs


def build_skills(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """<out>/jobs.parquet to job_skills, job_requirements, skills_summary, company_skills and skills-quality-report.json."""
    jobs = marts.enriched_jobs(spark.read.parquet(f"{out}/jobs.parquet"))
    sinks.write_table(marts.job_skills(jobs), f"{out}/job_skills.parquet")
    sinks.write_table(marts.job_requirements(jobs), f"{out}/job_requirements.parquet")
    skills, needs = spark.read.parquet(f"{out}/job_skills.parquet"), spark.read.parquet(f"{out}/job_requirements.parquet")
    sinks.write_table(marts.skills_summary(skills, needs), f"{out}/skills_summary.parquet")
    sinks.write_table(marts.company_skills(skills), f"{out}/company_skills.parquet")
    summary = spark.read.parquet(f"{out}/skills_summary.parquet")
    top = {name: [{"skill": r.technology, "job_count": r.job_count} for r in marts.top_technologies(summary, column).collect()] for name, column in (("top_target_market_skills", "target_market_job_count"), ("top_early_career_target_skills", "early_career_target_job_count"))}
    report = sinks.report_json(marts.skills_report(jobs), marts.skills_labels(skills, needs)) | {"unique_skill_count": summary.count()} | top
    sinks.write_json(f"{out}/skills-quality-report.json", report)
    return skills, needs


def build_marts(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """The tables of the stages before to dashboard_jobs, dashboard_skills and dashboard-quality-report.json."""
    jobs, skills, needs = (spark.read.parquet(f"{out}/{n}.parquet") for n in ("jobs", "job_skills", "job_requirements"))
    for df, kind in ((jobs, "jobs"), (skills, "skills"), (needs, "requirements")):
        marts.require_columns(df, kind)
    refuse(marts.violations(jobs, skills, needs), "inputs of the marts")
    sinks.write_table(marts.dashboard_jobs(jobs, skills, needs), f"{out}/dashboard_jobs.parquet")
    sinks.write_table(marts.dashboard_skills(jobs, skills), f"{out}/dashboard_skills.parquet")
    a, b = spark.read.parquet(f"{out}/dashboard_jobs.parquet"), spark.read.parquet(f"{out}/dashboard_skills.parquet")
    own = {"schema_version": MART_VERSION, "dashboard_skill_row_count": b.count()} | marts.mart_window(a)
    sinks.write_json(f"{out}/dashboard-quality-report.json", own | sinks.report_json(marts.mart_counts(a), marts.mart_labels(a, b), marts.mart_warnings(a)))
    return read_marts(spark, out)[:2]


def read_marts(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame, dict]:
    """Both marts and their report; ValueError if one isn't there or the report lacks a key."""
    report = sinks.read_report(f"{out}/dashboard-quality-report.json", ["schema_version", "dashboard_job_count", "dashboard_skill_row_count", "warnings"])
    if missing := [n for n in ("dashboard_jobs", "dashboard_skills") if not sinks.exists(spark, f"{out}/{n}.parquet")]:
        raise ValueError(f"no {', '.join(missing)} in {out}")
    return spark.read.parquet(f"{out}/dashboard_jobs.parquet"), spark.read.parquet(f"{out}/dashboard_skills.parquet"), report


def build_audits(spark: SparkSession, out: str) -> None:
    """<out>/jobs.parquet to the two review lists as CSV, the first as a Markdown table too."""
    jobs = spark.read.parquet(f"{out}/jobs.parquet")
    sinks.write_csv(audit.unspecified_roles(jobs), f"{out}/unspecified-role-audit.csv")
    sinks.write_lines(f"{out}/unspecified-role-audit.md", audit.review_document(audit.unspecified_roles(jobs)))
    sinks.write_csv(audit.role_audit(jobs), f"{out}/role-classification-audit.csv")
