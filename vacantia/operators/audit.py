"""Review lists of roles without a level and of the scored inference."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.operators.classify import audit_bucket


def unspecified_roles(jobs: DataFrame) -> DataFrame:
    """Target-market jobs without a level, with their review bucket; ordered by bucket, company and title (null as None)."""
    rows = audit_bucket(jobs.where("is_target_market and role_level = 'unspecified'"), "title", "description_text")
    none = lambda c: F.coalesce(F.col(c), F.lit("None"))
    out = rows.select("job_key", "likely_level", F.array_join("audit_evidence", " | ").alias("evidence"), "minimum_years", "maximum_years", "company", "title", "city", "province", "workplace_type", "department", "application_url", "first_seen_at", "last_seen_at", "source_provider")
    return out.orderBy("likely_level", none("company"), none("title"), "job_key")


def role_audit(jobs: DataFrame) -> DataFrame:
    """The scored inference beside the conservative level, for target-market jobs."""
    return jobs.where("is_target_market").select("company", "title", "role_level", "inferred_role_level", "role_level_confidence", "role_level_score", F.array_join("role_level_score_evidence", " | ").alias("evidence"), "is_talent_pool", "application_url").orderBy("company", "title")


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def markdown_lines(df: DataFrame) -> Iterator[str]:
    """Lines of a report table of all rows, in their order, one partition at a time; pipes are escaped and line ends flattened."""
    cell = lambda v: str("" if v is None else v).replace("|", "\\|").replace("\n", " ")
    yield "| " + " | ".join(df.columns) + " |\n"
    yield "|" + "---|" * len(df.columns) + "\n"
    for r in df.toLocalIterator():
        yield "| " + " | ".join(map(cell, r)) + " |\n"


def markdown_table(df: DataFrame) -> str:
    return "".join(markdown_lines(df))


def review_document(rows: DataFrame) -> Iterator[str]:
    """Lines of the review of roles without a level (unspecified_roles): how many, by level, by employer, then every role."""
    yield f"# Roles without a level\n\nBuckets for review; they change no classification.\n\nRoles: {rows.count()}\n\n## Likely levels\n\n"
    yield from markdown_lines(distribution(rows, "likely_level").orderBy("label").withColumnsRenamed({"label": "Likely level", "n": "Count"}))
    yield "\n## Employers\n\n"
    yield from markdown_lines(distribution(rows, "company").withColumnsRenamed({"label": "Company", "n": "Count"}))
    yield "\n## Roles\n\n"
    shown = F.coalesce(F.nullif("evidence", F.lit("")), F.lit("No explicit evidence"))
    yield from markdown_lines(rows.select(F.col("likely_level").alias("Likely level"), F.col("company").alias("Company"), F.col("title").alias("Title"), shown.alias("Evidence")))
