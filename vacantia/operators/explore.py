"""Filters, rankings and figures of the interactive layer, all as plans over the marts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import blank_to_null, clean

#: Columns that top_values and filter_options accept.
DIMENSIONS = ("employer_name", "employer_group", "industry", "province", "city", "workplace_type", "effective_role_level", "technology", "technology_category", "capability")


def chosen(values: Iterable[str]) -> tuple[str, ...]:
    """Stripped, non-blank choices, each once, in order."""
    return tuple(dict.fromkeys(v.strip() for v in values if v and v.strip()))


@dataclass(frozen=True)
class Filters:
    employers: tuple[str, ...] = ()
    industries: tuple[str, ...] = ()
    provinces: tuple[str, ...] = ()
    workplace_types: tuple[str, ...] = ()
    role_levels: tuple[str, ...] = ()
    target_only: bool = True
    early_only: bool = False
    exclude_pools: bool = True
    search: str = ""

    def condition(self, with_technology: bool = False) -> Column:
        """AND of the chosen values (null is in no list), the toggles (null is neither) and the search.

        The search term is lower-cased; % and _ are wildcards, a backslash is itself.
        """
        out = F.lit(True)
        for column, values in (("employer_name", self.employers), ("industry", self.industries), ("province", self.provinces), ("workplace_type", self.workplace_types), ("effective_role_level", self.role_levels)):
            if own := chosen(values):
                out &= F.col(column).isin(list(own))
        if self.target_only:
            out &= F.col("is_target_market")
        if self.early_only:
            out &= F.col("is_early_career_target")
        if self.exclude_pools:
            out &= ~F.col("is_talent_pool")
        if term := self.search.strip().lower().replace("\\", "\\\\"):
            fields = ["title", "employer_name"] + ["technology"] * with_technology
            hit = F.lit(False)
            for c in fields:
                hit |= F.lower(F.coalesce(F.col(c), F.lit(""))).like(f"%{term}%")
            out &= hit
        return out


def filtered_jobs(jobs: DataFrame, filters: Filters) -> DataFrame:
    """Filtered jobs, latest first (null last), then employer and title."""
    return jobs.where(filters.condition()).orderBy(F.desc_nulls_last("last_seen_at"), F.asc_nulls_last("employer_name"), F.asc_nulls_last("title"))


def filtered_skills(skills: DataFrame, filters: Filters) -> DataFrame:
    return skills.where(filters.condition(True)).orderBy(*[F.asc_nulls_last(c) for c in ("technology", "employer_name", "title")])


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct values to choose from, sorted; blank ones and those that stand for nothing are left out (role levels keep unspecified)."""
    _check(column)
    kept = ["unknown", "none"] + ["unspecified"] * (column != "effective_role_level")
    c = F.col(column)
    return df.where(c.isNotNull() & (F.trim(c) != "") & ~F.lower(F.trim(c)).isin(kept)).select(c.alias("value")).distinct().orderBy("value")


def _check(column: str) -> None:
    if column not in DIMENSIONS:
        raise ValueError(f"unknown dimension {column}")


def top_values(df: DataFrame, column: str, limit: int, condition: Column | None = None) -> DataFrame:
    """(label, value): most frequent non-blank values, ties by label; a top-k, not a full sort."""
    _check(column)
    if limit < 1:
        raise ValueError("limit must be at least 1")
    rows = df if condition is None else df.where(condition)
    return rows.where(F.col(column).isNotNull() & (F.trim(column) != "")).groupBy(F.col(column).alias("label")).agg(F.count("*").alias("value")).orderBy(F.desc("value"), "label").limit(limit)


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """(label, value) with null and blank as Unspecified; ties by label."""
    return df.groupBy(F.coalesce(blank_to_null(F.col(column)), F.lit("Unspecified")).alias("label")).agg(F.count("*").alias("value")).orderBy(F.desc("value"), "label").limit(n)


def key_figures(jobs: DataFrame) -> DataFrame:
    flexible = F.col("workplace_type").isin("remote", "hybrid").cast("double")
    return jobs.agg(F.count("*").alias("jobs"), F.count_distinct("employer_name").alias("employers"), F.count_distinct("province").alias("provinces"), F.count_if("is_early_career_target").alias("early_career"), F.avg(flexible).alias("flexible_share"))


def monthly_activity(jobs: DataFrame) -> DataFrame:
    """(month, vacancies): distinct jobs by the month they were last seen; jobs without time are left out."""
    return jobs.where("last_seen_at is not null").groupBy(F.date_format("last_seen_at", "yyyy-MM").alias("month")).agg(F.count_distinct("job_key").alias("vacancies"))


def employer_comparison(jobs: DataFrame) -> DataFrame:
    """Per employer and industry (null groups stay): vacancies, early-career vacancies, provinces, skill mentions."""
    return jobs.groupBy("employer_name", "industry").agg(F.count_distinct("job_key").alias("vacancies"), F.count_if("is_early_career_target").alias("early_career"), F.count_distinct("province").alias("provinces"), F.sum("skill_count").alias("skill_mentions")).orderBy(F.desc("vacancies"), F.asc_nulls_last("employer_name"))


def level_by_technology(skills: DataFrame, n: int = 12) -> DataFrame:
    """(effective_role_level, technology, value) for the n most frequent technologies, zeros filled in.

    The n names come to the driver; one pass then counts all of them per level.
    """
    top = [r.label for r in top_values(skills, "technology", n).collect()]
    counts = F.array(*[F.struct(F.lit(t).alias("technology"), F.count_if(F.col("technology") == t).alias("value")) for t in top]) if top else F.array().cast("array<struct<technology:string,value:bigint>>")
    rows = skills.where(F.col("technology").isin(top)).groupBy("effective_role_level").agg(counts.alias("c"))
    return rows.select("effective_role_level", F.explode("c").alias("c")).select("effective_role_level", "c.technology", "c.value")


def crosstab(skills: DataFrame, technologies: list[str]) -> DataFrame:
    """One row per level with a count column for each of the given technologies."""
    return skills.where(F.col("technology").isin(technologies)).groupBy("effective_role_level").pivot("technology", technologies).count().fillna(0)


def early_career_figures(jobs: DataFrame) -> DataFrame:
    rows = jobs.where("is_early_career_target")
    return rows.agg(F.count("*").alias("vacancies"), F.count_distinct("employer_name").alias("employers"), F.count_if(F.lower(F.col("graduate_programme")) == "yes").alias("with_programme"), F.avg(F.col("degree_required").cast("double")).alias("degree_share"))


def opportunities(jobs: DataFrame, filters: Filters) -> DataFrame:
    shown = F.array_join(F.filter("skills", lambda x: clean(x) != ""), ", ")
    return jobs.where(filters.condition()).select(
        F.col("title").alias("role"), F.col("employer_name").alias("employer"), "industry", F.col("location_label").alias("location"), F.col("workplace_type").alias("workplace"),
        F.col("effective_role_level").alias("level"), shown.alias("technologies"), F.date_format("last_seen_at", "dd MMM yyyy").alias("last_seen"), F.col("application_url").alias("apply"),
    )
