"""Skills and requirements of postings, their summaries, the two dashboard marts with their checks and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions.text import blank_to_null, clean, iso_text, job_text_sha256, label, strings
from vacantia.operators.canonical import label_counts, tidy
from vacantia.operators.skills import dimensions, enrich

_CARRIED = ["job_key", "job_text_sha256", "company", "employer_id", "employer_name", "parent_company", "industry", "title", "city", "province", "workplace_type", "role_level", "inferred_role_level", "is_target_market", "is_early_career_target"]
#: Columns of enriched jobs that the next tables need.
ENRICHED = [*_CARRIED, "skills", "degree_required", "degree_fields", "minimum_experience_years", "maximum_experience_years", "soft_skills", "extraction_warnings", "application_url"]
REQUIRED = {
    "jobs": ["job_key", "title", "employer_id", "employer_name", "description_text", "is_target_market", "role_level", "inferred_role_level"],
    "skills": ["job_key", "job_text_sha256", "skill", "category"],
    "requirements": ["job_key", "job_text_sha256", "degree_required", "degree_fields", "minimum_experience_years", "maximum_experience_years", "soft_skills", "extraction_warnings"],
}


def enriched_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs with the digest of their text, enrichment, and cleaned employer columns."""
    early = F.coalesce("is_target_market", F.lit(False)) & (F.coalesce("is_early_career", F.lit(False)) | F.coalesce(F.col("inferred_role_level").isin(R.EARLY_LEVELS), F.lit(False)))
    out = enrich(jobs, "title", "description_text")
    return out.withColumns(
        {
            "job_text_sha256": job_text_sha256(F.col("title"), F.col("description_text")),
            "employer_id": clean(F.col("employer_id")),
            "employer_name": clean(F.coalesce(F.nullif("employer_name", F.lit("")), F.col("company"))),
            "industry": F.coalesce(F.nullif("industry", F.lit("")), F.lit("unspecified")),
            "inferred_role_level": F.coalesce("inferred_role_level", F.lit("")),
            "is_target_market": F.coalesce("is_target_market", F.lit(False)),
            "is_early_career_target": early,
        }
    )


def job_skills(enriched: DataFrame) -> DataFrame:
    """One row per job and technology, with evidence and dimensions."""
    # explode would infer a filter on the size of the array and push the whole extraction into it, once more per row.
    rows = enriched.select(*_CARRIED, "application_url", F.explode_outer("skills").alias("s")).where("s is not null")
    kind, capability = dimensions(F.col("s.skill"), F.col("s.category"))
    return rows.select(*_CARRIED, F.col("s.skill").alias("skill"), F.col("s.category").alias("category"), F.col("s.skill").alias("technology"), kind.alias("technology_category"), capability.alias("capability"), F.col("s.evidence").alias("evidence"), "application_url")


def job_requirements(enriched: DataFrame) -> DataFrame:
    return enriched.select(*_CARRIED, "degree_required", "degree_fields", "minimum_experience_years", "maximum_experience_years", "soft_skills", "extraction_warnings", "application_url")


def skills_summary(skills: DataFrame, jobs: DataFrame) -> DataFrame:
    """Per technology: jobs, target-market and early-career jobs, and the share of target-market jobs (0 without any)."""
    total = jobs.agg(F.count_if("is_target_market").alias("n")).first().n
    by = skills.groupBy("skill", "category", "technology", "technology_category", "capability").agg(
        F.count("*").alias("all_job_count"), F.count_if("is_target_market").alias("target_market_job_count"), F.count_if("is_early_career_target").alias("early_career_target_job_count")
    )
    return by.withColumn("target_market_share", F.col("target_market_job_count") / F.lit(total) if total else F.lit(0.0))


def company_skills(skills: DataFrame) -> DataFrame:
    return skills.groupBy("employer_id", "employer_name", "technology").agg(F.count("*").alias("job_count")).select("employer_id", "employer_name", F.col("employer_name").alias("company"), "technology", F.col("technology").alias("skill"), "job_count")


def top_technologies(summary: DataFrame, count: str, n: int = 25) -> DataFrame:
    """The n technologies of most jobs by a count column, ties by name."""
    return summary.where(F.col(count) > 0).orderBy(F.desc(count), "technology").limit(n).select("technology", F.col(count).alias("job_count"))


def skills_report(enriched: DataFrame) -> DataFrame:
    """(metric, value): counts and coverage of the enrichment stage."""
    has, target = F.size("skills") > 0, F.col("is_target_market")
    return tidy(enriched, {
        "canonical_job_count": F.count("*"), "target_market_job_count": F.count_if(target), "early_career_target_job_count": F.count_if("is_early_career_target"),
        "job_skill_row_count": F.sum(F.size("skills")), "jobs_with_skills_count": F.count_if(has), "target_jobs_with_skills_count": F.count_if(has & target),
        "target_skill_coverage_rate": F.coalesce(F.count_if(has & target) / F.nullif(F.count_if(target), F.lit(0)), F.lit(0.0)),
        "degree_required_target_job_count": F.count_if(target & F.col("degree_required")),
        "target_jobs_with_experience_requirement_count": F.count_if(target & F.col("minimum_experience_years").isNotNull()),
    })


def skills_labels(skills: DataFrame, requirements: DataFrame) -> DataFrame:
    """(metric, label, n): mentions by technology category, capability and category, and extraction warnings."""
    mentions = label_counts(skills, {"technology_category_mention_counts": F.col("technology_category"), "capability_mention_counts": F.col("capability"), "category_mention_counts": F.col("category")})
    warnings = requirements.select(F.explode("extraction_warnings").alias("label")).groupBy(F.lit("extraction_warning_counts").alias("metric"), "label").agg(F.count("*").alias("n"))
    return mentions.unionByName(warnings)


def missing_figures(counts: DataFrame) -> DataFrame:
    """(field, value): missing values of mart_counts, most first, ties by name."""
    return counts.where("metric like 'missing@_%' escape '@'").select(F.expr("substring(metric, 9)").alias("field"), F.col("value").cast("long").alias("value")).orderBy(F.desc("value"), "field")


def unknown(c: Column) -> Column:
    return F.coalesce(F.lower(clean(c)).isin(R.UNKNOWN), F.lit(True))


def effective_level(inferred: Column, conservative: Column) -> Column:
    """The inferred level unless it says nothing, else the conservative one unless it does, else unspecified."""
    low = lambda c: F.lower(clean(c))
    return F.when(~unknown(inferred), low(inferred)).when(~unknown(conservative), low(conservative)).otherwise("unspecified")


def location_label(city: Column, province: Column, country: Column) -> Column:
    c, p, n = blank_to_null(city), blank_to_null(province), blank_to_null(country)
    return F.when(c.isNotNull() & p.isNotNull() & (F.lower(c) != F.lower(p)), F.concat_ws(", ", c, p)).otherwise(F.coalesce(c, p, n, F.lit("Unspecified")))


def _common(jobs: DataFrame) -> DataFrame:
    true = lambda c: F.coalesce(F.col(c), F.lit(False))
    level = effective_level(F.col("inferred_role_level"), F.col("role_level"))
    group = F.coalesce(*[blank_to_null(F.col(c)) for c in ("parent_company", "employer_name", "company")], F.lit("Unspecified"))
    out = jobs.withColumns({"effective_role_level": level, "employer_group": group, "is_target_market": true("is_target_market"), "is_early_career": true("is_early_career"), "is_talent_pool": true("is_talent_pool")})
    return out.withColumn("is_early_career_target", F.col("is_target_market") & (F.col("is_early_career") | F.col("effective_role_level").isin(R.EARLY_LEVELS)))


def dashboard_jobs(jobs: DataFrame, skills: DataFrame, requirements: DataFrame) -> DataFrame:
    """The jobs mart: one row per job, its technologies nested. Skills are aggregated by job before the join."""
    sets = skills.groupBy("job_key").agg(*[strings(F.collect_set(c)).alias(n) for n, c in (("skills", "technology"), ("technology_categories", "technology_category"), ("capabilities", "capability"))])
    need = requirements.select("job_key", "degree_required", "degree_fields", "minimum_experience_years", "maximum_experience_years", "soft_skills", "extraction_warnings")
    rows = _common(jobs).join(need, "job_key").join(sets, "job_key", "left")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    labels = ["source_provider", "source_name", "source_job_id", "title", "title_normalized", "industry", "employer_priority", "graduate_programme", "workplace_type"]
    return rows.select(
        clean(F.col("job_key")).alias("job_key"), *[label(F.col(c)).alias(c) for c in labels], "first_seen_at", "last_seen_at", "source_updated_at",
        F.when(F.coalesce("observation_count", F.lit(0)) == 0, 1).otherwise(F.col("observation_count")).alias("observation_count"),
        *[clean(F.col(c)).alias(c) for c in ("employer_id", "employer_name", "application_url")], "employer_group",
        *[blank_to_null(F.col(c)).alias(c) for c in ("city", "province", "country")],
        location_label(F.col("city"), F.col("province"), F.col("country")).alias("location_label"), "effective_role_level",
        label(F.col("role_level_confidence"), "low").alias("role_level_confidence"), "is_target_market", "is_early_career", "is_early_career_target", "is_talent_pool",
        F.size(empty("skills")).cast("long").alias("skill_count"), empty("skills").alias("skills"), empty("technology_categories").alias("technology_categories"), empty("capabilities").alias("capabilities"),
        F.coalesce("degree_required", F.lit(False)).alias("degree_required"), strings(F.col("degree_fields")).alias("degree_fields"), "minimum_experience_years", "maximum_experience_years",
        strings(F.col("soft_skills")).alias("soft_skills"), F.size(strings(F.col("data_quality_issues"))).cast("long").alias("data_quality_issue_count"),
        strings(F.col("data_quality_issues")).alias("data_quality_issues"), strings(F.col("extraction_warnings")).alias("extraction_warnings"),
    )


def dashboard_skills(jobs: DataFrame, skills: DataFrame) -> DataFrame:
    """The skills mart: one row per job and technology; missing technology, category and capability are filled in."""
    kind, capability = dimensions(clean(F.col("skill")), clean(F.col("category")))
    own = skills.select("job_key", label(F.col("technology"), "").alias("_t"), clean(F.col("skill")).alias("_s"), F.coalesce(blank_to_null(F.col("technology_category")), kind).alias("technology_category"), F.coalesce(blank_to_null(F.col("capability")), capability).alias("capability"), "evidence")
    rows = _common(jobs).join(own, "job_key")
    return rows.select(
        clean(F.col("job_key")).alias("job_key"), *[label(F.col(c)).alias(c) for c in ("title", "industry", "workplace_type")], *[clean(F.col(c)).alias(c) for c in ("employer_id", "employer_name", "application_url")],
        "employer_group", *[blank_to_null(F.col(c)).alias(c) for c in ("city", "province")], "effective_role_level", "is_target_market", "is_early_career_target", "is_talent_pool", "first_seen_at", "last_seen_at",
        F.coalesce(F.nullif("_t", F.lit("")), F.col("_s")).alias("technology"), "technology_category", "capability", strings(F.col("evidence")).alias("evidence"),
    )


def violations(jobs: DataFrame, skills: DataFrame, requirements: DataFrame) -> DataFrame:
    """(violation, n) of every broken rule between the inputs of the marts; no rows if all hold.

    duplicate_job_key, blank_job_key, missing_employer, orphan_skill, orphan_requirement, missing_requirement,
    duplicate_requirement, duplicate_skill, blank_skill, stale_skill, stale_requirement, and empty_jobs.
    """
    key = blank_to_null(F.col("job_key"))
    now = jobs.select("job_key", job_text_sha256(F.col("title"), F.col("description_text")).alias("_now"))
    as_count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("violation"), "n")
    repeated = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("k")).where("k > 1")
    parts = [
        as_count(jobs.where(key.isNull()), "blank_job_key"),
        as_count(repeated(jobs.where(key.isNotNull()), "job_key"), "duplicate_job_key"),
        as_count(jobs.where(blank_to_null(F.col("employer_id")).isNull() | blank_to_null(F.col("employer_name")).isNull()), "missing_employer"),
        as_count(skills.join(jobs, "job_key", "left_anti"), "orphan_skill"),
        as_count(requirements.join(jobs, "job_key", "left_anti"), "orphan_requirement"),
        as_count(jobs.join(requirements, "job_key", "left_anti"), "missing_requirement"),
        as_count(repeated(requirements, "job_key"), "duplicate_requirement"),
        as_count(repeated(skills, "job_key", F.lower(F.coalesce(blank_to_null(F.col("technology")), F.col("skill")))), "duplicate_skill"),
        as_count(skills.where(blank_to_null(F.col("skill")).isNull() | blank_to_null(F.col("category")).isNull()), "blank_skill"),
        as_count(skills.join(now, "job_key").where("job_text_sha256 <> _now"), "stale_skill"),
        as_count(requirements.join(now, "job_key").where("job_text_sha256 <> _now"), "stale_requirement"),
        jobs.limit(1).agg(F.count("*").alias("k")).select(F.lit("empty_jobs").alias("violation"), (1 - F.col("k")).alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("n > 0")


def require_columns(df: DataFrame, kind: str) -> None:
    """ValueError that names the columns which a stage's input lacks."""
    missing = sorted(set(REQUIRED[kind]) - set(df.columns))
    if missing:
        raise ValueError(f"{kind}: missing columns {', '.join(missing)}")


def mart_window(jobs: DataFrame) -> dict:
    """First and last sighting of the jobs mart as ISO text; null without jobs."""
    return jobs.agg(iso_text(F.min("first_seen_at")).alias("source_window_start"), iso_text(F.max("last_seen_at")).alias("source_window_end")).first().asDict()


def mart_counts(jobs: DataFrame) -> DataFrame:
    """(metric, value): counts of the jobs mart."""
    target = F.col("is_target_market")
    return tidy(jobs, {
        "dashboard_job_count": F.count("*"), "target_market_job_count": F.count_if(target), "non_talent_pool_target_market_job_count": F.count_if(target & ~F.col("is_talent_pool")),
        "early_career_target_job_count": F.count_if("is_early_career_target"), "talent_pool_job_count": F.count_if("is_talent_pool"),
        "jobs_with_skills_count": F.count_if(F.expr("skill_count > 0")), "jobs_without_skills_count": F.count_if(F.expr("skill_count = 0")), "target_jobs_with_skills_count": F.count_if(F.expr("is_target_market and skill_count > 0")),
        "target_skill_coverage_rate": F.coalesce(F.count_if(F.expr("is_target_market and skill_count > 0")) / F.nullif(F.count_if(target), F.lit(0)), F.lit(0.0)),
        "employer_count": F.count_distinct("employer_id"), "industry_count": F.count_distinct("industry"),
        **{f"missing_{c}": F.count_if(unknown(F.col(c))) for c in ("province", "workplace_type", "effective_role_level", "industry")},
        "jobs_with_data_quality_issues_count": F.count_if(F.expr("data_quality_issue_count > 0")), "jobs_with_extraction_warnings_count": F.count_if(F.size("extraction_warnings") > 0),
    })


def mart_labels(jobs: DataFrame, skills: DataFrame) -> DataFrame:
    """(metric, label, n): label counts of both marts."""
    named = {"role_level_counts": "effective_role_level", "workplace_type_counts": "workplace_type", "employer_counts": "employer_name", "industry_counts": "industry", "province_counts": "province"}
    by_job = label_counts(jobs, {m: label(F.col(c)) for m, c in named.items()})
    return by_job.unionByName(label_counts(skills, {"capability_mention_counts": label(F.col("capability")), "technology_mention_counts": label(F.col("technology"))}))


def mart_warnings(jobs: DataFrame) -> DataFrame:
    """(warning): thresholds that the jobs mart misses."""
    one = jobs.agg(F.count_if("is_target_market").alias("t"), F.count_if("is_early_career_target").alias("e"), F.count_if(F.expr("is_target_market and skill_count > 0")).alias("s"), F.count_if(F.col("is_target_market") & unknown(F.col("workplace_type"))).alias("w"), F.count_if(F.col("is_target_market") & blank_to_null(F.col("province")).isNull()).alias("p"))
    some = F.col("t") > 0
    return one.select(F.explode(F.array_compact(F.array(
        F.when(~some, "no_target_market_jobs"), F.when(F.col("e") < 10, "small_early_career_sample"), F.when(some & (F.col("s") / F.col("t") < 0.70), "low_target_market_skill_coverage"),
        F.when(some & (F.col("w") / F.col("t") > 0.25), "high_unknown_workplace_share"), F.when(some & (F.col("p") / F.col("t") > 0.25), "high_missing_province_share"),
    ))).alias("warning"))
