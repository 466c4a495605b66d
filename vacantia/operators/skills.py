"""Technologies, soft skills, degree requirements and dimensions of postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions.terms import Found, scan, sql_literal
from vacantia.functions.text import strip, unique_ci
from vacantia.operators.classify import years_of_experience


def skills_of(f: Found) -> Column:
    """ARRAY<STRUCT<skill, category, evidence>> of the technologies in a scan, in the order of the rules."""
    return F.transform(f.numbers("skill"), lambda k: F.struct(f.label("skill", k).alias("skill"), f.label("skill", k, 1).alias("category"), unique_ci(f.texts(k)).alias("evidence")))


def with_skills(df: DataFrame, title: str, description: str, name: str = "skills") -> DataFrame:
    """Adds the technologies in title and description."""
    return scan(df, ("skill",), title=F.col(title), description=F.col(description)).withColumn(name, skills_of(Found())).drop("_terms")


def dimensions(skill: Column, category: Column) -> tuple[Column, Column]:
    """(technology_category, capability): by technology where it has its own, else by category, else other."""
    as_map = lambda entries: F.expr("map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(f'{a}|{b}')}" for k, (a, b) in entries.items()) + ")")
    by_skill, by_category = as_map(R.SKILL_DIMENSIONS)[skill], as_map(R.CATEGORY_DIMENSIONS)[category]
    both = F.coalesce(by_skill, by_category, F.lit("other|Other"))
    return F.substring_index(both, "|", 1), F.substring_index(both, "|", -1)


def enrich(df: DataFrame, title: str, description: str) -> DataFrame:
    """Adds skills, degree_required, degree_fields, minimum_experience_years, maximum_experience_years, soft_skills, extraction_warnings."""
    rows, f = scan(df, ("skill", "degree", "field", "soft"), title=F.col(title), description=F.col(description)), Found()
    out = years_of_experience(rows, description).drop("years_evidence").withColumnsRenamed({"minimum_years": "minimum_experience_years", "maximum_years": "maximum_experience_years"})
    out = out.withColumns({"skills": skills_of(f), "degree_required": f.any("degree"), "degree_fields": f.labels("field"), "soft_skills": f.labels("soft")})
    blank = strip(F.coalesce(F.col(description), F.lit(""))) == ""
    warnings = F.array_compact(F.array(F.when(blank, "missing_description"), F.when(F.size("skills") == 0, "no_skills_detected")))
    return out.withColumn("extraction_warnings", warnings).drop("_terms")
