"""Outcomes that the classifications must have."""

import pytest
from pyspark.sql import functions as F

from vacantia.operators import audit, classify, skills

ROW = "title string, location string, description string, explicit string, department string"


def frame(spark, **kw):
    values = {k: kw.get(k) for k in ("title", "location", "description", "explicit", "department")}
    return spark.createDataFrame([tuple(values.values())], ROW)


@pytest.mark.parametrize(
    ("location", "description", "expected"),
    [
        ("Sandton, Johannesburg", "", ("Johannesburg", "Gauteng", "South Africa")),
        ("Cape Town or Durban", "", ("Cape Town", "Western Cape", "South Africa")),
        ("Lisbon, Portugal", "", ("Lisbon", None, "Portugal")),
        ("Remote, Germany", "", (None, None, "Germany")),
        ("", "Remote within South Africa only", (None, None, "South Africa")),
        (None, None, (None, None, None)),
    ],
)
def test_location(spark, location, description, expected):
    row = classify.classify_location(frame(spark, location=location, description=description), "location", "description").first()
    assert (row.city, row.province, row.country) == expected and row.is_south_africa == (expected[2] == "South Africa")


def test_workplace(spark):
    get = lambda **kw: classify.classify_workplace(frame(spark, **kw), "title", "location", "description", "explicit").first()
    assert get(description="Hybrid or remote").workplace_type == "hybrid" and get(description="Hybrid").workplace_evidence == ["text: Hybrid"]
    assert get(explicit="On-Site", description="remote").workplace_type == "on_site"
    assert get(explicit="unspecified", title="Remote dev").workplace_type == "remote"
    assert get().workplace_type == "unspecified" and get().workplace_evidence == []


@pytest.mark.parametrize(
    ("title", "description", "explicit", "level"),
    [
        ("Graduate Programme Manager", "", None, "senior"), ("Senior Developer", "entry-level", "junior", "senior"), ("Software Engineer I", "", None, "junior"),
        ("Developer", "this internship", None, "internship"), ("Developer", "0 - 2 years of experience", None, "junior"), ("Developer", "recent graduate", "Associate", "junior"),
        ("Developer", "no prior experience required", None, "junior"), ("Developer", "", None, "unspecified"), (None, None, None, "unspecified"),
    ],
)
def test_role_level(spark, title, description, explicit, level):
    assert classify.classify_role_level(frame(spark, title=title, description=description, explicit=explicit), "title", "description", "explicit").first().role_level == level


def test_technology(spark):
    get = lambda **kw: classify.classify_technology(frame(spark, **kw), "title", "department", "description").first()
    assert not get(title="Data Privacy Officer").is_technology_role and get(title="Data Privacy Officer").technology_evidence == []
    assert get(title="Cloud Software Engineer").technology_evidence == ["software", "cloud_devops", "Cloud"]
    assert get(title="Graduate Programme", description="software development").is_technology_role
    assert not get(title="Chef", description="software development").is_technology_role


@pytest.mark.parametrize(
    ("text", "lo", "hi"),
    [("1-2 years", 1, 2), ("5 to 3 years experience", 3, 5), ("3+ years' experience", 3, None), ("at least 4 yrs", 4, None), ("2-4 years, 1 year of SQL", 1, 4), ("none", None, None), (None, None, None), ("99999999999999999999 years", None, None)],
)
def test_years(spark, text, lo, hi):
    row = classify.years_of_experience(frame(spark, description=text), "description").first()
    assert (row.minimum_years, row.maximum_years) == (lo, hi)


@pytest.mark.parametrize(
    ("title", "description", "level", "confidence", "score"),
    [
        ("Developer", "2+ years", "ambiguous", "low", 2), ("Developer", "3+ years", "mid_level", "medium", -2), ("Developer", "5 years' experience", "senior", "medium", -10),
        ("Software Engineer II", "", "ambiguous", "low", -2), ("Junior Developer", "", "junior", "high", 10), ("Developer", "Junior JUNIOR", "ambiguous", "low", 0),
    ],
)
def test_scores(spark, title, description, level, confidence, score):
    row = classify.score_role(frame(spark, title=title, description=description), "title", "description", "explicit").first()
    assert (row.inferred_role_level, row.role_level_confidence, row.role_level_score) == (level, confidence, score)


def test_score_evidence_counts_once_per_spelling(spark):
    row = classify.score_role(frame(spark, title="Junior junior associate", explicit="junior", description="talent pool"), "title", "description", "explicit").first()
    assert row.role_level_score == 26 and row.role_level_score_evidence[0] == "title: Junior (+10, junior)" and row.is_talent_pool


def test_strongest_category(spark):
    items = spark.sql("select array(named_struct('source','t','value','x','weight',5,'category','junior'), named_struct('source','t','value','y','weight',-20,'category','senior')) as i")
    assert items.select(classify.strongest_category(F.col("i")).alias("c")).first().c == "senior"


def test_audit_buckets(spark):
    get = lambda t, d: classify.audit_bucket(frame(spark, title=t, description=d), "title", "description").first().likely_level
    assert [get("Associate Dev", "5 years of experience"), get("Architect", ""), get("Dev", "1 to 2 years"), get("Dev", "minimum of 6 years"), get("Dev", "3+ years"), get("Consultant", ""), get("Dev", None)] == ["likely_early_career", "likely_senior", "likely_early_career", "likely_senior", "likely_mid_level", "likely_mid_level", "ambiguous"]
    assert "a\\|b" in audit.markdown_table(spark.createDataFrame([("a|b",)], "x string"))


def test_skills(spark):
    def names(title, text):
        return [s.skill for s in skills.enrich(frame(spark, title=title, description=text), "title", "description").first().skills]

    assert names("JavaScript dev", "") == ["JavaScript"]
    assert names("Dev", "C, C# and C++ on .NET and ASP.NET") == ["C#", "C++", "C", ".NET", "ASP.NET"]
    assert names("Dev", "GitHub Actions") == ["Git", "GitHub Actions"]
    row = skills.enrich(frame(spark, title="", description=" "), "title", "description").first()
    assert row.extraction_warnings == ["missing_description", "no_skills_detected"] and row.skills == []
    row = skills.enrich(frame(spark, title="x", description="Bachelor's degree in Engineering; teamwork"), "title", "description").first()
    assert row.degree_required and row.degree_fields == ["Engineering"] and row.soft_skills == ["Collaboration"]


def test_report_table_has_all_rows_in_order(spark):
    lines = audit.markdown_table(spark.range(0, 2500, 1, 4).orderBy("id")).splitlines()
    assert lines[:2] == ["| id |", "|---|"] and lines[2:] == [f"| {k} |" for k in range(2500)]


def test_review_document(spark):
    rows = spark.createDataFrame([("likely_senior", "A|B", "Lead", "title: Lead"), ("ambiguous", None, "Dev", "")], "likely_level string, company string, title string, evidence string")
    text = "".join(audit.review_document(rows))
    assert "Roles: 2" in text and "| likely_senior | 1 |" in text and "| A\\|B | 1 |" in text and "| ambiguous |  | Dev | No explicit evidence |" in text
