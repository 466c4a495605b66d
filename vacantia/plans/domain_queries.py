"""Queries of the domain's own operators over the test tables, with the SQL they are checked against."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions import html as H
from vacantia.functions import rule_tables as R
from vacantia.functions import text as X
from vacantia.functions.rules import re2_values, sql_first, sql_has
from vacantia.operators import audit, canonical, classify, explore, marts, skills
from vacantia.operators.explore import Filters
from vacantia.session import cut, shared_dir, spread, table
from vacantia.sources import registry
from vacantia.sources import snapshots as S
from vacantia.streaming import observations as stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def jobs_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs")


def texts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Jobs for text rules, over all task slots: a small table in one file would be one task."""
    return spread(jobs_of(spark, d).select("job_key", *columns))


# --- text -----------------------------------------------------------------------------------------------------------

@query(f"SELECT job_key, {X.sql_normalized_key('title')} AS title_key, {X.sql_normalized_key('location_raw')} AS location_key FROM jobs")
def text_normalized_key(spark, d):
    return jobs_of(spark, d).select("job_key", X.normalized_key(F.col("title")).alias("title_key"), X.normalized_key(F.col("location_raw")).alias("location_key"))


@query(f"SELECT job_key, {X.sql_normalize_whitespace('description_text')} AS text FROM jobs")
def text_whitespace(spark, d):
    return texts(spark, d, "description_text").select("job_key", X.normalize_whitespace(F.col("description_text")).alias("text"))


_SQL_TAGS = r"regexp_replace(regexp_replace(coalesce({0}, ''), '<(script|style)\b[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]+>', ' ', 'gs')"
for _e, _c in X.ENTITIES.items():
    _SQL_TAGS = f"replace({_SQL_TAGS}, '{_e}', '{_c.replace(chr(39), chr(39) * 2)}')"


@query(f"SELECT id, {X.sql_normalize_whitespace(_SQL_TAGS.format('content'))} AS text FROM greenhouse_jobs_m2")
def text_strip_html(spark, d):
    return table(spark, d, "greenhouse_jobs_m2").select("id", X.strip_html_tags(F.col("content")).alias("text"))


@query("SELECT job_key, sha256(regexp_replace(coalesce(title, '') || chr(10) || coalesce(description_text, ''), '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')) AS job_text_sha256 FROM jobs")
def text_digest(spark, d):
    return jobs_of(spark, d).select("job_key", X.job_text_sha256(F.col("title"), F.col("description_text")).alias("job_text_sha256"))


_CONTENT = f"concat_ws('|', coalesce(source_name, ''), {X.sql_normalized_key('title')}, {X.sql_normalized_key('location_raw')}, substr(coalesce(description_text, ''), 1, 500))"


@query(
    f"""SELECT job_key, source_provider || ':' || coalesce(source_token, '') || ':' || coalesce(nullif({X.sql_clean('source_job_id')}, ''),
    'url-' || substr(sha256(nullif({X.sql_clean('application_url')}, '')), 1, 24), 'content-' || substr(sha256({_CONTENT}), 1, 24)) AS stable_key FROM jobs"""
)
def text_stable_key(spark, d):
    c = [F.col(x) for x in ("source_provider", "source_token", "source_job_id", "application_url", "source_name", "title", "location_raw", "description_text")]
    return jobs_of(spark, d).select("job_key", X.stable_key(*c).alias("stable_key"))


@query("SELECT job_key, regexp_replace(application_url, '[?#].*$', '') AS url, regexp_extract(application_url, '([^/]+)/?$', 1) AS slug FROM jobs")
def text_url(spark, d):
    url = F.col("application_url")
    return jobs_of(spark, d).select("job_key", X.normalize_url(url).alias("url"), F.regexp_extract(url, "([^/]+)/?$", 1).alias("slug"))


@query("SELECT job_key, coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(data_quality_issues, lambda x: lower(trim(x))), lambda x: x <> ''))), '|'), '') AS issues FROM jobs")
def text_sorted_unique(spark, d):
    return jobs_of(spark, d).select("job_key", F.lower(F.array_join(X.strings(F.col("data_quality_issues")), "|")).alias("issues"))


@query()
def html_text(spark, d):
    return table(spark, d, "greenhouse_jobs_m2").select("id", H.html_visible_text("content").alias("text"))


@query(r"SELECT doc_id, len(list_distinct(list_filter(regexp_extract_all(coalesce(text, ''), 'href\s*=\s*[""'']([^""'']+)[""'']', 1, 'i'), lambda x: regexp_matches(x, 'https?://')))) AS n_links FROM documents")
def html_links(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.matching_links(F.col("text"), "https?://")).cast("long").alias("n_links"))


# --- classification ---------------------------------------------------------------------------------------------------

_LOC, _DESC = X.sql_normalize_whitespace("location_raw"), "coalesce(description_text, '')"
_CITY = sql_first(_LOC, R.CITIES)
_PROVINCE = "CASE c " + " ".join(f"WHEN '{c}' THEN '{p}'" for c, p, _ in R.CITIES) + " END"


@query(
    f"""WITH a AS (SELECT job_key, {_LOC} AS l, {_CITY} AS c, {sql_first(_LOC, R.COUNTRIES)} AS n, {sql_has(_DESC, R.REMOTE_HOME)} AS r FROM jobs),
    b AS (SELECT *, CASE WHEN c IS NOT NULL THEN '{R.HOME}' ELSE coalesce(n, CASE WHEN r THEN '{R.HOME}' END) END AS country, trim(split_part(l, ',', 1)) AS head FROM a)
    SELECT job_key, coalesce(c, CASE WHEN country IS NOT NULL AND contains(l, ',') AND head <> '' AND NOT {sql_has('head', ['remote'])} THEN head END) AS city,
    {_PROVINCE} AS province, country, coalesce(country = '{R.HOME}', false) AS is_south_africa FROM b"""
)
def classify_locations(spark, d):
    out = classify.classify_location(texts(spark, d, "location_raw", "description_text"), "location_raw", "description_text")
    return out.select("job_key", "city", "province", "country", "is_south_africa")


_ALL = "concat_ws(' ', coalesce(title, ''), coalesce(location_raw, ''), coalesce(description_text, ''))"


@query(f"SELECT job_key, {sql_first(_ALL, R.WORKPLACES, chr(39) + 'unspecified' + chr(39))} AS workplace_type FROM jobs")
def classify_workplaces(spark, d):
    out = classify.classify_workplace(texts(spark, d, "title", "location_raw", "description_text"), "title", "location_raw", "description_text")
    return out.select("job_key", "workplace_type")


_TITLE = "coalesce(title, '')"
_LEVEL = f"coalesce({sql_first(_TITLE, [('senior', R.SENIOR_TITLE), *R.EARLY_TITLE])}, {sql_first(_DESC, R.DESCRIPTION_LEVEL)}, 'unspecified')"


@query(f"SELECT job_key, {_LEVEL} AS role_level, {_LEVEL} IN ('internship', 'graduate', 'junior') AS is_early_career FROM jobs")
def classify_role_levels(spark, d):
    return classify.classify_role_level(texts(spark, d, "title", "description_text"), "title", "description_text").select("job_key", "role_level", "is_early_career")


_SUPPORT = "concat_ws(' ', nullif(department, ''), nullif(description_text, ''))"


@query(
    f"""SELECT job_key, NOT {sql_has(_TITLE, R.TECH_VETO)} AND ({' OR '.join(sql_has(_TITLE, t) for _, t in R.TECH_TITLE)}
    OR ({sql_has(_TITLE, R.GENERIC_EARLY)} AND ({' OR '.join(sql_has(_SUPPORT, t) for _, t in R.TECH_DESCRIPTION)}))) AS is_technology_role FROM jobs"""
)
def classify_technology_roles(spark, d):
    out = classify.classify_technology(texts(spark, d, "title", "department", "description_text"), "title", "department", "description_text")
    return out.select("job_key", "is_technology_role")


@query()
def classify_evidence(spark, d):
    """Evidence of all four classifications."""
    out = classify.classify_location(texts(spark, d, "title", "department", "location_raw", "description_text"), "location_raw", "description_text")
    out = classify.classify_workplace(out, "title", "location_raw", "description_text")
    out = classify.classify_technology(classify.classify_role_level(out, "title", "description_text"), "title", "department", "description_text")
    return out.select("job_key", "location_evidence", "workplace_evidence", "role_level_evidence", "technology_evidence")


def _years(text: str, pattern: str, group: int) -> str:
    return f"list_transform(regexp_extract_all({text}, '{pattern.replace(chr(39), chr(39) * 2)}', {group}, 'i'), lambda x: try_cast(x AS BIGINT))"


_REST = f"regexp_replace({_DESC}, '{R.YEARS_RANGE}', ' ; ', 'gi')"
_ENDS = f"list_concat({_years(_DESC, R.YEARS_RANGE, 1)}, {_years(_DESC, R.YEARS_RANGE, 2)})"


@query(f"SELECT job_key, list_min(list_concat({_ENDS}, {_years(_REST, R.YEARS_SINGLE, 1)})) AS minimum_years, list_max({_ENDS}) AS maximum_years FROM jobs")
def classify_experience(spark, d):
    return classify.years_of_experience(texts(spark, d, "description_text"), "description_text").select("job_key", "minimum_years", "maximum_years")


def _named(level: str) -> str:
    t = " OR ".join(sql_has(_TITLE, terms) for _, c, terms in R.SCORE_TITLE if c == level)
    s = " OR ".join(sql_has("coalesce(role_level, '')", terms) for _, c, terms in R.SCORE_SOURCE if c == level)
    return f"({t} OR {s})"


@query(
    f"""WITH y AS (SELECT *, list_min(list_concat({_ENDS}, {_years(_REST, R.YEARS_SINGLE, 1)})) AS y FROM jobs)
    SELECT job_key, CASE {' '.join(f"WHEN {_named(c)} THEN '{c}'" for c in ('senior', 'internship', 'graduate', 'junior'))}
    WHEN {sql_has(_DESC, R.SCORE_DESCRIPTION[1][2])} THEN 'graduate' WHEN {sql_has(_DESC, R.SCORE_DESCRIPTION[0][2] + R.SCORE_DESCRIPTION[2][2])} THEN 'junior'
    WHEN y IS NOT NULL THEN CASE WHEN y <= 1 THEN 'junior' WHEN y = 2 THEN 'ambiguous' WHEN y <= 4 THEN 'mid_level' ELSE 'senior' END ELSE 'ambiguous' END AS inferred_role_level,
    {sql_has(_TITLE + " || ' ' || " + _DESC, R.TALENT_POOL)} AS is_talent_pool FROM y"""
)
def classify_inferred_levels(spark, d):
    out = classify.score_role(texts(spark, d, "title", "description_text", "role_level"), "title", "description_text", "role_level")
    return out.select("job_key", "inferred_role_level", "is_talent_pool")


def _values(expr: str, terms: list[str]) -> str:
    """Distinct matched texts of terms, in lower case: the term between its boundaries."""
    found = ", ".join(f"regexp_extract_all({expr}, '{re2_values(t).replace(chr(39), chr(39) * 2)}', 1, 'i')" for t in terms)
    return f"list_distinct(list_transform(flatten([{found}]), lambda x: lower(x)))"


_LV = "coalesce(role_level, '')"
_RULES = [(_TITLE, R.SCORE_TITLE), (_LV, R.SCORE_SOURCE), (_DESC, R.SCORE_DESCRIPTION)]
_YEAR_VALUES = f"list_distinct(list_transform(list_concat(regexp_extract_all({_DESC}, '{R.YEARS_RANGE}', 0, 'i'), regexp_extract_all({_REST}, '{R.YEARS_SINGLE.replace(chr(39), chr(39) * 2)}', 0, 'i')), lambda x: lower(x)))"
_LEAST = "list_min(list_transform(regexp_extract_all(x, '[0-9]+'), lambda d: try_cast(d AS BIGINT)))"


@query(
    f"""WITH v AS (SELECT *, {_YEAR_VALUES} AS years, list_min(list_concat({_ENDS}, {_years(_REST, R.YEARS_SINGLE, 1)})) AS y, {', '.join(f"len({_values(e, t)}) AS n{i}_{k}" for i, (e, rules) in enumerate(_RULES) for k, (_, _, t) in enumerate(rules))} FROM jobs),
    w AS (SELECT *, {' + '.join(f"{weight} * n{i}_{k}" for i, (_, rules) in enumerate(_RULES) for k, (weight, _, _) in enumerate(rules))}
      + coalesce(list_sum(list_transform(list_transform(years, lambda x: {_LEAST}), lambda n: CASE WHEN n <= 1 THEN 5 WHEN n = 2 THEN 2 WHEN n = 3 THEN -2 WHEN n = 4 THEN -5 ELSE -10 END)), 0)::BIGINT AS score,
      {' + '.join(f"n{i}_{k}" for i, (_, rules) in enumerate(_RULES) for k in range(len(rules)))} + len(years) AS n_evidence FROM v),
    l AS (SELECT *, CASE {' '.join(f"WHEN {_named(c)} THEN '{c}'" for c in ('senior', 'internship', 'graduate', 'junior'))} WHEN n2_1 > 0 THEN 'graduate' WHEN n2_0 + n2_2 > 0 THEN 'junior'
      WHEN y IS NOT NULL THEN CASE WHEN y <= 1 THEN 'junior' WHEN y = 2 THEN 'ambiguous' WHEN y <= 4 THEN 'mid_level' ELSE 'senior' END WHEN score >= 8 THEN 'junior' WHEN score <= -8 THEN 'senior' ELSE 'ambiguous' END AS level FROM w)
    SELECT job_key, score AS role_level_score, n_evidence, CASE WHEN level = 'ambiguous' THEN 'low' WHEN {' OR '.join(f"(level = '{c}' AND {_named(c)})" for c in ('senior', 'internship', 'graduate', 'junior', 'mid_level'))} THEN 'high'
      WHEN len(years) > 0 OR n_evidence >= 2 THEN 'medium' ELSE 'low' END AS role_level_confidence FROM l"""
)
def classify_scores(spark, d):
    out = classify.score_role(texts(spark, d, "title", "description_text", "role_level"), "title", "description_text", "role_level")
    return out.select("job_key", "role_level_score", F.size("role_level_score_evidence").cast("long").alias("n_evidence"), "role_level_confidence")


# --- skills -----------------------------------------------------------------------------------------------------------

_TEXT = "title || chr(10) || coalesce(description_text, '')"
_SKILL_ROWS = "SELECT job_key, employer_id, company, employer_name, is_target_market, is_early_career, inferred_role_level, unnest(list_filter([" + ", ".join(
    f"CASE WHEN {sql_has(_TEXT, t)} THEN '{s}' END" for s, _, t in R.SKILLS
) + "], lambda x: x IS NOT NULL)) AS skill FROM (SELECT * REPLACE (coalesce(title, '') AS title) FROM jobs)"
_DIMS = "(VALUES " + ", ".join(f"('{s}', '{c}', '{R.SKILL_DIMENSIONS.get(s, R.CATEGORY_DIMENSIONS[c])[0]}', '{R.SKILL_DIMENSIONS.get(s, R.CATEGORY_DIMENSIONS[c])[1]}')" for s, c, _ in R.SKILLS) + ") AS dims(skill, category, technology_category, capability)"
_S = f"WITH s AS ({_SKILL_ROWS}), k AS (SELECT * FROM s JOIN {_DIMS} USING (skill)) "
_EARLY = "(coalesce(is_target_market, false) AND (coalesce(is_early_career, false) OR coalesce(inferred_role_level IN ('internship', 'graduate', 'junior'), false)))"


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return marts.enriched_jobs(spread(jobs_of(spark, d)))


def _enriched_once(spark: SparkSession, d: str) -> DataFrame:
    """For plans that read skills and requirements: texts are read once, as in the pipeline, which writes both."""
    return cut(_enriched(spark, d).select(*marts.ENRICHED))


@query(_S + "SELECT job_key, skill AS technology, category, technology_category, capability FROM k")
def skills_by_job(spark, d):
    return marts.job_skills(_enriched(spark, d)).select("job_key", "technology", "category", "technology_category", "capability")


@query(
    _S
    + f"""SELECT skill AS technology, technology_category, capability, count(*) AS all_job_count, count(*) FILTER (WHERE is_target_market) AS target_market_job_count,
    count(*) FILTER (WHERE {_EARLY}) AS early_career_target_job_count, coalesce(count(*) FILTER (WHERE is_target_market) / nullif((SELECT count(*) FROM jobs WHERE is_target_market), 0)::DOUBLE, 0.0) AS target_market_share
    FROM k GROUP BY 1, 2, 3"""
)
def skills_by_technology(spark, d):
    e = _enriched(spark, d)
    return marts.skills_summary(marts.job_skills(e), e).drop("skill", "category")


_EMPLOYER = f"{X.sql_clean('coalesce(nullif(employer_name, chr(39)), company)')}".replace("chr(39)", "''")


@query(_S + f"SELECT {X.sql_clean('employer_id')} AS employer_id, {_EMPLOYER} AS employer_name, skill AS technology, count(*) AS job_count FROM k GROUP BY 1, 2, 3")
def skills_by_company(spark, d):
    return marts.company_skills(marts.job_skills(_enriched(spark, d))).select("employer_id", "employer_name", "technology", "job_count")


@query(_S + "SELECT skill AS technology, count(*) FILTER (WHERE is_target_market) AS job_count FROM k GROUP BY 1 HAVING count(*) FILTER (WHERE is_target_market) > 0 ORDER BY 2 DESC, 1 LIMIT 25")
def skills_top(spark, d):
    e = _enriched(spark, d)
    return marts.top_technologies(marts.skills_summary(marts.job_skills(e), e), "target_market_job_count")


@query(
    f"""SELECT job_key, {sql_has(_DESC, R.DEGREE_REQUIRED)} AS degree_required, array_to_string(list_filter([{', '.join(f"CASE WHEN {sql_has(_DESC, t)} THEN '{n}' END" for n, t in R.DEGREE_FIELDS)}], lambda x: x IS NOT NULL), ', ') AS degree_fields,
    array_to_string(list_filter([{', '.join(f"CASE WHEN {sql_has(_DESC, t)} THEN '{n}' END" for n, t in R.SOFT_SKILLS)}], lambda x: x IS NOT NULL), ', ') AS soft_skills FROM jobs"""
)
def skills_requirements(spark, d):
    out = skills.enrich(texts(spark, d, "title", "description_text"), "title", "description_text")
    return out.select("job_key", "degree_required", F.array_join("degree_fields", ", ").alias("degree_fields"), F.array_join("soft_skills", ", ").alias("soft_skills"))


@query(
    _S
    + f""", j AS (SELECT job_key, coalesce(is_target_market, false) AS t, {_EARLY} AS e, job_key IN (SELECT job_key FROM k) AS h, {sql_has(_DESC, R.DEGREE_REQUIRED)} AS dr, list_min(list_concat({_ENDS}, {_years(_REST, R.YEARS_SINGLE, 1)})) AS y FROM jobs),
    r AS (SELECT count(*)::DOUBLE AS canonical_job_count, count(*) FILTER (WHERE t)::DOUBLE AS target_market_job_count, count(*) FILTER (WHERE e)::DOUBLE AS early_career_target_job_count,
    (SELECT count(*) FROM k)::DOUBLE AS job_skill_row_count, count(*) FILTER (WHERE h)::DOUBLE AS jobs_with_skills_count, count(*) FILTER (WHERE h AND t)::DOUBLE AS target_jobs_with_skills_count,
    count(*) FILTER (WHERE t AND dr)::DOUBLE AS degree_required_target_job_count, count(*) FILTER (WHERE t AND y IS NOT NULL)::DOUBLE AS target_jobs_with_experience_requirement_count,
    coalesce(count(*) FILTER (WHERE h AND t) / nullif(count(*) FILTER (WHERE t), 0)::DOUBLE, 0.0) AS target_skill_coverage_rate FROM j)
    SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)"""
)
def skills_report(spark, d):
    return marts.skills_report(_enriched(spark, d))


@query(
    _S
    + f""", w AS (SELECT {X.sql_clean('description_text')} = '' AS no_text, job_key NOT IN (SELECT job_key FROM k) AS no_skill FROM jobs)
    SELECT metric, label, count(*) AS n FROM (SELECT 'technology_category_mention_counts' AS metric, technology_category AS label FROM k UNION ALL SELECT 'capability_mention_counts', capability FROM k UNION ALL SELECT 'category_mention_counts', category FROM k
    UNION ALL SELECT 'extraction_warning_counts', 'missing_description' FROM w WHERE no_text UNION ALL SELECT 'extraction_warning_counts', 'no_skills_detected' FROM w WHERE no_skill) GROUP BY 1, 2"""
)
def skills_label_counts(spark, d):
    e = _enriched_once(spark, d)
    return marts.skills_labels(marts.job_skills(e), marts.job_requirements(e))


# --- canonical table ---------------------------------------------------------------------------------------------------

def _boards(spark: SparkSession, d: str) -> DataFrame:
    """Board postings beside what a snapshot's sidecar says of them."""
    src = table(spark, d, "sources").select(F.col("token").alias("source_token"), F.col("name").alias("source_name"))
    rows = table(spark, d, "greenhouse_jobs_m2").join(src, "source_token", "left")
    return spread(rows.withColumns({"content_sha256": F.lit(""), "snapshot_path": F.lit("greenhouse"), "collected_at": F.lit("2026-01-01 00:00:00").cast("timestamp")}))


def _postings(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "sources").select(F.col("token").alias("source_token"), F.col("name").alias("source_name"))
    rows = table(spark, d, "lever_jobs").join(src, "source_token", "left")
    return spread(rows.withColumns({"content_sha256": F.lit(""), "snapshot_path": F.lit("lever"), "collected_at": F.lit("2026-01-01 00:00:00").cast("timestamp")}))


@query()
def canonical_boards(spark, d):
    return canonical.canonical_observations(canonical.from_board(_boards(spark, d)))


@query()
def canonical_postings(spark, d):
    return canonical.canonical_observations(canonical.from_postings(_postings(spark, d)))


@query("SELECT source_provider, count(*) AS n FROM (SELECT 'greenhouse' AS source_provider FROM greenhouse_jobs_m2 UNION ALL SELECT 'lever' FROM lever_jobs) GROUP BY 1")
def canonical_union(spark, d):
    both = canonical.from_board(_boards(spark, d)).unionByName(canonical.from_postings(_postings(spark, d)))
    return both.groupBy("source_provider").agg(F.count("*").alias("n"))


def _bundles(spark: SparkSession, d: str, provider: str, body: Column, index: Column, url: Column, path: Column) -> DataFrame:
    """Pages of a provider as bundle_pages gives them, one per job, made of the jobs' own columns."""
    own = jobs_of(spark, d).withColumns({"provider": F.lit(provider), "content_sha256": F.lit(""), "snapshot_path": F.lit(""), "collected_at": F.lit("2026-01-01 00:00:00").cast("timestamp"), "public_base_url": F.lit("https://w/en-US/s/")})
    return spread(own.select("provider", "source_name", "source_token", "content_sha256", "snapshot_path", "collected_at", "public_base_url", url.alias("url"), body.alias("body"), index.alias("index"), path.alias("external_path")))


_MAPPED = ["source_provider", "source_name", "source_token", "source_job_id", "title", "department", "location_raw", "application_url"]
_NW = X.sql_normalize_whitespace
_MAPPED_SQL = f"{_NW('source_name')} AS source_name, {_NW('source_token')} AS source_token"


@query(
    f"""SELECT 'workday' AS source_provider, {_MAPPED_SQL}, {_NW('source_job_id')} AS source_job_id, {_NW('title')} AS title, nullif({_NW('department')}, '') AS department,
    {_NW('location_raw')} AS location_raw, 'https://w/en-US/s/job/' || job_key AS application_url FROM jobs"""
)
def canonical_workday(spark, d):
    """Details nested in an object under the listing's fields, through the provider's own mapping."""
    info = F.struct(F.col("source_job_id").alias("jobReqId"), F.lit("nested title").alias("title"), F.col("location_raw").alias("location"), F.col("department").alias("jobFamily"))
    index = F.map_filter(F.create_map(F.lit("title"), F.col("title"), F.lit("externalPath"), F.concat(F.lit("/job/"), "job_key")), lambda k, v: v.isNotNull())
    pages = _bundles(spark, d, "workday", F.to_json(F.struct(info.alias("jobPostingInfo"))), index, F.lit("https://w/x"), F.lit(None).cast("string"))
    return canonical.from_json_details(S.json_details(pages, "workday"), "workday").select(*_MAPPED)


@query(
    f"""SELECT 'oracle_hcm' AS source_provider, {_MAPPED_SQL}, {_NW('source_job_id')} AS source_job_id, {_NW('title')} AS title, nullif({_NW('department')}, '') AS department,
    {_NW('location_raw')} AS location_raw, CASE WHEN {_NW('source_job_id')} <> '' THEN 'https://w/en-US/s/' || {_NW('source_job_id')} ELSE 'https://o/' || job_key END AS application_url FROM jobs"""
)
def canonical_oracle(spark, d):
    """Details wrapped into a list of one item, with fields that only the listing has."""
    item = F.struct(F.col("source_job_id").alias("Id"), F.col("title").alias("Title"), F.col("department").alias("JobFunction"))
    index = F.map_filter(F.create_map(F.lit("PrimaryLocation"), F.col("location_raw"), F.lit("Title"), F.lit("listing's title")), lambda k, v: v.isNotNull())
    pages = _bundles(spark, d, "oracle_hcm", F.to_json(F.struct(F.array(item).alias("items"))), index, F.concat(F.lit("https://o/"), "job_key"), F.lit(None).cast("string"))
    return canonical.from_json_details(S.json_details(pages, "oracle_hcm"), "oracle_hcm").select(*_MAPPED)


@query(
    f"""SELECT 'successfactors' AS source_provider, {_MAPPED_SQL}, {_NW('source_job_id')} AS source_job_id, {_NW('title')} AS title, NULL::VARCHAR AS department, {_NW('location_raw')} AS location_raw, 'https://s/job/' || job_key AS application_url FROM jobs"""
)
def canonical_html(spark, d):
    """Posting pages as HTML: title and place from the page, the id from the listing."""
    place = F.when(X.clean(F.col("location_raw")) != "", F.concat(F.lit("<span class='jobGeoLocation'>Location: "), _escaped("location_raw"), F.lit("</span>"))).otherwise("")
    page = F.concat(F.lit("<html><h1>"), _escaped("title"), F.lit("</h1>"), place, F.lit("<div class='jobdescription'>"), _escaped("description_text"), F.lit("</div></html>"))
    index = F.struct(F.col("source_job_id").alias("source_job_id"), F.lit("listed").alias("title"), F.lit("").alias("location_raw"), F.lit("").alias("published_text"))
    pages = _bundles(spark, d, "successfactors", page, index, F.concat(F.lit("https://s/job/"), "job_key"), F.lit(None).cast("string")).withColumnRenamed("body", "html")
    rows = canonical.from_html_details(pages, H.html_detail_fields("html")).select(*_MAPPED)
    return rows.withColumns({"title": F.when(F.col("title") != "listed", F.col("title")).otherwise("")})


@query(
    f"""SELECT 'wp_job_manager' AS source_provider, {_MAPPED_SQL}, regexp_replace(job_key, '^.*/', '') AS source_job_id, {_NW('title')} AS title, nullif({_NW('department')}, '') AS department,
    concat_ws(', ', nullif({_NW('city')}, ''), CASE WHEN lower({_NW('province')}) <> lower({_NW('city')}) THEN nullif({_NW('province')}, '') END) AS location_raw, 'https://p/jobs/' || job_key || '/?x=1' AS application_url FROM jobs"""
)
def canonical_embedded(spark, d):
    """Pages with a posting embedded as JSON, its place in parts."""
    address = F.struct(F.col("city").alias("addressLocality"), F.col("province").alias("addressRegion"))
    posting = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), "title", F.col("department").alias("industry"), F.struct(address.alias("address")).alias("jobLocation")))
    page = F.concat(F.lit("<script type='application/ld+json'>"), posting, F.lit("</script>"))
    pages = _bundles(spark, d, "wp_job_manager", page, F.create_map().cast("map<string,string>"), F.concat(F.lit("https://p/jobs/"), "job_key", F.lit("/?x=1")), F.lit(None).cast("string")).withColumnRenamed("body", "html")
    return canonical.from_posting_json(pages, H.html_posting_json("html")).select(*_MAPPED)


def _escaped(column: str) -> Column:
    out = F.coalesce(F.col(column), F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


_ORDERED = ["last_seen_at", "source_updated_at", "obs_id"]


@query(
    """SELECT job_key, arg_max(title, struct_pack(a := coalesce(last_seen_at, TIMESTAMPTZ '0001-01-01 00:00:00+00'), b := coalesce(source_updated_at, ''), c := obs_id)) AS title,
    arg_max(obs_id, struct_pack(a := coalesce(last_seen_at, TIMESTAMPTZ '0001-01-01 00:00:00+00'), b := coalesce(source_updated_at, ''), c := obs_id)) AS obs_id,
    epoch_us(min(first_seen_at)) AS first_us, epoch_us(max(last_seen_at)) AS last_us, count(*) AS observation_count FROM job_observations GROUP BY job_key"""
)
def canonical_dedup(spark, d):
    out = canonical.deduplicate(table(spark, d, "job_observations"), "job_key", _ORDERED)
    return out.select("job_key", "title", "obs_id", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("last_seen_at").alias("last_us"), "observation_count")


_LABELS = " UNION ALL ".join(f"SELECT '{c}_counts' AS metric, {X.sql_label(c)} AS label FROM jobs" for c in ("role_level", "inferred_role_level", "role_level_confidence", "workplace_type", "company", "industry"))


@query(
    f"""SELECT metric, label, count(*) AS n FROM ({_LABELS}
    UNION ALL SELECT 'parent_company_counts', coalesce(nullif({X.sql_clean('parent_company')}, ''), employer_name) FROM jobs
    UNION ALL SELECT 'employer_counts', {X.sql_label('employer_name')} FROM jobs UNION ALL SELECT 'provider_job_counts', {X.sql_label('source_provider')} FROM jobs
    UNION ALL SELECT 'south_africa_technology_role_level_counts', {X.sql_label('role_level')} FROM jobs WHERE is_south_africa AND is_technology_role
    UNION ALL SELECT 'early_career_target_market_company_counts', {X.sql_label('company')} FROM jobs WHERE is_target_market AND is_early_career
    UNION ALL SELECT 'source_snapshot_counts', source_name FROM snapshot_metadata
    UNION ALL SELECT 'target_market_role_level_counts', {X.sql_label('role_level')} FROM jobs WHERE is_target_market
    UNION ALL SELECT 'target_market_company_counts', {X.sql_label('company')} FROM jobs WHERE is_target_market
    UNION ALL SELECT 'target_market_inferred_role_level_counts', {X.sql_label('inferred_role_level')} FROM jobs WHERE is_target_market
    UNION ALL SELECT 'data_quality_issue_counts', unnest(data_quality_issues) FROM jobs) GROUP BY 1, 2"""
)
def canonical_label_counts(spark, d):
    return canonical.transform_report(jobs_of(spark, d), table(spark, d, "snapshot_metadata"))[1]


@query(
    """WITH r AS (SELECT count(*)::DOUBLE AS canonical_job_count, count(*) FILTER (WHERE is_south_africa)::DOUBLE AS south_africa_job_count, count(*) FILTER (WHERE is_technology_role)::DOUBLE AS technology_job_count,
    count(*) FILTER (WHERE is_south_africa AND is_technology_role)::DOUBLE AS south_africa_technology_job_count, count(*) FILTER (WHERE is_target_market)::DOUBLE AS target_market_job_count,
    count(*) FILTER (WHERE is_talent_pool)::DOUBLE AS talent_pool_job_count, count(*) FILTER (WHERE len(role_level_evidence) > 0)::DOUBLE AS role_level_evidence_count, sum(observation_count)::DOUBLE AS raw_job_observation_count,
    (sum(observation_count) - count(*))::DOUBLE AS duplicate_observations_removed, count(*) FILTER (WHERE is_early_career)::DOUBLE AS early_career_job_count, count(*) FILTER (WHERE is_early_career AND is_target_market)::DOUBLE AS early_career_target_market_job_count FROM jobs)
    SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)"""
)
def canonical_report(spark, d):
    return canonical.transform_report(jobs_of(spark, d))[0]


# --- joins and checks --------------------------------------------------------------------------------------------------

@query(
    """WITH e AS (SELECT employer_id AS id, min(name) AS employer_name, min(priority)::VARCHAR AS employer_priority FROM sources GROUP BY 1)
    SELECT j.job_key, e.id AS employer_id, e.employer_name, e.employer_priority FROM jobs j LEFT JOIN sources s ON j.source_token = s.token AND j.source_provider = s.provider LEFT JOIN e ON e.id = s.employer_id"""
)
def join_registry(spark, d):
    """Jobs with what the registry says of their source's employer; the registry is made of the sources."""
    src = table(spark, d, "sources")
    blank = {c: F.lit(None).cast("string").alias(c) for c in ("parent_company", "industry", "graduate_programme", "remote_scope")}
    employers = src.groupBy(F.col("employer_id").alias("id")).agg(F.min("name").alias("name"), F.min("priority").cast("string").alias("priority")).select("*", *blank.values())
    return registry.with_employers(jobs_of(spark, d).select("job_key", "source_provider", "source_token"), src, employers).select("job_key", "employer_id", "employer_name", "employer_priority")


@query(
    """SELECT DISTINCT m.source AS provider, trim(m.source_token) AS token, CASE WHEN s.token IS NULL THEN 'unknown_source' ELSE 'employer_differs' END AS violation FROM snapshot_metadata m LEFT JOIN sources s ON s.provider = m.source AND s.token = trim(m.source_token)
    WHERE s.token IS NULL OR (trim(m.employer_id) <> '' AND trim(m.employer_id) <> s.employer_id)"""
)
def join_employer_agreement(spark, d):
    return registry.employer_disagreements(table(spark, d, "snapshot_metadata").withColumnRenamed("source", "provider"), table(spark, d, "sources"))


@query("SELECT job_key FROM jobs WHERE job_key NOT IN (SELECT job_key FROM dashboard_skills WHERE job_key IS NOT NULL)")
def join_without_skills(spark, d):
    return jobs_of(spark, d).select("job_key").join(table(spark, d, "dashboard_skills").select("job_key"), "job_key", "left_anti")


@query("SELECT token, employer_id FROM sources WHERE enabled AND token NOT IN (SELECT source_token FROM greenhouse_jobs_m2 WHERE source_token IS NOT NULL)")
def join_sources_without_jobs(spark, d):
    """Enabled sources of which the board table has no posting."""
    seen = table(spark, d, "greenhouse_jobs_m2").select(F.col("source_token").alias("token"))
    return table(spark, d, "sources").where("enabled").select("token", "employer_id").join(seen, "token", "left_anti").select("token", "employer_id")


@query("SELECT j.job_key, coalesce(s.n, 0) AS n_skills FROM jobs j LEFT JOIN (SELECT job_key, count(DISTINCT lower(trim(technology))) AS n FROM dashboard_skills WHERE trim(technology) <> '' GROUP BY 1) s USING (job_key)")
def join_nested_skills(spark, d):
    tech = table(spark, d, "dashboard_skills").select("job_key", F.lower(F.trim("technology")).alias("t")).where("t <> ''")
    sets = tech.groupBy("job_key").agg(F.count_distinct("t").alias("n"))
    return jobs_of(spark, d).select("job_key").join(sets, "job_key", "left").select("job_key", F.coalesce("n", F.lit(0)).alias("n_skills"))


@query("SELECT DISTINCT s.snapshot_no, s.job_key FROM job_snapshots s JOIN jobs j USING (job_key) WHERE s.title IS DISTINCT FROM j.title")
def join_stale_rows(spark, d):
    now = jobs_of(spark, d).select("job_key", F.col("title").alias("_now"))
    return table(spark, d, "job_snapshots").select("snapshot_no", "job_key", "title").join(now, "job_key").where(~F.col("title").eqNullSafe(F.col("_now"))).select("snapshot_no", "job_key").distinct()


@query(f"SELECT c.city AS label, count(*) AS n FROM jobs JOIN (VALUES {', '.join(f'''('{c}', '{p}')''' for c, p, _ in R.CITIES)}) c(city, province) ON contains(lower(location_raw), lower(c.city)) GROUP BY 1")
def join_rules(spark, d):
    """A small table of user-supplied rules against all rows: a condition join whose rule side is broadcast."""
    rules = spark.createDataFrame([(c, p) for c, p, _ in R.CITIES], "label string, province string")
    return jobs_of(spark, d).select("location_raw").join(F.broadcast(rules), F.lower("location_raw").contains(F.lower("label"))).groupBy("label").agg(F.count("*").alias("n"))


_DIGEST = "sha256(regexp_replace(coalesce(title, '') || chr(10) || coalesce(description_text, ''), '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g'))"


@query(
    f"""WITH j AS (SELECT job_key, {_DIGEST} AS now, {X.sql_clean('employer_id')} = '' OR {X.sql_clean('employer_name')} = '' AS lost FROM jobs),
    k AS (SELECT CASE WHEN lower(trim(technology)) = 'sql' THEN 'lost:' || job_key ELSE job_key END AS job_key, technology, technology_category, sha256(title) AS sha FROM dashboard_skills),
    r AS (SELECT job_key, job_text_sha256 AS sha FROM job_snapshots WHERE snapshot_no = 3),
    v AS (SELECT 'missing_employer' AS violation, count(*) AS n FROM j WHERE lost UNION ALL SELECT 'orphan_skill', count(*) FROM k WHERE job_key NOT IN (SELECT job_key FROM j)
    UNION ALL SELECT 'missing_requirement', count(*) FROM j WHERE job_key NOT IN (SELECT job_key FROM r) UNION ALL SELECT 'duplicate_requirement', count(*) FROM (SELECT job_key FROM r GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'duplicate_skill', count(*) FROM (SELECT job_key, lower(coalesce(nullif({X.sql_clean('technology')}, ''), technology)) FROM k GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'blank_skill', count(*) FROM k WHERE {X.sql_clean('technology')} = '' OR {X.sql_clean('technology_category')} = ''
    UNION ALL SELECT 'stale_skill', count(*) FROM k JOIN j USING (job_key) WHERE sha <> now UNION ALL SELECT 'stale_requirement', count(*) FROM r JOIN j USING (job_key) WHERE sha <> now)
    SELECT violation, n FROM v WHERE n > 0"""
)
def check_marts(spark, d):
    """Inputs that don't fit together: mentions whose job is lost, repeated, blank and stale ones; one delivery as requirements."""
    lost = F.when(F.lower(F.trim("technology")) == "sql", F.concat(F.lit("lost:"), F.col("job_key"))).otherwise(F.col("job_key"))
    own = table(spark, d, "dashboard_skills").select(lost.alias("job_key"), "technology", F.col("technology").alias("skill"), F.col("technology_category").alias("category"), F.sha2("title", 256).alias("job_text_sha256"))
    return marts.violations(jobs_of(spark, d), own, table(spark, d, "job_snapshots").where("snapshot_no = 3").select("job_key", "job_text_sha256"))


# --- marts ---------------------------------------------------------------------------------------------------------------

def _mart_jobs(spark: SparkSession, d: str, e: DataFrame | None = None) -> DataFrame:
    e = _enriched_once(spark, d) if e is None else e
    return marts.dashboard_jobs(jobs_of(spark, d), marts.job_skills(e), marts.job_requirements(e))


def _mart_skills(spark: SparkSession, d: str, e: DataFrame | None = None) -> DataFrame:
    return marts.dashboard_skills(jobs_of(spark, d), marts.job_skills(_enriched(spark, d) if e is None else e))


_UNKNOWN = "('', 'unknown', 'unspecified', 'ambiguous', 'none')"
_EFFECTIVE = f"CASE WHEN lower({X.sql_clean('inferred_role_level')}) NOT IN {_UNKNOWN} THEN lower({X.sql_clean('inferred_role_level')}) WHEN lower({X.sql_clean('role_level')}) NOT IN {_UNKNOWN} THEN lower({X.sql_clean('role_level')}) ELSE 'unspecified' END"
_BN = lambda c: f"nullif({X.sql_clean(c)}, '')"
_PLACE = f"CASE WHEN {_BN('city')} IS NOT NULL AND {_BN('province')} IS NOT NULL AND lower({_BN('city')}) <> lower({_BN('province')}) THEN {_BN('city')} || ', ' || {_BN('province')} ELSE coalesce({_BN('city')}, {_BN('province')}, {_BN('country')}, 'Unspecified') END"
_GROUP = f"coalesce({_BN('parent_company')}, {_BN('employer_name')}, {_BN('company')}, 'Unspecified')"
_TRUE = lambda c: f"coalesce({c}, false)"
_M = f"""WITH e AS (SELECT *, {_EFFECTIVE} AS effective_role_level, {_GROUP} AS employer_group, {_PLACE} AS location_label FROM jobs),
m AS (SELECT job_key, {X.sql_label('title')} AS title, {X.sql_clean('employer_id')} AS employer_id, {X.sql_clean('employer_name')} AS employer_name, employer_group, {X.sql_label('industry')} AS industry, {X.sql_label('graduate_programme')} AS graduate_programme,
 {_BN('city')} AS city, {_BN('province')} AS province, {_BN('country')} AS country, location_label, {X.sql_label('workplace_type')} AS workplace_type, effective_role_level, {_TRUE('is_target_market')} AS is_target_market,
 {_TRUE('is_target_market')} AND ({_TRUE('is_early_career')} OR effective_role_level IN ('internship', 'graduate', 'junior')) AS is_early_career_target, {_TRUE('is_talent_pool')} AS is_talent_pool, last_seen_at FROM e) """
_MART_COLUMNS = ["job_key", "title", "employer_id", "employer_name", "employer_group", "industry", "city", "province", "country", "location_label", "workplace_type", "effective_role_level", "is_target_market", "is_early_career_target", "is_talent_pool"]


@query(_M + f"SELECT {', '.join(_MART_COLUMNS)} FROM m")
def mart_jobs(spark, d):
    return _mart_jobs(spark, d).select(*_MART_COLUMNS)


_LISTED = lambda c: f"coalesce(array_to_string(list_transform(list_sort(list_transform(list_filter(coalesce({c}, []), lambda x: trim(x) <> ''), lambda x: lower(trim(x)) || chr(1) || trim(x))), lambda x: split_part(x, chr(1), 2)), '|'), '')"
_EXTRACTED = f"""x AS (SELECT job_key, {sql_has(_DESC, R.DEGREE_REQUIRED)} AS degree_required, list_filter([{', '.join(f"CASE WHEN {sql_has(_DESC, t)} THEN '{n}' END" for n, t in R.DEGREE_FIELDS)}], lambda x: x IS NOT NULL) AS degree_fields,
 list_filter([{', '.join(f"CASE WHEN {sql_has(_DESC, t)} THEN '{n}' END" for n, t in R.SOFT_SKILLS)}], lambda x: x IS NOT NULL) AS soft_skills, list_min(list_concat({_ENDS}, {_years(_REST, R.YEARS_SINGLE, 1)})) AS lo, list_max({_ENDS}) AS hi, {X.sql_clean('description_text')} = '' AS no_text FROM jobs),
sk AS (SELECT job_key, count(*) AS n, list(DISTINCT skill) AS skills, list(DISTINCT technology_category) AS kinds, list(DISTINCT capability) AS capabilities FROM k GROUP BY 1),
f AS (SELECT m.*, x.*, coalesce(sk.n, 0) AS skill_count, sk.skills, sk.kinds, sk.capabilities, len(list_filter(coalesce(j.data_quality_issues, []), lambda x: trim(x) <> '')) AS n_issues, no_text OR sk.n IS NULL AS has_warning, j.*
      FROM m JOIN x USING (job_key) LEFT JOIN sk USING (job_key) JOIN (SELECT * EXCLUDE ({', '.join(c for c in _MART_COLUMNS if c not in ('job_key', 'employer_group', 'location_label', 'effective_role_level', 'is_early_career_target'))}, graduate_programme, last_seen_at), last_seen_at AS seen FROM jobs) j USING (job_key)) """
_FULL = _S.rstrip() + ", " + _M.removeprefix("WITH ").rstrip() + ", " + _EXTRACTED


@query(
    _FULL
    + f"""SELECT job_key, {', '.join(f"{X.sql_label(c)} AS {c}" for c in ('source_provider', 'source_name', 'source_job_id', 'title_normalized', 'employer_priority'))}, title, industry, graduate_programme, workplace_type,
    epoch_us(first_seen_at) AS first_seen_us, epoch_us(seen) AS last_seen_us, epoch_us(source_updated_at) AS source_updated_us, CASE WHEN coalesce(observation_count, 0) = 0 THEN 1 ELSE observation_count END AS observation_count,
    employer_id, employer_name, {X.sql_clean('application_url')} AS application_url, employer_group, city, province, country, location_label, effective_role_level, {X.sql_label('role_level_confidence', 'low')} AS role_level_confidence,
    is_target_market, coalesce(is_early_career, false) AS is_early_career, is_early_career_target, is_talent_pool, skill_count, {_LISTED('skills')} AS skills, {_LISTED('kinds')} AS technology_categories, {_LISTED('capabilities')} AS capabilities,
    degree_required, {_LISTED('degree_fields')} AS degree_fields, lo AS minimum_experience_years, hi AS maximum_experience_years, {_LISTED('soft_skills')} AS soft_skills, n_issues AS data_quality_issue_count, {_LISTED('data_quality_issues')} AS data_quality_issues,
    array_to_string(list_filter([CASE WHEN no_text THEN 'missing_description' END, CASE WHEN skills IS NULL THEN 'no_skills_detected' END], lambda x: x IS NOT NULL), '|') AS extraction_warnings FROM f"""
)
def mart_jobs_full(spark, d):
    """All columns of the jobs mart; lists joined by |, times in microseconds."""
    rows = _mart_jobs(spark, d)
    times = {"first_seen_at": "first_seen_us", "last_seen_at": "last_seen_us", "source_updated_at": "source_updated_us"}
    return rows.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.unix_micros(c).alias(times[c]) if c in times else F.col(c) for c, t in rows.dtypes])


@query(_S + "SELECT job_key, skill AS technology, technology_category, capability FROM k")
def mart_skills(spark, d):
    return _mart_skills(spark, d).select("job_key", "technology", "technology_category", "capability")


@query(
    _S.rstrip()
    + ", "
    + _M.removeprefix("WITH ")
    + """SELECT metric, label, count(*) AS n FROM (SELECT 'capability_mention_counts' AS metric, capability AS label FROM k UNION ALL SELECT 'technology_mention_counts', skill FROM k UNION ALL SELECT 'role_level_counts' AS metric, effective_role_level AS label FROM m UNION ALL SELECT 'workplace_type_counts', workplace_type FROM m UNION ALL SELECT 'employer_counts', coalesce(nullif(employer_name, ''), 'unspecified') FROM m
    UNION ALL SELECT 'industry_counts', industry FROM m UNION ALL SELECT 'province_counts', coalesce(province, 'unspecified') FROM m) GROUP BY 1, 2"""
)
def mart_label_counts(spark, d):
    e = _enriched_once(spark, d)
    return marts.mart_labels(_mart_jobs(spark, d, e), _mart_skills(spark, d, e))


_MISSING = lambda c: f"count(*) FILTER (WHERE {c} IS NULL OR lower(trim({c})) IN {_UNKNOWN})::DOUBLE"


@query(
    _FULL
    + f""", r AS (SELECT count(*)::DOUBLE AS dashboard_job_count, count(*) FILTER (WHERE is_target_market)::DOUBLE AS target_market_job_count, count(*) FILTER (WHERE is_target_market AND NOT is_talent_pool)::DOUBLE AS non_talent_pool_target_market_job_count,
    count(*) FILTER (WHERE is_early_career_target)::DOUBLE AS early_career_target_job_count, count(*) FILTER (WHERE is_talent_pool)::DOUBLE AS talent_pool_job_count, count(*) FILTER (WHERE skill_count > 0)::DOUBLE AS jobs_with_skills_count,
    count(*) FILTER (WHERE skill_count = 0)::DOUBLE AS jobs_without_skills_count, count(*) FILTER (WHERE is_target_market AND skill_count > 0)::DOUBLE AS target_jobs_with_skills_count,
    coalesce(count(*) FILTER (WHERE is_target_market AND skill_count > 0) / nullif(count(*) FILTER (WHERE is_target_market), 0)::DOUBLE, 0.0) AS target_skill_coverage_rate,
    count(DISTINCT employer_id)::DOUBLE AS employer_count, count(DISTINCT industry)::DOUBLE AS industry_count, {_MISSING('province')} AS missing_province, {_MISSING('workplace_type')} AS missing_workplace_type,
    {_MISSING('effective_role_level')} AS missing_effective_role_level, {_MISSING('industry')} AS missing_industry, count(*) FILTER (WHERE n_issues > 0)::DOUBLE AS jobs_with_data_quality_issues_count,
    count(*) FILTER (WHERE has_warning)::DOUBLE AS jobs_with_extraction_warnings_count FROM f) SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)"""
)
def mart_counts(spark, d):
    return marts.mart_counts(_mart_jobs(spark, d))


@query(
    _FULL
    + f""", r AS (SELECT count(*) FILTER (WHERE is_target_market)::DOUBLE AS t, count(*) FILTER (WHERE is_early_career_target) AS e, count(*) FILTER (WHERE is_target_market AND skill_count > 0) AS s,
    count(*) FILTER (WHERE is_target_market AND lower(trim(workplace_type)) IN {_UNKNOWN}) AS w, count(*) FILTER (WHERE is_target_market AND province IS NULL) AS p FROM f)
    SELECT warning FROM (SELECT unnest([CASE WHEN t = 0 THEN 'no_target_market_jobs' END, CASE WHEN e < 10 THEN 'small_early_career_sample' END, CASE WHEN t > 0 AND s / t < 0.7 THEN 'low_target_market_skill_coverage' END,
    CASE WHEN t > 0 AND w / t > 0.25 THEN 'high_unknown_workplace_share' END, CASE WHEN t > 0 AND p / t > 0.25 THEN 'high_missing_province_share' END]) AS warning FROM r) WHERE warning IS NOT NULL"""
)
def mart_warnings(spark, d):
    return marts.mart_warnings(_mart_jobs(spark, d))


@query(_FULL + f"""SELECT unnest(['province', 'workplace_type', 'effective_role_level', 'industry']) AS field, unnest([{', '.join(_MISSING(c) for c in ('province', 'workplace_type', 'effective_role_level', 'industry'))}])::BIGINT AS value FROM f""")
def mart_missing(spark, d):
    return marts.missing_figures(marts.mart_counts(_mart_jobs(spark, d)))


# --- exploration: the skills mart that is given, and the jobs mart that is built -------------------------------------

def _given_skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dashboard_skills")


def _light_jobs(spark: SparkSession, d: str) -> DataFrame:
    """The jobs mart's own columns without nested skills, for figures that need none: nothing but projections."""
    jobs = marts._common(jobs_of(spark, d))
    return jobs.select("job_key", *[X.label(F.col(c)).alias(c) for c in ("title", "industry", "workplace_type", "graduate_programme")], *[X.clean(F.col(c)).alias(c) for c in ("employer_name", "application_url")], X.blank_to_null(F.col("province")).alias("province"), "effective_role_level", "is_target_market", "is_early_career_target", "is_talent_pool", "last_seen_at", marts.location_label(F.col("city"), F.col("province"), F.col("country")).alias("location_label"), "employer_group")


_WANTED = Filters(workplace_types=("hybrid", "remote", " "), search="engineer")
_WHERE = "workplace_type IN ('hybrid', 'remote') AND is_target_market AND NOT is_talent_pool AND (lower(coalesce(title, '')) LIKE '%engineer%' OR lower(coalesce(employer_name, '')) LIKE '%engineer%')"


@query(_M + f"SELECT job_key, title, employer_name FROM m WHERE {_WHERE}")
def explore_filtered_jobs(spark, d):
    return explore.filtered_jobs(_light_jobs(spark, d), _WANTED).select("job_key", "title", "employer_name")


@query("SELECT job_key, technology FROM dashboard_skills WHERE is_target_market AND NOT is_talent_pool AND (lower(coalesce(title, '')) LIKE '%sql%' OR lower(coalesce(employer_name, '')) LIKE '%sql%' OR lower(coalesce(technology, '')) LIKE '%sql%')")
def explore_search_skills(spark, d):
    return explore.filtered_skills(_given_skills(spark, d), Filters(search=" SQL ")).select("job_key", "technology")


@query("SELECT DISTINCT province AS value FROM dashboard_skills WHERE province IS NOT NULL AND trim(province) <> '' AND lower(trim(province)) NOT IN ('unknown', 'none', 'unspecified') ORDER BY 1")
def explore_options(spark, d):
    return explore.filter_options(_given_skills(spark, d), "province")


@query("SELECT employer_name AS label, count(*) AS value FROM dashboard_skills WHERE is_target_market AND NOT is_talent_pool AND employer_name IS NOT NULL AND trim(employer_name) <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def explore_top_values(spark, d):
    return explore.top_values(_given_skills(spark, d), "employer_name", 12, Filters().condition())


@query(f"SELECT coalesce(nullif({X.sql_clean('technology')}, ''), 'Unspecified') AS label, count(*) AS value FROM dashboard_skills GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def explore_value_counts(spark, d):
    return explore.value_counts(_given_skills(spark, d), "technology", 15)


@query(_M + "SELECT count(*) AS jobs, count(DISTINCT employer_name) AS employers, count(DISTINCT province) AS provinces, count(*) FILTER (WHERE is_early_career_target) AS early_career, avg((workplace_type IN ('remote', 'hybrid'))::INT::DOUBLE) AS flexible_share FROM m")
def explore_key_figures(spark, d):
    return explore.key_figures(_light_jobs(spark, d))


@query("SELECT strftime(last_seen_at, '%Y-%m') AS month, count(DISTINCT job_key) AS vacancies FROM jobs WHERE last_seen_at IS NOT NULL GROUP BY 1")
def explore_monthly(spark, d):
    return explore.monthly_activity(jobs_of(spark, d))


@query("SELECT employer_name, industry, count(DISTINCT job_key) AS vacancies, count(*) FILTER (WHERE is_early_career_target) AS early_career, count(DISTINCT province) AS provinces, count(*) AS skill_mentions FROM dashboard_skills GROUP BY 1, 2")
def explore_employers(spark, d):
    return explore.employer_comparison(_given_skills(spark, d).withColumn("skill_count", F.lit(1).cast("long")))


@query(
    """WITH top AS (SELECT technology FROM dashboard_skills WHERE technology IS NOT NULL AND trim(technology) <> '' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12),
    r AS (SELECT effective_role_level, technology, count(*) AS n FROM dashboard_skills JOIN top USING (technology) GROUP BY 1, 2)
    SELECT l.effective_role_level, t.technology, coalesce(r.n, 0) AS value FROM (SELECT DISTINCT effective_role_level FROM r) l CROSS JOIN top t LEFT JOIN r ON r.effective_role_level = l.effective_role_level AND r.technology = t.technology"""
)
def explore_crosstab(spark, d):
    return explore.level_by_technology(_given_skills(spark, d))


@query(_FULL + "SELECT count(*) AS vacancies, count(DISTINCT employer_name) AS employers, count(*) FILTER (WHERE lower(graduate_programme) = 'yes') AS with_programme, avg(degree_required::INT::DOUBLE) AS degree_share FROM f WHERE is_early_career_target")
def explore_early_career(spark, d):
    return explore.early_career_figures(_mart_jobs(spark, d))


@query(
    _FULL
    + f"""SELECT title AS role, employer_name AS employer, industry, location_label AS location, workplace_type AS workplace, effective_role_level AS level, replace({_LISTED('skills')}, '|', ', ') AS technologies,
    strftime(last_seen_at, '%d %b %Y') AS last_seen, {X.sql_clean('application_url')} AS apply FROM f WHERE {_WHERE}"""
)
def explore_opportunities(spark, d):
    return explore.opportunities(_mart_jobs(spark, d), _WANTED)


# --- audits ----------------------------------------------------------------------------------------------------------------

_AREST = f"regexp_replace({_DESC}, '{R.AUDIT_YEARS_RANGE}', ' ; ', 'gi')"
_AENDS = f"list_concat({_years(_DESC, R.AUDIT_YEARS_RANGE, 1)}, {_years(_DESC, R.AUDIT_YEARS_RANGE, 2)})"
_AONES = f"list_concat({_years(_AREST, R.AUDIT_YEARS_SINGLE[0], 1)}, {_years(_AREST, R.AUDIT_YEARS_SINGLE[1], 1)}, {_years(_AREST, R.AUDIT_YEARS_SINGLE[2], 1)})"
_A = f"""WITH a AS (SELECT *, list_min(list_concat({_AENDS}, {_AONES})) AS lo, list_max({_AENDS}) AS hi FROM jobs WHERE is_target_market AND role_level = 'unspecified'),
b AS (SELECT job_key, company, CASE WHEN {sql_has(_TITLE, R.AUDIT_EARLY)} THEN 'likely_early_career' WHEN {sql_has(_TITLE, R.AUDIT_SENIOR)} THEN 'likely_senior' WHEN hi <= 2 THEN 'likely_early_career'
 WHEN lo >= 5 THEN 'likely_senior' WHEN lo >= 3 OR {sql_has(_TITLE, R.AUDIT_MID)} THEN 'likely_mid_level' ELSE 'ambiguous' END AS likely_level FROM a) """


@query(_A + "SELECT job_key, company, likely_level FROM b")
def audit_unspecified(spark, d):
    return audit.unspecified_roles(jobs_of(spark, d)).select("job_key", "company", "likely_level")


@query(_A + "SELECT likely_level AS label, count(*) AS n FROM b GROUP BY 1")
def audit_distribution(spark, d):
    return audit.distribution(audit.unspecified_roles(jobs_of(spark, d)), "likely_level")


@query(_A + "SELECT job_key, likely_level FROM b WHERE job_key IN (SELECT job_key FROM jobs WHERE workplace_type IN ('hybrid', 'remote') AND NOT coalesce(is_talent_pool, false))")
def audit_visible(spark, d):
    """Review rows of the jobs that a filter leaves: a semi join."""
    shown = _light_jobs(spark, d).where(Filters(workplace_types=("hybrid", "remote")).condition()).select("job_key")
    return audit.unspecified_roles(jobs_of(spark, d)).join(shown, "job_key", "left_semi").select("job_key", "likely_level")


@query("SELECT company, title, role_level, inferred_role_level, role_level_confidence, role_level_score, array_to_string(role_level_score_evidence, ' | ') AS evidence, is_talent_pool, application_url FROM jobs WHERE is_target_market")
def audit_inference(spark, d):
    return audit.role_audit(jobs_of(spark, d))


# --- ingestion -----------------------------------------------------------------------------------------------------------

@query("SELECT meta_id, CASE WHEN row_number() OVER (PARTITION BY source, source_token, content_sha256 ORDER BY meta_id) = 1 THEN 'written' ELSE 'duplicate' END AS status FROM snapshot_metadata")
def ingest_status(spark, d):
    rows = table(spark, d, "snapshot_metadata").select("meta_id", "source", "source_token", "content_sha256")
    return S.observation_status(rows, ["source", "source_token"], "content_sha256", "meta_id").select("meta_id", "status")


_STATUS = "CASE WHEN http_status <> 200 THEN 'failed' WHEN row_number() OVER (PARTITION BY source, source_token, content_sha256 ORDER BY meta_id) = 1 THEN 'written' ELSE 'duplicate' END"


@query(
    f"""WITH r AS (SELECT source AS provider, source_job_count AS n, {_STATUS} AS status FROM snapshot_metadata)
    SELECT provider, count(*) FILTER (WHERE status = 'written') AS written, count(*) FILTER (WHERE status = 'duplicate') AS duplicate, count(*) FILTER (WHERE status = 'failed') AS failed,
    sum(CASE WHEN status = 'failed' THEN 0 ELSE coalesce(n, 0) END)::BIGINT AS jobs FROM r GROUP BY 1"""
)
def ingest_run_report(spark, d):
    rows = table(spark, d, "snapshot_metadata").select("meta_id", "source", "source_token", "content_sha256", "http_status", "source_job_count")
    rows = S.observation_status(rows, ["source", "source_token"], "content_sha256", "meta_id")
    status = F.when(F.col("http_status") != 200, "failed").otherwise(F.col("status"))
    return S.run_report(rows.select(F.col("source").alias("provider"), status.alias("status"), F.col("source_job_count").alias("job_count")))


@query(
    f"""SELECT source_token, count(*) AS total_jobs, round(coalesce(count(DISTINCT internal_job_id) / nullif(count(internal_job_id), 0)::DOUBLE, 0.0), 4) AS unique_id_ratio,
    round(count(*) FILTER (WHERE nullif({X.sql_clean('title')}, '') IS NOT NULL AND nullif({X.sql_clean('content')}, '') IS NOT NULL AND nullif({X.sql_clean('absolute_url')}, '') IS NOT NULL) / count(*)::DOUBLE, 4) AS completion_ratio
    FROM greenhouse_jobs_m2 GROUP BY 1"""
)
def ingest_source_quality(spark, d):
    return S.source_quality(table(spark, d, "greenhouse_jobs_m2"), "source_token", "internal_job_id", ["title", "content", "absolute_url"])


_ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]{1,6})?)?(Z|[+-](0[0-9]|1[0-7]):?[0-5][0-9])?)?"
_SIDE = {
    "unknown_provider": "source NOT IN ('greenhouse', 'lever', 'successfactors', 'workday', 'oracle_hcm', 'wp_job_manager')", "blank_name": f"{X.sql_clean('source_name')} = ''", "blank_token": f"{X.sql_clean('source_token')} = ''",
    "blank_employer": f"employer_id IS NOT NULL AND {X.sql_clean('employer_id')} = ''", "bad_time": f"NOT coalesce(regexp_full_match({X.sql_normalize_whitespace('collected_at')}, '{_ISO}', 'i') AND try_cast(substr({X.sql_normalize_whitespace('collected_at')}, 1, 10) AS DATE) IS NOT NULL, false)",
    "bad_digest": "NOT coalesce(regexp_full_match(content_sha256, '[0-9a-f]{64}'), false)", "bad_file_name": "NOT coalesce(regexp_full_match(raw_file, '[^/\\\\]+') AND raw_file NOT IN ('.', '..'), false)", "no_count": "source_job_count IS NULL",
}


@query("SELECT violation, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS violation FROM snapshot_metadata WHERE {v}" for k, v in _SIDE.items()) + ") GROUP BY 1")
def ingest_sidecar_violations(spark, d):
    rows = table(spark, d, "snapshot_metadata").withColumns({"provider": F.col("source"), "sidecar_path": F.col("meta_id").cast("string"), "collected": X.iso_instant(F.col("collected_at"))})
    return S.sidecar_violations(rows).groupBy("violation").agg(F.count("*").alias("n"))


@query("SELECT snapshot_no, count(*) FILTER (WHERE s.job_text_sha256 = sha256(regexp_replace(coalesce(j.title, '') || chr(10) || coalesce(j.description_text, ''), '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g'))) AS n_current, count(*) AS n_rows FROM job_snapshots s JOIN jobs j USING (job_key) GROUP BY 1")
def ingest_verified_digests(spark, d):
    now = jobs_of(spark, d).select("job_key", X.job_text_sha256(F.col("title"), F.col("description_text")).alias("_now"))
    rows = table(spark, d, "job_snapshots").select("snapshot_no", "job_key", "job_text_sha256").join(now, "job_key")
    return rows.groupBy("snapshot_no").agg(F.count_if(F.col("job_text_sha256") == F.col("_now")).alias("n_current"), F.count("*").alias("n_rows"))


_PLACES, _TECH = ["gauteng", "cape", "south africa"], ["engineer", "developer", " data "]
_ANY = lambda c, terms: "(" + " OR ".join(f"contains(' ' || lower(coalesce({c}, '')) || ' ', '{t}')" for t in terms) + ")"


@query(
    f"""WITH r AS (SELECT source_token, internal_job_id, title, content, absolute_url, {_ANY("location.name", _PLACES)} AS h FROM greenhouse_jobs_m2),
    a AS (SELECT source_token, count(*) AS total_jobs, round(coalesce(count(DISTINCT internal_job_id) / nullif(count(internal_job_id), 0)::DOUBLE, 0.0), 4) AS unique_id_ratio,
    round(count(*) FILTER (WHERE nullif({X.sql_clean('title')}, '') IS NOT NULL AND nullif({X.sql_clean('content')}, '') IS NOT NULL) / count(*)::DOUBLE, 4) AS completion_ratio,
    count(*) FILTER (WHERE h) AS home_jobs, count(*) FILTER (WHERE h AND {_ANY("title", _TECH)}) AS technology_jobs FROM r GROUP BY 1)
    SELECT *, home_jobs > 0 AND unique_id_ratio = 1.0 AND completion_ratio >= 0.8 AS passed FROM a"""
)
def ingest_assessment(spark, d):
    rows = table(spark, d, "greenhouse_jobs_m2").withColumn("place", F.col("location.name"))
    return S.assess_sources(rows, "source_token", "internal_job_id", "title", "place", ["title", "content"], _PLACES, _TECH)


@query(
    r"""WITH r AS (SELECT doc_id, coalesce(text, '') AS html FROM documents), a AS (SELECT doc_id::VARCHAR AS source_token, len(list_distinct(list_filter(regexp_extract_all(html, 'href\s*=\s*[""'']([^""'']+)[""'']', 1, 'i'), lambda x: regexp_matches(x, '/')))) AS total_jobs,
    contains(lower(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)\b[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'), '\s+', ' ', 'g'))), 'team') AS has_term FROM r)
    SELECT source_token, total_jobs, total_jobs AS home_jobs, has_term AND total_jobs > 0 AS passed FROM a"""
)
def ingest_listing_assessment(spark, d):
    pages = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_token"), F.lit(200).alias("http_status"), F.lit("text/html").alias("content_type"), F.col("text").alias("html"))
    return S.assess_listings(pages, ["team"], "/", F.lit(True)).select("source_token", "total_jobs", "home_jobs", "passed")


# --- the observation history as a stream: the same rows as the batch ------------------------------------------------------

@query(ORACLES["canonical_dedup"])
def stream_latest(spark, d):
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = stream.read_observations(spark, f"{d}/job_observations.parquet")
    out = stream.latest_observations(rows, "job_key", _ORDERED).select("job_key", "title", "obs_id", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("last_seen_at").alias("last_us"), "observation_count")
    stream.run_to_table(out, f"{place}/table", f"{place}/state").awaitTermination()
    return stream.read_streamed(spark, f"{place}/table")
