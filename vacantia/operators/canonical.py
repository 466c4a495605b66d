"""Provider postings to the canonical job table, its deduplication and its quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions.html import html_shown, html_shown_between, html_unescape, html_visible_text
from vacantia.functions.text import blank_to_null, iso_instant, iso_text, normalize_whitespace, normalized_key, source_date, stable_key
from vacantia.functions.terms import scan
from vacantia.operators.classify import (
    LEVEL_RULES,
    LOCATION_RULES,
    SCORE_RULES,
    TECHNOLOGY_RULES,
    WORKPLACE_RULES,
    classify_location,
    classify_role_level,
    classify_technology,
    classify_workplace,
    score_role,
)

#: Columns that a provider's mapping gives, before classification.
MAPPED = [
    "source_provider", "source_name", "source_token", "source_job_id", "source_snapshot_sha256", "source_snapshot_path", "collected_at",
    "source_updated_at", "title", "department", "office", "location_raw", "description_text", "application_url", "explicit_workplace", "explicit_level",
]
CANONICAL = [
    "job_key", "source_provider", "source_name", "source_token", "source_job_id", "source_snapshot_sha256", "source_snapshot_path", "first_seen_at",
    "last_seen_at", "source_updated_at", "observation_count", "title", "title_normalized", "company", "department", "office", "location_raw", "city",
    "province", "country", "location_evidence", "is_south_africa", "workplace_type", "role_level", "role_level_evidence", "is_technology_role",
    "technology_evidence", "is_early_career", "is_target_market", "description_text", "application_url", "data_quality_issues", "inferred_role_level",
    "role_level_score", "role_level_confidence", "role_level_score_evidence", "is_talent_pool",
]


def display(c: Column) -> Column:
    """Text for display: character references decoded once, white space collapsed; null becomes empty."""
    return normalize_whitespace(html_unescape(F.coalesce(c.cast("string"), F.lit(""))))


def named_values(c: Column) -> Column:
    """Unique names of an array of structs, joined by commas; null if none."""
    return F.nullif(F.array_join(html_shown(F.transform(c, lambda x: x["name"])), ", "), F.lit(""))


def from_board(df: DataFrame) -> DataFrame:
    """Board postings (id, internal_job_id, title, updated_at, absolute_url, content, location, departments, offices) to MAPPED."""
    office = named_values(F.col("offices"))
    return df.select(
        *_source_columns("greenhouse"),
        F.coalesce(F.col("id"), F.col("internal_job_id")).cast("string").alias("source_job_id"),
        iso_instant(F.col("updated_at")).alias("source_updated_at"),
        display(F.col("title")).alias("title"),
        named_values(F.col("departments")).alias("department"),
        office.alias("office"),
        F.coalesce(F.nullif(display(F.col("location.name")), F.lit("")), office, F.lit("")).alias("location_raw"),
        html_visible_text("content").alias("description_text"),
        display(F.col("absolute_url")).alias("application_url"),
        *_no_explicit(),
    ).select(*MAPPED)


def from_postings(df: DataFrame) -> DataFrame:
    """Postings with categories (id, text, country, workplaceType, urls, plain and markup descriptions, lists) to MAPPED."""
    # Headings and contents of the lists are read in one pass.
    lists = F.coalesce("lists", F.array().cast(dict(df.dtypes)["lists"]))
    joined = F.array_join(F.transform(lists, lambda x: F.concat_ws(" ", x["text"], x["content"])), " ")
    base = df.withColumns({"_d": html_visible_text("description"), "_a": html_visible_text("additional"), "_l": html_visible_text(joined)})
    text = F.concat_ws(
        " ",
        F.coalesce(F.nullif(display(F.col("descriptionPlain")), F.lit("")), F.col("_d")),
        F.col("_l"),
        F.coalesce(F.nullif(display(F.col("additionalPlain")), F.lit("")), F.col("_a")),
    )
    c = F.col("categories")
    country = F.create_map(*[F.lit(x) for kv in R.COUNTRY_CODES.items() for x in kv])[F.upper(display(F.col("country")))]
    # The country comes last; the main place first, unless it is listed.
    places = html_shown_between(c["location"], c["allLocations"], country)
    team = F.nullif(display(c["team"]), F.lit(""))
    department = F.coalesce(F.nullif(display(c["department"]), F.lit("")), team)
    return base.select(
        *_source_columns("lever"),
        F.col("id").alias("source_job_id"),
        F.lit(None).cast("timestamp").alias("source_updated_at"),
        display(F.col("text")).alias("title"),
        department.alias("department"),
        F.when(team != department, team).alias("office"),
        F.array_join(places, ", ").alias("location_raw"),
        normalize_whitespace(text).alias("description_text"),
        F.coalesce(F.nullif(display(F.col("applyUrl")), F.lit("")), display(F.col("hostedUrl"))).alias("application_url"),
        display(F.col("workplaceType")).alias("explicit_workplace"),
        display(c["level"]).alias("explicit_level"),
    ).select(*MAPPED)


def first_field(detail: Column, *names: str, nested: str | None = None) -> Column:
    """The first of some fields of a JSON text that is not null or empty; then the same inside a nested object."""
    paths = [f"$.{n}" for n in names] + ([f"$.{nested}.{n}" for n in names] if nested else [])
    values = [F.nullif(F.get_json_object(detail, p), F.lit("")) for p in paths]
    return F.coalesce(*[F.when(~v.isin("[]", "{}"), v) for v in values])


def from_json_details(df: DataFrame, provider: str) -> DataFrame:
    """Details of REST providers (a JSON column ``detail`` with _detail_url, _public_base_url, _external_path) to MAPPED."""
    d = F.col("detail")
    base_url = F.regexp_replace(display(first_field(d, "_public_base_url")), "/+$", "")
    if provider == "workday":
        get = lambda *n: first_field(d, *n, nested="jobPostingInfo")
        more = get("additionalLocations", "locationsText")
        parts = F.when(more.startswith("["), F.from_json(more, "array<string>")).otherwise(F.array(more))
        location = F.array_join(html_shown(F.concat(F.array(get("location", "primaryLocation")), F.coalesce(parts, F.array().cast("array<string>")))), ", ")
        path = F.regexp_replace(display(F.coalesce(first_field(d, "_external_path"), get("externalPath"))), "^/+", "")
        url = F.when((path != "") & (base_url != ""), F.concat(base_url, F.lit("/"), path)).otherwise(display(first_field(d, "_detail_url")))
        own = (get("jobReqId", "requisitionId", "id"), get("title", "jobTitle"), get("jobFamily", "jobCategory", "businessUnit"), get("location"), location, get("jobDescription", "description"), url, get("startDate", "postedOn", "datePosted"), get("timeType", "workplaceType"), F.lit(""))
    else:
        get = lambda *n: first_field(d, *n)
        source_id = display(get("Id", "ID", "RequisitionId", "RequisitionNumber", "requisitionNumber"))
        url = F.when((base_url != "") & (source_id != ""), F.concat(base_url, F.lit("/"), F.replace(F.url_encode(source_id), F.lit("+"), F.lit("%20")))).otherwise(display(get("ExternalApplyURL", "ApplyUrl", "JobUrl", "_detail_url")))
        own = (source_id, get("Title", "JobTitle", "title"), get("JobFunction", "JobFamily", "Department", "BusinessUnit"), get("PrimaryLocation"), display(get("PrimaryLocation", "Location", "JobLocation", "primaryLocation")), get("ExternalDescriptionStr", "ExternalDescription", "Description", "description"), url, get("PostedDate", "PostingDate", "LastUpdateDate", "datePosted"), get("WorkplaceType", "RemoteType"), get("JobLevel", "Grade"))
    names = ["source_job_id", "title", "department", "office", "location_raw", "_body", "application_url", "_date", "explicit_workplace", "explicit_level"]
    rows = df.select("*", *[c.alias(n) for n, c in zip(names, own)])
    return rows.select(
        *_source_columns(provider),
        display(F.col("source_job_id")).alias("source_job_id"),
        iso_instant(F.col("_date")).alias("source_updated_at"),
        display(F.col("title")).alias("title"),
        F.nullif(display(F.col("department")), F.lit("")).alias("department"),
        F.nullif(display(F.col("office")), F.lit("")).alias("office"),
        "location_raw",
        html_visible_text("_body").alias("description_text"),
        "application_url",
        display(F.col("explicit_workplace")).alias("explicit_workplace"),
        display(F.col("explicit_level")).alias("explicit_level"),
    ).select(*MAPPED)


def from_html_details(df: DataFrame, fields: Column) -> DataFrame:
    """HTML detail pages (columns html, url, index STRUCT<source_job_id, title, location_raw, published_text>) to MAPPED.

    ``fields``: html_detail_fields of the page. What the page lacks comes from the listing's index.
    """
    rows = df.withColumn("_f", fields)
    pick = lambda name: F.coalesce(F.nullif(display(F.col(f"_f.{name}")), F.lit("")), display(F.col(f"index.{name}")))
    by_url = F.regexp_extract("url", r"(?i)/job/[^?#]+/(\d+)/?(?:[?#]|$)", 1)
    return rows.select(
        *_source_columns("successfactors"),
        F.coalesce(F.nullif(display(F.col("index.source_job_id")), F.lit("")), by_url).alias("source_job_id"),
        source_date(pick("published_text")).alias("source_updated_at"),
        pick("title").alias("title"),
        F.lit(None).cast("string").alias("department"),
        F.lit(None).cast("string").alias("office"),
        pick("location_raw").alias("location_raw"),
        F.coalesce(F.col("_f.description_text"), F.lit("")).alias("description_text"),
        F.col("url").alias("application_url"),
        *_no_explicit(),
    ).select(*MAPPED)


def from_posting_json(df: DataFrame, posting: Column) -> DataFrame:
    """Pages with an embedded job posting (columns html, url) to MAPPED; ``posting``: html_posting_json of the page."""
    address = "struct<addressLocality:string,addressRegion:string,addressCountry:string>"
    rows = df.withColumn("_j", posting)
    place = F.get_json_object("_j", "$.jobLocation")
    entries = F.when(place.startswith("["), F.from_json(place, f"array<struct<address:{address}>>")).otherwise(F.array(F.from_json(place, f"struct<address:{address}>")))
    parts = html_shown(F.flatten(F.transform(entries, lambda e: F.array(*[e["address"][k] for k in ("addressLocality", "addressRegion", "addressCountry")]))))
    get = lambda *n: first_field(F.col("_j"), *n)
    rows = rows.withColumns({"_b": html_visible_text(get("description")), "_page": html_visible_text("html")})
    return rows.select(
        *_source_columns("wp_job_manager"),
        F.element_at(F.split(F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/+$", ""), "/"), -1).alias("source_job_id"),
        iso_instant(get("datePosted")).alias("source_updated_at"),
        display(get("title")).alias("title"),
        F.nullif(display(get("industry", "occupationalCategory")), F.lit("")).alias("department"),
        F.lit(None).cast("string").alias("office"),
        F.array_join(parts, ", ").alias("location_raw"),
        F.coalesce(F.nullif(F.col("_b"), F.lit("")), F.col("_page")).alias("description_text"),
        F.col("url").alias("application_url"),
        display(get("jobLocationType")).alias("explicit_workplace"),
        display(get("experienceRequirements")).alias("explicit_level"),
    ).select(*MAPPED)


def _source_columns(provider: str) -> list[Column]:
    return [F.lit(provider).alias("source_provider"), display(F.col("source_name")).alias("source_name"), display(F.col("source_token")).alias("source_token"), F.col("content_sha256").alias("source_snapshot_sha256"), F.col("snapshot_path").alias("source_snapshot_path"), F.col("collected_at")]


def _no_explicit() -> list[Column]:
    return [F.lit("").alias("explicit_workplace"), F.lit("").alias("explicit_level")]


def canonical_observations(mapped: DataFrame) -> DataFrame:
    """One classified canonical row per mapped posting; missing fields are flagged, never dropped."""
    texts = {"title": "title", "location": "location_raw", "description": "description_text", "explicit": "explicit_level", "department": "department"}
    out = scan(mapped, (*LOCATION_RULES, *WORKPLACE_RULES, *LEVEL_RULES, *TECHNOLOGY_RULES, *SCORE_RULES), **{k: F.col(c) for k, c in texts.items()})
    out = classify_location(out, "location_raw", "description_text", "_terms")
    out = classify_workplace(out, "title", "location_raw", "description_text", "explicit_workplace", "_terms")
    out = classify_role_level(out, "title", "description_text", "explicit_level", "_terms")
    out = classify_technology(out, "title", "department", "description_text", "_terms")
    out = score_role(out, "title", "description_text", "role_level", "_terms")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    issues = [F.when(blank(c), name) for c, name in (("source_job_id", "missing_source_job_id"), ("title", "missing_title"), ("application_url", "missing_application_url"), ("location_raw", "missing_location"), ("description_text", "missing_description"))]
    issues.append(F.when(F.col("source_provider").isin("greenhouse", "successfactors") & F.col("source_updated_at").isNull(), "missing_or_invalid_source_updated_at"))
    key = stable_key(*[F.col(c) for c in ("source_provider", "source_token", "source_job_id", "application_url", "source_name", "title", "location_raw", "description_text")])
    return out.withColumns(
        {
            "job_key": key, "first_seen_at": F.col("collected_at"), "last_seen_at": F.col("collected_at"), "observation_count": F.lit(1).cast("long"),
            "title_normalized": normalized_key(F.col("title")), "company": F.col("source_name"), "is_target_market": F.col("is_south_africa") & F.col("is_technology_role"),
            "data_quality_issues": F.array_compact(F.array(*issues)),
        }
    ).select(*CANONICAL)


def deduplicate(df: DataFrame, key: str, order: Sequence[str], first: str = "first_seen_at", last: str = "last_seen_at", count: str = "observation_count", issues: str | None = None) -> DataFrame:
    """The latest row per key with the window over all rows: least ``first``, greatest ``last``, number of rows, union of issues.

    ``order``: columns, latest is greatest, null lowest; ties fall to the greatest of the remaining columns' hash, so
    that the result doesn't depend on the order of rows. One aggregation; the partial one keeps one row per key and task.
    Null keys form a group of their own. Extra columns come with the latest row. An empty table gives no rows.
    """
    rest = [c for c in df.columns if c not in (key, first, last, count, issues)]
    hashable = [F.to_json(F.struct(F.col(c))) for c in rest]
    latest = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.xxhash64(*hashable).alias("_h"), F.struct(*rest).alias("row")))
    aggs = [latest.alias("_l"), F.min(first).alias(first), F.max(last).alias(last), F.count("*").alias(count)]
    if issues:
        aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(issues)))).alias(issues))
    out = df.groupBy(key).agg(*aggs)
    picked = {c: F.col(f"_l.row.{c}") for c in rest}
    return out.select(*[picked[c].alias(c) if c in picked else F.col(c) for c in df.columns])


def label_counts(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, label, n) of several label columns in one pass: rows are exploded to (metric, label) and counted once."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("string").alias("label")) for m, c in metrics.items()]))
    return df.select(pairs.alias("p")).groupBy("p.metric", "p.label").agg(F.count("*").alias("n"))


def tidy(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(metric, value DOUBLE) of several aggregates of one pass."""
    one = df.agg(*[c.cast("double").alias(k) for k, c in values.items()])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[F.col(k) for k in values]))).alias("metric", "value"))


def snapshot_window(sidecars: DataFrame) -> dict:
    """First and last time of collection as ISO text, and the number of snapshots."""
    return sidecars.agg(iso_text(F.min("collected")).alias("source_window_start"), iso_text(F.max("collected")).alias("source_window_end"), F.count("*").alias("raw_snapshot_count")).first().asDict()


def transform_report(jobs: DataFrame, sidecars: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(counts, label counts) of a canonical table: the build's quality report in tidy form; with ``sidecars`` also snapshots by source."""
    target, early = F.col("is_target_market"), F.col("is_early_career")
    sa_tech = F.col("is_south_africa") & F.col("is_technology_role")
    counts = tidy(jobs, {
        "canonical_job_count": F.count("*"), "south_africa_job_count": F.count_if("is_south_africa"), "technology_job_count": F.count_if("is_technology_role"),
        "south_africa_technology_job_count": F.count_if(sa_tech), "target_market_job_count": F.count_if(target), "early_career_job_count": F.count_if(early),
        "early_career_target_market_job_count": F.count_if(early & target), "talent_pool_job_count": F.count_if("is_talent_pool"), "role_level_evidence_count": F.count_if(F.size("role_level_evidence") > 0),
        "raw_job_observation_count": F.sum("observation_count"), "duplicate_observations_removed": F.sum("observation_count") - F.count("*"),
    })
    said = lambda c: F.coalesce(blank_to_null(F.col(c)), F.lit("unspecified"))
    named = {f"{c}_counts": said(c) for c in ("role_level", "inferred_role_level", "role_level_confidence", "workplace_type", "company", "industry")}
    named |= {"employer_counts": said("employer_name"), "provider_job_counts": said("source_provider"), "parent_company_counts": F.coalesce(blank_to_null(F.col("parent_company")), F.col("employer_name"))}
    # Maps of a part of the jobs: null metrics are left out of the same single pass.
    part = lambda name, which: F.when(which, name)
    parts = [(part("target_market_role_level_counts", target), said("role_level")), (part("target_market_company_counts", target), said("company")), (part("target_market_inferred_role_level_counts", target), said("inferred_role_level")), (part("south_africa_technology_role_level_counts", sa_tech), said("role_level")), (part("early_career_target_market_company_counts", target & early), said("company"))]
    pairs = [F.struct(F.lit(m).alias("metric"), c.cast("string").alias("label")) for m, c in named.items()] + [F.struct(m.alias("metric"), c.alias("label")) for m, c in parts]
    issues = F.transform(F.coalesce("data_quality_issues", F.array().cast("array<string>")), lambda x: F.struct(F.lit("data_quality_issue_counts").alias("metric"), x.alias("label")))
    rows = jobs.select(F.explode(F.concat(F.array(*pairs), issues)).alias("p")).where("p.metric is not null")
    labels = rows.groupBy("p.metric", "p.label").agg(F.count("*").alias("n"))
    if sidecars is not None:
        labels = labels.unionByName(label_counts(sidecars, {"source_snapshot_counts": F.col("source_name")}))
    return counts, labels
