"""Employer registry and source configuration: reading, and every rule they must keep as rows of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions.text import strip

EMPLOYER = "id string, name string, parent_company string, brands array<string>, industry string, head_office_city string, country string, graduate_programme string, listed_company boolean, remote_scope string, priority string, collection_status string"
SOURCE = "name string, provider string, token string, employer_id string, enabled boolean, listing_url string, api_url string, host string, tenant string, site string, page_size int, max_pages int, request_delay_seconds double, priority int"
# Allowed labels of a registry.
PRIORITIES = ["tier_1", "tier_2", "tier_3"]
NEEDED = {"successfactors": ["listing_url"], "workday": ["host", "tenant", "site"], "oracle_hcm": ["host", "site"], "wp_job_manager": ["listing_url", "api_url"], "greenhouse": [], "lever": []}
STATUSES = ["active", "candidate", "paused", "retired"]
SCOPES = ["south_africa", "africa", "emea", "global", "multi_country", "unknown"]


def read_employers(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a registry file {"schema_version": 1, "employers": [...]}."""
    return spark.read.schema(f"schema_version int, employers array<struct<{_struct(EMPLOYER)}>>").option("multiLine", True).json(path).select(F.explode("employers").alias("e")).select("e.*")


def read_sources(spark: SparkSession, path: str, providers: list[str] | None = None, tokens: list[str] | None = None) -> DataFrame:
    """Enabled sources of a configuration file {"sources": [...]}; an unknown token is an error."""
    rows = spark.read.schema(f"sources array<struct<{_struct(SOURCE)}>>").option("multiLine", True).json(path).select(F.explode("sources").alias("s")).select("s.*")
    rows = rows.where(F.coalesce("enabled", F.lit(True)))
    if providers:
        rows = rows.where(F.col("provider").isin(providers))
    if tokens:
        have = {r.token for r in rows.where(F.col("token").isin(tokens)).select("token").distinct().collect()}
        if missing := sorted(set(tokens) - have):
            raise ValueError(f"unknown sources: {', '.join(missing)}")
        rows = rows.where(F.col("token").isin(tokens))
    return rows


def _struct(ddl: str) -> str:
    return ", ".join(f"{part.split(' ', 1)[0]}:{part.split(' ', 1)[1]}" for part in ddl.split(", "))


def _rows(df: DataFrame, key: str, rules: dict) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), name) for name, c in rules.items()]))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("violation"))


def _repeated(df: DataFrame, name: str, *columns) -> DataFrame:
    keys = [c.alias(f"k{i}") for i, c in enumerate(columns)]
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(F.concat_ws(":", *[f"k{i}" for i in range(len(columns))]).alias("key"), F.lit(name).alias("violation"))


def employer_violations(e: DataFrame) -> DataFrame:
    """(key, violation) of a registry: ids trimmed, lower case and unique; names unique but for case; labels as allowed."""
    rules = {
        "blank_id": F.col("id").isNull() | (strip(F.col("id")) == ""), "untidy_id": F.col("id") != F.lower(strip(F.col("id"))), "blank_name": F.col("name").isNull() | (strip(F.col("name")) == ""),
        "bad_priority": ~F.col("priority").isin(PRIORITIES), "bad_status": ~F.col("collection_status").isin(STATUSES), "bad_scope": ~F.col("remote_scope").isin(SCOPES),
        "no_brands": F.col("brands").isNull(), "no_listing": F.col("listed_company").isNull(), **{f"no_{c}": F.col(c).isNull() for c in ("industry", "head_office_city", "country", "graduate_programme")},
    }
    return _rows(e, "id", rules).unionByName(_repeated(e, "repeated_id", F.col("id"))).unionByName(_repeated(e, "repeated_name", F.lower("name")))


def source_violations(s: DataFrame, e: DataFrame) -> DataFrame:
    """(key, violation) of sources: tidy values, unique (provider, token), and an employer in the registry, active if enabled."""
    rules = {
        "blank_token": F.col("token").isNull() | (strip(F.col("token")) == ""), "unknown_provider": ~F.col("provider").isin(list(NEEDED)),
        "plain_http": F.exists(F.array("listing_url", "api_url", "host"), lambda u: F.coalesce(~F.lower(u).startswith("https://"), F.lit(False))),
        "incomplete": F.exists(F.create_map(*[x for p, names in NEEDED.items() for x in (F.lit(p), F.array(*[F.coalesce(strip(F.col(n)), F.lit("")) for n in names]).cast("array<string>"))])[F.col("provider")], lambda v: v == "") & F.col("provider").isin(list(NEEDED)),
        "bad_page_size": F.coalesce(F.col("page_size") <= 0, F.lit(False)) | F.coalesce(F.col("max_pages") <= 0, F.lit(False)), "bad_delay": F.coalesce(F.col("request_delay_seconds") < 0, F.lit(False)),
    }
    known = e.select(F.col("id").alias("employer_id"), "collection_status")
    return (
        _rows(s, "token", rules)
        .unionByName(_repeated(s, "repeated_source", F.col("provider"), F.col("token")))
        .unionByName(s.join(known, "employer_id", "left_anti").select(F.col("token").alias("key"), F.lit("unknown_employer").alias("violation")))
        .unionByName(s.where(F.coalesce("enabled", F.lit(True))).join(known.where("collection_status <> 'active'"), "employer_id").select(F.col("token").alias("key"), F.lit("employer_not_active").alias("violation")))
    )


def with_employers(jobs: DataFrame, sources: DataFrame, employers: DataFrame) -> DataFrame:
    """Jobs with the attributes of their source's employer; jobs whose source or employer is unknown get nulls, see source_violations."""
    link = sources.select(F.col("provider").alias("source_provider"), F.col("token").alias("source_token"), "employer_id")
    e = employers.select(F.col("id").alias("employer_id"), F.col("name").alias("employer_name"), "parent_company", "industry", F.col("priority").alias("employer_priority"), "graduate_programme", F.col("remote_scope").alias("employer_remote_scope"))
    return jobs.join(link, ["source_provider", "source_token"], "left").join(e, "employer_id", "left")


def employer_disagreements(sidecars: DataFrame, sources: DataFrame) -> DataFrame:
    """(provider, token, violation) of snapshots whose source isn't configured, or that name another employer than it."""
    own = sidecars.select("provider", strip(F.col("source_token")).alias("token"), strip(F.col("employer_id")).alias("own")).distinct()
    rows = own.join(sources.select("provider", "token", F.col("employer_id").alias("known")), ["provider", "token"], "left")
    what = F.when(F.col("known").isNull(), "unknown_source").when((F.col("own") != "") & (F.col("own") != F.col("known")), "employer_differs")
    return rows.select("provider", "token", what.alias("violation")).where("violation is not null").distinct()


def employers_where(e: DataFrame, priority: str | None = None, status: str | None = None) -> DataFrame:
    out = e if priority is None else e.where(F.col("priority") == priority)
    return out if status is None else out.where(F.col("collection_status") == status)
