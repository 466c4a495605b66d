"""Canonical table, marts, exploration, audits, sources and streams on small rows."""

import base64
import hashlib
import json
import re
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.functions import html
from vacantia.operators import canonical, explore, marts
from vacantia.operators.explore import Filters
from vacantia.sources import career_site, registry, sinks, snapshots
from vacantia.streaming import observations as stream

T0 = datetime(2026, 7, 20)


def board_row(**kw):
    return {"id": 1, "internal_job_id": None, "title": "Junior Data Engineer", "updated_at": "2026-07-20T08:00:00Z", "absolute_url": "https://x/1", "content": "&lt;p&gt;Hybrid, Python&lt;/p&gt;", "location": {"name": "Sandton"}, "departments": [{"id": 1, "name": "Tech &eacute;"}], "offices": []} | kw


def test_board_to_canonical(spark):
    rows = spark.createDataFrame([board_row(), board_row(id=None, title=None, absolute_url=None, content=None, location=None, updated_at="soon")], "id bigint, internal_job_id bigint, title string, updated_at string, absolute_url string, content string, location struct<name:string>, departments array<struct<id:bigint,name:string>>, offices array<struct<id:bigint,name:string>>")
    meta = rows.withColumns({"source_name": F.lit("Acme"), "source_token": F.lit("acme"), "content_sha256": F.lit("0"), "snapshot_path": F.lit("p"), "collected_at": F.lit(T0)})
    good, bad = canonical.canonical_observations(canonical.from_board(meta)).orderBy("source_job_id").collect()[::-1]
    assert good.job_key == "greenhouse:acme:1" and good.city == "Johannesburg" and good.role_level == "junior" and good.is_target_market and good.description_text == "Hybrid, Python" and good.department == "Tech é"
    assert bad.data_quality_issues == ["missing_source_job_id", "missing_title", "missing_application_url", "missing_location", "missing_description", "missing_or_invalid_source_updated_at"]


def test_postings_to_canonical(spark):
    job = {"id": "a", "text": "Entry-level Tester", "country": "ZA", "workplaceType": "remote", "hostedUrl": "https://h", "applyUrl": None, "descriptionPlain": None, "description": "<p>Plain</p>", "additionalPlain": "More", "additional": None, "lists": [{"text": "You", "content": "<li>do</li>"}], "categories": {"location": "Durban", "allLocations": ["durban", "Pretoria"], "commitment": None, "team": "QA", "department": None, "level": "Senior"}}
    rows = spark.createDataFrame([(json.dumps([job]),)], "v string").select(F.explode(F.from_json("v", snapshots.POSTINGS)).alias("j")).select("j.*")
    meta = rows.withColumns({"source_name": F.lit("Acme"), "source_token": F.lit("acme"), "content_sha256": F.lit("0"), "snapshot_path": F.lit("p"), "collected_at": F.lit(T0)})
    row = canonical.canonical_observations(canonical.from_postings(meta)).first()
    assert row.location_raw == "durban, Pretoria, South Africa" and row.description_text == "Plain You do More" and row.department == "QA" and row.office is None
    assert row.workplace_type == "remote" and row.role_level == "junior" and row.application_url == "https://h" and row.data_quality_issues == []


def test_shown_lists():
    assert html.shown([" a &amp; b ", None, "A & B", "", "c"]) == ["a & b", "c"] and html.shown(None) == []
    between = lambda *rows: html.html_shown_between.func(*(pa.array(list(c)) for c in zip(*rows))).to_pylist()
    assert between(("South Africa", ["Durban"], "South Africa"), ("durban", ["Durban", "Pretoria"], None), (None, None, "Kenya")) == [["South Africa", "Durban"], ["Durban", "Pretoria"], ["Kenya"]]


def test_deduplicate(spark):
    t = lambda d: datetime(2026, 7, d)
    rows = [("k", t(20), t(20), None, "old", 1, ["a"]), ("k", t(22), t(22), t(1), "new", 1, ["b", "a"]), ("k", t(22), t(22), None, "tie", 1, None), (None, t(1), t(1), None, "x", 1, [])]
    df = spark.createDataFrame(rows, "job_key string, first_seen_at timestamp, last_seen_at timestamp, source_updated_at timestamp, title string, observation_count bigint, issues array<string>")
    out = {r.job_key: r for r in canonical.deduplicate(df, "job_key", ["last_seen_at", "source_updated_at"], issues="issues").collect()}
    assert out["k"].title == "new" and out["k"].observation_count == 3 and out["k"].first_seen_at == t(20) and out["k"].issues == ["a", "b"] and None in out
    assert canonical.deduplicate(df.limit(0), "job_key", ["last_seen_at"]).count() == 0


JOB = {"job_key": "a", "title": "Dev", "title_normalized": "dev", "company": "Acme", "employer_id": "acme", "employer_name": "Acme", "parent_company": None, "industry": None, "city": "Durban", "province": "KwaZulu-Natal", "country": None, "workplace_type": "hybrid", "role_level": "junior", "inferred_role_level": "ambiguous", "role_level_confidence": None, "is_target_market": True, "is_early_career": None, "is_talent_pool": None, "description_text": "Python and SQL", "application_url": None, "first_seen_at": T0, "last_seen_at": T0, "source_updated_at": None, "observation_count": None, "source_provider": "lever", "source_name": " ", "source_job_id": None, "employer_priority": None, "graduate_programme": "yes", "data_quality_issues": ["x", "X "]}
JOB_DDL = ", ".join(f"{k} {'timestamp' if k.endswith('_at') else 'boolean' if k.startswith('is_') else 'bigint' if k.endswith('count') else 'array<string>' if k.endswith('issues') else 'string'}" for k in JOB)


def jobs(spark, *changes):
    return spark.createDataFrame([JOB | c for c in changes or ({},)], JOB_DDL)


def test_marts_and_checks(spark):
    j = jobs(spark, {}, {"job_key": "b", "description_text": None, "is_target_market": None})
    e = marts.enriched_jobs(j)
    s, r = marts.job_skills(e), marts.job_requirements(e)
    assert marts.violations(j, s, r).count() == 0
    a, b = marts.dashboard_jobs(j, s, r).orderBy("job_key").collect()
    assert a.skills == ["Python", "SQL"] and a.skill_count == 2 and a.effective_role_level == "junior" and a.is_early_career_target and a.location_label == "Durban, KwaZulu-Natal"
    assert a.industry == "unspecified" and a.role_level_confidence == "low" and a.observation_count == 1 and a.data_quality_issues == ["x"] and a.source_name == "unspecified"
    assert b.skill_count == 0 and b.skills == [] and not b.is_target_market and b.extraction_warnings == ["missing_description", "no_skills_detected"]
    assert {x.technology: x.capability for x in marts.dashboard_skills(j, s).collect()} == {"Python": "Programming", "SQL": "Data Storage"}
    assert {x.metric: x.value for x in marts.mart_counts(marts.dashboard_jobs(j, s, r)).collect()}["target_skill_coverage_rate"] == 1.0
    assert [x.warning for x in marts.mart_warnings(marts.dashboard_jobs(j, s, r)).collect()] == ["small_early_career_sample"]
    broken = {x.violation: x.n for x in marts.violations(jobs(spark, {}, {}, {"job_key": " ", "employer_id": None}), s.unionByName(s.withColumn("job_key", F.lit("z"))), r.limit(0)).collect()}
    assert broken == {"blank_job_key": 1, "duplicate_job_key": 1, "missing_employer": 1, "orphan_skill": 2, "missing_requirement": 3}
    stale = {x.violation: x.n for x in marts.violations(jobs(spark, {"title": "Other"}, {"job_key": "b"}), s, r).collect()}
    assert stale["stale_skill"] == 2 and stale["stale_requirement"] == 2
    with pytest.raises(ValueError, match="category"):
        marts.require_columns(s.drop("category"), "skills")
    assert {x.technology: x.target_market_share for x in marts.skills_summary(s, e).collect()} == {"Python": 1.0, "SQL": 1.0}


def test_empty_marts(spark):
    j = jobs(spark).limit(0)
    e = marts.enriched_jobs(j)
    assert [r.violation for r in marts.violations(j, marts.job_skills(e), marts.job_requirements(e)).collect()] == ["empty_jobs"]
    assert [r.warning for r in marts.mart_warnings(marts.dashboard_jobs(j, marts.job_skills(e), marts.job_requirements(e))).collect()] == ["no_target_market_jobs", "small_early_career_sample"]


def test_filters(spark):
    rows = [("100% remote a\\b", "E", None, True, False, "x"), ("dev", "Dee", "p", True, None, None), ("dev", "F", "p", None, False, "SQL")]
    df = spark.createDataFrame(rows, "title string, employer_name string, province string, is_target_market boolean, is_talent_pool boolean, technology string")
    n = lambda f, t=False: df.where(f.condition(t)).count()
    assert n(Filters()) == 1 and n(Filters(exclude_pools=False)) == 2 and n(Filters(target_only=False)) == 2
    assert n(Filters(target_only=False, exclude_pools=False, provinces=(" p ", ""))) == 2
    assert n(Filters(search="A\\B")) == 1 and n(Filters(search="1%mote")) == 1 and n(Filters(target_only=False, search="sql"), True) == 1
    assert explore.chosen([" a", "a", "", None]) == ("a",)
    for bad in (("title", 3), ("province", 0)):
        with pytest.raises(ValueError):
            explore.top_values(df, *bad)
    assert [tuple(r) for r in explore.top_values(df, "province", 1).collect()] == [("p", 2)]
    assert [tuple(r) for r in explore.value_counts(df, "province", 5).collect()] == [("p", 2), ("Unspecified", 1)]


def test_crosstab(spark):
    df = spark.createDataFrame([("junior", "SQL"), ("junior", "SQL"), ("senior", "Go"), ("senior", None)], "effective_role_level string, technology string")
    assert {(r.effective_role_level, r.technology): r.value for r in explore.level_by_technology(df, 2).collect()} == {("junior", "SQL"): 2, ("junior", "Go"): 0, ("senior", "SQL"): 0, ("senior", "Go"): 1}
    assert {r.effective_role_level: (r.SQL, r.Go) for r in explore.crosstab(df, ["SQL", "Go"]).collect()} == {"junior": (2, 0), "senior": (0, 1)}


def _snapshot(root, provider, token, stamp, payload, **kw):
    folder = root / provider / token
    folder.mkdir(parents=True, exist_ok=True)
    raw = json.dumps(payload).encode()
    (folder / f"{stamp}.json").write_bytes(raw)
    meta = {"source": provider, "source_name": token.title(), "source_token": token, "collected_at": "2026-07-20T08:00:00Z", "content_sha256": hashlib.sha256(raw).hexdigest(), "source_job_count": len(payload["jobs"]) if isinstance(payload, dict) and "jobs" in payload else 1, "raw_file": f"{stamp}.json"} | kw
    (folder / f"{stamp}.metadata.json").write_text(json.dumps(meta))


def test_snapshots(spark, tmp_path):
    _snapshot(tmp_path, "greenhouse", "acme", "1", {"jobs": [board_row(), board_row(id=2)]})
    _snapshot(tmp_path, "greenhouse", "acme", "2", {"jobs": [board_row()]}, content_sha256="0" * 64)
    _snapshot(tmp_path, "lever", "beta", "1", {"jobs": []}, raw_file="../x", source="workday", collected_at="soon")
    page = {"requested_url": "https://h/job/x/9", "body_base64": base64.b64encode(b'{"items": [{"Id": "9", "Title": "QA Engineer", "PrimaryLocation": "Durban"}]}').decode(), "content_sha256": hashlib.sha256(b'{"items": [{"Id": "9", "Title": "QA Engineer", "PrimaryLocation": "Durban"}]}').hexdigest()}
    _snapshot(tmp_path, "oracle_hcm", "ora", "1", {"provider": "oracle_hcm", "public_base_url": "https://p/", "listing_pages": [page], "job_pages": [page, page], "job_index": [{"Title": "from index", "Grade": "senior"}]})
    root = f"file://{tmp_path}"
    sidecars = snapshots.read_sidecars(spark, root)
    assert sidecars.count() == 4 and snapshots.read_sidecars(spark, root, ["lever"]).count() == 1
    assert {r.violation for r in snapshots.sidecar_violations(sidecars).collect()} == {"provider_differs", "bad_time", "bad_file_name"}
    payloads = snapshots.read_payloads(spark, sidecars, root).cache()
    assert snapshots.board_jobs(payloads).count() == 2  # the second payload isn't what its digest says
    assert {(r.payload_path.split("/")[-2], r.violation) for r in snapshots.payload_violations(payloads).collect()} == {("acme", "unverified"), ("..", "unverified"), ("ora", "job_count"), ("ora", "reported_count")}
    pages = snapshots.bundle_pages(payloads).orderBy("pos").collect()
    assert [(p.page_ok, p["index"]) for p in pages] == [(True, {"Title": "from index", "Grade": "senior"}), (True, {})]
    details = snapshots.json_details(snapshots.bundle_pages(payloads), "oracle_hcm")
    rows = canonical.from_json_details(details, "oracle_hcm").collect()
    assert [(r.source_job_id, r.title, r.location_raw, r.application_url) for r in rows] == [("9", "QA Engineer", "Durban", "https://p/9")] * 2 and {r.explicit_level for r in rows} == {"senior", ""}
    made = canonical.canonical_observations(canonical.from_board(snapshots.board_jobs(payloads)))
    assert {r.job_key for r in made.collect()} == {"greenhouse:acme:1", "greenhouse:acme:2"}


def test_html_and_embedded_postings(spark):
    meta = {"source_name": F.lit("A"), "source_token": F.lit("a"), "content_sha256": F.lit(""), "snapshot_path": F.lit(""), "collected_at": F.lit(T0)}
    page = "<h1>Dev</h1><div class='jobdescription'>Text</div> Date: 3 Aug 2026"
    df = spark.createDataFrame([(page, "https://h/job/dev/77/", ("", "t", "Durban", ""))], "html string, url string, index struct<source_job_id:string,title:string,location_raw:string,published_text:string>").withColumns(meta)
    from vacantia.functions.html import html_detail_fields, html_posting_json

    row = canonical.from_html_details(df, html_detail_fields("html")).first()
    assert (row.source_job_id, row.title, row.location_raw, row.description_text) == ("77", "Dev", "Durban", "Text") and row.source_updated_at == datetime(2026, 8, 3)
    ld = '<script type="application/ld+json">{"@type":"JobPosting","title":"QA","description":"<p>Do</p>","datePosted":"2026-08-01","jobLocation":{"address":{"addressLocality":"Durban","addressCountry":"ZA"}}}</script>'
    row = canonical.from_posting_json(df.withColumn("html", F.lit(ld)).withColumn("url", F.lit("https://h/jobs/qa-1/?x")), html_posting_json("html")).first()
    assert (row.source_job_id, row.title, row.description_text, row.location_raw) == ("qa-1", "QA", "Do", "Durban, ZA")


def test_workday_details(spark):
    detail = json.dumps({"jobPostingInfo": {"jobReqId": "R1", "title": "Dev", "location": "Durban", "additionalLocations": ["Pretoria"], "jobDescription": "<p>x</p>", "startDate": "2026-07-01"}, "_public_base_url": "https://p/", "_external_path": "/job/1"})
    df = spark.createDataFrame([(detail, "A", "a", "", "", T0)], "detail string, source_name string, source_token string, content_sha256 string, snapshot_path string, collected_at timestamp")
    row = canonical.from_json_details(df, "workday").first()
    assert (row.source_job_id, row.title, row.location_raw, row.application_url, row.description_text) == ("R1", "Dev", "Durban, Pretoria", "https://p/job/1", "x")


def test_registry(spark, tmp_path):
    good = {"id": "acme", "name": "Acme", "parent_company": None, "brands": [], "industry": "it", "head_office_city": "c", "country": "ZA", "graduate_programme": "yes", "listed_company": False, "remote_scope": "global", "priority": "tier_1", "collection_status": "active"}
    (tmp_path / "e.json").write_text(json.dumps({"schema_version": 1, "employers": [good, good | {"id": "Bad ", "name": "ACME", "priority": "x", "collection_status": "paused", "brands": None}]}))
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"name": "A", "provider": "lever", "token": "a", "employer_id": "acme"}, {"name": "B", "provider": "lever", "token": "b", "employer_id": "Bad ", "listing_url": "http://x", "page_size": 0}, {"name": "C", "provider": "lever", "token": "c", "employer_id": "none", "enabled": True}, {"name": "D", "provider": "lever", "token": "d", "employer_id": "acme", "enabled": False}]}))
    e, s = registry.read_employers(spark, str(tmp_path / "e.json")), registry.read_sources(spark, str(tmp_path / "s.json"))
    assert {(r.key, r.violation) for r in registry.employer_violations(e).collect()} == {("Bad ", "untidy_id"), ("Bad ", "bad_priority"), ("Bad ", "no_brands"), ("acme", "repeated_name")}
    assert {(r.key, r.violation) for r in registry.source_violations(s, e).collect()} == {("b", "plain_http"), ("b", "bad_page_size"), ("c", "unknown_employer"), ("b", "employer_not_active")}
    assert s.count() == 3 and registry.employers_where(e, status="paused").count() == 1
    with pytest.raises(ValueError, match="zz"):
        registry.read_sources(spark, str(tmp_path / "s.json"), tokens=["a", "zz"])
    j = spark.createDataFrame([("lever", "a"), ("lever", "q")], "source_provider string, source_token string")
    assert {r.source_token: r.employer_name for r in registry.with_employers(j, s, e).collect()} == {"a": "Acme", "q": None}


def fetch_from(pages):
    """A fake site: pages(url, body) gives bytes or a JSON value."""
    def fetch(url, body=None, as_form=False):
        value = pages(url, body)
        return career_site.Answer(value if isinstance(value, bytes) else json.dumps(value).encode(), url)

    return fetch


WORKDAY = {"provider": "workday", "token": "a", "host": "https://w", "tenant": "t", "site": "s", "page_size": 20}
ORACLE = {"provider": "oracle_hcm", "token": "a", "host": "https://o", "site": "CX", "page_size": 25}
HTML = {"provider": "successfactors", "token": "a", "listing_url": "https://s/go/All/1"}
AJAX = {"provider": "wp_job_manager", "token": "a", "listing_url": "https://x/careers", "api_url": "https://x/ajax"}


def read_site(site, pages):
    return dict(zip([c.split()[0] for c in career_site.SCHEMA.split(", ")], career_site.read_site(site, fetch_from(pages), T0)))


def offset_of(url):
    return int(re.search(r"offset=(\d+)", url)[1])


def test_career_sites():
    ok = read_site({"provider": "greenhouse", "token": "a"}, lambda u, b: {"jobs": [1, 2]})
    assert ok["source_job_count"] == 2 and ok["error"] is None and ok["endpoint"].startswith("https://boards-api.greenhouse.io/v1/boards/a/jobs")
    assert "list of jobs" in read_site({"provider": "greenhouse", "token": "a"}, lambda u, b: {})["error"]
    assert "back" in read_site({"provider": "lever", "token": "a"}, lambda u, b: [{}])["error"] and read_site({"provider": "lever", "token": "a"}, lambda u, b: [])["source_job_count"] == 0
    page = b"<p>Results 1 - 1 of 1</p><table><tr><td><a href='/job/x/1?a'>X</a></td><td>Durban</td><td> </td><td>3 Aug 2026</td></tr></table>"
    row = read_site(HTML, lambda u, b: page)
    payload = json.loads(row["payload"])
    assert (row["source_job_count"], row["listing_page_count"], row["detail_page_count"]) == (1, 1, 1)
    assert payload["job_index"] == [{"source_job_id": "1", "title": "X", "location_raw": "Durban", "published_text": "3 Aug 2026", "application_url": "https://s/job/x/1"}]
    assert hashlib.sha256(row["payload"]).hexdigest() == row["content_sha256"] and payload["job_pages"][0]["source_job_id"] == "1"
    assert "how many" in read_site(HTML, lambda u, b: b"<a href='/job/x/1'>X</a>")["error"]
    assert "lacks host" in read_site({"provider": "workday", "token": "a", "tenant": "t", "site": "s"}, lambda u, b: {})["error"]
    with pytest.raises(career_site.SiteError):
        career_site.http_fetch()("http://plain")


def test_paged_sites_are_whole_or_fail():
    def workday(total, n=60):
        def pages(url, body):
            if not body:
                return {"id": url}
            listed = [{"externalPath": f"/job/j{k}", "title": f"t{k}"} for k in range(body["offset"], min(n, body["offset"] + body["limit"]))]
            return {"jobPostings": listed} | ({} if total is None else {"total": total(body["offset"])})
        return pages

    row = read_site(WORKDAY, workday(lambda o: 60))
    payload = json.loads(row["payload"])
    assert row["source_job_count"] == 60 and row["listing_page_count"] == 3 and payload["public_base_url"] == "https://w/en-US/s" and payload["job_pages"][59]["external_path"] == "/job/j59"
    assert "no total" in read_site(WORKDAY, workday(None))["error"] and "changed" in read_site(WORKDAY, workday(lambda o: 60 + o))["error"]
    assert "without new" in read_site(WORKDAY, workday(lambda o: 90))["error"] and "more than 2 pages" in read_site(WORKDAY | {"max_pages": 2}, workday(lambda o: 60))["error"]

    def oracle(more, total=None, n=100):
        def pages(url, body):
            if "Details" in url:
                return {"Id": url}
            o = offset_of(url)
            return {"items": [{"Id": k} for k in range(o, min(n, o + 25))]} | ({"hasMore": o + 25 < n} if more else {}) | ({} if total is None else {"totalResults": total})
        return pages

    for pages in (oracle(True), oracle(False), oracle(True, 100), oracle(False, 100)):
        row = read_site(ORACLE, pages)
        assert row["error"] is None and row["source_job_count"] == 100
    assert "99 of" in read_site(ORACLE, oracle(True, 120, 99))["error"]
    wrapped = read_site(ORACLE, lambda u, b: {"items": [{"TotalJobsCount": 1, "requisitionList": [{"Id": 4}]}]} if "offset" in u else {"Id": 4})
    assert wrapped["source_job_count"] == 1

    def ajax(number, n=3):
        def pages(url, body):
            if not body:
                return b"<p>job</p>"
            k = body["page"]
            links = "".join(f"<li><a href='/jobs/dev-{k}-{i}/'></a><h3>Dev {k}</h3></li>" for i in range(2)) if k <= n else ""
            return {"success": True, "data": {"html": links, "max_num_pages": number(k), "found_jobs": True}}
        return pages

    row = read_site(AJAX, ajax(lambda k: 3))
    assert row["source_job_count"] == 6 and json.loads(row["payload"])["job_index"][0] == {"source_job_id": "dev-1-0", "title": "Dev 1", "location_raw": "", "published_text": "", "application_url": "https://x/jobs/dev-1-0/"}
    assert "pages changed" in read_site(AJAX, ajax(lambda k: 3 + k))["error"] and "no links" in read_site(AJAX, ajax(lambda k: 1, 0))["error"]
    assert "failed" in read_site(AJAX, lambda u, b: {"success": False})["error"]


def test_career_source_runs_in_spark(spark):
    spark.dataSource.register(career_site.CareerSiteSource)
    rows = spark.read.format("career_site").option("sites", json.dumps([{"provider": "successfactors", "token": "a", "listing_url": "http://plain"}])).load().collect()
    assert "https" in rows[0].error and rows[0].payload is None


def site_row(token, body, day, **kw):
    row = {"provider": "greenhouse", "name": token, "token": token, "employer_id": "e", "endpoint": "https://b", "http_status": 200, "content_type": "application/json", "content_sha256": hashlib.sha256(body).hexdigest(), "byte_count": len(body), "source_job_count": 1, "listing_page_count": None, "detail_page_count": None, "collected_at": datetime(2026, 7, day), "payload": bytearray(body), "error": None}
    return row | kw


def test_raw_store(spark, tmp_path):
    root = str(tmp_path / "raw")
    status = lambda *rows: [r.status for r in sinks.store_snapshots(spark, spark.createDataFrame(rows, career_site.SCHEMA), root).collect()]
    one, two = b'{"jobs": [{"id": 1}]}', b'{"jobs": [{"id": 2}]}'
    assert status(site_row("a", one, 1)) == ["written"] and status(site_row("a", one, 2)) == ["duplicate"] and status(site_row("a", two, 3)) == ["written"]
    assert status(site_row("a", two, 3)) == ["duplicate"]  # a replay adds nothing
    assert status(site_row("a", one, 3)) == ["failed"]  # another payload of the same time is never written over
    assert status(site_row("b", one, 1), site_row("c", one, 1, error="SiteError: x", payload=None, content_sha256=None)) == ["written", "failed"]
    assert len(list((tmp_path / "raw" / "greenhouse" / "a").glob("*.metadata.json"))) == 3 and len(list((tmp_path / "raw" / "greenhouse" / "a").iterdir())) == 5
    sidecars = snapshots.read_sidecars(spark, root)
    assert snapshots.sidecar_violations(sidecars).count() == 0 and snapshots.payload_violations(snapshots.read_payloads(spark, sidecars, root)).count() == 0
    results = spark.createDataFrame([("lever", "n", "t", "written", 4, None, None, None), ("lever", "n", "u", "failed", 0, None, None, "e")], sinks.RESULT)
    report = sinks.run_document(results, T0)
    assert (report["successful_sources"], report["failed_sources"], report["total_source_jobs"], report["provider_job_counts"]) == (1, 1, 4, {"lever": 4})


def test_workday_bundle_through_the_raw_path(spark, tmp_path):
    """What a site's answers say ends up in the canonical row: nested details, the listing's fields where the detail has none."""
    detail = {"jobPostingInfo": {"jobReqId": "R1", "title": "Nested title", "location": "Durban", "additionalLocations": ["Pretoria", "durban"], "jobDescription": "<p>Build &amp; run</p>", "startDate": "2026-07-01", "timeType": "Full time"}}
    pages = lambda u, b: {"total": 1, "jobPostings": [{"externalPath": "/job/x_R1", "title": "Graduate Developer", "postedOn": "2026-06-30", "bulletFields": ["R1"]}]} if b else detail
    row = read_site(WORKDAY, pages)
    sinks.store_snapshots(spark, spark.createDataFrame([row | {"payload": bytearray(row["payload"])}], career_site.SCHEMA), str(tmp_path))
    sidecars = snapshots.read_sidecars(spark, str(tmp_path), ["workday"])
    payloads = snapshots.read_payloads(spark, sidecars, str(tmp_path), ["workday"])
    assert snapshots.payload_violations(payloads).count() == 0
    got = canonical.from_json_details(snapshots.json_details(snapshots.bundle_pages(payloads), "workday"), "workday").first()
    assert (got.source_job_id, got.title, got.location_raw, got.office, got.description_text) == ("R1", "Graduate Developer", "Durban, Pretoria", "Durban", "Build & run")
    assert got.application_url == "https://w/en-US/s/job/x_R1" and got.explicit_workplace == "Full time" and got.snapshot_path if "snapshot_path" in got else True
    assert got.source_updated_at is not None and got.source_snapshot_path.startswith("workday/a/")
    with pytest.raises(ValueError, match="no snapshots"):
        snapshots.read_sidecars(spark, str(tmp_path), ["lever"])


def test_payload_violations(spark, tmp_path):
    def page(body):
        return {"requested_url": "https://h/1", "body_base64": base64.b64encode(body).decode(), "content_sha256": hashlib.sha256(body).hexdigest()}

    good = {"provider": "workday", "reported_job_count": 1, "listing_pages": [page(b"{}")], "job_pages": [page(b"{}")], "job_index": [{}]}
    cases = {
        "good": (good, {}), "other": (good | {"provider": "oracle_hcm"}, {}), "empty": (good | {"listing_pages": []}, {}), "nopages": (good | {"job_pages": None}, {"source_job_count": 1}),
        "reported": (good | {"reported_job_count": 4}, {}), "unsound": (good | {"listing_pages": [page(b"{}") | {"content_sha256": "0"}], "job_pages": [], "reported_job_count": 0}, {"source_job_count": 0}),
        "list": (good | {"job_pages": [page(b"[]")]}, {}), "count": (good | {"reported_job_count": 2}, {"source_job_count": 2}), "text": ("x", {"source_job_count": 0}), "digest": (good, {"content_sha256": "1" * 64}),
    }
    for token, (payload, kw) in cases.items():
        _snapshot(tmp_path, "workday", token, "1", payload, **kw)
    sidecars = snapshots.read_sidecars(spark, str(tmp_path))
    got = {}
    for r in snapshots.payload_violations(snapshots.read_payloads(spark, sidecars, str(tmp_path))).collect():
        got.setdefault(r.payload_path.split("/")[-2], set()).add(r.violation)
    assert got == {"other": {"wrong_provider"}, "empty": {"no_listing_pages"}, "nopages": {"no_pages", "job_count"}, "reported": {"reported_count"}, "unsound": {"unsound_page"}, "list": {"no_json_detail"}, "count": {"job_count"}, "text": {"no_payload", "job_count"}, "digest": {"unverified"}}


def test_employer_agreement(spark):
    s = spark.createDataFrame([("lever", "a", "acme"), ("lever", "b", "acme")], "provider string, token string, employer_id string")
    seen = spark.createDataFrame([("lever", "a", "acme"), ("lever", "a ", None), ("lever", "b", "other"), ("lever", "b", " "), ("lever", "z", "acme")], "provider string, source_token string, employer_id string")
    assert sorted(map(tuple, registry.employer_disagreements(seen, s).collect())) == [("lever", "b", "employer_differs"), ("lever", "z", "unknown_source")]


def test_reports_are_read_with_their_keys(spark, tmp_path):
    sinks.write_json(str(tmp_path / "r.json"), {"a": 1})
    assert sinks.read_report(str(tmp_path / "r.json"), ["a"]) == {"a": 1}
    for name, need in (("r.json", ["b"]), ("none.json", [])):
        with pytest.raises(ValueError):
            sinks.read_report(str(tmp_path / name), need)
    assert sinks.read_csv(spark, str(tmp_path / "none.csv"), "x int, y string").count() == 0
    (tmp_path / "t.csv").write_text("x,y\n1,a\nbad\n")
    assert [tuple(r) for r in sinks.read_csv(spark, str(tmp_path / "t.csv"), "x int, y string").collect()] == [(1, "a")]


def test_run_report_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("lever", "written", 3), ("lever", "failed", 9), ("workday", "duplicate", None)], "provider string, status string, job_count int")
    assert {r.provider: (r.written, r.duplicate, r.failed, r.jobs) for r in snapshots.run_report(df).collect()} == {"lever": (1, 0, 1, 3), "workday": (0, 1, 0, 0)}
    j = jobs(spark, {}, {"job_key": "b", "industry": "it"}).withColumns({"is_south_africa": F.lit(True), "is_technology_role": F.lit(True), "role_level_evidence": F.array(F.lit("x"))})
    report = sinks.report_json(*canonical.transform_report(j))
    assert report["canonical_job_count"] == 2 and sum(report["industry_counts"].values()) == 2 and report["data_quality_issue_counts"] == {"x": 2, "X ": 2}
    sinks.write_json(str(tmp_path / "r" / "report.json"), report)
    assert json.loads((tmp_path / "r" / "report.json").read_text()) == report
    sinks.write_table(j, str(tmp_path / "t"))
    sinks.write_csv(j.select("job_key", "data_quality_issues"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "c")).first().data_quality_issues == "x | X "


def test_streamed_history_equals_batch(spark, tmp_path):
    rows = [(f"k{i % 7}", datetime(2026, 7, 1 + i % 20), datetime(2026, 7, 1 + i % 20), f"t{i}", 1) for i in range(60)]
    ddl = "job_key string, first_seen_at timestamp, last_seen_at timestamp, title string, observation_count bigint"
    for k in range(3):
        spark.createDataFrame(rows[k::3], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = stream.latest_observations(stream.read_observations(spark, str(tmp_path / "in"), 1), "job_key", ["last_seen_at", "title"])
    stream.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = canonical.deduplicate(spark.createDataFrame(rows, ddl), "job_key", ["last_seen_at", "title"])
    assert sorted(map(tuple, stream.read_streamed(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, want.collect()))
