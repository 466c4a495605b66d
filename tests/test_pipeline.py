"""All stages end to end on two snapshots, and what they refuse."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_tables import _snapshot, board_row, fetch_from
from vacantia.__main__ import main
from vacantia.plans import pipeline
from vacantia.sources import career_site, sinks
from vacantia.streaming.observations import daily_sightings

EMPLOYER = {"id": "acme", "name": "Acme", "parent_company": None, "brands": [], "industry": "it", "head_office_city": "c", "country": "ZA", "graduate_programme": "yes", "listed_company": False, "remote_scope": "global", "priority": "tier_1", "collection_status": "active"}


def test_stages(spark, tmp_path, capsys):
    raw, out = tmp_path / "raw", tmp_path / "out"
    _snapshot(raw, "greenhouse", "acme", "1", {"jobs": [board_row(), board_row(id=2, title="Senior Chef"), board_row(id=3, title="Graduate Developer")]})
    _snapshot(raw, "greenhouse", "acme", "2", {"jobs": [board_row(title="Junior Software Engineer"), board_row(id=3, title="Graduate Developer")]}, collected_at="2026-07-22T08:00:00Z")
    (tmp_path / "e.json").write_text(json.dumps({"schema_version": 1, "employers": [EMPLOYER]}))
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"name": "Acme", "provider": "greenhouse", "token": "acme", "employer_id": "acme"}]}))
    call = ["--raw", f"file://{raw}", "--employers", str(tmp_path / "e.json"), "--sources", str(tmp_path / "s.json")]
    assert main(["jobs", str(out), *call]) == 0
    jobs = {r.job_key: r for r in spark.read.parquet(str(out / "jobs.parquet")).collect()}
    one = jobs["greenhouse:acme:1"]
    assert len(jobs) == 3 and one.title == "Junior Software Engineer" and one.observation_count == 2 and one.employer_name == "Acme"
    assert one.first_seen_at == datetime(2026, 7, 20, 8) and one.last_seen_at == datetime(2026, 7, 22, 8)
    report = json.loads((out / "quality-report.json").read_text())
    assert report["raw_job_observation_count"] == 5 and report["role_level_counts"] == {"graduate": 1, "junior": 1, "senior": 1} and report["target_market_job_count"] == 2
    assert report["raw_snapshot_count"] == 2 and report["source_snapshot_counts"] == {"Acme": 2} and report["duplicate_observations_removed"] == 2 and report["early_career_job_count"] == 2
    assert (report["source_window_start"], report["source_window_end"]) == ("2026-07-20T08:00:00.000000+00:00", "2026-07-22T08:00:00.000000+00:00") and report["employer_counts"] == {"Acme": 3}
    assert main(["skills", str(out)]) == main(["marts", str(out)]) == main(["audits", str(out)]) == 0
    dashboard = json.loads((out / "dashboard-quality-report.json").read_text())
    assert dashboard["dashboard_job_count"] == 3 and dashboard["technology_mention_counts"] == {"Python": 3} and "small_early_career_sample" in dashboard["warnings"]
    assert dashboard["source_window_start"].startswith("2026-07-20") and dashboard["schema_version"] == 1 and dashboard["dashboard_skill_row_count"] == 3
    spark.read.parquet(str(out / "job_skills.parquet")).limit(1).withColumn("job_key", F.lit("z")).write.mode("append").parquet(str(out / "job_skills.parquet"))
    assert main(["marts", str(out)]) == 1 and "orphan_skill" in capsys.readouterr().err
    with pytest.raises(SystemExit) as e:
        main(["jobs", str(out)])
    assert e.value.code == 2
    _snapshot(raw, "greenhouse", "acme", "3", {"jobs": []}, content_sha256="1" * 64)
    with pytest.raises(pipeline.BuildError, match="unverified"):
        pipeline.build_jobs(spark, f"file://{raw}", str(tmp_path / "e.json"), str(tmp_path / "s.json"), str(out))


def test_collect_to_marts(spark, tmp_path, monkeypatch, capsys):
    """Sites are collected into the raw store, and the next stages read what is there."""
    raw, out = tmp_path / "raw", tmp_path / "out"
    sources = [
        {"name": "Acme", "provider": "greenhouse", "token": "acme", "employer_id": "acme"}, {"name": "Acme W", "provider": "workday", "token": "aw", "employer_id": "acme", "host": "https://w", "tenant": "t", "site": "s"},
        {"name": "Acme L", "provider": "lever", "token": "al", "employer_id": "acme"},
    ]
    (tmp_path / "e.json").write_text(json.dumps({"schema_version": 1, "employers": [EMPLOYER]}))
    (tmp_path / "s.json").write_text(json.dumps({"sources": sources}))

    def site(url, body):
        if "greenhouse" in url:
            return {"jobs": [board_row()]}
        if "lever" in url:
            raise OSError("down")
        return {"total": 1, "jobPostings": [{"externalPath": "/job/1", "title": "Developer"}]} if body else {"jobPostingInfo": {"jobReqId": "R1", "location": "Durban", "jobDescription": "SQL"}}

    rows = [career_site.read_site(s, fetch_from(site), datetime(2026, 7, 20, 8)) for s in sources]
    frame = spark.createDataFrame([(*r[:-2], bytearray(r[-2]) if r[-2] is not None else None, r[-1]) for r in rows], career_site.SCHEMA)
    results = {r.source_token: r.status for r in sinks.store_snapshots(spark, frame, str(raw)).collect()}
    assert results == {"acme": "written", "aw": "written", "al": "failed"}
    call = ["--employers", str(tmp_path / "e.json"), "--sources", str(tmp_path / "s.json")]
    assert main(["jobs", str(out), "--raw", f"file://{raw}", *call]) == main(["skills", str(out)]) == main(["marts", str(out)]) == 0
    jobs, skills, report = pipeline.read_marts(spark, str(out))
    assert {r.job_key for r in jobs.collect()} == {"greenhouse:acme:1", "workday:aw:R1"} and {r.technology for r in skills.collect()} == {"Python", "SQL"} and report["dashboard_job_count"] == 2
    # The stage itself, where no site answers: a failed run has its report and exit code 1; a wrong configuration 2.
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"name": "H", "provider": "successfactors", "token": "h", "employer_id": "acme", "listing_url": "https://localhost:1/x"}]}))
    assert main(["collect", str(raw), *call, "--timeout", "2"]) == 1
    (run,) = (raw / "_runs").iterdir()
    assert json.loads(run.read_text())["failed_sources"] == 1
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"name": "H", "provider": "successfactors", "token": "h", "employer_id": "acme"}]}))
    assert main(["collect", str(raw), *call]) == 2 and "incomplete" in capsys.readouterr().err
    assert main(["jobs", str(out), "--raw", f"file://{raw}", *call]) == 1
    with pytest.raises(ValueError, match="no report"):
        pipeline.read_marts(spark, str(tmp_path / "nowhere"))


def test_daily_sightings(spark):
    df = spark.createDataFrame([(datetime(2026, 7, 1, 5),), (datetime(2026, 7, 1, 9),), (None,)], "last_seen_at timestamp")
    assert [tuple(r) for r in daily_sightings(df).collect()] == [(datetime(2026, 7, 1), 2)]
