"""python -m vacantia collect|jobs|skills|marts|audits OUT [--raw DIR --employers FILE --sources FILE]; exit codes: 0 done, 1 a source or check failed, 2 wrong call or configuration."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from vacantia.plans import pipeline
from vacantia.session import ship_package


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="vacantia")
    parser.add_argument("stage", choices=["collect", "jobs", "skills", "marts", "audits"])
    parser.add_argument("out", help="folder of the results; of collect, the raw store")
    for name in ("raw", "employers", "sources"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--token", action="append", help="collect this source only; may be given more than once")
    parser.add_argument("--timeout", type=float, default=30.0)
    call = parser.parse_args(args)
    if call.stage in ("collect", "jobs") and not (call.employers and call.sources and (call.raw or call.stage == "collect")):
        parser.error(f"{call.stage} needs --employers and --sources" + ", jobs also --raw" * (call.stage == "jobs"))
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship_package(spark)
    try:
        if call.stage == "collect":
            report = pipeline.collect(spark, call.out, call.employers, call.sources, call.token, call.timeout)
            for r in report["results"]:
                print(f"{r['status']} {r['source_provider']} {r['source_token']} {r['job_count']} jobs" + (f": {r['error']}" if r["error"] else ""))
            return int(report["failed_sources"] > 0)
        if call.stage == "jobs":
            pipeline.build_jobs(spark, call.raw, call.employers, call.sources, call.out)
        else:
            {"skills": pipeline.build_skills, "marts": pipeline.build_marts, "audits": pipeline.build_audits}[call.stage](spark, call.out)
    except (pipeline.BuildError, ValueError) as e:
        print(f"{call.stage}: {e}", file=sys.stderr)
        return 2 if call.stage == "collect" else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
