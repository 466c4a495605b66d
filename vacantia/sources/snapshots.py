"""Raw snapshots: sidecars, hash-verified payloads, and the postings in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.functions.text import blank_to_null, iso_instant, matching_links, strip_html_tags

PROVIDERS = ["greenhouse", "lever", "successfactors", "workday", "oracle_hcm", "wp_job_manager"]
_S, _L = T.StringType(), T.LongType()
SIDECAR = T.StructType(
    [T.StructField(c, _S) for c in ("source", "source_name", "source_token", "endpoint", "collected_at")]
    + [T.StructField("http_status", _L)]
    + [T.StructField(c, _S) for c in ("content_type", "content_sha256")]
    + [T.StructField("byte_count", _L), T.StructField("source_job_count", _L), T.StructField("raw_file", _S), T.StructField("employer_id", _S), T.StructField("listing_page_count", _L), T.StructField("detail_page_count", _L)]
)
BOARD = "struct<jobs:array<struct<id:bigint,internal_job_id:bigint,title:string,updated_at:string,absolute_url:string,content:string,location:struct<name:string>,departments:array<struct<id:bigint,name:string>>,offices:array<struct<id:bigint,name:string>>>>>"
POSTINGS = "array<struct<id:string,text:string,country:string,workplaceType:string,hostedUrl:string,applyUrl:string,descriptionPlain:string,description:string,additionalPlain:string,additional:string,lists:array<struct<text:string,content:string>>,categories:struct<location:string,allLocations:array<string>,commitment:string,team:string,department:string,level:string>>>"
_PAGE = "struct<requested_url:string,final_url:string,status_code:int,content_type:string,content_sha256:string,body_base64:string,source_job_id:string,external_path:string>"
BUNDLE = f"struct<provider:string,source_token:string,reported_job_count:bigint,listing_url:string,public_base_url:string,listing_pages:array<{_PAGE}>,job_pages:array<{_PAGE}>,job_index:array<map<string,string>>>"


def read_sidecars(spark: SparkSession, root: str, providers: list[str] | None = None) -> DataFrame:
    """One row per sidecar under <root>/<provider>/<token>/, with its path, provider folder and the payload's path.

    Provider folders prune the scan; a provider that is asked for and has no sidecar is an error. Fields that a sidecar lacks are null; a file that is no JSON gives nulls, and so a violation.
    """
    paths = [f"{root}/{p}/*/*.metadata.json" for p in providers] if providers else [f"{root}/*/*/*.metadata.json"]
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for p in paths:
        if not spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs_path(p)):
            raise ValueError(f"no snapshots: {p}")
    rows = spark.read.schema(SIDECAR).option("multiLine", True).json(paths)
    path = F.col("_metadata.file_path")
    rows = rows.select("*", path.alias("sidecar_path"), F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1).alias("provider"))
    return rows.withColumns({"payload_path": F.concat(F.regexp_replace("sidecar_path", r"[^/]+$", ""), F.col("raw_file")), "collected": iso_instant(F.col("collected_at"))})


def sidecar_violations(sidecars: DataFrame) -> DataFrame:
    """(sidecar_path, violation) of each broken rule of a sidecar."""
    blank = lambda c: blank_to_null(F.col(c)).isNull()
    rules = {
        "provider_differs": ~F.col("source").eqNullSafe(F.col("provider")), "unknown_provider": ~F.col("provider").isin(PROVIDERS),
        "blank_name": blank("source_name"), "blank_token": blank("source_token"), "blank_employer": F.col("employer_id").isNotNull() & blank("employer_id"),
        "bad_time": F.col("collected").isNull(), "bad_digest": ~F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)),
        "bad_file_name": ~F.coalesce(F.col("raw_file").rlike(r"^[^/\\]+$") & ~F.col("raw_file").isin(".", ".."), F.lit(False)), "no_count": F.col("source_job_count").isNull(),
    }
    found = F.array_compact(F.array(*[F.when(c, name) for name, c in rules.items()]))
    return sidecars.select("sidecar_path", F.explode(found).alias("violation"))


def read_payloads(spark: SparkSession, sidecars: DataFrame, root: str, providers: list[str] | None = None) -> DataFrame:
    """Sidecars with the payload's bytes and ``verified``: whether its SHA-256 is the sidecar's digest; null without a file."""
    files = spark.read.format("binaryFile").load([f"{root}/{p}/*/" for p in providers] if providers else f"{root}/*/*/").where(~F.col("path").endswith(".metadata.json")).select(F.col("path").alias("payload_path"), "content")
    return sidecars.join(files, "payload_path", "left").withColumn("verified", F.sha2("content", 256) == F.col("content_sha256"))


# Lineage paths begin at the provider's folder.
_RELATIVE = r"^.*/(?=[^/]+/[^/]+/[^/]+$)"
_META = ["provider", "source_name", "source_token", "employer_id", "content_sha256", "collected", "payload_path", "source_job_count"]


def board_jobs(payloads: DataFrame) -> DataFrame:
    """One row per posting of verified board payloads: the posting's fields and the sidecar's."""
    rows = payloads.where("provider = 'greenhouse' and verified").select(*_META, F.from_json(F.decode("content", "UTF-8"), BOARD)["jobs"].alias("jobs"))
    return _with_meta(rows.select(*_META, F.posexplode("jobs").alias("pos", "job")))


def posting_jobs(payloads: DataFrame) -> DataFrame:
    rows = payloads.where("provider = 'lever' and verified").select(*_META, F.from_json(F.decode("content", "UTF-8"), POSTINGS).alias("jobs"))
    return _with_meta(rows.select(*_META, F.posexplode("jobs").alias("pos", "job")))


def _with_meta(rows: DataFrame) -> DataFrame:
    return rows.select("source_name", "source_token", "employer_id", "content_sha256", F.col("collected").alias("collected_at"), F.regexp_replace("payload_path", _RELATIVE, "").alias("snapshot_path"), "pos", "job.*")


def bundle_pages(payloads: DataFrame) -> DataFrame:
    """One row per detail page of bundle payloads: decoded body, whether its own digest holds, and its index entry by position.

    A missing index entry is an empty map. Whole bundles are checked by payload_violations.
    """
    rows = payloads.where(~F.col("provider").isin("greenhouse", "lever") & F.col("verified")).select(*_META, F.from_json(F.decode("content", "UTF-8"), BUNDLE).alias("b"))
    sound = lambda p: F.sha2(F.try_to_binary(p["body_base64"], F.lit("base64")), 256) == p["content_sha256"]
    rows = rows.select(*_META, "b", F.posexplode("b.job_pages").alias("pos", "page"))
    body = F.try_to_binary(F.col("page.body_base64"), F.lit("base64"))
    index = F.coalesce(F.get("b.job_index", F.col("pos")), F.create_map().cast("map<string,string>"))
    return rows.select(
        "provider", "source_name", "source_token", "employer_id", "content_sha256", F.col("collected").alias("collected_at"), F.regexp_replace("payload_path", _RELATIVE, "").alias("snapshot_path"), "pos",
        F.coalesce(F.col("page.final_url"), F.col("page.requested_url")).alias("url"), F.decode(body, "UTF-8").alias("body"), sound(F.col("page")).alias("page_ok"), index.alias("index"),
        F.col("b.public_base_url").alias("public_base_url"), F.col("page.external_path").alias("external_path"),
    )


def json_details(pages: DataFrame, provider: str) -> DataFrame:
    """Detail objects of a REST provider: the detail's fields over the index's, with addresses added, as JSON text.

    Nested objects stay objects. A body with a single-element ``items`` is that element.
    """
    fields = "map<string,variant>"
    single = F.when(F.get_json_object("body", "$.items[1]").isNull(), F.get_json_object("body", "$.items[0]"))
    detail = F.try_parse_json(F.coalesce(single, F.col("body")))
    own = F.coalesce(F.when(F.schema_of_variant(detail).startswith("OBJECT"), detail.cast(fields)), F.create_map().cast(fields))
    path = F.coalesce(F.col("external_path"), F.col("index")["externalPath"], F.col("index")["external_path"])
    extra = F.map_filter(F.create_map(F.lit("_detail_url"), F.col("url"), F.lit("_public_base_url"), F.col("public_base_url"), F.lit("_external_path"), path), lambda k, v: v.isNotNull())
    rest = lambda m, *above: F.map_filter(m, lambda k, v: ~F.array_contains(F.flatten(F.array(*[F.map_keys(x) for x in above])), k))
    merged = F.map_concat(rest(F.col("index"), own, extra).cast(fields), rest(own, extra), extra.cast(fields))
    return pages.where(F.col("provider") == provider).withColumn("detail", F.to_json(merged))


def payload_violations(payloads: DataFrame) -> DataFrame:
    """(payload_path, violation) of every rule that a payload breaks; each payload is hashed and parsed once.

    unverified: the digest isn't the sidecar's, or there is no file. no_payload: it hasn't the shape of its provider's
    payloads. job_count: the number of postings isn't the sidecar's. Of bundles: wrong_provider, no_listing_pages,
    no_pages, reported_count, unsound_page (a listing or posting page whose digest doesn't hold), no_json_detail (a REST
    detail that is no object), also where there are no posting pages at all.
    """
    text, provider = F.decode("content", "UTF-8"), F.col("provider")
    is_board, is_postings = provider == "greenhouse", provider == "lever"
    rows = payloads.withColumns({
        "_ok": F.coalesce("verified", F.lit(False)), "_j": F.when(is_board, F.from_json(text, BOARD)["jobs"]), "_l": F.when(is_postings, F.from_json(text, POSTINGS)),
        "_b": F.when(~is_board & ~is_postings, F.from_json(text, BUNDLE)),
    })
    n = F.when(is_board, F.size("_j")).when(is_postings, F.size("_l")).otherwise(F.size("_b.job_pages"))
    body = lambda p: F.try_to_binary(p["body_base64"], F.lit("base64"))
    sound = lambda p: F.coalesce(F.sha2(body(p), 256) == p["content_sha256"], F.lit(False))
    is_object = lambda p: F.coalesce(F.schema_of_variant(F.try_parse_json(F.decode(body(p), "UTF-8"))).startswith("OBJECT"), F.lit(False))
    b, expected = "_b", F.col("source_job_count")
    is_bundle = F.col("_b.provider").isNotNull() | F.col("_b.listing_pages").isNotNull() | F.col("_b.job_pages").isNotNull()
    rules = {
        "no_payload": F.coalesce(F.col("_j").isNull() & F.col("_l").isNull() & ~is_bundle, F.lit(True)), "job_count": ~expected.eqNullSafe(n.cast("long")),
        "wrong_provider": is_bundle & ~F.col(f"{b}.provider").eqNullSafe(provider), "no_listing_pages": is_bundle & (F.coalesce(F.size(f"{b}.listing_pages"), F.lit(0)) <= 0),
        "no_pages": is_bundle & (F.col(f"{b}.job_pages").isNull() | F.col(f"{b}.job_index").isNull()), "reported_count": is_bundle & ~F.col(f"{b}.reported_job_count").eqNullSafe(expected),
        "unsound_page": is_bundle & ~(F.coalesce(F.forall(f"{b}.listing_pages", sound), F.lit(True)) & F.coalesce(F.forall(f"{b}.job_pages", sound), F.lit(True))),
        "no_json_detail": is_bundle & provider.isin("workday", "oracle_hcm") & ~F.coalesce(F.forall(f"{b}.job_pages", is_object), F.lit(True)),
    }
    found = F.when(~F.col("_ok"), F.array(F.lit("unverified"))).otherwise(F.array_compact(F.array(*[F.when(c, name) for name, c in rules.items()])))
    return rows.select("payload_path", F.explode(found).alias("violation"))


def observation_status(rows: DataFrame, source: list[str], digest: str, time: Column | str) -> DataFrame:
    """Adds status: written for a payload's first observation in its source, duplicate for later ones (order: time, then all)."""
    at = F.col(time) if isinstance(time, str) else time
    w = Window.partitionBy(*source, digest).orderBy(at.asc_nulls_first(), *[F.col(c) for c in rows.columns if c not in (*source, digest)])
    return rows.withColumn("status", F.when(F.row_number().over(w) == 1, "written").otherwise("duplicate"))


def run_report(results: DataFrame) -> DataFrame:
    """(provider, written, duplicate, failed, jobs) of the results of a collection run; failed results count no jobs."""
    return results.groupBy("provider").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("written", "duplicate", "failed")], F.sum(F.when(F.col("status") == "failed", 0).otherwise(F.coalesce("job_count", F.lit(0)))).alias("jobs"))


def source_quality(rows: DataFrame, source: str, id_col: str, required: list[str]) -> DataFrame:
    """Per source: rows, distinct ids over ids, and rows with all required fields filled over rows, to 4 decimals."""
    whole = F.lit(True)
    for c in required:
        whole &= blank_to_null(F.col(c)).isNotNull()
    ids = F.count(id_col)
    return rows.groupBy(source).agg(F.count("*").alias("total_jobs"), F.round(F.coalesce(F.count_distinct(id_col) / F.nullif(ids, F.lit(0)), F.lit(0.0)), 4).alias("unique_id_ratio"), F.round(F.count_if(whole) / F.count("*"), 4).alias("completion_ratio"))


def contains_any(text: Column, terms: list[str]) -> Column:
    """Whether the text, in lower case and with a blank on either side, contains any of the terms."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    out = F.lit(False)
    for t in terms:
        out |= padded.contains(t)
    return out


def assess_sources(rows: DataFrame, source: str, id_col: str, title: str, location: str, required: list[str], places: list[str], technologies: list[str]) -> DataFrame:
    """source_quality with the postings at home, the technology ones among them, and whether the source passes.

    A source passes with postings at home, ids that are all distinct and at least 80 % complete postings.
    """
    home = contains_any(F.col(location), places)
    more = rows.groupBy(F.col(source).alias("_s")).agg(F.count_if(home).alias("home_jobs"), F.count_if(home & contains_any(F.col(title), technologies)).alias("technology_jobs"))
    out = source_quality(rows, source, id_col, required).join(more, F.col(source).eqNullSafe(F.col("_s"))).drop("_s")
    return out.withColumn("passed", (F.col("home_jobs") > 0) & (F.col("unique_id_ratio") == 1.0) & (F.col("completion_ratio") >= 0.8))


def assess_listings(pages: DataFrame, terms: list[str], link: str = "/job/", at_home: Column | None = None) -> DataFrame:
    """Per listing page (columns source_token, http_status, content_type, html): links to postings, missing evidence, errors, passed.

    total_jobs counts detected links, not postings; home_jobs is the same where the page's market is the home one
    (``at_home``). A page passes with status 200, HTML, all ``terms`` in its text (in any case) and a link.
    """
    text = F.lower(strip_html_tags(F.col("html")))
    n = F.size(matching_links(F.col("html"), link)).cast("long")
    missing = F.array_compact(F.array(*[F.when(~text.contains(t.lower()), t) for t in terms])) if terms else F.array().cast("array<string>")
    is_html = F.coalesce(F.lower("content_type").contains("html"), F.lit(False))
    status = F.coalesce(F.col("http_status") == 200, F.lit(False))
    rows = pages.select("source_token", n.alias("total_jobs"), F.when(F.coalesce(at_home, F.lit(False)) if at_home is not None else F.lit(False), n).otherwise(0).alias("home_jobs"), missing.alias("missing_terms"), status.alias("_s"), is_html.alias("_h"))
    errors = F.array_compact(F.array(F.when(~F.col("_s"), "status"), F.when(~F.col("_h"), "content_type"), F.when(F.size("missing_terms") > 0, "missing_terms"), F.when(F.col("total_jobs") == 0, "no_links")))
    return rows.withColumn("errors", errors).withColumn("passed", F.size("errors") == 0).drop("_s", "_h")
