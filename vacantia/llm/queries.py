"""Queries of the training-data operators tagged llm, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import chunks, golden, mix, nearjoin, pairs, personal, places, tokens
from vacantia.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return nearjoin.near_duplicates(table(spark, d, "jobs"), "job_key", ["title", "company", "description_text"], "description_text", min_words=30, shingle=3, num=3, den=5)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nearjoin.record_pairs(*_near(spark, d)).select(F.col("id_a").alias("job_key_a"), F.col("id_b").alias("job_key_b"))


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    return nearjoin.record_links(*_near(spark, d)).withColumnRenamed("id", "job_key")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "places")
    jobs, boards = table(spark, d, "jobs"), table(spark, d, "greenhouse_jobs_m2")
    out = None
    for source, name, column, key, value, kinds in (
        (jobs, "jobs", "location_raw", F.col("job_key"), F.col("location_raw"), ("city", "province", "country")),
        (jobs, "jobs", "province", F.col("job_key"), F.col("province"), ("province",)),
        (boards, "greenhouse_jobs_m2", "location.name", F.col("id").cast("string"), F.col("location.name"), ("city", "province", "country")),
    ):
        rows = source.select(F.lit(name).alias("src_table"), F.lit(column).alias("src_field"), key.alias("record_key"), value.alias("value"))
        own = places.map_values(rows, "value", ["src_table", "src_field", "record_key"], listed, kinds)
        out = own if out is None else out.unionByName(own)
    return out


def p3_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs.item_pairs(table(spark, d, "dashboard_skills"), "job_key", "technology")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = p3_pairs(spark, d).where("n_both >= 5 and n_both * n_baskets >= 2 * n_a * n_b")
    return rows.select(F.col("item_a").alias("technology_a"), F.col("item_b").alias("technology_b"))


def _personal(spark: SparkSession, d: str, redacted: bool) -> DataFrame:
    jobs = table(spark, d, "jobs").select(F.lit("jobs").alias("src_table"), F.col("job_key").alias("record_key"), F.col("description_text").alias("text"))
    lever = table(spark, d, "lever_jobs").select(F.lit("lever_jobs").alias("src_table"), F.col("id").alias("record_key"), F.col("additionalPlain").alias("text"))
    rows = jobs.unionByName(lever)
    return personal.find_in(rows, ["src_table", "record_key"], "text", personal.fit(rows.select("text"), personal.listed_names(table(spark, d, "given_names"), "given_name")), redacted)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _personal(spark, d, False).select("src_table", "record_key", F.explode("found").alias("f"))
    return rows.select("src_table", "record_key", F.col("f.pii_kind").alias("pii_kind"), F.col("f.start_pos").alias("start_pos"))


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    return _personal(spark, d, True).select("src_table", "record_key", "redacted", F.coalesce(F.size("found"), F.lit(0)).alias("n_found"))


def _golden(spark: SparkSession, d: str) -> DataFrame:
    fields = ["title", "company", "employer_id", "department", "location_raw", "role_level", "application_url", "source_token", "source_job_id"]
    return golden.representatives(table(spark, d, "job_observations"), "job_key", "obs_id", "last_seen_at", "observation_count", "description_text", fields, learned="role_level")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """From the representatives as they are built, currency orders of all fields included."""
    return cut(_golden(spark, d)).where("n_records > 1 and best_id is not null").select(F.col("best_id").alias("obs_id"))


def p5_golden(spark: SparkSession, d: str) -> DataFrame:
    return _golden(spark, d)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_table(table(spark, d, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """What the ids of each document decode to, as a digest and a length: that of its text."""
    back = tokens.decode_table(tokens.encode_table(table(spark, d, "documents"), "doc_id", "text"), "doc_id")
    return back.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("long").alias("n_chars"))


def _mix(spark: SparkSession, d: str) -> DataFrame:
    return mix.mix_sources(mix.document_sizes(table(spark, d, "documents")), table(spark, d, "source_weights"), "doc_id", "source")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.mix_shares(_mix(spark, d), table(spark, d, "source_weights"), "source")


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunks.split_table(table(spark, d, "documents"), "doc_id", "text", limit=512, overlap=48)


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (p1_found, p1_links, p2_found, p3_found, p3_pairs, p4_found, p4_redacted, p5_found, p5_golden, p8_ids, p8_round_trip, p9_mix, p9_shares, p10_pieces)
}

_ITEMS = r"""
items AS (SELECT DISTINCT job_key, lower(regexp_replace(technology, '^\s+|\s+$', '', 'g')) AS item FROM dashboard_skills
          WHERE job_key IS NOT NULL AND technology IS NOT NULL AND regexp_replace(technology, '^\s+|\s+$', '', 'g') <> ''),
single AS (SELECT item, count(*) AS n FROM items GROUP BY item),
pairs AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_both FROM items a JOIN items b ON a.job_key = b.job_key AND a.item < b.item GROUP BY 1, 2),
counted AS (SELECT item_a, item_b, n_both, x.n AS n_a, y.n AS n_b, (SELECT count(DISTINCT job_key) FROM items) AS n_baskets
            FROM pairs JOIN single x ON x.item = item_a JOIN single y ON y.item = item_b)
"""
_SHINGLES = r"""
base AS (SELECT job_key, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(company, '') || ' ' || coalesce(description_text, '')), '[\p{L}\p{N}]+') AS w
         FROM jobs WHERE len(regexp_extract_all(lower(coalesce(description_text, '')), '[\p{L}\p{N}]+')) >= 30),
pos AS (SELECT job_key, w, unnest(range(1, len(w) - 1)) AS i FROM base),
sh AS (SELECT DISTINCT job_key, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM pos),
n AS (SELECT job_key, count(*) AS n FROM sh GROUP BY 1)
"""
ORACLES: dict[str, str] = {
    "p1_found": f"""WITH {_SHINGLES}, o AS (SELECT a.job_key AS ka, b.job_key AS kb, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.job_key < b.job_key GROUP BY 1, 2)
        SELECT ka AS job_key_a, kb AS job_key_b FROM o JOIN n x ON x.job_key = ka JOIN n y ON y.job_key = kb WHERE 5 * o >= 3 * x.n AND 5 * o >= 3 * y.n""",
    "p1_links": f"""WITH {_SHINGLES}, g AS (SELECT job_key, md5(string_agg(s, '|' ORDER BY s)) AS g FROM sh GROUP BY 1), c AS (SELECT g, min(job_key) AS class_id, count(*) AS n_copies FROM g GROUP BY 1),
        o AS (SELECT a.job_key AS ka, b.job_key AS kb, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.job_key <> b.job_key GROUP BY 1, 2),
        l AS (SELECT ka AS job_key, count(*) AS n_links FROM o JOIN n x ON x.job_key = ka JOIN n y ON y.job_key = kb JOIN g p ON p.job_key = ka JOIN g q ON q.job_key = kb
              WHERE 5 * o >= 3 * x.n AND 5 * o >= 3 * y.n AND p.g <> q.g GROUP BY 1)
        SELECT g.job_key, class_id, n_copies, coalesce(n_links, 0) AS n_links FROM g JOIN c USING (g) LEFT JOIN l USING (job_key)""",
    "p3_found": f"WITH {_ITEMS} SELECT item_a AS technology_a, item_b AS technology_b FROM counted WHERE n_both >= 5 AND n_both * n_baskets >= 2 * n_a * n_b",
    "p3_pairs": f"""WITH {_ITEMS} SELECT item_a, item_b, n_both, n_a, n_b, n_baskets, n_both::DOUBLE * n_baskets / (n_a::DOUBLE * n_b) AS lift,
        ln((n_both + 0.5::DOUBLE) * (n_baskets::DOUBLE - n_a - n_b + n_both + 0.5) / ((n_a::DOUBLE - n_both + 0.5) * (n_b::DOUBLE - n_both + 0.5))) AS log_odds FROM counted""",
    "p5_found": r"""WITH r AS (SELECT obs_id, lower(regexp_replace(job_key, '\s+', '', 'g')) AS g, last_seen_at AS t, observation_count AS c,
            coalesce(length(regexp_replace(description_text, '^\s+|\s+$', '', 'g')), 0) AS l FROM job_observations WHERE job_key IS NOT NULL),
        m AS (SELECT g, count(*) AS k, max(t) AS t, max(c) AS c, max(l) AS l FROM r WHERE g <> '' GROUP BY g)
        SELECT min(obs_id) AS obs_id FROM r JOIN m USING (g) WHERE k > 1 AND r.t IS NOT DISTINCT FROM m.t AND r.c IS NOT DISTINCT FROM m.c AND r.l = m.l GROUP BY g""",
    "p8_round_trip": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, length(coalesce(text, '')) AS n_chars FROM documents",
}
