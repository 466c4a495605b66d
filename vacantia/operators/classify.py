"""Location, workplace, seniority and technology relevance of postings, each with the evidence for it.

Rules are read in one scan per row (functions/terms.py); labels by precedence and evidence are expressions over its map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions.terms import Found, scan
from vacantia.functions.text import normalize_whitespace, unique_ci

LOCATION_RULES, WORKPLACE_RULES, LEVEL_RULES = ("city", "country", "remote_home"), ("workplace",), ("title_level", "source_level", "text_level")
TECHNOLOGY_RULES, SCORE_RULES = ("veto", "tech_title", "generic", "tech_text"), ("score_title", "score_text", "pool")
_EMPTY = "array<string>"


def _none() -> Column:
    return F.array().cast(_EMPTY)


def _optional(column: str | None) -> Column:
    return F.col(column) if column else F.lit(None).cast("string")


def classify_location(df: DataFrame, location: str, description: str, terms: str | None = None) -> DataFrame:
    """Adds city, province, country, is_south_africa, location_evidence.

    City rules on the location come first, then country rules, then phrases in the description; without a city, the
    part before the first comma is taken if a country is known and the part doesn't mention remote work. Null texts
    match nothing. ``terms``: a column with the scan of these rules, if there is one already; so for all classifications.
    """
    rows = df if terms else scan(df, LOCATION_RULES, location=F.col(location), description=F.col(description))
    f = Found(terms or "_terms")
    loc = normalize_whitespace(F.col(location))
    city, head = f.label("city"), normalize_whitespace(F.substring_index(loc, ",", 1))
    out = rows.withColumns({"_city": city, "_named": f.label("country"), "_home": f.any("remote_home"), "_head": head})
    out = out.withColumn("country", F.when(F.col("_city").isNotNull(), R.HOME).otherwise(F.coalesce("_named", F.when(F.col("_home"), R.HOME))))
    by_comma = F.when(F.col("country").isNotNull() & loc.contains(",") & (F.col("_head") != "") & ~F.col("_head").rlike(r"(?iU)\bremote\b"), F.col("_head"))
    evidence = F.when(F.col("_city").isNotNull(), f.evidence("city")).when(F.col("_named").isNotNull(), f.evidence("country")).otherwise(f.evidence("remote_home"))
    out = out.withColumns({"city": F.coalesce("_city", by_comma), "province": f.label("city", at=1), "is_south_africa": F.coalesce(F.col("country") == R.HOME, F.lit(False)), "location_evidence": unique_ci(evidence)})
    return out.drop("_city", "_named", "_home", "_head", *([] if terms else ["_terms"]))


def _tagged(source: str, values: Column) -> Column:
    return unique_ci(F.transform(values, lambda v: F.concat(F.lit(source + ": "), v)))


def classify_workplace(df: DataFrame, title: str, location: str, description: str, explicit: str | None = None, terms: str | None = None) -> DataFrame:
    """Adds workplace_type and workplace_evidence: a usable explicit label, else hybrid before remote before on_site."""
    rows = df if terms else scan(df, WORKPLACE_RULES, title=F.col(title), location=F.col(location), description=F.col(description))
    f, own = Found(terms or "_terms"), _optional(explicit)
    spelled = F.create_map(*[F.lit(x) for kv in R.WORKPLACE_SPELLINGS.items() for x in kv])[F.lower(normalize_whitespace(own))]
    out = rows.withColumn("_said", spelled)
    evidence = F.when(F.col("_said").isNotNull(), F.array(F.concat(F.lit("source: "), own))).otherwise(_tagged("text", f.evidence("workplace")))
    out = out.withColumns({"workplace_type": F.coalesce("_said", f.label("workplace"), F.lit("unspecified")), "workplace_evidence": evidence})
    return out.drop("_said", *([] if terms else ["_terms"]))


def classify_role_level(df: DataFrame, title: str, description: str, explicit: str | None = None, terms: str | None = None) -> DataFrame:
    """Adds role_level, role_level_evidence, is_early_career: senior titles win, then early titles, source level, description."""
    rows = df if terms else scan(df, LEVEL_RULES, title=F.col(title), description=F.col(description), explicit=_optional(explicit))
    f = Found(terms or "_terms")
    out = rows.withColumns({"_t": f.label("title_level"), "_e": f.label("source_level"), "_d": f.label("text_level")})
    evidence = (
        F.when(F.col("_t").isNotNull(), _tagged("title", f.evidence("title_level")))
        .when(F.col("_e").isNotNull(), _tagged("source_level", f.evidence("source_level")))
        .otherwise(_tagged("description", f.evidence("text_level")))
    )
    out = out.withColumns({"role_level": F.coalesce("_t", "_e", "_d", F.lit("unspecified")), "role_level_evidence": evidence})
    return out.withColumn("is_early_career", F.col("role_level").isin(R.EARLY_LEVELS)).drop("_t", "_e", "_d", *([] if terms else ["_terms"]))


def classify_technology(df: DataFrame, title: str, department: str, description: str, terms: str | None = None) -> DataFrame:
    """Adds is_technology_role and technology_evidence (labels and matched texts of all rules that match).

    Some titles veto. Title rules decide; only where none matches and the title is a general early-career one, rules on
    department and description do.
    """
    rows = df if terms else scan(df, TECHNOLOGY_RULES, title=F.col(title), department=F.col(department), description=F.col(description))
    f = Found(terms or "_terms")
    all_of = lambda family: F.flatten(F.transform(f.numbers(family), lambda k: F.concat(F.array(f.label(family, k)), f.texts(k))))
    evidence = F.when(f.any("veto"), _none()).when(f.any("tech_title"), all_of("tech_title")).when(f.any("generic"), all_of("tech_text")).otherwise(_none())
    out = rows.withColumn("technology_evidence", unique_ci(evidence))
    return out.withColumn("is_technology_role", F.size("technology_evidence") > 0).drop(*([] if terms else ["_terms"]))


def years_of_experience(df: DataFrame, description: str, single: list[str] | None = None, ranges: str | None = None) -> DataFrame:
    """Adds minimum_years, maximum_years (BIGINT, null if none) and years_evidence.

    Ranges are read first and taken out, so that their ends don't count as single numbers; the minimum is over ranges
    and single numbers, the maximum over ranges only. Numbers that don't fit a BIGINT count as null.
    """
    ranges = "(?iU)" + (ranges or R.YEARS_RANGE)
    singles = ["(?iU)" + p for p in (single or [R.YEARS_SINGLE])]
    text = F.coalesce(F.col(description), F.lit(""))
    get = lambda p, g, t: F.regexp_extract_all(t, F.lit(p), F.lit(g))
    out = df.withColumns({"_lo": get(ranges, 1, text), "_hi": get(ranges, 2, text), "_ev": get(ranges, 0, text), "_rest": F.regexp_replace(text, ranges, " ⁣ ")})
    ones, evidence, rest = [], [F.col("_ev")], F.col("_rest")
    for p in singles:
        ones.append(get(p, 1, rest))
        evidence.append(get(p, 0, rest))
        rest = F.regexp_replace(rest, p, " ⁣ ") if len(singles) > 1 else rest
    number = lambda xs: F.transform(xs, lambda x: x.try_cast("long"))
    out = out.withColumns({"_ends": F.concat(number(F.col("_lo")), number(F.col("_hi"))), "_ones": number(F.flatten(F.array(*ones)))})
    return out.withColumns(
        {"minimum_years": F.array_min(F.concat("_ends", "_ones")), "maximum_years": F.array_max("_ends"), "years_evidence": unique_ci(F.flatten(F.array(*evidence)))}
    ).drop("_lo", "_hi", "_ev", "_rest", "_ends", "_ones")


_ITEM = "array<struct<source:string,value:string,weight:int,category:string>>"


def _scored(f: Found, family: str, source: str) -> Column:
    def items(k: Column) -> Column:
        return F.transform(f.texts(k), lambda v: F.struct(F.lit(source).alias("source"), v.alias("value"), f.label(family, k, 0).alias("weight"), f.label(family, k, 1).alias("category")))

    return F.flatten(F.transform(f.numbers(family), items)).cast(_ITEM)


def _names(items: Column, level: str) -> Column:
    return F.exists(items, lambda x: x["category"] == level)


def score_role(df: DataFrame, title: str, description: str, explicit: str, terms: str | None = None) -> DataFrame:
    """Adds inferred_role_level, role_level_score (BIGINT), role_level_confidence, role_level_score_evidence, is_talent_pool.

    Evidence of title, source level, description and years has a weight and a level, each once per spelling. The level
    is the first of senior, internship, graduate, junior that title or source level name; else graduate or junior by the
    description; else by the least years (up to 1 junior, 2 ambiguous, 3 and 4 mid_level, more senior); else junior or
    senior by a score of 8 or more, -8 or less. Confidence is high if title or source level name the level, medium with
    years or at least two items, else low; ambiguous is always low.
    """
    rows = df if terms else scan(df, SCORE_RULES, title=F.col(title), description=F.col(description))
    rows, f = scan(rows, ("score_source",), "_level_terms", explicit=F.col(explicit)), Found(terms or "_terms")
    out = years_of_experience(rows, description).withColumns({"_ti": _scored(f, "score_title", "title"), "_so": _scored(Found("_level_terms"), "score_source", "source_level"), "_de": _scored(f, "score_text", "description")})

    def by_years(v: Column) -> Column:
        numbers = F.transform(F.regexp_extract_all(v, F.lit(r"(?U)\d+"), F.lit(0)), lambda x: x.try_cast("long"))
        y = F.array_min(numbers)
        weight = F.when(y <= 1, 5).when(y == 2, 2).when(y == 3, -2).when(y == 4, -5).otherwise(-10)
        level = F.when(y <= 1, "junior").when(y == 2, "ambiguous").when(y <= 4, "mid_level").otherwise("senior")
        return F.struct(F.lit("experience").alias("source"), v.alias("value"), weight.alias("weight"), level.alias("category"))

    everything = F.concat("_ti", "_so", "_de", F.transform("years_evidence", by_years).cast(_ITEM))
    out = out.withColumn("_all", everything)
    keys = F.transform("_all", lambda x: F.concat_ws("\0", x["source"], F.lower(x["value"]), x["weight"].cast("string"), x["category"]))
    out = out.withColumn("_k", keys).withColumn("_all", F.filter("_all", lambda x, i: F.array_position(F.col("_k"), F.get("_k", i)) == i + 1))
    out = out.withColumn("role_level_score", F.aggregate(F.transform("_all", lambda x: x["weight"].cast("long")), F.lit(0).cast("long"), lambda a, b: a + b))
    named = F.concat("_ti", "_so")
    level = None
    for candidate in ("senior", "internship", "graduate", "junior"):
        hit = _names(named, candidate)
        level = F.when(hit, candidate) if level is None else level.when(hit, candidate)
    y = F.col("minimum_years")
    level = (
        level.when(_names(F.col("_de"), "graduate"), "graduate")
        .when(_names(F.col("_de"), "junior"), "junior")
        .when(y.isNotNull(), F.when(y <= 1, "junior").when(y == 2, "ambiguous").when(y <= 4, "mid_level").otherwise("senior"))
        .when(F.col("role_level_score") >= 8, "junior")
        .when(F.col("role_level_score") <= -8, "senior")
        .otherwise("ambiguous")
    )
    out = out.withColumn("inferred_role_level", level)
    by_name = F.exists(named, lambda x: x["category"] == F.col("inferred_role_level"))
    by_year = F.exists("_all", lambda x: x["source"] == "experience")
    confidence = F.when(F.col("inferred_role_level") == "ambiguous", "low").when(by_name, "high").when(by_year | (F.size("_all") >= 2), "medium").otherwise("low")
    shown = F.transform("_all", lambda x: F.format_string("%s: %s (%+d, %s)", x["source"], x["value"], x["weight"], x["category"]))
    out = out.withColumns({"role_level_confidence": confidence, "role_level_score_evidence": shown, "is_talent_pool": f.any("pool")})
    return out.drop("_level_terms", *([] if terms else ["_terms"]), "_ti", "_so", "_de", "_all", "_k", "minimum_years", "maximum_years", "years_evidence")


def strongest_category(items: Column) -> Column:
    """The level with the greatest absolute sum of weights of scored evidence; null without evidence, ties by name."""
    levels = F.array_distinct(F.transform(items, lambda x: x["category"]))
    total = lambda c: F.aggregate(F.filter(items, lambda x: x["category"] == c), F.lit(0), lambda a, x: a + x["weight"])
    ranked = F.array_sort(F.transform(levels, lambda c: F.struct((-F.abs(total(c))).alias("n"), c.alias("c"))))
    return F.get(ranked, 0)["c"]


def audit_bucket(df: DataFrame, title: str, description: str) -> DataFrame:
    """Adds likely_level and audit_evidence: the review bucket of a role without a level."""
    rows = scan(df, ("audit_early", "audit_senior", "audit_mid"), title=F.col(title))
    f = Found()
    out = years_of_experience(rows, description, R.AUDIT_YEARS_SINGLE, R.AUDIT_YEARS_RANGE)
    early, senior, mid = f.any("audit_early"), f.any("audit_senior"), f.any("audit_mid")
    lo, hi = F.col("minimum_years"), F.col("maximum_years")
    level = (
        F.when(early, "likely_early_career").when(senior, "likely_senior").when(hi <= 2, "likely_early_career")
        .when(lo >= 5, "likely_senior").when((lo >= 3) | mid, "likely_mid_level").otherwise("ambiguous")
    )
    years = F.transform("years_evidence", lambda v: F.concat(F.lit("description: "), v))
    evidence = (
        F.when(early, _tagged("title", f.evidence("audit_early")))
        .when(senior, _tagged("title", f.evidence("audit_senior")))
        .otherwise(F.concat(_tagged("title", f.evidence("audit_mid")), years))
    )
    return out.withColumns({"likely_level": level, "audit_evidence": evidence}).drop("_terms")
