"""Timestamps in mixed formats and zones, brought to one UTC instant each.

A value is read by shape, in Arrow batches, into the instants that it can mean. The all-numeric day/month forms have two
readings; their mixture weights are fitted per source and form by expectation-maximisation over counts of (source, form,
valid readings), a table whose size doesn't follow the rows. A zone abbreviation that several zones use has a reading for
each of their offsets; the weights come from the zones that the source, and all sources, name elsewhere.
"""

from __future__ import annotations

import functools
import re
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Offsets, in minutes, of zone abbreviations; of those that several zones use, all of them.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "sast": 120, "cat": 120, "eat": 180, "wat": 60, "cet": 60,
    "cest": 120, "eet": 120, "eest": 180, "mst": -420, "mdt": -360, "pdt": -420,
}
SHARED_ABBREVIATIONS = {
    "bst": (60, 360), "ist": (330, 120, 60), "cst": (-360, 480, -300), "cdt": (-300, -240), "est": (-300, 600), "edt": (-240, 660), "pst": (-480, 480),
}
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}

_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?\s*(?P<half>[ap]\.?m\.?(?![a-z]))?"
_ZONE = r"\s*(?P<zone>\[?[a-z][a-z_]*(?:/[a-z0-9_+-]+)+\]?|\[?[a-z]{1,5}\]?|\(?(?:utc|gmt)?\s*[+-]\d{1,2}(?::?\d{2})?\)?(?:\s*\[[a-z0-9_/+-]+\])?)?"
_TAIL = rf"(?:(?:[t,\s]\s*|\s+at\s+){_CLOCK}{_ZONE})?"
_DAY = r"(?:[a-z]{3,9}\.?,?\s+)?"
_SHAPES = [
    re.compile(rf"(?P<y>\d{{4}})(?P<sep>[-/.])(?P<mo>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}}){_TAIL}", re.I),
    re.compile(rf"(?P<y>\d{{4}})(?P<mo>\d{{2}})(?P<d>\d{{2}})(?:t?(?P<h>\d{{2}})(?P<mi>\d{{2}})(?P<s>\d{{2}})[.,]?(?P<f>\d{{1,9}})?(?P<half>)?{_ZONE})", re.I),
    re.compile(rf"{_DAY}(?P<d>\d{{1,2}})(?:st|nd|rd|th)?[-\s](?P<name>[a-z]{{3,9}})\.?[-,\s]+(?P<y>\d{{4}}){_TAIL}", re.I),
    re.compile(rf"{_DAY}(?P<name>[a-z]{{3,9}})\.?\s(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}}){_TAIL}", re.I),
]
_NUMERIC = re.compile(rf"(?P<one>\d{{1,2}})(?P<sep>[-/.])(?P<two>\d{{1,2}})(?P=sep)(?P<y>\d{{4}}){_TAIL}", re.I)
_EPOCH = re.compile(r"(-?\d{9,10})(?:\.(\d+))?|(\d{13})|(\d{16})|(\d{19})")
_OFFSET = re.compile(r"\(?(?:utc|gmt)?([+-])(\d{1,2}):?(\d{2})?\)?(?:\[.*\])?", re.I)
#: The same as _NUMERIC in front, for a filter in the scan's own stage.
NUMERIC_START = r"^\s*\d{1,2}[-/.]\d{1,2}[-/.]\d{4}"
_START = datetime(1970, 1, 1)


@functools.cache
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if re.fullmatch(r"[A-Za-z][A-Za-z0-9_+/-]*", name) else None
    except (KeyError, ValueError, OSError):
        return None


def _micros(wall: datetime) -> int:
    return (wall - _START) // timedelta(microseconds=1)


def _settle(wall: datetime, zone_text: str, source_zone: str | None) -> tuple[int | None, str]:
    """Instant and status of a wall-clock time: by the zone in the value, else by that of its source."""
    if zone_text:
        text = re.sub(r"\s", "", zone_text)
        if m := _OFFSET.fullmatch(text):
            minutes = int(m[2]) * 60 + int(m[3] or 0)
            return (None, "unreadable") if minutes > 18 * 60 else (_micros(wall) - (minutes if m[1] == "+" else -minutes) * 60_000_000, "ok")
        if (minutes := ABBREVIATIONS.get(text.strip("[]").lower())) is not None:
            return _micros(wall) - minutes * 60_000_000, "ok"
        if text.strip("[]").lower() in SHARED_ABBREVIATIONS:
            return _micros(wall), "shared"
        zone = _zone(text.strip("[]"))
    else:
        zone = _zone(source_zone) if source_zone else None
    if zone is None:
        return None, "no_zone"
    found = set()
    for fold in (0, 1):
        u = wall.replace(tzinfo=zone, fold=fold).astimezone(UTC)
        if u.astimezone(zone).replace(tzinfo=None, fold=0) == wall:
            found.add(u)
    if len(found) != 1:
        return None, "twice" if found else "never"
    return _micros(found.pop().replace(tzinfo=None)), "ok"


def _wall(m: re.Match, month: int, day: int) -> datetime | None:
    hour, half = int(m["h"] or 0), (m["half"] or "")[:1].lower()
    if half:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half == "p" else 0)
    try:
        return datetime(int(m["y"]), month, day, hour, int(m["mi"] or 0), int(m["s"] or 0), int((m["f"] or "0")[:6].ljust(6, "0")))
    except ValueError:
        return None


def readings(value: str | None, source_zone: str | None) -> tuple[str | None, int | None, str, int | None, str | None]:
    """(form, instant, status, second instant, second status): form and the second reading only for numeric dates.

    The first reading of a numeric date is day before month; a reading that is no date has status unreadable.
    """
    text = re.sub(r"^\s+|\s+$", "", value or "")
    if not text:
        return None, None, "null", None, None
    if m := _EPOCH.fullmatch(text):
        if m[1]:
            us = int(m[1]) * 1_000_000 + (-1 if m[1][0] == "-" else 1) * int((m[2] or "0")[:6].ljust(6, "0"))
        else:
            us = int(m[3]) * 1000 if m[3] else int(m[4]) if m[4] else int(m[5]) // 1000
        return None, us, "ok", None, None
    if m := _NUMERIC.fullmatch(text):
        form = m["sep"] + ("12h" if m["half"] else "24h" if m["h"] else "date")
        out: list = []
        for day, month in ((m["one"], m["two"]), (m["two"], m["one"])):
            wall = _wall(m, int(month), int(day))
            out += _settle(wall, m["zone"] or "", source_zone) if wall else (None, "unreadable")
        return form, *out
    for shape in _SHAPES:
        if m := shape.fullmatch(text):
            month = int(m["mo"]) if "mo" in m.groupdict() else MONTHS.get(m["name"][:3].lower(), 0)
            wall = _wall(m, month, int(m["d"]))
            return (None, *(_settle(wall, m["zone"] or "", source_zone) if wall else (None, "unreadable")), None, None)
    return None, None, "unreadable", None, None


def uses(zone_name: str | None) -> list[str]:
    """abbreviation:minutes for each shared abbreviation that a zone uses, in winter or summer."""
    zone = _zone(zone_name) if zone_name else None
    out = set()
    for month in (1, 7) if zone else ():
        at = datetime(2020, month, 1, tzinfo=zone)
        name, minutes = (at.tzname() or "").lower(), int(at.utcoffset().total_seconds() // 60)
        if minutes in SHARED_ABBREVIATIONS.get(name, ()):
            out.add(f"{name}:{minutes}")
    return sorted(out)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _uses(zone: pd.Series) -> pd.Series:
    return zone.map(lambda z: uses(z if isinstance(z, str) else None))


_READING = T.StructType([T.StructField("form", T.StringType()), T.StructField("us1", T.LongType()), T.StructField("status1", T.StringType()), T.StructField("us2", T.LongType()), T.StructField("status2", T.StringType())])


@F.pandas_udf(_READING)
def _readings(value: pd.Series, zone: pd.Series) -> pd.DataFrame:
    rows = [readings(v if isinstance(v, str) else None, z if isinstance(z, str) else None) for v, z in zip(value, zone)]
    out = pd.DataFrame(rows, columns=["form", "us1", "status1", "us2", "status2"], dtype=object)
    return out.astype({"us1": "Int64", "us2": "Int64"})


def share_of_first(masks: list[int], counts: list[int], start: float, strength: float, rounds: int = 40) -> float:
    """Share of the first reading in a mixture of two, by expectation-maximisation.

    masks: 1 only the first reading is a date, 2 only the second, 3 both; ``start`` weighs as much as ``strength`` values.
    """
    share = start
    for _ in range(rounds):
        first = sum(k * (1.0 if m == 1 else 0.0 if m == 2 else share) for m, k in zip(masks, counts))
        share = (first + strength * start) / (sum(counts) + strength)
    return share


def read_instants(df: DataFrame, value: str, zone: str, source: list[str], threshold: float = 0.9, prior: float = 4.0) -> DataFrame:
    """``df`` with epoch_us (BIGINT) and time_status added.

    value: the text; zone: an IANA name used where the value has no zone; source: columns that name the source.
    time_status is one of ok; null (null or blank value); unreadable (no valid full date and time); no_zone; twice,
    never (wall-clock time repeated or skipped by its zone, and the value has no offset); ambiguous (day and month, or
    the zones that use its abbreviation, can't be told apart: no reading reaches ``threshold``). epoch_us is null unless ok. A date alone is its midnight;
    digits beyond microseconds are dropped, missing ones are zero. Null source columns form a source of their own.
    Repeated rows stay; columns of ``df`` named like the added ones are replaced; an empty table gives an empty result.
    ``prior`` is the weight, in values, of the form's overall mixture within each source.
    """
    own = [c for c in df.columns if c not in ("epoch_us", "time_status")]
    keys = [f"_s{i}" for i in range(len(source))]
    # The caller's columns travel in one struct, so that their names can't clash with those used here.
    base = df.select(F.struct(*own).alias("_own"), F.col(value).alias("_v"), F.col(zone).alias("_z"), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(k) for k, c in zip(keys, source)])
    read = lambda rows: rows.withColumn("_r", _readings(F.col("_v"), F.col("_z")))
    valid = lambda s: (F.col(f"_r.{s}") != "unreadable").cast("int")
    mask = valid("status1") + 2 * valid("status2")
    # Equal readings (3 March) say nothing about the order.
    numeric = read(base.where(F.col("_v").rlike(NUMERIC_START)).select(*keys, "_v", "_z")).select(*keys, F.col("_r.form").alias("_form"), mask.alias("_mask"), F.col("_r.us1").eqNullSafe(F.col("_r.us2")).alias("_same"))
    counts = numeric.where("_form is not null and _mask > 0 and not (_mask = 3 and _same)").groupBy(*keys, "_form", "_mask").agg(F.count("*").alias("_k"))

    def by_form(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"_form": [pdf._form[0]], "_overall": [share_of_first(pdf._mask.tolist(), pdf._k.tolist(), 0.5, 0.01)]})

    def by_source(pdf: pd.DataFrame) -> pd.DataFrame:
        share = share_of_first(pdf._mask.tolist(), pdf._k.tolist(), float(pdf._overall.iloc[0]), prior)
        return pdf.iloc[:1][[*keys, "_form"]].assign(_share=share)

    overall = counts.groupBy("_form", "_mask").agg(F.sum("_k").alias("_k")).groupBy("_form").applyInPandas(by_form, "_form string, _overall double")
    shares = counts.join(overall, "_form").groupBy(*keys, "_form").applyInPandas(by_source, ", ".join([f"{k} string" for k in keys] + ["_form string", "_share double"]))
    rows = read(base).withColumn("_form", F.col("_r.form")).join(shares, [*keys, "_form"], "left")
    first = (
        F.when(F.col("_form").isNull() | (F.col("_r.status2") == "unreadable") | F.col("_r.us1").eqNullSafe(F.col("_r.us2")) & (F.col("_r.status1") != "unreadable"), True)
        .when(F.col("_r.status1") == "unreadable", False)
        .when(F.col("_share") >= threshold, True)
        .when(F.col("_share") <= 1 - threshold, False)
    )
    rows = rows.withColumn("_first", first)
    status = F.when(F.col("_first").isNull(), "ambiguous").when(F.col("_first"), F.col("_r.status1")).otherwise(F.col("_r.status2"))
    us = F.when(F.col("_first"), F.col("_r.us1")).when(~F.col("_first"), F.col("_r.us2"))
    rows = rows.withColumns({"_status": status, "_us": us, "_abbr": F.lower(F.regexp_extract("_v", r"([A-Za-z]+)\]?\s*$", 1))})

    # Zones that are named: in the value, else by the source. Distinct names are few, whatever the number of rows.
    named = F.coalesce(F.nullif(F.regexp_extract("_v", r"([A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+)\]?\s*$", 1), F.lit("")), F.col("_z"))
    zones = base.where("_v is not null").groupBy(*keys, named.alias("_name")).agg(F.count("*").alias("_k")).where("_name is not null")
    said = zones.select(*keys, F.explode(_uses("_name")).alias("_use"), "_k").groupBy(*keys, "_use").agg(F.sum("_k").alias("_k"))
    mine = said.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_use", "_k"))).alias("_mine"))
    everywhere = said.groupBy("_use").agg(F.sum("_k").alias("_k")).groupBy(F.substring_index("_use", ":", 1).alias("_abbr"))
    everywhere = everywhere.agg(F.map_from_entries(F.collect_list(F.struct("_use", "_k"))).alias("_all"))
    rows = rows.join(mine, keys, "left").join(everywhere, "_abbr", "left")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    own = lambda k: F.coalesce(F.try_element_at("_mine", k), F.lit(0)).cast("double")
    uses_ = F.map_keys("_all")
    weight = lambda k: own(k) + F.lit(prior) * F.try_element_at("_all", k) / total(F.transform(F.map_values("_all"), lambda x: x.cast("double")))
    best = F.array_max(F.transform(uses_, lambda k: F.struct((weight(k) / (total(F.transform(uses_, own)) + prior)).alias("share"), F.substring_index(k, ":", -1).cast("long").alias("minutes"))))
    shared = F.col("_status") == "shared"
    sure = F.coalesce(best["share"] >= threshold, F.lit(False))
    out_us = F.when(shared, F.when(sure, F.col("_us") - best["minutes"] * 60_000_000)).when(F.col("_status") == "ok", F.col("_us"))
    return rows.select("_own.*", out_us.alias("epoch_us"), F.when(shared, F.when(sure, "ok").otherwise("ambiguous")).otherwise(F.col("_status")).alias("time_status"))
