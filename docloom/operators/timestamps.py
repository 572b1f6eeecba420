"""Timestamps of many forms and zones as one UTC instant.

A value is parsed into calendar parts by JVM-side patterns. Local times then
meet the zone-offset intervals of their zone in an as-of join: intervals are
exploded per zone and year, two matching intervals mean an ambiguous time (the
first counts), none a skipped one (the offset before the change counts), one
gives the offset.

Defined cases: null, blank, impossible and relative values give null; digits
finer than a microsecond are cut; a local value at a site without a known zone
gives null; zone abbreviations are looked up among those the site's own zone
uses that year, then among ``KNOWN_OFFSETS``; years outside 1..9999 give null,
and outside 1900..2100 the first or last known offset holds.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FIRST_YEAR, LAST_YEAR = 1900, 2100

# Month names by their first letters (English, German, French, Spanish).
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "jän": 1, "mär": 3, "mrz": 3, "mai": 5, "okt": 10, "dez": 12,
    "fév": 2, "avr": 4, "jui": 6, "aoû": 8, "déc": 12, "ene": 1, "abr": 4, "ago": 8, "dic": 12,
}

# Offsets in minutes of abbreviations that a site's zone does not use.
KNOWN_OFFSETS = {
    "UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "IST": 330, "NPT": 345, "JST": 540, "ACST": 570, "ACDT": 630, "AEST": 600,
    "AEDT": 660, "AWST": 480, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

_ZONE = r"(Z|z|(?:UTC|GMT)?[+-]\d{2}:?\d{2}(?:\[[^\]]+\])?|\[[^\]]+\]|[A-Za-z_]+/[A-Za-z_/+-]+\d*|[A-Z]{2,5})?"
_HMS = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_AMPM = r"((?:[AaPp]\.?[Mm]\.?)(?![A-Za-z]))?"
_CLOCK = rf"(?:,?[ Tt]\s*{_HMS}\s*{_AMPM}(?: Uhr)?\s*{_ZONE})?"
_DOW = r"(?:\p{L}+\.?,? +)?"
_MON = r"(\p{L}{3,})\.?"

# pattern, replacement into kind|year|month|day|hour|minute|second|fraction|am-pm|zone
PATTERNS = [
    (rf"(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_CLOCK}", "L|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_CLOCK}", "S|$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (rf"(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_CLOCK}", "L|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"{_DOW}(\d{{1,2}})(?:\.|st|nd|rd|th)?[- ]+(?:de )?{_MON},?[- ]+(?:de )?(\d{{4}}){_CLOCK}", "L|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"{_DOW}{_MON} +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}}){_CLOCK}", "L|$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (rf"\p{{L}}{{3}} +{_MON} +(\d{{1,2}}) +{_HMS} *{_ZONE} +(\d{{4}})", "L|$8|$1|$2|$3|$4|$5|$6||$7"),
    (r"(\d{4})年(\d{1,2})月(\d{1,2})日(?: *(\d{1,2})[時时](\d{1,2})分(?:(\d{1,2})秒)?)?", "L|$1|$2|$3|$4|$5|$6|||"),
    (r"(?:D:)?(\d{4})(\d{2})(\d{2})[Tt]?(\d{2})(\d{2})(\d{2})(?:[.,](\d+))?(?:(Z|z|[+-]\d{2}):?'?(\d{2})?'?)?", "L|$1|$2|$3|$4|$5|$6|$7||$8$9"),
]
_NAMED_ZONE = r"(?<![A-Za-z_])([A-Za-z_]+/[A-Za-z_/+-]+\d*|(?<=\[)[^\[\]]+(?=\]))"
_EPOCH = r"^(\d{10}|\d{13}|\d{16})$"
_JSON_DATE = r"^/Date\((-?\d+)(?:[+-]\d{4})?\)/$"


_FOUND = "\x01"  # no value begins with it: white space and control characters are trimmed


def parts(value: Column) -> Column:
    """``kind|year|month|…`` of a trimmed value, null if no pattern fits.

    The patterns are tried one after the other on the same text, each once: what
    one has rewritten fits no other.
    """
    out = F.regexp_replace(value, f"^{_FOUND}+", "")
    for pattern, to in PATTERNS:
        out = F.regexp_replace(out, f"^{pattern}$", f"{_FOUND}{to}")
    return F.get(F.transform(F.array(out), lambda x: F.when(x.startswith(_FOUND), F.ltrim(x, F.lit(_FOUND)))), F.lit(0))


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _calendar(p: Column, america: Column) -> Column:
    """Struct of local seconds, micros, offset, abbreviation and zone from split parts."""
    at = lambda i: F.get(p, F.lit(i))
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    swap = (at(0) == "S") & ~america
    month_text, day = F.when(swap, at(3)).otherwise(at(2)), F.when(swap, at(2)).otherwise(at(3))
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    name = F.when(F.lower(month_text).startswith("juil"), F.lit("jul")).otherwise(F.lower(F.substring(month_text, 1, 3)))
    month = F.coalesce(_int(month_text), F.try_element_at(months, name))
    hour, minute, second = _int(at(4)), _int(at(5)), _int(at(6))
    hour24 = (
        F.when(blank(at(4)), 0)
        .when(blank(at(8)), F.when(hour < 24, hour))
        .when((hour >= 1) & (hour <= 12), F.pmod(hour, F.lit(12)) + F.when(F.lower(F.substring(at(8), 1, 1)) == "p", 12).otherwise(0))
    )
    date = F.when(_int(at(1)) >= 1, F.format_string("%04d-%02d-%02d", _int(at(1)), month, _int(day))).try_cast("date")
    local = (
        F.unix_date(date).cast("bigint") * 86400 + hour24 * 3600
        + F.when(blank(at(5)), 0).when(minute < 60, minute) * 60
        + F.when(blank(at(6)), 0).when(second < 60, second)
    )
    zone = F.coalesce(at(9), F.lit(""))
    sign = r"^(?:UTC|GMT)?([+-])(\d{2}):?(\d{2})?"
    offset = F.when(
        zone.rlike(sign),
        (_int(F.regexp_extract(zone, sign, 2)) * 3600 + F.coalesce(_int(F.regexp_extract(zone, sign, 3)), F.lit(0)) * 60)
        * F.when(F.regexp_extract(zone, sign, 1) == "-", -1).otherwise(1),
    ).when(F.upper(zone).isin("Z", "UTC", "GMT"), 0)
    is_name = zone.startswith("[") | zone.contains("/")
    return F.struct(
        local.alias("local"),
        F.coalesce(_int(F.rpad(F.substring(at(7), 1, 6), 6, "0")), F.lit(0)).alias("micros"),
        offset.alias("offset"),
        F.when(~is_name & (zone != ""), zone).alias("abbr"),
        F.when(is_name, F.regexp_replace(zone, r"[\[\]]", "")).alias("zone"),
    )


def parsed(df: DataFrame, value: str, time_zone: str) -> DataFrame:
    """Adds _dl_epoch (micros of epoch values), _dl_local (local seconds), _dl_micros,
    _dl_offset (seconds, of values that name one), _dl_abbr and _dl_zone.

    Each stage is bound by a one-element array, so no expression is repeated in
    the next one and the plan stays small.
    """
    bind = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))
    america = F.coalesce(F.col(time_zone), F.lit("")).startswith("America/")
    trimmed = F.regexp_replace(F.col(value), r"^[\s\p{Z}\x{feff}]+|[\s\p{Z}\x{feff}]+$", "")

    def epoch(v: Column) -> Column:
        scale = F.when(F.length(v) == 10, 1_000_000).when(F.length(v) == 13, 1_000).otherwise(1)
        return F.when(v.rlike(_EPOCH), v.try_cast("bigint") * scale).when(
            v.rlike(_JSON_DATE), F.regexp_extract(v, _JSON_DATE, 1).try_cast("bigint") * 1000
        )

    p = bind(bind(bind(trimmed, parts), lambda x: F.split(x, r"\|")), lambda x: _calendar(x, america))
    df = df.withColumns({"_dl_epoch": bind(trimmed, epoch), "_dl_parts": p})
    given = F.col("_dl_parts.offset").isNotNull()
    return df.select(
        *[c for c in df.columns if c != "_dl_parts"],
        F.col("_dl_parts.local").alias("_dl_local"), F.col("_dl_parts.micros").alias("_dl_micros"), F.col("_dl_parts.offset").alias("_dl_offset"),
        F.when(~given, F.col("_dl_parts.abbr")).alias("_dl_abbr"),
        F.coalesce(F.when(~given, F.col("_dl_parts.zone")), F.col(time_zone)).alias("_dl_zone"),
    )


def zone_intervals(name: str) -> list[tuple[int, int, int, str]]:
    """(utc_start, utc_end, offset, abbreviation) of a zone over 1900..2100."""
    from zoneinfo import ZoneInfo

    zone = ZoneInfo(name)
    first = datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc)
    days = (datetime(LAST_YEAR + 1, 1, 1, tzinfo=timezone.utc) - first).days

    def at(second: int) -> tuple[int, str]:
        t = (first + timedelta(seconds=second)).astimezone(zone)
        return round(t.utcoffset().total_seconds()), t.tzname()

    base, out = int(first.timestamp()), []
    start, now = 0, at(0)
    for week in range(0, days + 7, 7):
        end = week * 86400
        while at(end) != now:
            lo, hi = max(start, end - 7 * 86400), end
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == now else (lo, mid)
            out.append((start + base, hi + base, *now))
            start, now = hi, at(hi)
    out.append((start + base, days * 86400 + base, *now))
    far = 1 << 40
    out[0] = (-far, *out[0][1:])
    out[-1] = (out[-1][0], far, *out[-1][2:])
    return out


INTERVALS = "_dl_z_zone string, _dl_z_year int, _dl_z_list array<struct<lo: bigint, hi: bigint, off: int, abbr: string>>"


def _year(second: int) -> int:
    if second < -2208988800:
        return FIRST_YEAR
    return LAST_YEAR if second >= 4133980800 else (datetime(1970, 1, 1) + timedelta(seconds=second)).year


def _explode(frames):
    for f in frames:
        rows = []
        for name in f["z"]:
            try:
                intervals = zone_intervals(name)
            except Exception:  # noqa: BLE001 - no such zone
                continue
            years: dict[int, list] = {}
            for start, end, off, abbr in intervals:
                lo, hi = start + off, end + off
                for y in range(_year(lo - 86400), _year(hi + 86400) + 1):
                    years.setdefault(y, []).append({"lo": lo, "hi": hi, "off": off, "abbr": abbr})
            rows += [(name, y, sorted(v, key=lambda x: x["hi"] - x["off"])) for y, v in years.items()]
        yield pd.DataFrame(rows, columns=["_dl_z_zone", "_dl_z_year", "_dl_z_list"])


def offset_intervals(zones: DataFrame) -> DataFrame:
    """Zone-offset intervals per zone and local year.

    At most one row for each of the about 600 zone names and 201 years, some
    12 MB: bounded whatever the input holds, so it may be broadcast.
    """
    return zones.repartition(zones.sparkSession.sparkContext.defaultParallelism).mapInPandas(_explode, INTERVALS)


def to_utc(df: DataFrame, value: str, time_zone: str) -> DataFrame:
    """Adds utc_micros and zone_status (unique, ambiguous, skipped, given).

    ``time_zone`` names the column with the zone of values that name none.
    """
    keep = df.columns
    p = parsed(df, value, time_zone)
    need = F.col("_dl_local").isNotNull() & F.col("_dl_offset").isNull() & F.col("_dl_zone").isNotNull()
    # the zones that may be asked for, without parsing the values for it
    named = F.when(F.col(value).rlike(_NAMED_ZONE), F.regexp_extract(value, _NAMED_ZONE, 1))
    zones = df.select(F.explode(F.array(time_zone, named)).alias("z")).where("z is not null").distinct()
    intervals = offset_intervals(zones)
    seconds = F.col("_dl_local")
    bucket = F.greatest(F.lit(FIRST_YEAR), F.least(F.lit(LAST_YEAR), F.year(F.timestamp_seconds(seconds))))
    j = p.withColumn("_dl_year", F.when(need, bucket)).join(
        F.broadcast(intervals), (F.col("_dl_zone") == F.col("_dl_z_zone")) & (F.col("_dl_year") == F.col("_dl_z_year")), "left"
    )
    match = F.filter("_dl_z_list", lambda x: (x["lo"] <= seconds) & (seconds < x["hi"]))
    before = F.filter("_dl_z_list", lambda x: x["hi"] <= seconds)
    by_abbr = F.filter("_dl_z_list", lambda x: x["abbr"] == F.col("_dl_abbr"))
    known = F.create_map(*[F.lit(x) for k, v in KNOWN_OFFSETS.items() for x in (k, v * 60)])
    local_off = F.coalesce(F.get(match, F.lit(0))["off"], F.try_element_at(before, F.lit(-1))["off"])
    abbr_off = F.coalesce(F.get(by_abbr, F.lit(0))["off"], F.try_element_at(known, F.col("_dl_abbr")))
    offset = F.coalesce("_dl_offset", F.when(F.col("_dl_abbr").isNotNull(), abbr_off).otherwise(local_off))
    micros = F.coalesce("_dl_epoch", (seconds - offset) * 1_000_000 + F.col("_dl_micros"))
    given = F.col("_dl_epoch").isNotNull() | F.col("_dl_offset").isNotNull() | F.col("_dl_abbr").isNotNull()
    status = (
        F.when(micros.isNull(), None).when(given, "given").when(F.size(match) > 1, "ambiguous")
        .when(F.size(match) == 0, "skipped").otherwise("unique")
    )
    return j.select(*keep, micros.alias("utc_micros"), status.alias("zone_status"))


def metadata_instants(records: DataFrame, office: DataFrame, sites: DataFrame) -> DataFrame:
    """tab, item_id, field_name, utc_micros, zone_status of every dated value."""
    first = lambda c: F.get(c, F.lit(0))
    a = records.select(
        F.lit("content_records").alias("tab"), F.col("row_id").alias("item_id"), "site_id",
        F.lit("create_time").alias("field_name"), F.col("create_time").alias("value"),
    )
    pair = lambda c: F.struct(F.lit(c).alias("field_name"), first(c).alias("value"))
    b = office.select(
        F.lit("office_files").alias("tab"), F.col("file_no").alias("item_id"), "site_id",
        F.inline(F.array(pair("dcterms_created"), pair("dcterms_modified"))),
    )
    values = a.unionByName(b).where(F.col("value").isNotNull())
    zone = sites.select(F.col("site_id").alias("s_site"), "time_zone").dropDuplicates(["s_site"])
    placed = values.join(zone, F.col("site_id") == F.col("s_site"), "left").drop("s_site")
    return to_utc(placed, "value", "time_zone").where(F.col("utc_micros").isNotNull()).select(
        "tab", "item_id", "field_name", "utc_micros", "zone_status"
    )
