"""Time text to instants: every written form is read by a few anchored patterns inside the JVM.

A value is split into year, month, day, hour, minute, second, fraction, half of day and zone; only then is it
validated, so an impossible value (month 13, 31 November, hour 25) becomes null and never an error.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone abbreviations with their usual offset in minutes.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "AEST": 600, "ACDT": 630,
    "AEDT": 660, "NZST": 720, "NZDT": 780, "BRT": -180, "ART": -180, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
MONTHS = "".join(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"))

_MON = r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"
_DAY = r"(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([AaPp])\.?[Mm]\.?)?"
_ZONE = r"(?:\s*((?:UTC|GMT)?[+-]\d{1,2}:?\d{2}|(?:UTC|GMT)[+-]\d{1,2}|[A-Z]{1,5}|[A-Z][A-Za-z]+(?:/[A-Za-z_+\-0-9]+)+))?(?:\[[^\]]*\])?"

#: (pattern, replacement): each replacement lists @|year|month|day|hour|minute|second|fraction|half|zone|
SHAPES = (
    (rf"^(\d{{4}})\s*[-/.年]\s*(\d{{1,2}})\s*[-/.月]\s*(\d{{1,2}})\s*日?(?:(?:T|\s+|\s*,\s*){_CLOCK}{_HALF})?{_ZONE}$", "@|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T(\d{{2}})(\d{{2}})(?:(\d{{2}}))?)?{_ZONE}$", "@|$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"(?i)^{_DAY}(\d{{1,2}})\s+{_MON},?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK}{_HALF})?(?-i){_ZONE}$", "@|$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"(?i)^{_DAY}{_MON}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK}{_HALF})?(?-i){_ZONE}$", "@|$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
    (rf"(?i)^{_DAY}{_MON}\s+(\d{{1,2}})\s+{_CLOCK}\s+(?-i)([+-]\d{{4}}|[A-Z]{{1,5}})\s+(\d{{4}})$", "@|$8|$1|$2|$3|$4|$5|$6||$7|"),
)
EPOCH_RE = r"^(\d{10}|\d{13}|\d{16}|\d{19})(?:\.\d+)?$"
AGO_RE = r"(?i)^(\d{1,6})\s*(second|sec|minute|min|hour|hr|day|week)s?\s+ago$"
AGO_ZH_RE = r"^(\d{1,6})\s*(秒钟?|分钟?|个?小时|天|日|周|个?星期)前$"
ALREADY_UTC_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00$"


def known_zones() -> list[str]:
    return sorted(z for z in zoneinfo.available_timezones() if "/" in z or z == "UTC")


def is_zone(name: Column) -> Column:
    """Whether a name is an IANA zone; the list is one literal, folded to an array when the plan is made."""
    return F.array_contains(F.split(F.lit(",".join(known_zones())), ","), name)


def time_fields(value: Column) -> Column:
    """array<string> of ['@', year, month, day, hour, minute, second, fraction, half, zone, '']; other shapes lack the '@'."""
    text = F.trim(F.regexp_replace(value, r"(?U)\s+", " "))
    for pattern, fields in SHAPES:
        text = F.regexp_replace(text, pattern, fields)
    return F.split(text, r"\|")


def _int(fields: Column, i: int, empty: int | None = None) -> Column:
    return F.when(F.get(fields, i) == "", F.lit(empty)).otherwise(F.get(fields, i).try_cast("int"))


def zone_seconds(zone: Column) -> Column:
    """Offset of a written zone (Z, +08:00, UTC+8, CEST); null for '' and for region names."""
    signed = F.regexp_replace(F.regexp_replace(zone, "^(UTC|GMT)(?=[+-])", ""), r"^([+-])(\d)(?=$|:)", "$10$2")
    hours = F.substring(signed, 2, 2).try_cast("int")
    minutes = F.coalesce(F.substring(F.replace(signed, F.lit(":"), F.lit("")), 4, 2).try_cast("int"), F.lit(0))
    sign = F.when(signed.startswith("-"), -1).otherwise(1)
    names = F.str_to_map(F.lit(",".join(f"{z}:{m}" for z, m in ZONE_MINUTES.items())))
    return (
        F.when(signed.rlike(r"^[+-]\d{2}:?(\d{2})?$") & (hours <= 18) & (minutes < 60), sign * (hours * 3600 + minutes * 60))
        .otherwise(F.try_element_at(names, zone).try_cast("int") * 60)
    )


def parts(fields: Column) -> dict[str, Column]:
    """Numbers of a field array; hour is null where the half of day doesn't fit it, all is null for other shapes."""
    at = lambda i: F.get(fields, i)
    month = F.coalesce(at(2).try_cast("int"), F.floor((F.instr(F.lit(MONTHS), F.lower(F.substring(at(2), 1, 3))) + 2) / 3).cast("int"))
    hour, half = _int(fields, 4, 0), F.lower(at(8))
    twelve = F.when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = _int(fields, 6, 0)
    return {
        "year": F.when(at(0) == "@", at(1).try_cast("int")), "month": month, "day": at(3).try_cast("int"),
        "hour": F.when(half == "", hour).otherwise(twelve), "minute": _int(fields, 5, 0),
        "second": F.when(second < 60, second), "bare": at(4) == "", "zone": F.when(at(0) == "@", at(9)),
    }


def local_timestamp(fields: Column) -> Column:
    """The clock reading, held as if its zone were UTC; null where the calendar or the clock has no such value."""
    p = parts(fields)
    second = p["second"].cast("decimal(8,6)")
    return F.when(p["year"] > 0, F.try_make_timestamp(p["year"], p["month"], p["day"], p["hour"], p["minute"], second, F.lit("UTC")))


def local_to_utc(local: Column, zone: Column, bare_day: Column) -> Column:
    """Instant of a clock reading in an IANA zone.

    A reading that occurs twice means the first; one that a clock change skips means nothing, except that a bare day whose
    midnight is skipped starts with its first moment.
    """
    instant = F.to_utc_timestamp(local, zone)
    return F.when(bare_day | (F.from_utc_timestamp(instant, zone) == local), instant)


def epoch_seconds(value: Column) -> Column:
    """Whole seconds of an epoch value written in s, ms, us or ns; null for anything else."""
    whole = F.regexp_extract(F.trim(value), EPOCH_RE, 1)
    digits = F.length(whole)
    seconds = F.substring(whole, 1, 10).try_cast("bigint")  # 10, 13, 16 and 19 digits all lead with the seconds
    return F.when(digits > 0, seconds)


def span_seconds(value: Column) -> Column:
    """Length in seconds of "3 hours ago" and the like; null for other text."""
    text = F.trim(value)
    number = F.coalesce(F.nullif(F.regexp_extract(text, AGO_RE, 1), F.lit("")), F.nullif(F.regexp_extract(text, AGO_ZH_RE, 1), F.lit("")))
    unit = F.lower(F.concat(F.regexp_extract(text, AGO_RE, 2), F.regexp_extract(text, AGO_ZH_RE, 2)))
    each = (
        F.when(unit.rlike("^(sec|秒)"), 1)
        .when(unit.rlike("^(min|分)"), 60)
        .when(unit.rlike("^(h|个?小时)"), 3600)
        .when(unit.rlike("^(day|天|日)"), 86400)
        .when(unit.rlike("^(week|周|个?星期)"), 604800)
    )
    return number.try_cast("bigint") * each


def parse_feed_date(value: Column) -> Column:
    """Feed dates (RFC 822, ISO, bare day); text without a zone counts as UTC."""

    def instant(fields: Column) -> Column:
        zone = parts(fields)["zone"]
        shift = F.when(zone == "", F.lit(0)).otherwise(zone_seconds(zone))
        return F.timestamp_seconds(F.unix_seconds(local_timestamp(fields)) - shift)

    return once(time_fields(value), instant)


def once(value: Column, use) -> Column:
    """use(value) with value computed a single time, however often use names it."""
    return F.get(F.transform(F.array(value), use), 0)


def recency_score(ts: Column, now: Column) -> Column:
    """1.5 under 6 hours of age (and for the future), 1.0 under 24, else 0; 0 without a date."""
    hours = (F.unix_micros(now) - F.unix_micros(ts)) / 3.6e9
    return F.when(hours < 6, 1.5).when(hours < 24, 1.0).otherwise(0.0)


def iso_text(second: Column) -> Column:
    """Whole seconds since 1970 as ISO text in UTC, whatever the session's zone; null for null."""
    day, rest = F.floor(second / 86400), F.pmod(second, F.lit(86400))
    clock = F.format_string("T%02d:%02d:%02d+00:00", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))
    return F.when(second.isNotNull(), F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), clock))


def local_text(ts: Column, zone: Column) -> Column:
    """Instant as ISO text with the offset of a zone."""
    wall = F.from_utc_timestamp(F.to_utc_timestamp(ts, F.current_timezone()), zone)
    minutes = ((F.unix_seconds(F.to_timestamp_ntz(F.date_format(wall, "yyyy-MM-dd HH:mm:ss")).cast("timestamp")) - F.unix_seconds(ts)) / 60).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.concat(sign, F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.pmod(F.abs(minutes), F.lit(60))))
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def local_day(ts: Column, zone: Column) -> Column:
    """Calendar day of an instant in a zone."""
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(ts, F.current_timezone()), zone))
