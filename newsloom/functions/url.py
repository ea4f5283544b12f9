"""URL expressions, all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that start with one of these track the reader.
TRACKING_PREFIXES = ("utm_", "spm", "scm", "mc_", "ref", "refer", "aff", "share", "tk")
TRACKING_RE = "^(" + "|".join(TRACKING_PREFIXES) + ")"

URL_RE = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*).*$"


def cleaned(url: Column) -> Column:
    """Without tabs and line ends anywhere, and without control characters and spaces before it; null to ''."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def url_host(url: Column) -> Column:
    """Lower-case host with every `www.` removed; '' where there is none or the link is null."""
    host = F.regexp_extract(cleaned(url), URL_RE, 1)
    return F.replace(F.lower(host), F.lit("www."), F.lit(""))


def normalize_url(url: Column) -> Column:
    """Host and path without scheme, query, fragment, `;parameters` of the last segment and closing slash."""
    path = F.regexp_replace(F.regexp_extract(cleaned(url), URL_RE, 2), r";[^/]*$", "")
    return F.concat(url_host(url), F.regexp_replace(path, "/+$", ""))


def query_text(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)


def tracking_params(url: Column) -> Column:
    """Number of query keys on the tracking list; a key counts once for each time it stands there."""
    keys = F.transform(F.split(query_text(url), "&"), lambda p: F.lower(F.trim(F.split_part(p, F.lit("="), F.lit(1)))))
    return F.size(F.filter(keys, lambda k: k.rlike(TRACKING_RE)))


def in_domains(url: Column, domains: Column) -> Column:
    """Whether the host is one of the domains or below one; an empty or missing list accepts all."""
    host = url_host(url)
    hit = F.exists(domains, lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))
    return F.when(F.coalesce(F.size(domains), F.lit(0)) <= 0, True).otherwise(F.coalesce(hit, F.lit(False)))


def resolve_link(link: Column, base: Column) -> Column:
    """Absolute http(s) form of a link found on a page; '' for other schemes."""
    text = F.trim(F.coalesce(link, F.lit("")))
    origin = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^?#]*/)", 1)
    return (
        F.when(text.rlike("(?i)^https?://"), text)
        .when(text == "", "")
        .when(text.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), text))
        .when(text.rlike("(?i)^[a-z][a-z0-9+.-]*:"), "")
        .when(text.startswith("/"), F.concat(origin, text))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), text))
    )
