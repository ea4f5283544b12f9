"""Text expressions. All native but for NFKC and HTML entities, which go through an Arrow UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.udf import html_unescape, nfkc

# Code points that count as CJK, and the shapes of counts and prices in promotional text.
CJK = "㐀-䶿一-鿿"
COUNT_UNITS = r"(?i)\b\d+\s*(?:posts?|participants?|comments?|replies?)\b|\d+\s*(?:个帖子|位参与者|条评论|条回复|人参与)"
PROMOTION = r"(?i)(?:[¥￥$€£]\s*\d)|(?:\d+\s*(?:折|off))"


def text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def collapse(value: Column) -> Column:
    """Runs of white space to one space, none at the ends; null to ''."""
    return F.trim(F.regexp_replace(text(value), r"(?U)\s+", " "))


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty; '' if there is none."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def normalize_title(title: Column, compatibility: bool = True) -> Column:
    """Lower-case words by single spaces, CJK set apart from ASCII. compatibility=False leaves NFKC out (ASCII-safe input)."""
    out = F.lower(nfkc(text(title)) if compatibility else text(title))
    out = F.regexp_replace(out, f"([a-z0-9])(?=[{CJK}])", "$1 ")
    out = F.regexp_replace(out, f"([{CJK}])(?=[a-z0-9])", "$1 ")
    out = F.regexp_replace(out, r"(?U)[^\p{L}\p{N}_\s]+", " ")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def compact(normalized: Column) -> Column:
    return F.replace(normalized, F.lit(" "), F.lit(""))


def word_tokens(normalized: Column) -> Column:
    """Distinct words of two characters or more."""
    return F.array_distinct(F.filter(F.split(normalized, " "), lambda t: F.length(t) >= 2))


def bigrams(chars: Column) -> Column:
    """Distinct pairs of neighbouring characters; [] under two characters."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(chars) - 1), lambda i: F.substring(chars, i, F.lit(2)))
    return F.array_distinct(F.when(F.length(chars) >= 2, pairs).otherwise(F.array().cast("array<string>")))


def cjk_bigrams(compacted: Column) -> Column:
    return bigrams(F.regexp_replace(compacted, f"[^{CJK}]", ""))


def contains_cjk(value: Column) -> Column:
    return text(value).rlike(f"[{CJK}]")


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def embedded_domains(value: Column) -> Column:
    from newsloom.functions.url import url_host

    found = F.regexp_extract_all(text(value), F.lit(r"(?i)https?://\S+"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda u: url_host(u)), lambda d: d != ""))


def strip_tags(value: Column) -> Column:
    return html_unescape(F.regexp_replace(text(value), "<[^>]+>", ""))


def clean_html(value: Column) -> Column:
    """Entities, then tags to spaces, then collapsed."""
    return collapse(F.regexp_replace(html_unescape(text(value)), "<[^>]+>", " "))


def extract_cdata(value: Column) -> Column:
    inner = F.regexp_extract(text(value), r"(?s)<!\[CDATA\[(.*?)\]\]>", 1)
    return F.when(text(value).rlike(r"(?s)<!\[CDATA\[.*?\]\]>"), inner).otherwise(text(value))


def truncate(value: Column, limit: int) -> Column:
    """At most limit characters, the last three of a cut text an ellipsis."""
    v = text(value)
    return F.when(F.length(v) <= limit, v).otherwise(F.concat(F.rtrim(F.substring(v, 1, limit - 3)), F.lit("...")))


def truncate_at_space(value: Column, limit: int = 500) -> Column:
    """Cut at the limit, or at the last space before it if that keeps more than 80 % of the limit, with an ellipsis."""
    v = text(value)
    cut = F.substring(v, 1, limit)
    space = F.when(F.contains(cut, F.lit(" ")), F.length(cut) - F.instr(F.reverse(cut), " ")).otherwise(-1)
    kept = F.when(space > limit * 0.8, F.substring(cut, F.lit(1), space)).otherwise(cut)
    return F.when(F.length(v) <= limit, v).otherwise(F.concat(kept, F.lit("...")))


# What counts as Markdown in release notes, in the order in which it is taken out.
MARKDOWN = (
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),  # links
    (r"\*+([^*]+)\*+", "$1"),  # emphasis by asterisks; underscores stay
    (r"(?mU)^#+\s*", ""),  # headings
    (r"```[^`]*```", ""),  # fences
    (r"`([^`]+)`", "$1"),  # inline code
)


def strip_markdown(value: Column) -> Column:
    out = text(value)
    for pattern, kept in MARKDOWN:
        out = F.regexp_replace(out, pattern, kept)
    return out


def release_summary(body: Column, limit: int = 500) -> Column:
    """Release notes as one line of plain text."""
    return truncate_at_space(collapse(strip_markdown(body)), limit)


def search_term(term: Column, exclude: bool = False) -> Column:
    """A term of a search query: quoted if it has a blank, with a minus if it is excluded; '' for blank terms."""
    t = F.trim(text(term))
    quoted = F.when(F.contains(t, F.lit(" ")), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)
    return F.when(t == "", "").otherwise(F.concat(F.lit("-"), quoted) if exclude else quoted)


def search_query(base: Column, exclude: Column) -> Column:
    terms = F.filter(F.transform(exclude, lambda t: search_term(t, True)), lambda t: t != "")
    return F.trim(F.concat_ws(" ", F.trim(text(base)), F.array_join(terms, " ")))


def search_url(prefix: str, keyword: Column) -> Column:
    return F.concat(F.lit(prefix), F.replace(F.url_encode(text(keyword)), F.lit("+"), F.lit("%20")))


def error_text(value: Column, limit: int = 180) -> Column:
    """First two lines that aren't blank, joined by a bar and cut."""
    lines = F.filter(F.transform(F.split(text(value), r"\R"), lambda x: collapse(x)), lambda x: x != "")
    return truncate(F.array_join(F.slice(lines, 1, 2), " | "), limit)


def humanize_id(value: Column) -> Column:
    return F.initcap(F.translate(value, "-_", "  "))


def short_repo(value: Column) -> Column:
    return F.element_at(F.split(value, "/"), -1)


def output_markers(lines: Column) -> Column:
    """map of KEY=VALUE lines, the last of a key wins."""
    pairs = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x.rlike(r"^[A-Z][A-Z0-9_]*="))
    entries = F.transform(pairs, lambda x: F.struct(F.regexp_extract(x, "^([^=]+)=", 1).alias("key"), F.regexp_extract(x, "(?s)^[^=]+=(.*)$", 1).alias("value")))
    last = F.aggregate(entries, F.array().cast("array<struct<key:string,value:string>>"), lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["key"]), F.array(e)))
    return F.map_from_entries(last)
