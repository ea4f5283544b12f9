"""Number expressions: priorities, human counts, half-even rounding, score ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_priority(priority: Column, default: int = 3) -> Column:
    """Whole number clamped to 1..10; the default where it is missing or no number."""
    return F.greatest(F.lit(1), F.least(F.lit(10), F.coalesce(priority.try_cast("int"), F.lit(default))))


def flagged_priority(priority: Column, default: int = 3) -> Column:
    """Priority of a catalogue that also marks sources by true and false: true is 8, false the default. priority: text or boolean."""
    t = F.lower(F.trim(priority.cast("string")))
    return F.when(t == "true", 8).when(t == "false", default).otherwise(normalize_priority(t, default))


def human_number(text: Column) -> Column:
    """Count written for people: "1,234", "1.2万", "3亿", "5w"; null without digits. Fractions are cut off."""
    plain = F.replace(F.trim(text), F.lit(","), F.lit(""))
    pattern = r"(?i)(\d+(?:\.\d+)?)\s*([万亿w]?)"
    number = F.nullif(F.regexp_extract(plain, pattern, 1), F.lit("")).try_cast("double")
    unit = F.lower(F.regexp_extract(plain, pattern, 2))
    scale = F.when(unit.isin("万", "w"), 1e4).when(unit == "亿", 1e8).otherwise(1.0)
    return F.floor(number * scale + 1e-6).cast("bigint")


def count_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def ladder(value: Column, steps: list[tuple[float, float]], default: float = 0.0) -> Column:
    """Score of the first threshold that value reaches; steps from the highest down."""
    out = None
    for least, score in steps:
        hit = value >= F.lit(least)
        out = F.when(hit, F.lit(score)) if out is None else out.when(hit, F.lit(score))
    return out.otherwise(F.lit(default))


def rounded(value: Column, digits: int = 3) -> Column:
    """Half-even rounding."""
    return F.bround(value, digits)
