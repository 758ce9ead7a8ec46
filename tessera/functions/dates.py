"""Date extraction from free text (F1-F4): a cascade of patterns, first hit wins.

The whole cascade is one projection (a ``CASE WHEN`` chain), evaluated in
whole-stage code generation; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations, in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Month names as notes spell them, two common misspellings included.
_MON = ("(?i)\\b(jan(?:uary|aury)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
        "|oct(?:ober)?|nov(?:ember)?|dec(?:ember|emeber)?)")
_SEP = "[\\s,.-]+"  # between the parts of a written date
# Patterns in priority order (the first one that yields a date wins).
PATTERNS = [
    ("m/d/yyyy", "([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})", ("m", "d", "y")),
    ("m/d/yy", "([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{2})(?:[^0-9]|$)", ("m", "d", "yy")),
    ("mon d yyyy", f"{_MON}{_SEP}([0-9]{{1,2}}){_SEP}([0-9]{{4}})", ("mon", "d", "y")),
    ("d mon yyyy", f"([0-9]{{1,2}}){_SEP}{_MON}{_SEP}([0-9]{{4}})", ("d", "mon", "y")),
    ("mon dth yyyy", f"{_MON}{_SEP}([0-9]{{1,2}})(?:st|nd|rd|th){_SEP}([0-9]{{4}})", ("mon", "d", "y")),
    ("mon yyyy", f"{_MON}{_SEP}([0-9]{{4}})", ("mon", "y")),
    ("m/yyyy", "([0-9]{1,2})/([0-9]{4})", ("m", "y")),
    ("yyyy", "((?:19|20)[0-9]{2})", ("y",)),
]


def month_number(name) -> Column:
    """Month name or abbreviation (any case) -> 1..12, NULL if unknown."""
    c = F.col(name) if isinstance(name, str) else name
    key = F.lower(F.substring(c, 1, 3))
    pos = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), key)
    return F.when(pos > 0, pos.cast("int"))


def two_digit_year(yy) -> Column:
    """yy -> 19yy (the rule of the source notes)."""
    c = F.col(yy) if isinstance(yy, str) else yy
    return F.concat(F.lit("19"), F.lpad(c, 2, "0"))


def _make(y: Column, m: Column, d: Column) -> Column:
    txt = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"),
                      F.lpad(d.cast("string"), 2, "0"))
    return F.to_date(F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")))


def _parse(text: Column, pattern: str, parts: tuple) -> Column:
    g = {name: F.regexp_extract(text, pattern, i + 1) for i, name in enumerate(parts)}
    y = two_digit_year(g["yy"]) if "yy" in g else g["y"]
    m = month_number(g["mon"]) if "mon" in g else (g["m"] if "m" in g else F.lit("1"))
    d = g.get("d", F.lit("1"))
    return _make(y, m, d)


def extract_date(text) -> Column:
    """Date of the first pattern (in priority order) that matches ``text``;
    missing day/month = 1. An impossible date (9/31/2009) gives NULL: the
    matching pattern decides, later patterns are not tried."""
    c = F.col(text) if isinstance(text, str) else text
    out = None
    for _, p, parts in PATTERNS:
        hit = c.rlike(p)
        out = F.when(hit, _parse(c, p, parts)) if out is None else out.when(hit, _parse(c, p, parts))
    return out
