"""Scalar functions on dates, identifiers, numbers and text (D*, N*, H*, B*), all as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from filewright.functions.vocab import BAD_PERSON

SPACE = "\\s\\u00A0"


def trim_all(c: Column) -> Column:
    """Trim white space of any kind, not only blanks."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; the ends are trimmed."""
    return trim_all(F.regexp_replace(c, f"[{SPACE}]+", " "))


def blank_to_null(c: Column) -> Column:
    return let(c, lambda x: F.when(trim_all(x) != "", x))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it: expressions would else grow with each use."""
    return F.element_at(F.transform(F.array(value), f), 1)


def replace_first(c: Column, literal: str, by: str = "") -> Column:
    """Replace the first occurrence of a literal."""
    return F.regexp_replace(c, f"(?s)^(.*?)\\Q{literal}\\E", "$1" + by)


def parse_date(c: Column) -> Column:
    """A date written yyyy-M-d, yyyy/M/d, M/d/yyyy, M-d-yyyy or yyyyMMdd; anything else is null."""
    c = trim_all(c)
    forms = {r"^\d{4}-\d{1,2}-\d{1,2}\z": "yyyy-M-d", r"^\d{4}/\d{1,2}/\d{1,2}\z": "yyyy/M/d", r"^\d{1,2}/\d{1,2}/\d{4}\z": "M/d/yyyy", r"^\d{1,2}-\d{1,2}-\d{4}\z": "M-d-yyyy", r"^\d{8}\z": "yyyyMMdd"}
    return F.coalesce(*(F.when(c.rlike(p), F.try_to_date(c, f)) for p, f in forms.items()))


def sec_date(c: Column) -> Column:
    """A date, timestamp or text as yyyy-MM-dd."""
    return F.date_format(c, "yyyy-MM-dd")


def is_sec_date(c: Column) -> Column:
    """D3."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.lit(False))


def today(fixed: str | None = None) -> Column:
    """The date of today, or a fixed one for repeatable runs."""
    return F.to_date(F.lit(fixed)) if fixed else F.current_date()


def quarter_of(c: Column) -> Column:
    """D5."""
    return F.quarter(c)


def quarters(start: Column, end: Column) -> Column:
    """The first days of the quarters from start's to end's, both included."""
    return F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 months"))


def backoff(c: Column) -> Column:
    """A year later; 29 February becomes the 28th."""
    return F.add_months(c, 12)


def pad_cik(c: Column) -> Column:
    """An id with leading zeros, ten digits."""
    return F.lpad(c.cast("long").cast("string"), 10, "0")


def strip_dashes(c: Column) -> Column:
    """N2."""
    return F.replace(c, F.lit("-"), F.lit(""))


def parse_int(c: Column) -> Column:
    """The leading integer of a text, null without one."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("long")


def unescape(c: Column) -> Column:
    """Entities decoded once, numeric ones and the named ones of HTML 4; anything else stays as it is."""
    names = F.create_map(*(F.lit(x) for k, v in sorted({**name2codepoint, "apos": 39}.items()) for x in (k, v)))

    def part(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10).cast("int")).when(name.startswith("#"), F.substring(name, 2, 7).cast("int"))
        return let(F.struct(name.alias("name"), F.coalesce(number, F.try_element_at(names, name)).alias("code")), lambda x: _decoded(p, x))

    parts = F.split(c, "&", -1)
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.size(parts)), part)), "")).otherwise(c)


def _decoded(p: Column, x: Column) -> Column:
    fine = (x["code"] > 0) & (x["code"] < 0x110000) & ~x["code"].between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(x["code"]), 8, "0")), "UTF-32")
    return F.when(fine, F.concat(char, F.substring(p, F.length(x["name"]) + 2, F.length(p)))).otherwise(F.concat(F.lit("&"), p))


def clean_html(c: Column) -> Column:
    """H1: entities decoded, line breaks and no-break spaces to blanks, blanks squeezed, only what follows <TEXT>."""
    c = F.regexp_replace(F.regexp_replace(unescape(c), "[\u00A0\r\n]", " "), " +", " ")
    at = F.instr(c, "<TEXT>")
    return F.when(at > 0, F.substring(c, at + 6, F.length(c))).otherwise(c)


# Phrases that stand before or after a company's name in a signature.
COMPANY_PREFIX = r"^(?<prefix>(\(?Managing Partner|Managing Member|Partner|General Partner\)?)\s+(of the Issuer|of Issuer|of (the )?General Partner)?)\b"
COMPANY_POSTFIX = r"\b(?<postfix>(\(?Managing Partner|Managing Member|Partner|General Partner\)?)(\s+(of the Issuer|of Issuer|of (the )?General Partner))?)$"


def company_prefix(c: Column) -> Column:
    """H2: the phrase of a role that a company's name follows; empty without one."""
    return F.regexp_extract(c, f"(?i){COMPANY_PREFIX}", 1)


def company_postfix(c: Column) -> Column:
    """H2: the phrase of a role that follows a company's name; empty without one."""
    return F.regexp_extract(c, f"(?i){COMPANY_POSTFIX}", 1)


def is_bad_person(c: Column) -> Column:
    """B1: a field that is missing or holds no name; compared without case."""
    return F.coalesce(F.lower(trim_all(c)).isin([x.lower() for x in BAD_PERSON]) | (trim_all(c) == ""), F.lit(True))


def any_of(words: list[str]) -> str:
    """A regular expression for any of the words, literally."""
    return "|".join(re.escape(w).replace(r"\ ", " ") for w in words)
