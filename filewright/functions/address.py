"""Addresses (AD1-AD10, J9, J10) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filewright.functions.company import has_ending
from filewright.functions.scalars import any_of, blank_to_null, let, squeeze, trim_all
from filewright.functions.vocab import COUNTRIES, PLACE_CODES, US_STATES

# Number words, street types and directions that a US street line abbreviates.
NUMBERS = {"one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
TYPES = {"street": "St", "avenue": "Ave", "road": "Rd", "boulevard": "Blvd", "drive": "Dr", "lane": "Ln", "court": "Ct", "place": "Pl", "square": "Sq", "parkway": "Pkwy", "highway": "Hwy", "terrace": "Ter", "circle": "Cir"}
_UNIT = r"(?i)[,\s]+((?:suite|ste|unit|apt|apartment|floor|fl|room|rm|#)\.?\s*[\w-]+|\d+(?:st|nd|rd|th)\s+(?:floor|fl))\.?\z"


def clean_street(c: Column) -> Column:
    """AD1: a blank line or one that looks like a company is null; what follows c/o goes; blanks are squeezed."""
    cut = squeeze(F.regexp_replace(c, r"(?i)\bc/o\b.*", ""))
    return F.when(~has_ending(c), blank_to_null(cut))


def consolidate(*streets: Column) -> Column:
    """AD2: the lines that aren't blank, moved up."""
    return F.filter(F.array(*streets), lambda x: x.isNotNull() & (trim_all(x) != ""))


def place_code(*lines: Column) -> Column:
    """AD3, J10: the code of the first place that a line names; the lines in order, the places in theirs."""
    table = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in PLACE_CODES.items()))
    return F.coalesce(*(_first_place(table, line) for line in lines))


def _first_place(table: Column, line: Column) -> Column:
    named = lambda x: F.when(x.rlike(any_of(list(PLACE_CODES))), F.get(F.filter(table, lambda e: F.contains(x, e["k"])), F.lit(0))["v"])
    return let(F.upper(line), named)


def country_code(code: Column, name: Column | None = None, supplied: Column | None = None, countries: list[tuple[str, str, str]] = COUNTRIES) -> Column:
    """AD4, J9: the ISO code by filing code, else by the country's name, else the supplied one; first match wins."""
    by_code, by_name = {}, {}
    for c, iso, full in countries:
        by_code.setdefault(c, iso)
        by_name.setdefault(full.upper(), iso)
    by_code |= {s: "US" for s in US_STATES if s not in by_code}
    look = lambda m, c: F.try_element_at(F.create_map(*(F.lit(x) for p in m.items() for x in p)), F.upper(trim_all(c)))
    return F.coalesce(look(by_code, code), look(by_name, code), *([look(by_name, name)] if name is not None else []), *([F.upper(trim_all(supplied))] if supplied is not None else []))


def city(c: Column) -> Column:
    """AD5."""
    for pattern, by in ((r"(?i)\b(SAINT|ST\.?)\b", "ST"), (r"(?i)\b(MOUNT|MT\.?)\b", "MT"), (r"(?i)\b(NYC?)\b", "New York"), (r"(?i)\b(New York City)\b", "New York")):
        c = F.regexp_replace(c, pattern, by)
    return F.upper(squeeze(c))


def us_street(c: Column) -> Column:
    """AD6: (street1, street2): number words to digits, common types abbreviated, a unit moved to the second line."""
    unit = F.nullif(F.regexp_extract(c, _UNIT, 1), F.lit(""))
    digits = F.create_map(*(F.lit(x) for pair in NUMBERS.items() for x in pair))

    def counted(x: Column) -> Column:
        digit = F.try_element_at(digits, F.lower(F.regexp_extract(x, r"^(\w+)\s", 1)))
        return F.coalesce(F.concat(digit, F.regexp_extract(x, r"^\w+(\s.*)\z", 1)), x)

    line = let(F.regexp_replace(c, _UNIT, ""), counted)
    for word, short in TYPES.items():
        line = F.regexp_replace(line, rf"(?i)(?<=\w\s)\b{word}\b\.?(?=\s*(?:[NSEW]{{1,2}}\.?)?\s*\z)", short)
    return F.struct(squeeze(line).alias("street1"), unit.alias("street2"))


def postal_code(c: Column, country: Column) -> Column:
    """AD7."""

    def normal(t: Column) -> Column:
        us = F.nullif(F.regexp_extract(t, r"([0-9]{5})-[0-9]{4}", 1), F.lit(""))
        ca = F.when(t.rlike(r"^[A-Z][0-9][A-Z]\s?[0-9][A-Z][0-9]\z"), F.concat(F.substring(t, 1, 3), F.lit(" "), F.substring(t, -3, 3)))
        gb = F.when(t.rlike(r"^[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s?[0-9][A-Z]{2}\z"), F.concat(F.regexp_extract(t, r"^(.*?)\s?[0-9][A-Z]{2}\z", 1), F.lit(" "), F.substring(t, -3, 3)))
        return F.when(t == "", None).otherwise(F.coalesce(F.when(country == "US", us).when(country == "CA", ca).when(country == "GB", gb), t))

    return let(F.upper(trim_all(c)), normal)


def address_key(*parts: Column) -> Column:
    """AD10: the parts that aren't blank, trimmed, lower-cased and joined."""
    return F.concat_ws("|", *(F.nullif(F.lower(trim_all(p)), F.lit("")) for p in parts))


def _facts(street1: Column, street2: Column, street3: Column, city_: Column, state: Column, country: Column | None, countries: list) -> Column:
    lines = consolidate(clean_street(street1), clean_street(street2), clean_street(street3))
    return let(F.coalesce(blank_to_null(state), place_code(street1, street2, street3, city_)), lambda code: F.struct(code.alias("code"), country_code(code, None, country, countries).alias("iso"), lines.alias("lines")))


def is_unknown(street1: Column, street2: Column, street3: Column, city_: Column, state: Column, zip_: Column, country: Column | None = None, countries: list = COUNTRIES) -> Column:
    """AD9: address() is null for these, told without the parts that never decide it (abbreviations, postal code, key)."""

    def missing(x: Column) -> Column:
        first = F.get(x["lines"], F.lit(0))
        one = F.coalesce(F.when((x["iso"] == "US") & first.isNotNull(), F.regexp_replace(first, _UNIT, "")), first, blank_to_null(street1))
        return ~F.coalesce((x["code"] != "") & (x["iso"] != "") & (trim_all(city_) != "") & (trim_all(one) != ""), F.lit(False))

    return let(_facts(street1, street2, street3, city_, state, country, countries), missing)


def address(street1: Column, street2: Column, street3: Column, city_: Column, state: Column, zip_: Column, country: Column | None = None, countries: list = COUNTRIES) -> Column:
    """AD1-AD10 together: the normal address as a struct, null unless street, state, city and country are known."""
    facts = _facts(street1, street2, street3, city_, state, country, countries)

    def parsed(x: Column) -> Column:
        first = F.get(x["lines"], F.lit(0))
        us = F.when((x["iso"] == "US") & first.isNotNull(), us_street(first))
        return let(us, lambda u: F.struct(x["code"].alias("code"), x["iso"].alias("iso"), F.coalesce(u["street1"], first, blank_to_null(street1)).alias("one"), F.array_compact(F.concat(F.array(u["street2"]), F.slice(x["lines"], 2, 2))).alias("rest")))

    def row(x: Column) -> Column:
        parts = F.struct(
            x["one"].alias("street1"), F.get(x["rest"], F.lit(0)).alias("street2"), F.get(x["rest"], F.lit(1)).alias("street3"), city(city_).alias("city"),
            x["code"].alias("state_or_country"), x["iso"].alias("country_code"), postal_code(zip_, x["iso"]).alias("zip"),
        )
        names = ("street1", "street2", "street3", "city", "state_or_country", "country_code", "zip")
        whole = lambda p: F.when((p["street1"] != "") & (p["state_or_country"] != "") & (p["city"] != "") & (p["country_code"] != ""), F.struct(address_key(*(p[n] for n in names)).alias("address_hash_id"), *(p[n].alias(n) for n in names)))
        return let(parts, whole)

    return let(let(facts, parsed), row)
