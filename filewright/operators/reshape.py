"""Flattening (F2-F6) and wire-to-table mappings (P13, P14) of submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filewright.functions.scalars import parse_int
from filewright.functions.phone import phone_or_us
from filewright.functions.address import address, country_code

_WIRE = {
    "accessionNumber": "accession_number", "filingDate": "filing_date", "reportDate": "report_date", "acceptanceDateTime": "acceptance_date", "act": "act", "form": "form",
    "filmNumber": "film_number", "fileNumber": "file_number", "items": "items", "size": "size", "isXBRL": "is_xbrl", "isInlineXBRL": "is_inline_xbrl",
    "primaryDocument": "primary_doc", "primaryDocDescription": "primary_doc_description",
}


def zip_rows(df: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """parallel arrays to rows."""
    return df.select(*keep, F.inline(F.arrays_zip(*arrays)))


def zip_present(df: DataFrame, keep: list[str], a: str, b: str) -> DataFrame:
    """two parallel arrays to rows, without those where either is null or empty."""
    return zip_rows(df, keep, [a, b]).where((F.col(a) != "") & (F.col(b) != ""))


def falsy_to_null(c: Column, kind: str) -> Column:
    """P13: '', 0 and false become null."""
    if kind == "boolean":
        return F.when(c, F.lit(True))
    return F.nullif(c, F.lit("") if kind == "string" else F.lit(0).cast(kind))


def wire_flag(c: Column) -> Column:
    """A flag written 0 or 1, as text or number."""
    return F.when(c.cast("string") == "1", F.lit(True))


def filings(submission: DataFrame, overflow: DataFrame | None = None) -> DataFrame:
    """The filings of main documents and of overflow batches (cik, recent)."""
    one = submission.select(parse_int(F.col("cik").cast("string")).alias("cik"), F.col("filings.recent").alias("recent"))
    if overflow is not None:
        one = one.unionByName(overflow.select("cik", "recent"))
    types = one.schema["recent"].dataType  # an array that is not there is all null
    rows = one.select("cik", F.inline(F.arrays_zip(*(F.coalesce(F.col(f"recent.{c}"), F.array().cast(types[c].dataType)).alias(c) for c in _WIRE))))
    out = []
    for wire, name in _WIRE.items():
        c = F.col(wire)
        out.append((wire_flag(c) if name.startswith("is_") else F.nullif(c, F.lit(0)) if name == "size" else F.regexp_replace(F.nullif(c, F.lit("")), "^xsl[^/]+/", "") if name == "primary_doc" else F.nullif(c, F.lit(""))).alias(name))
    return rows.select("cik", *out).where("accession_number is not null")


def kinds(df: DataFrame, keep: list[str], struct: str, names: list[str]) -> DataFrame:
    """the fields of a struct to rows (relation_name, value), without null ones."""
    entries = F.array(*(F.struct(F.lit(f"entity:{n}").alias("relation_name"), F.col(f"{struct}.{n}").alias("value")) for n in names))
    return df.select(*keep, F.inline(entries)).where("value is not null")


def contact_addresses(submission: DataFrame) -> DataFrame:
    """F4 + AD: (cik, relation_name, raw, address); address is null for those that can't be normalized."""
    rows = kinds(submission.select(parse_int(F.col("cik").cast("string")).alias("cik"), "addresses"), ["cik"], "addresses", ["mailing", "business"])
    v = lambda n: F.col(f"value.{n}")
    return rows.select("cik", "relation_name", F.col("value").alias("raw"), address(v("street1"), v("street2"), F.lit(None).cast("string"), F.coalesce(v("city"), F.lit("")), v("stateOrCountry"), v("zipCode"), v("countryCode")).alias("address"))


def contact_phones(submission: DataFrame) -> DataFrame:
    """F6, A5 + PH2: (cik, relation_name, phone), parsed for the country of the first address that has one."""
    region = F.coalesce(country_code(F.col("addresses.mailing.stateOrCountry"), None, F.col("addresses.mailing.countryCode")), country_code(F.col("addresses.business.stateOrCountry"), None, F.col("addresses.business.countryCode")), F.lit("US"))
    return submission.select(parse_int(F.col("cik").cast("string")).alias("cik"), F.lit("entity:contact").alias("relation_name"), phone_or_us(F.col("phone"), region).alias("phone")).where("phone is not null")


def tickers(submission: DataFrame) -> DataFrame:
    """(cik, ticker, exchange)."""
    rows = zip_present(submission.select(parse_int(F.col("cik").cast("string")).alias("cik"), "tickers", "exchanges"), ["cik"], "tickers", "exchanges")
    return rows.select("cik", F.col("tickers").alias("ticker"), F.col("exchanges").alias("exchange"))


def entities(submission: DataFrame) -> DataFrame:
    """The entity row of each submission."""
    text = {"entityType": "type", "name": "name", "ein": "ein", "description": "description", "website": "website", "investorWebsite": "investor_website", "category": "category", "fiscalYearEnd": "fiscal_year", "stateOfIncorporation": "state_incorporation", "stateOfIncorporationDescription": "state_incorporation_desc"}
    return submission.select(parse_int(F.col("cik").cast("string")).alias("cik"), F.nullif(parse_int(F.col("sic")), F.lit(0)).cast("int").alias("sic"), *(F.nullif(F.col(a), F.lit("")).alias(b) for a, b in text.items()))


def sic_codes(submission: DataFrame) -> DataFrame:
    """(sic, description), once each; rows without either go."""
    rows = submission.select(F.nullif(parse_int(F.col("sic")), F.lit(0)).cast("int").alias("sic"), F.nullif(F.col("sicDescription"), F.lit("")).alias("description"))
    return rows.where("sic is not null and description is not null").groupBy("sic").agg(F.max("description").alias("description"))
