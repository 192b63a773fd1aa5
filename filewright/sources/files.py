"""Scans of the wire formats (S1-S10) and paths of the landing zone (S13, S14). All are single-stage plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from filewright.functions.scalars import parse_date, parse_int, trim_all

INDEX_COLUMNS = ["cik", "company_name", "form_type", "date_filed", "file_name"]


def master_index(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """Rows of master indexes: (cik, company_name, form_type, date_filed, file_name, path).

    Rows are those of five fields with a number in the first; the header, blank lines and rows of other widths go.
    Quotes mean nothing. With ``strict`` a file without a single such row (an error page) raises when it is read.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    return index_rows(lines, strict)


def index_rows(lines: DataFrame, strict: bool = False) -> DataFrame:
    """S1 on lines (value, path), batch or stream."""
    parts = F.split("value", r"\|")
    rows = lines.where((F.size(parts) == 5) & parse_int(F.get(parts, F.lit(0))).isNotNull())
    out = rows.select(parse_int(F.get(parts, F.lit(0))).alias("cik"), *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(INDEX_COLUMNS) if i), "path")
    if strict:
        bad = lines.groupBy("path").agg(F.max(((F.size(parts) == 5) & parse_int(F.get(parts, F.lit(0))).isNotNull()).cast("int")).alias("good")).where("good = 0").limit(1).collect()
        if bad:
            raise ValueError(f"no index rows in {bad[0].path}")
    return out


def daily_index(rows: DataFrame, date: str) -> DataFrame:
    """S1 + A1: the distinct ids of a day's index, stamped with the day asked for."""
    return rows.select("cik").distinct().select("cik", F.lit(date).alias("last_update"))


def quarterly_index(rows: DataFrame) -> DataFrame:
    """S2, S3 + A2, A3: each id's latest date; rows without a date go. One partial and one final aggregation."""
    return rows.groupBy("cik").agg(F.max(parse_date(F.col("date_filed"))).alias("d")).where("d is not null").select("cik", F.date_format("d", "yyyy-MM-dd").alias("last_update"))


def cik_names(spark: SparkSession, path: str) -> DataFrame:
    """(name, cik) of NAME:CIK: lines; names may hold colons, an empty name is '?', other lines go."""
    lines = spark.read.text(path)
    return name_rows(lines)


def name_rows(lines: DataFrame) -> DataFrame:
    pattern = "^(.*):([^:]*):\\s*\\z"
    name = trim_all(F.regexp_extract("value", pattern, 1))
    out = lines.where(F.col("value").rlike(pattern)).select(F.when(name == "", "?").otherwise(name).alias("name"), parse_int(F.regexp_extract("value", pattern, 2)).alias("cik"))
    return out.where("cik is not null")


FACT = "struct<end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string,start:string,frame:string>"
FACTS = f"cik string, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<{FACT}>>>>>"


def company_facts(texts: DataFrame, column: str = "value") -> DataFrame:
    """S5 + F1: a row of 13 columns for each dated fact of the JSON documents in a column."""
    doc = texts.select(F.from_json(column, FACTS).alias("d"))
    groups = doc.select(parse_int(F.col("d.cik")).alias("cik"), F.explode("d.facts").alias("grouping", "names"))
    names = groups.select("cik", "grouping", F.explode("names").alias("name", "n"))
    units = names.select("cik", "grouping", "name", F.explode("n.units").alias("val_unit", "rows"))
    return units.select("cik", "grouping", "name", "val_unit", F.inline("rows")).select(
        "cik", "grouping", "name", F.col("accn").alias("accession_number"), F.col("filed").alias("filed_date"), "form", "fp", "fy", F.col("start").alias("start_date"),
        F.col("end").alias("end_date"), "val", "val_unit", "frame",
    )


FILINGS = (
    "accessionNumber array<string>, filingDate array<string>, reportDate array<string>, acceptanceDateTime array<string>, act array<string>, form array<string>, "
    "filmNumber array<string>, fileNumber array<string>, items array<string>, size array<bigint>, isXBRL array<string>, isInlineXBRL array<string>, "
    "primaryDocument array<string>, primaryDocDescription array<string>"
)
_FILINGS_STRUCT = "struct<" + FILINGS.replace(" array", ":array").replace(", ", ",") + ">"
ADDRESS = "struct<street1:string,street2:string,city:string,stateOrCountry:string,zipCode:string,stateOrCountryDescription:string,isForeignLocation:string,foreignStateTerritory:string,country:string,countryCode:string>"
SUBMISSION = (
    "cik string, entityType string, sic string, sicDescription string, insiderTransactionForOwnerExists string, insiderTransactionForIssuerExists string, name string, "
    "tickers array<string>, exchanges array<string>, ein string, description string, website string, investorWebsite string, category string, fiscalYearEnd string, "
    f"stateOfIncorporation string, stateOfIncorporationDescription string, addresses struct<mailing:{ADDRESS},business:{ADDRESS}>, phone string, flags string, "
    f"formerNames array<struct<name:string,`from`:string,`to`:string>>, filings struct<recent:{_FILINGS_STRUCT},files:array<struct<name:string,filingCount:bigint>>>"
)


def submissions(texts: DataFrame, column: str = "value") -> DataFrame:
    """The typed main documents."""
    return texts.select(F.from_json(column, SUBMISSION).alias("d")).select("d.*")


def overflow_filings(texts: DataFrame, column: str = "value") -> DataFrame:
    """The bare filing batches of overflow files."""
    return texts.select(F.from_json(column, FILINGS).alias("recent"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole documents: (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def xml_form(texts: DataFrame, schema: T.StructType | str, column: str = "text") -> DataFrame:
    """XML documents by a schema: attributes and prefixes ignored, leaves are text, arrays as declared."""
    schema = schema if isinstance(schema, str) else schema.simpleString()
    return texts.select("*", F.from_xml(column, F.lit(schema), {"ignoreNamespace": "true", "excludeAttribute": "true", "ignoreSurroundingSpaces": "true"}).alias("form"))


def response_type(path: Column) -> Column:
    """How a fetched file is read, by its extension."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)\z", 1))
    return F.when(ext == "json", "json").when(ext.isin("idx", "txt", "xml", "xbrl", "csv", "html", "htm"), "text").otherwise("blob")


def is_stale(modified: Column, date: Column) -> Column:
    """A landed file is stale if the day it was written is before the date asked for."""
    return F.to_date(modified) < F.to_date(date)


def daily_index_path(date: Column) -> Column:
    """S14."""
    return F.concat(F.lit("daily-index/"), F.date_format(date, "yyyy"), F.lit("/"), F.date_format(date, "yyyy-MM-dd"), F.lit(".master.idx"))


def quarterly_index_path(date: Column) -> Column:
    return F.concat(F.lit("full-index/"), F.date_format(date, "yyyy"), F.lit("/QTR"), F.quarter(date).cast("string"), F.lit("/master.idx"))


def facts_path(cik: Column) -> Column:
    return F.concat(F.lit("companyfacts/CIK"), F.lpad(cik.cast("string"), 10, "0"), F.lit(".json"))


def submissions_path(cik: Column) -> Column:
    return F.concat(F.lit("submissions/CIK"), F.lpad(cik.cast("string"), 10, "0"), F.lit(".json"))


def document_path(cik: Column, accession: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("data"), cik.cast("string"), F.replace(accession, F.lit("-"), F.lit("")), name)
