"""The catalogue of form codes (G1-G5): families, amendments by rule, parsers, and items of current reports.

The catalogue is data: any table (family, code) may be given. The built-in one lists the plain codes of common
families; a rule adds their amendments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from filewright.functions.vocab import ITEMS_8K

# Plain codes by family; each of them has an amendment, its code with /A.
FAMILIES = {
    "application-withdrawal": "APP NTC, APP ORDR, APP WD, APP WDG",
    "asset-backed-exhibit": "10-D, NT 10-D, ABS-15G, ABS-EE",
    "broker-dealer": "17HACON, 17HQCON, 7-M, 8-M, 9-M, X-17A-5",
    "exempt-offerings": "1-A, 1-A POS, 1-A-W, 1-K, 1-SA, 1-U, 1-Z, C, C-AR, C-TR, C-U, C-W, D",
    "foreign-registration-statements": "20-F, 20FR12B, 20FR12G, 40-F, 6-K, CB, F-1, F-3, F-4, F-6, F-10",
    "insider-trading": "144, 3, 4, 5",
    "investment-companies": "N-1A, N-2, N-8A, N-CEN, N-CSR, N-PORT, N-PX, N-Q, 24F-2NT, 485APOS, 485BPOS, 497",
    "large-trader": "13F-HR, 13F-NT, 13FCONP, 13H",
    "miscellaneous-filings": "8-K, 11-K, ARS, SD, 15-12B, 15-12G",
    "municipal-advisor": "MA, MA-I, MA-NR, MA-W",
    "periodic-reports": "10-C, 10-K, 10-K405, 10-KSB, 10-KT, 10-Q, 10-QSB, 10-QT, NT 10-K, NT 10-Q",
    "portal": "CFPORTAL, CFPORTAL-W",
    "proxies-information-statements": "DEF 14A, DEF 14C, DEFA14A, DEFM14A, PRE 14A, PRE 14C, PREC14A, PREM14A",
    "registration-statements": "424B1, 424B2, 424B3, 424B4, 424B5, S-1, S-3, S-4, S-8, S-11, POS AM",
    "statements-of-ownership": "SC 13D, SC 13G, SC 14D1F, SC 14D9, SC TO-I, SC TO-T",
    "transfer-agent": "TA-1, TA-2, TA-W",
}


def catalogue(spark: SparkSession, families: dict[str, str] = FAMILIES) -> DataFrame:
    """(code, family, amended), with amendments by rule; of a code listed twice the later family wins."""
    rows = [(i, family, code.strip()) for i, (family, codes) in enumerate(families.items()) for code in codes.split(",")]
    plain = spark.createDataFrame(rows, "nth int, family string, code string")
    both = plain.select("nth", "family", "code", F.lit(False).alias("amended")).unionByName(plain.select("nth", "family", F.concat("code", F.lit("/A")).alias("code"), F.lit(True).alias("amended")))
    return later_wins(both)


def later_wins(rows: DataFrame) -> DataFrame:
    last = rows.withColumn("__n", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("nth"))))
    return last.where("__n = 1").select("code", "family", "amended")


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def parser(*codes: str):
    """Register a parser, a function of (path, text) documents, for form codes."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        PARSERS.update(dict.fromkeys(codes, f))
        return f

    return add


def dispatch(filings: DataFrame, codes: DataFrame) -> DataFrame:
    """Filings with their family and a reason why they can't be parsed, null if they can."""
    rows = filings.join(F.broadcast(codes), filings["form"] == codes["code"], "left")
    reason = F.when(F.col("code").isNull(), "form not found").when(~F.col("code").isin(*(PARSERS or [""])), "no parser")
    return rows.select(*(filings[c] for c in filings.columns), "family", reason.alias("reason"))


def unknown_forms(filings: DataFrame, codes: DataFrame) -> DataFrame:
    """The codes that the catalogue doesn't know, and how many filings have them."""
    return filings.join(codes.select(F.col("code").alias("form")), "form", "left_anti").groupBy("form").agg(F.count("*").alias("n"))


def items(filings: DataFrame, column: str = "items") -> DataFrame:
    """A row for each item of a current report, with its description (null for unknown items)."""
    spark = filings.sparkSession
    table = spark.createDataFrame(list(ITEMS_8K.items()), "item string, description string")
    rows = filings.withColumn("item", F.explode(F.split(column, ","))).withColumn("item", F.trim("item"))
    return rows.join(F.broadcast(table), "item", "left")
