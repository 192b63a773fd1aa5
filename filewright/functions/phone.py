"""Phone numbers (PH1, PH2) as Column expressions: North American numbers by rule, others by their country code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filewright.functions.scalars import let, trim_all

# Calling codes of regions; the numbers of other regions must carry a plus sign.
CALLING = {"US": "1", "CA": "1", "GB": "44", "DE": "49", "FR": "33", "CH": "41", "IL": "972", "CN": "86", "HK": "852", "SG": "65", "IE": "353", "AU": "61", "JP": "81"}


def phone(raw: Column, region: Column | None = None) -> Column:
    """PH1: (international_number, type, extension), null for what can't be a number (letters, zeros, too short)."""
    region = F.coalesce(region, F.lit("US")) if region is not None else F.lit("US")
    calling = F.try_element_at(F.create_map(*(F.lit(x) for p in CALLING.items() for x in p)), F.upper(region))
    text = trim_all(raw)
    seen = F.struct(
        F.nullif(F.regexp_extract(text, r"(?i)(?:ext\.?|extension|x)\s*([0-9]{1,6})\z", 1), F.lit("")).alias("ext"),
        trim_all(F.regexp_replace(text, r"(?i)[,;\s]*(?:ext\.?|extension|x)\s*[0-9]{1,6}\z", "")).alias("body"), calling.alias("calling"),
    )
    split = lambda s: F.struct(s["ext"].alias("ext"), s["calling"].alias("calling"), s["body"].startswith("+").alias("plus"), s["body"].rlike(r"^\+?[0-9(][0-9()\s./-]*\z").alias("fine"), F.regexp_replace(s["body"], "[^0-9]", "").alias("digits"))

    def read(s: Column) -> Column:
        digits, plus, code = s["digits"], s["plus"], s["calling"]
        eleven = (F.length(digits) == 11) & digits.startswith("1")
        national = F.when(eleven & (plus | (code == "1")), F.substring(digits, 2, 10)).when(~plus & (code == "1"), digits)
        gb = F.when(plus & digits.startswith("44"), F.substring(digits, F.lit(3), F.length(digits))).when(~plus & (code == "44"), F.regexp_replace(digits, "^0", ""))
        other = F.when(plus, digits).when(code.isNotNull() & (code != "1"), F.concat(code, F.regexp_replace(digits, "^0", "")))
        return F.struct(s["ext"].alias("ext"), (s["fine"] & ~digits.rlike("^0*\\z")).alias("fine"), national.alias("national"), gb.alias("gb"), other.alias("other"))

    def written(s: Column) -> Column:
        n, g, o = s["national"], s["gb"], s["other"]
        nanp = F.when(n.rlike("^[2-9][0-9]{9}\\z"), F.concat(F.lit("+1 "), F.substring(n, 1, 3), F.lit("-"), F.substring(n, 4, 3), F.lit("-"), F.substring(n, 7, 4)))
        london = F.when(g.rlike("^20[0-9]{8}\\z"), F.concat(F.lit("+44 20 "), F.substring(g, 3, 4), F.lit(" "), F.substring(g, 7, 4)))
        british = F.when(g.rlike("^[1-9][0-9]{9}\\z"), F.concat(F.lit("+44 "), F.substring(g, 1, 4), F.lit(" "), F.substring(g, 5, 6)))
        abroad = F.when(~o.rlike("^(?:1|44|0)") & o.rlike("^[0-9]{8,15}\\z"), F.concat(F.lit("+"), o))
        kind = F.when(n.isNull() & g.rlike("^[1-689][0-9]{9}\\z"), "fixed-line").when(n.isNull() & g.rlike("^7[0-9]{9}\\z"), "mobile").otherwise("unknown")
        return F.struct(F.when(s["fine"], F.coalesce(nanp, london, british, abroad)).alias("number"), kind.alias("type"), s["ext"].alias("ext"))

    row = lambda w: F.when(w["number"].isNotNull(), F.struct(F.concat_ws(" ext. ", w["number"], w["ext"]).alias("international_number"), w["type"].alias("type"), w["ext"].alias("extension"), raw.alias("raw_phone")))
    return let(let(let(let(seen, split), read), written), row)


def phone_or_us(raw: Column, region: Column) -> Column:
    """PH2: by its region, else as a US number."""
    return F.coalesce(phone(raw, region), phone(raw))
