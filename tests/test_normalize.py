"""Golden values of the normal forms, and properties that hold for all of them."""

import pytest
from pyspark.sql import functions as F

from filewright.functions import address, company, person, phone, scalars


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("raw, normal", [
    ("Orion Tools, Inc", "Orion Tools"), ("Orion Tools Corporation Incorporated", "Orion Tools"), ("Orion Tools LLC", "Orion Tools LLC"), ("Orion Tools L.L.C.", "Orion Tools LLC"),
    ("Orion Holdings", "Orion Holdings"), ("B & B, Inc.", "B & B"), ("  Orion   Tools  Co ", "Orion Tools"), ("APPLE Inc", "Apple Computer"), ("", None), ("  ", None), (None, None), ("Inc.", None),
])
def test_company(spark, raw, normal):
    assert one(spark, raw, company.normal_name) == normal


def test_company_slug_and_compat(spark):
    assert one(spark, "B & B", company.slug) == "b-and-b"
    assert one(spark, "Café Größe X", company.slug) == "cafe-große-x"
    assert one(spark, "Series A", lambda c: company.normal_name(c, compat=True)) == "Series"
    assert one(spark, "Series A", company.normal_name) == "Series A"
    assert one(spark, "John D", lambda c: company.has_ending(c, compat=True)) and not one(spark, "John D", company.has_ending)
    row = one(spark, "Orion Tools Ltd", lambda c: company.company(c, F.lit(0), F.lit("9")))
    assert (row.company_hash_id, row.company_name, row.cik, row.crd) == ("orion-tools", "Orion Tools", None, "9")


def strip_by_loop(name):
    """The rule of stripping, word for word."""
    import re

    name = re.sub(r"\s+", " ", re.sub(r"[.,;:!?]", "", name)).strip()
    from filewright.functions.vocab import ENDINGS_STRIPPED

    while True:
        for ending in ENDINGS_STRIPPED:
            cut = re.sub(rf"\s*{'' if ending[0] == '[' else chr(92) + 'b'}{re.escape(ending)}\s*\Z", "", name, flags=re.I)
            if cut != name:
                name = cut.strip()
                break
        else:
            return name


def test_strip_is_the_loop(spark):
    import itertools

    names = [" ".join(x) for n in (1, 2, 3, 4) for x in itertools.product(["Inc.", "Co", "Acme", "Ltd", "Cost", "a Delaware limited liability company"], repeat=n)]
    rows = spark.createDataFrame([(n,) for n in names], "v string").select("v", company.strip_endings(F.col("v")).alias("r")).collect()
    assert [r.r for r in rows] == [strip_by_loop(r.v) for r in rows]


@pytest.mark.parametrize("raw, parts", [
    ("anna maria smith jr.", ("Anna", "Maria", "Smith", "Jr.", "", "anna-maria-smith-jr")), ("dr. Paul KLEIN", ("Paul", "", "Klein", "", "Dr.", "paul-klein")),
    ("mary-jane o'connor", ("Mary-Jane", "", "O'Connor", "", "", "mary-jane-o'connor")), ("Rio del Mar", ("Rio", "", "del Mar", "", "", "rio-del-mar")),
    ("Smith, Anna", ("Anna", "", "Smith", "", "", "anna-smith")), ("/s/ Anna  Lee 2nd", ("Anna", "", "Lee", "Jr.", "", "anna-lee-jr")),
])
def test_person(spark, raw, parts):
    row = one(spark, raw, person.person)
    assert (row.first, row.middle, row.last, row.suffix, row.title, row.person_hash_id) == parts


@pytest.mark.parametrize("raw", ["Solo", "", " ", None])
def test_no_person(spark, raw):
    assert one(spark, raw, person.person) is None


@pytest.mark.parametrize("raw, number, kind", [
    ("(212) 555-0100", "+1 212-555-0100", "unknown"), ("1 212 555 0100", "+1 212-555-0100", "unknown"), ("212.555.0100 x12", "+1 212-555-0100 ext. 12", "unknown"),
    ("+44 20 7946 0958", "+44 20 7946 0958", "fixed-line"), ("+4915112345678", "+4915112345678", "unknown"),
])
def test_phone(spark, raw, number, kind):
    row = one(spark, raw, phone.phone)
    assert (row.international_number, row.type) == (number, kind)


@pytest.mark.parametrize("raw", ["12", "call me", "0000000000", "(000) 000-0000", "++1 212 555 0100", "", None])
def test_no_phone(spark, raw):
    assert one(spark, raw, phone.phone) is None


def test_address(spark):
    row = spark.createDataFrame([("One Park Avenue, Suite 400", "Acme Holdings", " ", "Saint  Paul", "MN", "55101-1234")], "a string, b string, c string, d string, e string, f string").select(address.address(*map(F.col, "abcdef")).alias("r")).first().r
    assert (row.street1, row.street2, row.city, row.state_or_country, row.country_code, row.zip) == ("1 Park Ave", "Suite 400", "ST PAUL", "MN", "US", "55101")
    assert row.address_hash_id == "1 park ave|suite 400|st paul|mn|us|55101"
    row = spark.createDataFrame([("4 High Road", "London", "", "SW1A1AA")], "a string, d string, e string, f string").select(address.address(F.col("a"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("d"), F.col("e"), F.col("f")).alias("r")).first().r
    assert (row.state_or_country, row.country_code, row.zip) == ("X0", "GB", "SW1A 1AA")
    bad = spark.createDataFrame([("1 Main St", "Nowhere", "", "")], "a string, d string, e string, f string").select(address.address(F.col("a"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("d"), F.col("e"), F.col("f")).alias("r")).first().r
    assert bad is None


def test_scalars(spark):
    assert one(spark, "20250418", lambda c: scalars.sec_date(scalars.parse_date(c))) == "2025-04-18"
    assert one(spark, "soon", scalars.parse_date) is None
    assert str(one(spark, "2024-02-29", lambda c: scalars.backoff(F.to_date(c)))) == "2025-02-28"
    assert one(spark, "12abc", scalars.parse_int) == 12 and one(spark, "x", scalars.parse_int) is None
    assert one(spark, "a.b.c", lambda c: scalars.replace_first(c, ".")) == "ab.c"
    assert one(spark, "x<TEXT>a&amp;b&nbsp; \n c", scalars.clean_html) == "a&b c" and one(spark, "no tag", scalars.clean_html) == "no tag"
    assert one(spark, "[None]", scalars.is_bad_person) and one(spark, None, scalars.is_bad_person) and not one(spark, "Anna", scalars.is_bad_person)


def test_normal_forms_are_fixed_points(spark):
    names = ["Orion Tools, Inc", "B & B Co", "Über Corp. Ltd", "x", "Series A"]
    rows = spark.createDataFrame([(n,) for n in names], "v string").select(company.normal_name(F.col("v")).alias("a")).select("a", company.normal_name(F.col("a")).alias("b"), company.slug(F.col("a")).alias("s"), company.slug(company.slug(F.col("a"))).alias("t")).collect()
    assert all(r.a == r.b and r.s == r.t for r in rows)


def test_entities_and_phrases(spark):
    assert one(spark, "it&#8217;s &eacute; &amp;lt; &x; &#xe9;&#0; a&b &#128512;", scalars.unescape) == "it\u2019s \u00e9 &lt; &x; \u00e9&#0; a&b \U0001f600"
    assert one(spark, "Managing Member of the Issuer Acme LLC", scalars.company_prefix) == "Managing Member of the Issuer"
    assert one(spark, "Acme LLC General Partner of the General Partner", scalars.company_postfix) == "General Partner of the General Partner"
    assert one(spark, "Acme LLC", scalars.company_prefix) == ""


def test_missing_told_without_normal_forms(spark):
    """What has no normal form is told the same by the short way as by the normal form."""
    from itertools import product

    from pyspark.sql import functions as F

    from filewright.functions import address, company, person

    names = [None, "", " ", " ", "Inc", "Inc.", "Corp Inc", "[related person is an entity]", ", .", "Co, Ltd", "apple", "Zed Inc", "7", "Anna Lee", "Dr Lee", "Dr. Lee", "Mr Anna Lee", "Anna Jr", "Anna Lee Jr", "Anna", "anna  lee", '"Bo" Lee', "/s/ Lee", "Lee, Anna", "Lee, Jr", "(x) (y)", "é è", "a Delaware limited liability company"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    for f, g in ((company.is_nameless, company.company), (person.is_nameless, person.person)):
        assert rows.where(f(F.col("n")) != g(F.col("n")).isNull()).count() == 0 and rows.where(f(F.col("n")).isNull()).count() == 0
    streets = [None, " ", ", Suite 5", "Suite 5", "x, Suite 5", "c/o Bo", "One Main Street", "Acme Holdings", "Street", "#"]
    places = spark.createDataFrame(list(product(streets, [None, "Fl 2", ", Suite 5", "London"], ["", " ", "NYC", "Paris", " "], [None, "", "MA", "X0", "??"])), "a string, b string, c string, d string")
    given = (F.col("a"), F.col("b"), F.lit(None).cast("string"), F.col("c"), F.col("d"), F.lit("02101"))
    assert places.where(address.is_unknown(*given) != address.address(*given).isNull()).count() == 0 and places.where(address.is_unknown(*given)).count() not in (0, places.count())
