"""Offerings, issuers, people and their relations from notices of exempt offerings (FD1-FD8).

One parse of the documents; each output is a DataFrame over it. What can't be normalized becomes a row of ``rejects``
instead of an exception.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F, types as T

from filewright.functions.address import address, is_unknown
from filewright.functions import company as companies, person as persons
from filewright.functions.company import company, has_ending
from filewright.functions.person import person
from filewright.functions.phone import phone, phone_or_us
from filewright.functions.scalars import is_bad_person, parse_int, trim_all
from filewright.operators.catalog import parser
from filewright.sources.files import xml_form

_ADDR = "struct<street1:string,street2:string,city:string,stateOrCountry:string,stateOrCountryDescription:string,zipCode:string>"
_PREV = "struct<value:string,previousName:array<string>>"
_ISSUER = f"struct<cik:string,entityName:string,issuerAddress:{_ADDR},issuerPhoneNumber:string,jurisdictionOfInc:string,issuerPreviousNameList:{_PREV},edgarPreviousNameList:{_PREV},entityType:string,entityTypeOtherDesc:string>"
_FLAGS = {
    "isEquityType": "is_equity", "isDebtType": "is_debt", "isOptionToAcquireType": "is_option", "isSecurityToBeAcquiredType": "is_security_to_be_acquired",
    "isPooledInvestmentFundType": "is_pooled_investment", "isTenantInCommonType": "is_tenant_in_common", "isMineralPropertyType": "is_mineral_property", "isOtherType": "is_other",
}
_PERSON = f"struct<relatedPersonName:struct<firstName:string,middleName:string,lastName:string>,relatedPersonAddress:{_ADDR},relatedPersonRelationshipList:struct<relationship:array<string>>,relationshipClarification:string>"
_RECIPIENT = f"struct<recipientName:string,recipientCRDNumber:string,associatedBDName:string,associatedBDCRDNumber:string,recipientAddress:{_ADDR}>"
_SIGNATURE = "struct<issuerName:string,signatureName:string,nameOfSigner:string,signatureTitle:string,signatureDate:string>"
SCHEMA = (
    f"struct<schemaVersion:string,submissionType:string,testOrLive:string,primaryIssuer:{_ISSUER},issuerList:struct<issuer:array<{_ISSUER}>,over100IssuerFlag:string>,"
    f"relatedPersonsList:struct<relatedPersonInfo:array<{_PERSON}>>,"
    "offeringData:struct<industryGroup:struct<industryGroupType:string,investmentFundInfo:struct<investmentFundType:string,is40Act:string>>,"
    "issuerSize:struct<revenueRange:string,aggregateNetAssetValueRange:string>,federalExemptionsExclusions:struct<item:array<string>>,"
    "typeOfFiling:struct<newOrAmendment:struct<isAmendment:string,previousAccessionNumber:string>,dateOfFirstSale:struct<value:string,yetToOccur:string>>,"
    f"typesOfSecuritiesOffered:struct<{','.join(f'{x}:string' for x in _FLAGS)},descriptionOfOtherType:string>,"
    "businessCombinationTransaction:struct<isBusinessCombinationTransaction:string>,minimumInvestmentAccepted:string,"
    f"salesCompensationList:struct<recipient:array<{_RECIPIENT}>>,offeringSalesAmounts:struct<totalOfferingAmount:string,totalAmountSold:string,totalRemaining:string>,"
    "investors:struct<hasNonAccreditedInvestors:string,numberNonAccreditedInvestors:string,totalNumberAlreadyInvested:string>,"
    f"signatureBlock:struct<authorizedRepresentative:string,signature:array<{_SIGNATURE}>>>>"
)
RELATIONS = ("issuer", "related-person", "sales-compensation", "signature", "primary-issuer", "additional-issuer")


@parser("D", "D/A")
def parse(texts: DataFrame) -> DataFrame:
    """Documents (cik, file_number, accession_number, text) with the parsed form."""
    return xml_form(texts, SCHEMA)


def parse_fields(texts: DataFrame, fields: list[str]) -> DataFrame:
    """The form with some fields only (paths of SCHEMA, with all below them). What needs another field fails, it gets no null."""
    return xml_form(texts, _narrowed(T.StructType.fromDDL(SCHEMA), [f.split(".") for f in fields]))


def _narrowed(kind: T.DataType, paths: list[list[str]]) -> T.DataType:
    if [] in paths:
        return kind
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_narrowed(kind.elementType, paths))
    unknown = {p[0] for p in paths} - set(kind.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return T.StructType([T.StructField(f.name, _narrowed(f.dataType, below)) for f in kind if (below := [p[1:] for p in paths if p[0] == f.name])])


def offerings(forms: DataFrame) -> DataFrame:
    """FD1: flags are true or null; business combination is true or false."""
    o = lambda p: F.col(f"form.offeringData.{p}")
    return forms.select(
        "cik", "file_number", o("industryGroup.industryGroupType").alias("industry_group"), o("industryGroup.investmentFundInfo.investmentFundType").alias("industry_subgroup"),
        o("typeOfFiling.dateOfFirstSale.value").alias("date_of_first_sale"), o("federalExemptionsExclusions.item").alias("exemptions"),
        *(F.when(o(f"typesOfSecuritiesOffered.{w}") == "true", F.lit(True)).alias(n) for w, n in _FLAGS.items()),
        F.coalesce(o("businessCombinationTransaction.isBusinessCombinationTransaction") == "true", F.lit(False)).alias("is_business_combination"),
        o("typesOfSecuritiesOffered.descriptionOfOtherType").alias("description_of_other"),
    )


def history(forms: DataFrame) -> DataFrame:
    """FD2: 'Indefinite' is null; no non-accredited investors is null."""
    o = lambda p: F.col(f"form.offeringData.{p}")
    amount = lambda p: F.when(o(p) != "Indefinite", parse_int(o(p)))
    return forms.select(
        "cik", "file_number", "accession_number", parse_int(o("minimumInvestmentAccepted")).alias("minimum_investment_accepted"),
        *(amount(f"offeringSalesAmounts.{w}").alias(n) for w, n in (("totalOfferingAmount", "total_offering_amount"), ("totalAmountSold", "total_amount_sold"), ("totalRemaining", "total_remaining"))),
        parse_int(o("investors.totalNumberAlreadyInvested")).alias("investor_count"), F.nullif(parse_int(o("investors.numberNonAccreditedInvestors")), F.lit(0)).alias("non_accredited_count"),
    )


def _address(c: str, f: Callable = address) -> Column:
    a = lambda n: F.col(f"{c}.{n}")
    return F.when(F.col(c).isNotNull(), f(a("street1"), a("street2"), F.lit(None).cast("string"), F.coalesce(a("city"), F.lit("")), a("stateOrCountry"), a("zipCode")))


def _previous(field: str, kind: str) -> Column:
    return F.coalesce(F.transform(field, lambda p: F.struct(p.alias("previous_name"), F.lit(kind).alias("name_type"))), F.array())


KEYS = ["cik", "file_number", "accession_number"]
#: What tells a party's name: names (issuer: name, id; person: first, middle, last; recipient: name, CRD; signer: name, other name).
NAMES = ["kind", "a", "b", "c"]
_SLOTS = {"a": "string", "b": "string", "c": "string", "raw_titles": "array<string>", "rep": "string", "raw_address": _ADDR, "raw_phone": "string", "previous_issuer": "array<string>", "previous_edgar": "array<string>"}
_LISTS = {"primary-issuer": "primaryIssuer", "additional-issuer": "issuerList.issuer", "related-person": "relatedPersonsList.relatedPersonInfo", "sales-compensation": "offeringData.salesCompensationList.recipient", "signature": "offeringData.signatureBlock.signature"}
_OF_ISSUER = {"a": "entityName", "b": "cik", "raw_address": "issuerAddress", "raw_phone": "issuerPhoneNumber", "previous_issuer": "issuerPreviousNameList.previousName", "previous_edgar": "edgarPreviousNameList.previousName"}
#: Where a kind of party has a slot; a slot that it has not is null.
_FROM = {
    "primary-issuer": _OF_ISSUER,
    "additional-issuer": _OF_ISSUER,
    "related-person": {"a": "relatedPersonName.firstName", "b": "relatedPersonName.middleName", "c": "relatedPersonName.lastName", "raw_titles": "relatedPersonRelationshipList.relationship", "raw_address": "relatedPersonAddress"},
    "sales-compensation": {"a": "recipientName", "b": "recipientCRDNumber", "raw_address": "recipientAddress"},
    "signature": {"a": "signatureName", "b": "nameOfSigner", "raw_titles": "signatureTitle", "rep": None},
}
_REP = "offeringData.signatureBlock.authorizedRepresentative"


def fields(*slots: str) -> list[str]:
    """The fields of a form that the names of its parties and these slots need."""
    wanted = {*NAMES, *slots}
    return [f"{_LISTS[k]}.{path}" for k, has in _FROM.items() for slot, path in has.items() if slot in wanted and path] + [_REP] * ("rep" in wanted)


def raw_parties(forms: DataFrame, slots: list[str] = [*_SLOTS][3:]) -> DataFrame:  # noqa: B006
    """A row for each party as the form has it. All kinds leave one generator: a union would parse the form for each."""
    names = [*NAMES[1:], *slots]

    def party(kind: str, x: Column) -> Column:
        def value(slot: str) -> Column:
            if slot not in _FROM[kind]:
                return F.lit(None)
            if slot == "rep":
                return F.col(f"form.{_REP}")
            out = x
            for step in _FROM[kind][slot].split("."):
                out = out[step]
            return F.array(out) if (kind, slot) == ("signature", "raw_titles") else out

        row = F.struct(F.lit(kind).alias("kind"), *(value(n).cast(_SLOTS[n]).alias(n) for n in names))
        return F.when(x.isNotNull(), row) if kind.endswith("-issuer") else row

    def listed(kind: str, path: str) -> Column:
        found = F.col(f"form.{path}")
        return F.array(party(kind, found)) if kind == "primary-issuer" else F.coalesce(F.transform(found, lambda x: party(kind, x)), F.array())

    return forms.select(*KEYS, F.explode(F.concat(*(listed(k, p) for k, p in _LISTS.items()))).alias("x")).where("x is not null").select(*KEYS, "x.*")


def _told(raw: DataFrame, once: bool = True) -> DataFrame:
    """Raw parties that name somebody, with name, is_company, party_cik and crd; raw's other columns stay.

    With ``once`` names are worked out before any filter on them; what is written as it is needs no such stop.
    """
    a, b, c, kind = F.col("a"), F.col("b"), F.col("c"), F.col("kind")
    issuer, human, paid = kind.endswith("-issuer"), kind == "related-person", kind == "sales-compensation"
    good = lambda x: F.when(~is_bad_person(x), trim_all(x))
    named = F.lower(trim_all(a))
    first = F.nullif(trim_all(a), F.lit(""))
    name = F.when(issuer, F.coalesce(first, F.concat(F.lit("Entity "), b))).when(human, F.concat_ws(" ", good(a), good(b), good(c))).when(paid, a).otherwise(F.coalesce(first, b))
    is_company = F.when(issuer, F.lit(True)).when(human, has_ending(F.coalesce(a, F.lit(""))) | has_ending(F.coalesce(c, F.lit("")))).otherwise(has_ending(F.col("name")))
    kept = F.when(human, ~(is_bad_person(a) & is_bad_person(c))).when(paid, F.coalesce((named != "") & (named != "none"), F.lit(False))).otherwise(F.lit(True))
    crd = F.when(paid & (F.lower(trim_all(b)) != "none"), b)
    rows = raw.where(kept)
    told = _once(rows, name=name, is_company=is_company) if once else rows.withColumn("name", name).withColumn("is_company", is_company)
    return told.select("*", F.concat(F.lit("form-d:"), kind).alias("relation_name"), F.when(issuer, parse_int(b)).alias("party_cik"), crd.alias("crd"))


def _titles() -> Column:
    kind = F.col("kind")
    signed = F.array_compact(F.array(F.coalesce(F.nullif(trim_all(F.get("raw_titles", F.lit(0))), F.lit("")), F.lit("Signer")), F.when(F.col("rep") == "true", "Authorized Representative")))
    fixed = {"primary-issuer": "Primary Issuer", "additional-issuer": "Additional Issuer", "sales-compensation": "Sales Compensation Recipient"}
    out = F.when(kind == "related-person", F.coalesce("raw_titles", F.array().cast("array<string>"))).when(kind == "signature", signed)
    for k, title in fixed.items():
        out = out.when(kind == k, F.array(F.lit(title)))
    return out


def _company() -> Column:
    return F.when(F.col("is_company"), company(F.col("name"), F.col("party_cik"), F.col("crd")))


def _person() -> Column:
    return F.when(~F.col("is_company"), person(F.col("name"), F.col("party_cik"), F.col("crd")))


def _phone(place: Column | None = None) -> Column:
    place = F.col("address") if place is None else place
    return F.when(F.col("raw_phone").isNotNull(), phone_or_us(F.col("raw_phone"), F.coalesce(place["country_code"], F.lit("US"))))


def _previous_names() -> Column:
    return F.array_compact(F.concat(_previous("previous_issuer", "issuer"), _previous("previous_edgar", "edgar")))


def named_parties(forms: DataFrame) -> DataFrame:
    """FD4-FD7: the parties with their relation and name alone; parsed with ``fields()``."""
    return _told(raw_parties(forms, []), once=False).select(*KEYS, "relation_name", "name")


def parties(forms: DataFrame) -> DataFrame:
    """FD4-FD7: a row for each party of a form: relation, titles, company or person, raw and normal address, phone."""
    rows = _told(raw_parties(forms), once=False)
    rows = rows.select(*KEYS, "relation_name", _titles().alias("titles"), "name", "is_company", "party_cik", "crd", "raw_address", "raw_phone", _previous_names().alias("previous"), _company().alias("company"), _person().alias("person"), _address("raw_address").alias("address"))
    return rows.withColumn("phone", _phone())


def _once(rows: DataFrame, **normal: Column) -> DataFrame:
    """Columns worked out once for each row, in their order: filters on them don't move below and work them out again."""
    for n, c in normal.items():
        rows = rows.select("*", F.explode(F.array(c)).alias(n))
    return rows


class FormD:
    """The outputs of one batch of parsed forms; each is a plan that is made when it is asked for.

    Where an output holds distinct rows, the parties are made distinct as the forms have them, and only then normalized.
    """

    def __init__(self, forms: DataFrame, rows: DataFrame | None = None):
        self.forms, self.rows = forms, rows

    def _each(self, *slots: str) -> DataFrame:
        """Every party, with its names and raw columns."""
        return _told(raw_parties(self.forms, [*slots])) if self.rows is None else self.rows

    def _with(self, rows: DataFrame, **normal: Column) -> DataFrame:
        return _once(rows, **normal) if self.rows is None else rows

    def _distinct(self, columns: list[str], **normal: Column) -> DataFrame:
        """Distinct parties by what tells their names and by raw columns, with normal forms of those."""
        if self.rows is not None:
            return self.rows
        return _once(_told(raw_parties(self.forms, columns).select(*NAMES, *columns).distinct()), **normal)

    def _placed(self, **normal: Column) -> DataFrame:
        """The same exchange for all that needs addresses: what joins two of them parses the forms once."""
        return self._distinct(["raw_address"], **normal)

    @staticmethod
    def _best(rows: DataFrame, c: str, key: str) -> DataFrame:
        return rows.where(F.col(c).isNotNull()).groupBy(F.col(f"{c}.{key}").alias("__k")).agg(F.max(c).alias("r")).select("r.*")

    @cached_property
    def offerings(self) -> DataFrame:
        return offerings(self.forms)

    @cached_property
    def history(self) -> DataFrame:
        return history(self.forms)

    @staticmethod
    def _other_issuers(rows: DataFrame) -> DataFrame:
        own = F.col("party_cik")
        return rows.where(F.col("relation_name").isin("form-d:primary-issuer", "form-d:additional-issuer") & own.isNotNull() & (own != F.col("cik")))

    @cached_property
    def issuers(self) -> DataFrame:
        return self._other_issuers(self._each()).groupBy("cik", F.col("party_cik").alias("issuer_cik")).agg(F.max(F.col("relation_name") == "form-d:primary-issuer").alias("is_primary"))

    @cached_property
    def companies(self) -> DataFrame:
        return self._best(self._distinct([], company=_company()), "company", "company_hash_id")

    @cached_property
    def persons(self) -> DataFrame:
        return self._best(self._distinct([], person=_person()), "person", "person_hash_id")

    @cached_property
    def addresses(self) -> DataFrame:
        if self.rows is not None:
            return self._best(self.rows, "address", "address_hash_id")
        return self._best(_once(self._placed().select("raw_address").distinct(), address=_address("raw_address")), "address", "address_hash_id")

    @cached_property
    def phones(self) -> DataFrame:
        return self._best(self._distinct(["raw_address", "raw_phone"], address=_address("raw_address"), phone=_phone()), "phone", "international_number")

    @cached_property
    def company_edges(self) -> DataFrame:
        rows = self._each("raw_titles", "rep")
        rows = rows.withColumn("titles", _titles()) if self.rows is None else rows
        known = self._with(rows.where("is_company"), company=_company()).where("company.company_hash_id is not null")
        own = F.col("party_cik")
        other = F.col("relation_name").isin("form-d:primary-issuer", "form-d:additional-issuer") & own.isNotNull() & (own != F.col("cik"))
        made = lambda relation, cik, titles: F.struct(F.lit(relation).alias("relation_name") if isinstance(relation, str) else relation.alias("relation_name"), cik.alias("cik"), titles.alias("titles"))
        edges = F.array(made(F.col("relation_name"), F.col("cik"), F.col("titles")), F.when(other, made("form-d:issuer", own, F.array(F.lit("Issuer")))))
        return known.select("company.company_hash_id", F.explode(edges).alias("e")).where("e is not null").select("company_hash_id", "e.*")

    @cached_property
    def person_edges(self) -> DataFrame:
        rows = self._each("raw_titles", "rep")
        rows = rows.withColumn("titles", _titles()) if self.rows is None else rows
        return self._with(rows.where("not is_company"), person=_person()).where("person.person_hash_id is not null").select("person.person_hash_id", "relation_name", "cik", "titles")

    @cached_property
    def address_edges(self) -> DataFrame:
        rows = self._with(self._each("raw_address"), address=_address("raw_address"))
        return rows.where("address is not null").select("address.address_hash_id", "relation_name", "cik").distinct()

    @cached_property
    def phone_edges(self) -> DataFrame:
        rows = self._with(self._each("raw_address", "raw_phone").where("raw_phone is not null"), address=_address("raw_address"), phone=_phone())
        return rows.where("phone is not null").select("phone.international_number", "relation_name", "cik").distinct()

    @cached_property
    def company_addresses(self) -> DataFrame:
        rows = self._placed(company=_company(), address=_address("raw_address"))
        return rows.where("company.company_hash_id is not null and address is not null").select("company.company_hash_id", "relation_name", "address.address_hash_id").distinct()

    @cached_property
    def company_phones(self) -> DataFrame:
        rows = self._distinct(["raw_address", "raw_phone"], company=_company(), address=_address("raw_address"), phone=_phone())
        return rows.where("company.company_hash_id is not null and phone is not null").select("company.company_hash_id", "relation_name", "phone.international_number").distinct()

    @cached_property
    def person_addresses(self) -> DataFrame:
        rows = self._placed(person=_person(), address=_address("raw_address"))
        return rows.where("person.person_hash_id is not null and address is not null").select("person.person_hash_id", "relation_name", "address.address_hash_id").distinct()

    @cached_property
    def previous_names(self) -> DataFrame:
        none = F.lower(trim_all(F.col("x.previous_name")))
        rows = self._distinct(["previous_issuer", "previous_edgar"], company=_company())
        rows = rows.withColumn("previous", _previous_names()) if self.rows is None else rows
        known = rows.where("company.company_hash_id is not null")
        return known.select("company.company_hash_id", F.explode("previous").alias("x")).where((none != "") & (none != "none")).select("company_hash_id", "x.previous_name", "x.name_type", F.lit("Form D").alias("source"), F.lit(None).cast("string").alias("date_changed")).distinct()

    @cached_property
    def rejects(self) -> DataFrame:
        rows, name, called = self._each("raw_address", "raw_phone"), F.col("name"), F.col("raw_phone")
        if self.rows is None:  # only whether there is a normal form, not what it is; a number that is one in the US needs no country
            faults = {
                "name": F.when(F.col("is_company"), companies.is_nameless(name)).otherwise(persons.is_nameless(name)), "address": _address("raw_address", is_unknown),
                "phone": called.isNotNull() & F.when(phone(called).isNotNull(), F.lit(False)).otherwise(_phone(_address("raw_address")).isNull()),
            }
        else:
            edge = F.when(F.col("is_company"), F.col("company.company_hash_id")).otherwise(F.col("person.person_hash_id"))
            faults = {"name": edge.isNull(), "address": F.col("raw_address").isNotNull() & F.col("address").isNull(), "phone": called.isNotNull() & F.col("phone").isNull()}
        reasons = F.array_compact(F.array(*(F.when(c, F.lit(what)) for what, c in faults.items())))
        return rows.select("cik", "accession_number", "relation_name", F.explode(reasons).alias("reason"), F.col("name").alias("payload"))


def extract(forms: DataFrame, rows: DataFrame | None = None) -> FormD:
    """FD1-FD8: everything, from forms with columns cik, file_number, accession_number and form.

    ``rows`` may be the parties of the forms, if they have been written once for all outputs.
    """
    return FormD(forms, rows)
