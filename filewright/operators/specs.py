"""The tables that the engine keeps: 31, with their keys and clustering."""

from __future__ import annotations

from filewright.operators.store import TableSpec as T

_OFFER_FLAGS = "is_equity boolean, is_debt boolean, is_option boolean, is_security_to_be_acquired boolean, is_pooled_investment boolean, is_tenant_in_common boolean, is_mineral_property boolean, is_business_combination boolean, is_other boolean"
_FINANCES = ", ".join(f"{n}_{w} decimal(14,2)" for n in ("total_assets", "cash", "accounts_receivable", "short_term_debt", "long_term_debt", "revenue", "cost_goods_sold", "taxes_paid", "net_income") for w in ("recent", "prior"))


def _junction(name: str, left: str, left_type: str, right: str, right_type: str, titles: bool = False) -> T:
    return T(name, f"{left} {left_type}, relation_name string, {right} {right_type}" + ", titles array<string>" * titles, (left, "relation_name", right), (right,))


TABLES = {
    t.name: t
    for t in [
        T("cik_last_update", "cik long, last_update string", ("cik",)),
        T("processed_facts", "cik long, last_processed string, success boolean", ("cik",)),
        T("processed_submissions", "cik long, last_processed string, success boolean", ("cik",)),
        T("processed_filings", "cik long, accession_number string, form string, last_processed string, success boolean", ("cik", "accession_number")),
        T(
            "company_facts",
            "cik long, grouping string, name string, accession_number string, filed_date string, form string, fp string, fy int, start_date string, end_date string, val double, val_unit string, frame string",
            ("cik", "grouping", "name", "accession_number", "frame", "val_unit", "fy", "fp", "val"), ("cik", "name"),
        ),
        T(
            "filings",
            "cik long, accession_number string, filing_date string, report_date string, acceptance_date string, act string, form string, film_number string, file_number string, items string, "
            "size long, is_xbrl boolean, is_inline_xbrl boolean, primary_doc string, primary_doc_description string",
            ("cik", "accession_number"), ("form", "cik"),
        ),
        T("cik_names", "name string, cik long", ("name", "cik"), ("name",)),
        T(
            "entities",
            "cik long, sic int, type string, name string, ein string, description string, website string, investor_website string, category string, fiscal_year string, state_incorporation string, state_incorporation_desc string",
            ("cik",),
        ),
        T("entity_tickers", "cik long, ticker string, exchange string", ("cik", "ticker", "exchange"), ("ticker", "exchange")),
        T("sic_codes", "sic int, description string", ("sic",)),
        T("addresses", "address_hash_id string, street1 string, street2 string, street3 string, city string, state_or_country string, country_code string, zip string", ("address_hash_id",), ("city",)),
        _junction("addresses_entity_junction", "address_hash_id", "string", "cik", "long"),
        T("persons", "first string, middle string, last string, suffix string, title string, nick string, cik long, crd string, person_hash_id string", ("person_hash_id",), ("last", "first")),
        _junction("persons_entity_junction", "person_hash_id", "string", "cik", "long", True),
        _junction("persons_address_junction", "person_hash_id", "string", "address_hash_id", "string"),
        _junction("persons_phone_junction", "person_hash_id", "string", "international_number", "string"),
        T("persons_previous_names", "person_hash_id string, previous_name string, name_type string, source string, date_changed string", ("person_hash_id", "previous_name", "name_type")),
        T("companies", "company_hash_id string, company_name string, cik long, crd string", ("company_hash_id",), ("company_name",)),
        _junction("companies_entity_junction", "company_hash_id", "string", "cik", "long", True),
        _junction("companies_address_junction", "company_hash_id", "string", "address_hash_id", "string"),
        _junction("companies_phone_junction", "company_hash_id", "string", "international_number", "string"),
        T("companies_previous_names", "company_hash_id string, previous_name string, name_type string, source string, date_changed string", ("company_hash_id", "previous_name", "name_type")),
        T("phones", "international_number string, type string, extension string, raw_phone string", ("international_number",)),
        _junction("phones_entity_junction", "international_number", "string", "cik", "long"),
        T(
            "investment_offerings",
            f"cik long, file_number string, industry_group string, industry_subgroup string, date_of_first_sale string, exemptions array<string>, {_OFFER_FLAGS}, description_of_other string",
            ("cik", "file_number"), ("industry_group", "industry_subgroup"),
        ),
        T(
            "investment_offerings_history",
            "cik long, file_number string, accession_number string, minimum_investment_accepted long, total_offering_amount long, total_amount_sold long, total_remaining long, investor_count long, non_accredited_count long",
            ("cik", "file_number", "accession_number"), ("accession_number",),
        ),
        T("issuers", "cik long, issuer_cik long, is_primary boolean", ("cik", "issuer_cik"), ("issuer_cik", "cik")),
        T("crowdfunding", "cik long, file_number string, portal_cik long, name string, status string, state_jurisdiction string, date_incorporation string, url string", ("cik", "file_number"), ("portal_cik", "status")),
        T(
            "crowdfunding_offerings",
            "cik long, file_number string, filing_date string, portal_cik long, security_type string, price decimal(14,4), offering_amount decimal(14,2), maximum_offering_amount decimal(14,2), "
            f"over_subscription_accepted boolean, deadline_date string, employees int, {_FINANCES}",
            ("cik", "file_number", "filing_date"), ("cik", "file_number"),
        ),
        T("crowdfunding_reports", "cik long, file_number string, filing_date string, disclosure_name string, value decimal(14,2)", ("cik", "file_number", "filing_date", "disclosure_name")),
        T("portals", "cik long, name string, brand string, url string, live boolean", ("cik",), ("name",)),
    ]
}

#: What could not be normalized, beside the tables: a row instead of an exception.
REJECTS = T("rejects", "cik long, accession_number string, relation_name string, reason string, payload string", ("cik", "accession_number", "relation_name", "reason", "payload"))
