"""Batch jobs over a store and a landing zone (L1-L10): one plan each, no loop over entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from filewright.functions.scalars import today
from filewright.operators import catalog, form_d, lookup, planning, reshape
from filewright.operators.specs import REJECTS, TABLES
from filewright.operators.store import Store, require_consistent
from filewright.sources import files


class Engine:
    """A store at ``root`` and landed files at ``landing``; ``day`` fixes the date of today."""

    def __init__(self, spark: SparkSession, root: str, landing: str, day: str | None = None):
        self.spark, self.store, self.landing, self.day = spark, Store(spark, root), landing.rstrip("/"), today(day)

    def table(self, name: str) -> DataFrame:
        return self.store.read(TABLES[name])

    def setup(self) -> None:
        """L1."""
        for spec in (*TABLES.values(), REJECTS):
            self.store.create(spec)

    def load_names(self) -> None:
        """L2: every name of every id."""
        self.store.put(TABLES["cik_names"], files.cik_names(self.spark, f"{self.landing}/cik-lookup-data.txt").distinct())

    def primary_names(self) -> DataFrame:
        """One name for each id: the last in order."""
        return self.table("cik_names").groupBy("cik").agg(F.max("name").alias("name"))

    def load_quarters(self, first: int, last: int) -> None:
        """L3: the quarterly indexes of years, latest date of each id."""
        if not 1993 <= first <= last:
            raise ValueError("years start at 1993")
        paths = [f"{self.landing}/full-index/{y}/QTR*/master.idx" for y in range(first, last + 1)]
        self.store.put(TABLES["cik_last_update"], files.quarterly_index(files.master_index(self.spark, paths)), "last_update")

    def load_day(self, date: str) -> None:
        """L4."""
        rows = files.master_index(self.spark, f"{self.landing}/daily-index/{date[:4]}/{date}.master.idx")
        self.store.put(TABLES["cik_last_update"], files.daily_index(rows, date), "last_update")

    def work(self, kind: str) -> DataFrame:
        """The work list for 'facts' or 'submissions'."""
        return planning.work_list(self.table("cik_last_update"), self.table(f"processed_{kind}"))

    def update_facts(self) -> None:
        """The facts of all ids that are stale or new, from landed documents; a missing document is a failure."""
        work = self.work("facts")
        docs = files.documents(self.spark, f"{self.landing}/companyfacts").withColumn("cik", F.regexp_extract("path", r"CIK0*(\d+)\.json", 1).cast("long"))
        wanted = docs.join(work.select("cik"), "cik", "left_semi")
        self.store.put(TABLES["company_facts"], files.company_facts(wanted, "text").distinct())
        done = wanted.select("cik", F.from_json("text", "cik string").isNotNull().alias("success"))
        results = work.select("cik").join(done, "cik", "left").select("cik", F.coalesce("success", F.lit(False)).alias("success"))
        self.store.put(TABLES["processed_facts"], planning.marker(results, self.day))

    def update_submissions(self) -> None:
        """Five tables from one parse of the landed submissions."""
        work = self.work("submissions")
        docs = files.documents(self.spark, f"{self.landing}/submissions").withColumn("cik", F.regexp_extract("path", r"CIK0*(\d+)(?:-|\.json)", 1).cast("long"))
        wanted = docs.join(work.select("cik"), "cik", "left_semi")
        main = files.submissions(wanted.where(F.col("path").rlike(r"CIK\d+\.json\z")), "text").where("cik is not null").cache()
        more = wanted.where(~F.col("path").rlike(r"CIK\d+\.json\z"))
        overflow = more.select("cik", F.from_json("text", files.FILINGS).alias("recent"))
        put = lambda name, rows: self.store.put(TABLES[name], rows.distinct())
        put("sic_codes", reshape.sic_codes(main))
        put("entities", reshape.entities(main))
        put("entity_tickers", reshape.tickers(main))
        self.store.put(TABLES["filings"], reshape.filings(main, overflow))
        places = reshape.contact_addresses(main).where("address is not null")
        put("addresses", places.select("address.*"))
        put("addresses_entity_junction", places.select("address.address_hash_id", "relation_name", "cik"))
        phones = reshape.contact_phones(main)
        put("phones", phones.select("phone.*"))
        put("phones_entity_junction", phones.select("phone.international_number", "relation_name", "cik"))
        done = wanted.select("cik", F.lit(True).alias("success")).distinct()
        results = work.select("cik").join(done, "cik", "left").select("cik", F.coalesce("success", F.lit(False)).alias("success"))
        self.store.put(TABLES["processed_submissions"], planning.marker(results, self.day, retry_later=False))
        main.unpersist()

    def load_forms(self, **criteria) -> form_d.FormD:
        """The filings of the criteria (cik, form, accession_number) that have a parser, parsed and stored.

        The documents are parsed once and written; every table is a plan over that. What can't be normalized goes to
        ``rejects``, a filing that can't be read or parsed is a failure in ``processed_filings``.
        """
        self.store.drop_staged()
        rows = lookup.search(self.table("filings"), **criteria)
        known = catalog.dispatch(rows, catalog.catalogue(self.spark)).where("reason is null").drop("reason", "family")
        docs = files.documents(self.spark, f"{self.landing}/data/*/*").withColumn("accession_plain", F.regexp_extract("path", r"/([^/]+)/[^/]+\z", 1))
        wanted = known.withColumn("accession_plain", F.replace("accession_number", F.lit("-"), F.lit("")))
        texts = wanted.join(docs, "accession_plain").select("cik", "file_number", "accession_number", "form", "text")
        parsed = self.store.staged(form_d.parse(texts.withColumnRenamed("form", "form_type")).drop("text"))
        good = parsed.where("form.primaryIssuer is not null")
        out = form_d.extract(good, self.store.staged(form_d.parties(good)))
        require_consistent(out.offerings.distinct(), out.history.select("cik", "file_number").distinct(), ["file_number", "cik"], ["cik", "file_number"])
        for name, rows in {
            "investment_offerings": out.offerings, "investment_offerings_history": out.history, "issuers": out.issuers, "companies": out.companies, "persons": out.persons,
            "addresses": out.addresses, "phones": out.phones, "companies_entity_junction": out.company_edges, "persons_entity_junction": out.person_edges,
            "addresses_entity_junction": out.address_edges, "phones_entity_junction": out.phone_edges, "companies_address_junction": out.company_addresses,
            "companies_phone_junction": out.company_phones, "persons_address_junction": out.person_addresses, "companies_previous_names": out.previous_names,
        }.items():
            self.store.put(TABLES[name], rows.select(*TABLES[name].schema.names))
        self.store.put(REJECTS, out.rejects.select(*REJECTS.schema.names))
        done = parsed.groupBy("cik", "accession_number").agg(F.max(F.col("form.primaryIssuer").isNotNull()).alias("success"))
        results = wanted.select("cik", "accession_number", "form").join(done, ["cik", "accession_number"], "left")
        self.store.put(TABLES["processed_filings"], results.select("cik", "accession_number", "form", F.date_format(self.day, "yyyy-MM-dd").alias("last_processed"), F.coalesce("success", F.lit(False)).alias("success")))
        return out
