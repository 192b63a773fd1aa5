"""One query for each operator on the given tables, with its SQL.

The tables hold no filings, so each operator runs on a stand-in: orders as filings, customers as entities, lineitem as
facts and offering history, part as offerings, events as update logs, documents as free text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from filewright.functions import address, company, person, phone, scalars
from filewright.functions.vocab import BAD_PERSON, ITEMS_8K, PLACE_CODES
from filewright.operators import catalog, lookup, planning, reshape, store
from filewright.sources import files
from filewright.streaming import index_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def updates(self) -> DataFrame:
        """(cik, last_update): the latest event of each user."""
        return self.events.groupBy(F.col("user_id").alias("cik")).agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_update"))

    def processed(self) -> DataFrame:
        """(cik, last_processed): the first event of two users in three."""
        return self.events.where("user_id % 3 <> 0").groupBy(F.col("user_id").alias("cik")).agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("last_processed"))

    def filings(self) -> DataFrame:
        return self.orders.select(F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("accession"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"), F.col("o_orderpriority").alias("form"), F.col("o_orderstatus").alias("file_number"))

    def junction(self) -> DataFrame:
        return self.lineitem.select(F.col("l_partkey").alias("cik"), F.col("l_returnflag").alias("relation_name"), F.col("l_suppkey").alias("s_suppkey")).distinct()

    def issuers(self) -> DataFrame:
        return self.lineitem.groupBy(F.col("l_suppkey").alias("cik"), F.col("l_partkey").alias("issuer_cik")).agg(F.max(F.col("l_linenumber") == 1).alias("is_primary"))


UPDATES = "SELECT user_id AS cik, strftime(max(ts), '%Y-%m-%d') AS last_update FROM events GROUP BY user_id"
PROCESSED = "SELECT user_id AS cik, strftime(min(ts), '%Y-%m-%d') AS last_processed FROM events WHERE user_id % 3 <> 0 GROUP BY user_id"
FILINGS = "SELECT o_custkey AS cik, o_orderkey AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, o_orderpriority AS form, o_orderstatus AS file_number FROM orders"
JUNCTION = "SELECT DISTINCT l_partkey AS cik, l_returnflag AS relation_name, l_suppkey AS s_suppkey FROM lineitem"
ISSUERS = "SELECT l_suppkey AS cik, l_partkey AS issuer_cik, max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) = 1 AS is_primary FROM lineitem GROUP BY ALL"


def query(name: str, sql: str | None = None):
    """Register a query, a function of Tables, and its SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


# --- sources -----------------------------------------------------------------------------------------------------

LINE = "concat_ws('|', cast(user_id as string), event_type, props, date_format(ts, 'yyyy-MM-dd'), concat('f/', cast(event_id as string)))"


def _index(t: Tables) -> DataFrame:
    """Events as lines of an index, with a line of another width for each view."""
    lines = t.events.select(F.expr(f"CASE WHEN event_type = 'view' THEN concat({LINE}, '|x') ELSE {LINE} END").alias("value"), F.lit("events").alias("path"))
    return files.index_rows(lines)


@query("s1_daily_index_distinct", "SELECT DISTINCT user_id AS cik, '2024-01-02' AS last_update FROM events WHERE event_type <> 'view'")
def _(t):
    return files.daily_index(_index(t), "2024-01-02")


@query("s2_index_max_date", "SELECT user_id AS cik, strftime(max(ts), '%Y-%m-%d') AS last_update FROM events WHERE event_type <> 'view' GROUP BY user_id")
def _(t):
    return files.quarterly_index(_index(t))


@query("s3_range_partial_max", f"SELECT * FROM ({UPDATES})")
def _(t):
    days = t.events.select(F.col("user_id").alias("cik"), F.date_format("ts", "yyyy-MM-dd").alias("date_filed"))
    return files.quarterly_index(days)


@query("s4_name_split", "SELECT CASE WHEN c_custkey % 7 = 0 THEN '?' ELSE c_name || ':' || c_mktsegment END AS name, c_custkey AS cik FROM customer")
def _(t):
    lines = t.customer.select(F.expr("concat(CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE concat(' ', c_name, ':', c_mktsegment, ' ') END, ':', lpad(cast(c_custkey as string), 10, '0'), ':')").alias("value"))
    return files.name_rows(lines.union(t.spark.createDataFrame([("",)], "value string")))


@query("s12_response_type", "SELECT page_id, CASE WHEN regexp_matches(url, '\\.html$') THEN 'text' ELSE 'blob' END AS kind FROM pages")
def _(t):
    return t.pages.select("page_id", files.response_type(F.col("url")).alias("kind"))


@query("s14_paths", "SELECT event_id, 'daily-index/' || strftime(ts, '%Y') || '/' || strftime(ts, '%Y-%m-%d') || '.master.idx' AS day, 'full-index/' || strftime(ts, '%Y') || '/QTR' || quarter(ts) || '/master.idx' AS quarter, 'companyfacts/CIK' || lpad(CAST(user_id AS VARCHAR), 10, '0') || '.json' AS facts, 'submissions/CIK' || lpad(CAST(user_id AS VARCHAR), 10, '0') || '.json' AS submissions FROM events")
def _(t):
    return t.events.select("event_id", files.daily_index_path(F.col("ts")).alias("day"), files.quarterly_index_path(F.col("ts")).alias("quarter"), files.facts_path(F.col("user_id")).alias("facts"), files.submissions_path(F.col("user_id")).alias("submissions"))


# --- reshape -----------------------------------------------------------------------------------------------------


@query("f1_linearize_json", "SELECT user_id AS cik, event_type AS grouping, 'n' AS name, 'k' AS val_unit, CAST(event_id AS VARCHAR) AS accession_number, CAST(json_extract(props, '$.k') AS DOUBLE) AS val FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def _(t):
    doc = F.expr("""concat('{"cik":"', cast(user_id as string), '","facts":{"', event_type, '":{"n":{"label":"l","units":{"k":[{"accn":"', cast(event_id as string), '","val":', get_json_object(props, '$.k'), '}]}}}}}')""")
    rows = files.company_facts(t.events.where("get_json_object(props, '$.k') is not null").select(doc.alias("value")))
    return rows.select("cik", "grouping", "name", "val_unit", "accession_number", "val")


@query("f2_zip_arrays", "SELECT l_orderkey, l_linenumber AS line, l_quantity AS quantity FROM lineitem")
def _(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_partkey"))).alias("a"))
    rows = rows.select("l_orderkey", F.col("a.l_linenumber").alias("line"), F.col("a.l_quantity").alias("quantity"))
    return reshape.zip_rows(rows, ["l_orderkey"], ["line", "quantity"])


@query("f3_zip_skip_null", "SELECT c_custkey, c_name AS ticker, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS exchange FROM customer WHERE c_custkey % 2 = 0")
def _(t):
    rows = t.customer.select("c_custkey", F.array("c_name").alias("ticker"), F.array(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("exchange"))
    return reshape.zip_present(rows, ["c_custkey"], "ticker", "exchange")


@query("f4_stack_kinds", "SELECT c_custkey, 'entity:mailing' AS relation_name, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'entity:business', c_mktsegment FROM customer WHERE c_custkey % 3 <> 0")
def _(t):
    rows = t.customer.select("c_custkey", F.struct(F.col("c_name").alias("mailing"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("business")).alias("a"))
    return reshape.kinds(rows, ["c_custkey"], "a", ["mailing", "business"])


# --- projections, filters ----------------------------------------------------------------------------------------


@query("p1_point_lookup", f"SELECT * FROM ({FILINGS}) WHERE accession = 77")
def _(t):
    return lookup.get(t.filings(), accession=77)


@query("p2_search_conjunctive", f"SELECT * FROM ({FILINGS}) WHERE form = '1-URGENT' AND file_number = 'F'")
def _(t):
    return lookup.search(t.filings(), form="1-URGENT", file_number="F")


@query("p3_search_empty", f"SELECT * FROM ({ISSUERS})")
def _(t):
    return lookup.search(t.issuers())


@query("p5_threshold_above", "SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 30000")
def _(t):
    return lookup.above(t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 30000)


@query("p6_nonzero", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0")
def _(t):
    return lookup.present(t.lineitem.select("l_orderkey", "l_linenumber", "l_discount"), "l_discount")


@query("p7_flag_search", "SELECT p_partkey, p_size > 25 AS is_equity, p_size % 2 = 0 AS is_debt FROM part WHERE p_size % 2 = 0")
def _(t):
    rows = t.part.select("p_partkey", (F.col("p_size") > 25).alias("is_equity"), (F.col("p_size") % 2 == 0).alias("is_debt"))
    return lookup.by_flag(rows, "is_debt", True)


@query("p8_named_filters", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand = 'Brand#1' AND p_type IS NOT DISTINCT FROM (SELECT min(p_type) FROM part)")
def _(t):
    first = t.part.agg(F.min("p_type").alias("p_type"))
    return lookup.exists(lookup.search(t.part.select("p_partkey", "p_brand", "p_type"), p_brand="Brand#1"), first, "p_type").select("p_partkey", "p_brand", "p_type")


@query("p9_filings_by_form", f"SELECT cik, accession, form FROM ({FILINGS}) WHERE cik = 7 AND form <> '5-LOW'")
def _(t):
    return lookup.search(t.filings(), cik=7).where("form <> '5-LOW'").select("cik", "accession", "form")


@query("p10_first_by_key", f"SELECT cik, accession FROM ({FILINGS}) WHERE file_number = 'O' ORDER BY filing_date, accession LIMIT 1")
def _(t):
    return lookup.first_by(t.filings(), ["filing_date", "accession"], file_number="O").select("cik", "accession")


@query("p11_exists", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def _(t):
    return lookup.exists(t.customer.select("c_custkey", "c_name"), lookup.search(t.orders, o_orderstatus="F").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("p12_drop_falsy", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def _(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k")).dropna("all", subset=["k"])


@query("p13_falsy_to_null", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END, '') AS flag, CASE WHEN l_tax > 0.04 THEN true END AS taxed FROM lineitem")
def _(t):
    flag = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", "l_linenumber", reshape.falsy_to_null(F.col("l_discount"), "double").alias("discount"), reshape.falsy_to_null(flag, "string").alias("flag"), reshape.falsy_to_null(F.col("l_tax") > 0.04, "boolean").alias("taxed"))


@query("p14_replace", "SELECT p_partkey, regexp_replace(CASE WHEN p_partkey % 2 = 0 THEN 'xslFormDX01/' ELSE '' END || p_name, '^xsl[^/]+/', '') AS doc FROM part")
def _(t):
    return t.part.select("p_partkey", F.regexp_replace(F.concat(F.when(F.col("p_partkey") % 2 == 0, "xslFormDX01/").otherwise(""), F.col("p_name")), "^xsl[^/]+/", "").alias("doc"))


@query("p15_insert_if_absent", "WITH new AS (SELECT o_custkey AS cik, o_orderpriority AS name, min(o_orderkey) AS first_key FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL) SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = new.cik AND o.o_orderpriority = new.name AND o.o_orderstatus = 'F')")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("first_key"), "o_orderstatus")
    target = rows.where("o_orderstatus = 'F'").select("cik", "name").distinct()
    return lookup.insert_if_absent(rows.drop("o_orderstatus"), target, ["cik", "name"], F.col("name") == "5-LOW", ["first_key"])


# --- joins -------------------------------------------------------------------------------------------------------


@query("j1_stale", f"SELECT u.cik, u.last_update, p.last_processed FROM ({UPDATES}) u JOIN ({PROCESSED}) p ON u.cik = p.cik WHERE u.last_update > p.last_processed")
def _(t):
    return planning.stale(t.updates(), t.processed())


@query("j2_unprocessed", f"SELECT u.cik, u.last_update FROM ({UPDATES}) u LEFT JOIN ({PROCESSED}) p ON u.cik = p.cik WHERE p.cik IS NULL")
def _(t):
    return planning.unprocessed(t.updates(), t.processed())


@query("j3_traverse", f"SELECT j.cik, j.relation_name, s.s_suppkey, s.s_name FROM ({JUNCTION}) j JOIN supplier s USING (s_suppkey)")
def _(t):
    return lookup.traverse(t.junction(), t.supplier.select("s_suppkey", "s_name"), "s_suppkey").select("cik", "relation_name", "s_suppkey", "s_name")


@query("j3_traverse_relation", f"SELECT j.cik, j.relation_name, s.s_suppkey, s.s_name FROM ({JUNCTION}) j JOIN supplier s USING (s_suppkey) WHERE j.cik = 5 AND j.relation_name = 'R'")
def _(t):
    return lookup.traverse(t.junction(), t.supplier.select("s_suppkey", "s_name"), "s_suppkey", {"cik": 5}, "R").select("cik", "relation_name", "s_suppkey", "s_name")


@query("j4_dim_description", "SELECT c_custkey, c_nationkey, n_name AS description FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey <> 0")
def _(t):
    c, n = t.customer.select("c_custkey", "c_nationkey"), t.nation
    return lookup.describe(c, n, (c["c_nationkey"] == n["n_nationkey"]) & (n["n_nationkey"] != 0), "n_name", "description")


@query("j5_nested_children", "SELECT c_custkey, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def _(t):
    out = lookup.nest(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], "orders", ["o_orderkey"])
    return out.select("c_custkey", F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"))


@query("j6_offering_history", "SELECT p_partkey, count(l_orderkey) AS n, coalesce(round(sum(l_extendedprice), 2), 0) AS total FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey")
def _(t):
    history = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return t.part.select("p_partkey").join(history, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("total", F.lit(0.0)).alias("total"))


@query("j7_children_by_subset_key", "SELECT p_partkey, p_brand, n FROM part LEFT JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_size > 25 GROUP BY p_brand) USING (p_brand)")
def _(t):
    children = t.part.where("p_size > 25").groupBy("p_brand").agg(F.count("*").alias("n"))
    return t.part.select("p_partkey", "p_brand").join(children, "p_brand", "left").select("p_partkey", "p_brand", "n")


@query("j8_name_lookup", "SELECT c_mktsegment AS name, min(c_custkey) AS cik FROM customer GROUP BY 1")
def _(t):
    return t.customer.groupBy(F.col("c_mktsegment").alias("name")).agg(F.min("c_custkey").alias("cik"))


_CODES = "['A0', 'X0', 'CA', 'ZZ', 'V8', 'Germany', 'NY']"
_ISO = "['CA', 'GB', 'US', NULL, 'CH', 'DE', 'US']"


@query("j9_code_lookup", f"SELECT c_custkey, ({_ISO})[c_custkey % 7 + 1] AS country FROM customer")
def _(t):
    code = F.get(F.array(*map(F.lit, eval(_CODES))), (F.col("c_custkey") % 7).cast("int"))
    return t.customer.select("c_custkey", address.country_code(code).alias("country"))


_PLACES = ["One Main St, Toronto", "London Wall", "nowhere", "Rue de Paris 4", "Bahnhofstrasse, Zurich", "Baar near Zug"]
_FOUND = ["A0", "X0", None, "I0", "V8", "V8"]


@query("j10_keyword_lookup", f"SELECT s_suppkey, ([{', '.join('NULL' if x is None else repr(x) for x in _FOUND)}])[s_suppkey % 6 + 1] AS code FROM supplier")
def _(t):
    line = F.get(F.array(*map(F.lit, _PLACES)), (F.col("s_suppkey") % 6).cast("int"))
    return t.supplier.select("s_suppkey", address.place_code(line, F.lit("elsewhere")).alias("code"))


# --- aggregates, order, sets, writes -------------------------------------------------------------------------------


@query("a3_merge_max", f"SELECT * FROM ({UPDATES})")
def _(t):
    parts = t.events.groupBy(F.col("user_id").alias("cik"), F.quarter("ts").alias("q")).agg(F.max("ts").alias("ts"))
    return parts.groupBy("cik").agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_update"))


@query("a6_last_writer_wins", "SELECT user_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value FROM events GROUP BY user_id")
def _(t):
    return store.last_writer(t.events.select("user_id", "event_type", "value", F.col("event_id").alias("__seq")), ["user_id"]).drop("__seq")


@query("a7_worklist_counts", f"SELECT CASE WHEN p.cik IS NULL THEN 'unprocessed' ELSE 'stale' END AS reason, count(*) AS n FROM ({UPDATES}) u LEFT JOIN ({PROCESSED}) p ON u.cik = p.cik WHERE p.cik IS NULL OR u.last_update > p.last_processed GROUP BY 1")
def _(t):
    return planning.counts(planning.work_list(t.updates(), t.processed()))


@query("a8_sum_batch", "SELECT CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem")
def _(t):
    return t.lineitem.agg(F.sum("l_quantity").alias("total"))


@query("o1_order_desc", f"SELECT * FROM ({UPDATES})")
def _(t):
    return t.updates().orderBy(F.desc("last_update"), "cik")


@query("o2_top_k_recent", f"SELECT cik, accession, filing_date FROM ({FILINGS}) QUALIFY row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC, accession) <= 10")
def _(t):
    return lookup.top_k_each(t.filings().select("cik", "accession", "filing_date"), ["cik"], [F.desc("filing_date"), "accession"])


@query("o2_top_k_one", f"SELECT cik, accession, filing_date FROM ({FILINGS}) WHERE cik = 7 ORDER BY filing_date DESC, accession LIMIT 10")
def _(t):
    return lookup.top_k(lookup.search(t.filings(), cik=7).select("cik", "accession", "filing_date"), [F.desc("filing_date"), "accession"])


@query("u1_union_all", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 1000")
def _(t):
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey").unionByName(t.orders.where("o_totalprice > 1000").select("o_orderkey"))


@query("u3_upsert", "SELECT c_custkey, coalesce(o.name, c_name) AS name FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY 1) o ON o_custkey = c_custkey UNION ALL SELECT o_custkey, max_by(o_orderpriority, o_orderkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1")
def _(t):
    new = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("name"), "o_orderkey")
    return store.upsert(t.customer.select("c_custkey", F.col("c_name").alias("name")), new, ["c_custkey"], "o_orderkey")


@query("u4_delete_by_key", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _(t):
    keys = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return store.delete(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query("u5_update_if_exists", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE s_name END AS s_name FROM supplier")
def _(t):
    values = t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("new").alias("s_name"))
    return store.update(t.supplier.select("s_suppkey", "s_name"), values, ["s_suppkey"], "s_name")


@query("u6_mismatch_check", "SELECT o_orderkey AS k, c_custkey AS c FROM orders JOIN customer ON o_custkey = c_custkey WHERE (CASE WHEN o_orderstatus = 'F' THEN 'BUILDING' ELSE c_mktsegment END) IS DISTINCT FROM c_mktsegment")
def _(t):
    a = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "BUILDING").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return store.mismatches(a, t.customer, ["c_custkey"], ["c_mktsegment"]).select(F.col("a.o_orderkey").alias("k"), F.col("b.c_custkey").alias("c"))


# --- scalars -----------------------------------------------------------------------------------------------------


@query("d1_parse_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS d FROM events WHERE event_id % 6 < 5 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 6 = 5")
def _(t):
    forms = ["yyyy-M-d", "M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "M-d-yyyy"]
    text = F.coalesce(*(F.when(F.col("event_id") % 6 == i, F.date_format("ts", f)) for i, f in enumerate(forms)), F.lit("soon"))
    return t.events.select("event_id", F.date_format(scalars.parse_date(text), "yyyy-MM-dd").alias("d"))


@query("d2_sec_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, true AS ok FROM orders")
def _(t):
    d = scalars.sec_date(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", d.alias("d"), scalars.is_sec_date(d).alias("ok"))


@query("d5_quarter", "SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS q FROM orders")
def _(t):
    return t.orders.select("o_orderkey", scalars.quarter_of(F.col("o_orderdate")).alias("q"))


@query("d6_quarter_sequence", "SELECT strftime(q, '%Y-%m-%d') AS start FROM (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)), date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS q FROM orders)")
def _(t):
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return ends.select(F.explode(scalars.quarters(F.col("a"), F.col("b"))).alias("q")).select(F.date_format("q", "yyyy-MM-dd").alias("start"))


@query("d7_backoff", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR, '%Y-%m-%d') AS d FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.date_format(scalars.backoff(F.to_date("o_orderdate")), "yyyy-MM-dd").alias("d"))


@query("n1_zero_pad", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer")
def _(t):
    return t.customer.select("c_custkey", scalars.pad_cik(F.col("c_custkey")).alias("cik"))


@query("n2_strip_dashes", "SELECT o_orderkey, replace(o_orderpriority || '-' || o_orderkey, '-', '') AS c FROM orders")
def _(t):
    return t.orders.select("o_orderkey", scalars.strip_dashes(F.concat_ws("-", "o_orderpriority", F.col("o_orderkey").cast("string"))).alias("c"))


@query("n3_parse_int", "SELECT o_orderkey, try_cast(regexp_extract(o_orderpriority, '^\\s*([+-]?\\d+)', 1) AS BIGINT) AS n FROM orders")
def _(t):
    return t.orders.select("o_orderkey", scalars.parse_int(F.col("o_orderpriority")).alias("n"))


@query("h1_clean_html", "SELECT page_id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '[ \r\n]', ' ', 'g'), ' +', ' ', 'g') AS body FROM pages")
def _(t):
    return t.pages.select("page_id", scalars.clean_html(F.concat(F.lit("x<TEXT>"), F.col("html"))).alias("body"))


_BAD = ", ".join(repr(x.lower()) for x in BAD_PERSON)
_FIELDS = ["N/A", "managing member", " -- ", "Smith", "", "Entity", "Anna"]


@query("b1_bad_values", f"SELECT c_custkey, lower(trim(v)) IN ({_BAD}, '') AS bad FROM (SELECT c_custkey, ({_FIELDS!r})[c_custkey % 7 + 1] AS v FROM customer)")
def _(t):
    v = F.get(F.array(*map(F.lit, _FIELDS)), (F.col("c_custkey") % 7).cast("int"))
    return t.customer.select("c_custkey", scalars.is_bad_person(v).alias("bad"))


# --- normalization -----------------------------------------------------------------------------------------------

_TAILS = ["", ", Inc.", " Corp", " L.L.C.", " Holdings", " & Co., Ltd.", " Corporation Incorporated", " d/b/a Größe"]
_NAMED = "c_custkey, c_name || (['', ', Inc.', ' Corp', ' L.L.C.', ' Holdings', ' & Co., Ltd.', ' Corporation Incorporated', ' d/b/a Größe'])[c_custkey % 8 + 1] AS name FROM customer"
_STRIP = "regexp_replace(trim(regexp_replace(regexp_replace(name, '[.,;:!?]', '', 'g'), '\\s+', ' ', 'g')), '(?i)(\\s*\\b(INC|INCORPORATED|CORPORATION|CORP|COMPANY|CO|PTE|LTD|LIMITED))+\\s*$', '')"


def _names(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.concat("c_name", F.get(F.array(*map(F.lit, _TAILS)), (F.col("c_custkey") % 8).cast("int"))).alias("name"))


def _ends_sql(expr: str) -> str:
    pattern = company.endings().replace("'", "''")
    return f"regexp_matches(trim({expr}), '(?i)\\b(?:{pattern})$')"


@query("c1_has_ending", f"SELECT c_custkey, {_ends_sql('name')} AS ends FROM (SELECT {_NAMED})")
def _(t):
    return _names(t).select("c_custkey", company.has_ending(F.col("name")).alias("ends"))


@query("c3_strip_endings", f"SELECT c_custkey, trim({_STRIP}) AS name FROM (SELECT {_NAMED})")
def _(t):
    return _names(t).select("c_custkey", company.strip_endings(F.col("name")).alias("name"))


@query("c7_normalize_name", f"SELECT c_custkey, nullif(trim({_STRIP}), '') AS name FROM (SELECT {_NAMED})")
def _(t):
    return _names(t).select("c_custkey", company.normal_name(F.col("name")).alias("name"))


@query("c8_slug", f"SELECT c_custkey, replace(strip_accents(replace(replace(regexp_replace(lower(trim({_STRIP})), '\\s+', '-', 'g'), '-&-', '-and-'), '/', '-')), '--', '-') AS slug FROM (SELECT {_NAMED})")
def _(t):
    return _names(t).select("c_custkey", company.slug(company.normal_name(F.col("name"))).alias("slug"))


_STREETS = ["12 Main Street", "Acme Holdings", "5 Elm  Road C/O John Doe", " ", "One Park Avenue, Suite 400"]
_CLEANED = ["12 Main Street", None, "5 Elm Road", None, "One Park Avenue, Suite 400"]


def _pick(values: list, key: str):
    return F.get(F.array(*map(F.lit, values)), (F.col(key) % len(values)).cast("int"))


def _sql_pick(values: list, key: str) -> str:
    quoted = ("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return "([" + ", ".join(quoted) + f"])[{key} % {len(values)} + 1]"


@query("ad1_clean_street", f"SELECT s_suppkey, {_sql_pick(_CLEANED, 's_suppkey')} AS street FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", address.clean_street(_pick(_STREETS, "s_suppkey")).alias("street"))


@query("ad2_consolidate", "SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END, 'x'], lambda v: v IS NOT NULL AND trim(v) <> ''), '|') AS lines FROM customer")
def _(t):
    k = F.col("c_custkey")
    return t.customer.select("c_custkey", F.array_join(address.consolidate(F.when(k % 2 == 0, F.col("c_name")), F.when(k % 3 == 0, " ").otherwise(F.col("c_mktsegment")), F.lit("x")), "|").alias("lines"))


_CITIES = ["Saint Paul", "Mount  Vernon", "NYC", "New York City", "st louis"]
_CITIES_OUT = ["ST PAUL", "MT VERNON", "NEW YORK", "NEW YORK", "ST LOUIS"]


@query("ad5_city", f"SELECT s_suppkey, {_sql_pick(_CITIES_OUT, 's_suppkey')} AS city FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", address.city(_pick(_CITIES, "s_suppkey")).alias("city"))


_ZIPS, _LANDS, _POSTS = ["12345-6789", "k1a0b6", "SW1A1AA", "75008", "abc", " "], ["US", "CA", "GB", "FR", "US", "US"], ["12345", "K1A 0B6", "SW1A 1AA", "75008", "ABC", None]


@query("ad7_postal", f"SELECT s_suppkey, {_sql_pick(_POSTS, 's_suppkey')} AS zip FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", address.postal_code(_pick(_ZIPS, "s_suppkey"), _pick(_LANDS, "s_suppkey")).alias("zip"))


@query("ad10_address_key", "SELECT s_suppkey, concat_ws('|', nullif(lower(trim(s_name)), ''), nullif(lower(trim(n_name)), ''), CASE WHEN s_suppkey % 2 = 0 THEN 'x' END) AS key FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    rows = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    return rows.select("s_suppkey", address.address_key(F.col("s_name"), F.col("n_name"), F.when(F.col("s_suppkey") % 2 == 0, " X ").otherwise(" ")).alias("key"))


_PEOPLE = ["dr. anna maria SMITH jr.", "O'Connor, Mary-Jane", "/s/ Juan del Rio", "Solo", "john  q. public"]
_LAST = "O'Connor"
_PERSON_KEYS = ["anna-maria-smith-jr", "mary-jane-o'connor", "juan-del-rio", None, "john-q-public"]


@query("r1_person_parts", f"SELECT s_suppkey, {_sql_pick(['Anna', 'Mary-Jane', 'Juan', None, 'John'], 's_suppkey')} AS first, {_sql_pick(['Smith', _LAST, 'del Rio', None, 'Public'], 's_suppkey')} AS last FROM supplier")
def _(t):
    rows = t.supplier.select("s_suppkey", person.person(_pick(_PEOPLE, "s_suppkey")).alias("p"))
    return rows.select("s_suppkey", "p.first", "p.last")


@query("r2_person_slug", "SELECT s_suppkey, " + "CASE s_suppkey % 5 " + " ".join(f"WHEN {i} THEN {'NULL' if k is None else chr(39) + k.replace(chr(39), chr(39) * 2) + chr(39)}" for i, k in enumerate(_PERSON_KEYS)) + " END AS slug FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", person.person(_pick(_PEOPLE, "s_suppkey"))["person_hash_id"].alias("slug"))


_PHONES = ["(212) 555-0100", "1-212-555-0100", "212.555.0100 ext. 7", "12", "+44 20 7946 0958", "letters", "0000000000"]
_NUMBERS = ["+1 212-555-0100", "+1 212-555-0100", "+1 212-555-0100 ext. 7", None, "+44 20 7946 0958", None, None]


@query("ph1_us_phone", f"SELECT s_suppkey, {_sql_pick(_NUMBERS, 's_suppkey')} AS number FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", phone.phone(_pick(_PHONES, "s_suppkey"))["international_number"].alias("number"))


# --- catalogue ---------------------------------------------------------------------------------------------------


@query("g1_form_dim", "WITH c AS (SELECT o_orderpriority AS code, o_orderstatus AS family, o_orderkey AS nth FROM orders) SELECT code, max_by(family, nth) AS family, false AS amended FROM c GROUP BY code")
def _(t):
    return catalog.later_wins(t.orders.select(F.col("o_orderpriority").alias("code"), F.col("o_orderstatus").alias("family"), F.lit(False).alias("amended"), F.col("o_orderkey").alias("nth")))


@query("g4_unknown_forms", "SELECT o_orderpriority AS form, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return catalog.unknown_forms(t.filings(), catalog.catalogue(t.spark))


@query("g3_dispatch", "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN '10-K/A' ELSE o_orderpriority END AS form, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'no parser' ELSE 'form not found' END AS reason, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    from filewright.operators import form_d  # noqa: F401  registers its parser

    k = F.col("accession") % 3
    rows = t.filings().withColumn("form", F.when(k == 0, "D").when(k == 1, "10-K/A").otherwise(F.col("form")))
    return catalog.dispatch(rows, catalog.catalogue(t.spark)).groupBy("form", "reason").agg(F.count("*").alias("n"))


_ITEM = "CASE o_orderkey % 3 WHEN 0 THEN '1.01,9.01' WHEN 1 THEN '5.02' ELSE '0.99' END"


@query("g5_item_explode", "SELECT o_orderkey, item, CASE item " + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in ITEMS_8K.items() if k in ("1.01", "9.01", "5.02")) + f" END AS description FROM (SELECT o_orderkey, unnest(string_split({_ITEM}, ',')) AS item FROM orders)")
def _(t):
    return catalog.items(t.orders.select("o_orderkey", F.expr(_ITEM).alias("items"))).select("o_orderkey", "item", "description")


# --- extensions --------------------------------------------------------------------------------------------------


@query("x_days_since_previous", "SELECT o_orderkey, CAST(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER) AS days FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def _(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_orderkey", F.date_diff(F.to_date("o_orderdate"), F.to_date(F.lag("o_orderdate").over(w))).alias("days"))


@query("x_rollup", "SELECT p_brand, p_type, count(*) AS n, sum(p_size) AS size FROM part GROUP BY ROLLUP (p_brand, p_type)")
def _(t):
    return t.part.rollup("p_brand", "p_type").agg(F.count("*").alias("n"), F.sum("p_size").alias("size"))


@query("x_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def _(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("x_as_of_join", "SELECT e.event_id, max_by(o.o_orderkey, struct_pack(d := o.o_orderdate, k := o.o_orderkey)) AS o_orderkey FROM events e LEFT JOIN orders o ON e.user_id = o.o_custkey AND o.o_orderdate <= e.ts GROUP BY e.event_id")
def _(t):
    # the latest order at each event: one sort of both by key and time, no join of ranges
    both = t.events.select(F.col("user_id").alias("k"), "ts", F.lit(1).alias("side"), "event_id", F.lit(None).cast("long").alias("o_orderkey")).unionByName(t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("ts"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("event_id"), "o_orderkey"))
    w = Window.partitionBy("k").orderBy("ts", "side", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("o_orderkey", F.last("o_orderkey", True).over(w)).where("side = 1").select("event_id", "o_orderkey")


@query("x_intersect", "SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'")
def _(t):
    return t.events.where("event_type = 'click'").select("user_id").intersect(t.events.where("event_type = 'purchase'").select("user_id"))


@query("x_except", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(t):
    return t.orders.where("o_orderstatus = 'F'").select("o_custkey").subtract(t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("x_tumbling_window", "SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(t):
    return index_stream.windowed_counts(t.events).withColumn("total", F.round("total", 4))


@query("x_session_window", "WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT min(ts) AS start, max(ts) + INTERVAL 12 HOUR AS \"end\", user_id, count(*) AS n FROM s GROUP BY user_id, s")
def _(t):
    return index_stream.sessions(t.events, "12 hours")


@query("x_similar_names", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey WHERE levenshtein(a.s_name, b.s_name) <= 1")
def _(t):
    # names that one edit tells apart are equal less a character each, or one of them is: only such pairs are compared
    cut = F.transform(F.sequence(F.lit(1), F.length("s_name")), lambda i: F.concat(F.substring(F.col("s_name"), F.lit(1), i - 1), F.substring(F.col("s_name"), i + 1, F.length("s_name"))))
    forms = t.supplier.select("s_suppkey", "s_name", "s_nationkey", F.explode(F.array_distinct(F.concat(F.array("s_name"), cut))).alias("form"))
    a, b = forms.alias("a"), forms.alias("b")
    met = a.join(b, (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.form") == F.col("b.form")) & (F.col("a.s_suppkey") < F.col("b.s_suppkey")))
    return met.where(F.levenshtein(F.col("a.s_name"), F.col("b.s_name")) <= 1).select(F.col("a.s_suppkey").alias("a"), F.col("b.s_suppkey").alias("b")).distinct()
