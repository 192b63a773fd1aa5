"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from compare import SMALL, duck, same
from filewright.plans import form_queries  # noqa: F401  registers its queries
from filewright.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return duck()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    same(spark, con, QUERIES[name], SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_plans(spark):
    sf = "/root/testdata/sf0.001"
    threshold = _plan(QUERIES["p5_threshold_above"](spark, sf))
    assert "GreaterThan(l_extendedprice,30000" in threshold and "l_comment" not in threshold
    assert "TakeOrderedAndProject" in _plan(QUERIES["o2_top_k_one"](spark, sf))
    assert "LeftAnti" in _plan(QUERIES["j2_unprocessed"](spark, sf))
    for name in QUERIES:
        plan = _plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in plan and "PythonUDF" not in plan, name


@pytest.mark.parametrize("name", ["f5_party_counts", "ar1_rejects", "fd6_recipient_crd", "fd_company_addresses", "fd_person_addresses"])
def test_forms_are_parsed_once(spark, name):
    """The plan that ran holds one parse of the forms; what needs them again reuses an exchange."""
    df = QUERIES[name](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("from_xml" in line for line in plan.split("\n")) == 1
