"""Tables: upsert, insert-if-absent, delete, update, versions, planning."""

import pytest
from pyspark.sql import functions as F

from filewright.operators import lookup, planning, store
from filewright.operators.specs import TABLES
from filewright.operators.store import Store


@pytest.fixture
def tables(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def test_31_tables():
    assert len(TABLES) == 31 and all(set(t.pk) <= set(t.schema.names) and set(t.cluster) <= set(t.schema.names) for t in TABLES.values())


def test_put_is_last_writer_wins(spark, tables):
    spec = TABLES["cik_last_update"]
    tables.create(spec)
    tables.create(spec)
    assert tables.read(spec).count() == 0
    tables.put(spec, spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (1, "2024-03-01")], spec.ddl), "last_update")
    tables.put(spec, spark.createDataFrame([(2, "2023-01-01")], spec.ddl), "last_update")
    rows = sorted((r.cik, r.last_update) for r in tables.read(spec).collect())
    assert rows == [(1, "2024-03-01"), (2, "2023-01-01")]
    tables.put(spec, tables.read(spec), "last_update")  # the same rows again change nothing
    assert sorted((r.cik, r.last_update) for r in tables.read(spec).collect()) == rows


def test_delete_and_update(spark, tables):
    spec = TABLES["issuers"]
    tables.put(spec, spark.createDataFrame([(1, 2, False), (1, 3, True)], spec.ddl))
    assert tables.delete(spec, spark.createDataFrame([(1, 2)], "cik long, issuer_cik long")) is True
    assert tables.delete(spec, spark.createDataFrame([(1, 2)], "cik long, issuer_cik long")) is False
    tables.update(spec, spark.createDataFrame([(1, 3, False), (8, 8, True)], spec.ddl), "is_primary")
    assert [tuple(r) for r in tables.read(spec).collect()] == [(1, 3, False)]


def test_null_keys_are_keys(spark):
    facts = spark.createDataFrame([(1, None, 5.0)], "cik long, frame string, val double")
    assert store.upsert(facts, facts, ["cik", "frame"]).count() == 1


def test_insert_if_absent(spark):
    new = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (2, "none", 1), (3, "b", 1)], "k long, name string, n int")
    old = spark.createDataFrame([(3, "b")], "k long, name string")
    assert [tuple(r) for r in lookup.insert_if_absent(new, old, ["k", "name"], F.col("name") == "none", ["n"]).collect()] == [(1, "a", 1)]


def test_consistency(spark):
    a = spark.createDataFrame([(1, "x", "c")], "k long, file string, v string")
    store.require_consistent(a, a, ["k"], ["file"])
    with pytest.raises(ValueError):
        store.require_consistent(a, a.withColumn("file", F.lit("y")), ["k"], ["file"])


def test_search_and_flags(spark):
    df = spark.createDataFrame([(1, None, True), (2, "b", False)], "cik long, name string, is_debt boolean")
    assert lookup.search(df, name=None).first().cik == 1 and lookup.search(df).count() == 2 and lookup.by_flag(df, "is_debt", True).count() == 1
    with pytest.raises(ValueError):
        lookup.by_flag(df, "name", 1)


def test_work_lists_are_disjoint(spark):
    updates = spark.createDataFrame([(i, f"2024-01-{i + 10:02d}") for i in range(20)], "cik long, last_update string")
    done = spark.createDataFrame([(i, "2024-01-15", True) for i in range(12)], "cik long, last_processed string, success boolean")
    stale, fresh = planning.stale(updates, done), planning.unprocessed(updates, done)
    both = [r.cik for r in stale.collect()], [r.cik for r in fresh.collect()]
    assert not set(both[0]) & set(both[1]) and both[0] == sorted(both[0], reverse=True)
    assert {r.cik for r in planning.work_list(updates, done).collect()} == {*both[0], *both[1]}
    marks = planning.marker(spark.createDataFrame([(1, True), (2, False)], "cik long, success boolean"), F.to_date(F.lit("2024-02-29"))).collect()
    assert [(r.last_processed, r.success) for r in marks] == [("2024-02-29", True), ("2025-02-28", False)]
