"""Every registered query against its SQL on the smallest data, and plans."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, database
from earshot import constants as C
from earshot.operators import classify, clean
from checks.demo_contacts import contacts_from_documents

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def sql():
    return database(SF)


# The queries of the library itself; the training-data ones have tests of their own.
OWN = [n for n in entry.queries() if not (entry.llm_queries and n in entry.llm_queries.queries())]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, sql, name):
    assert compare(spark, sql, name, SF) == ""


# Tested on planted data instead: splitting, quantising and linking are iterative.
WITHOUT_SQL = {"topic_fit", "topk_lists", "topk_lists_recall", "crm_links"}


def test_every_query_has_sql():
    assert set(OWN) - WITHOUT_SQL <= set(entry.oracle_sql())


def test_customers_are_linked(spark):
    pairs = {(r["left_id"], r["right_id"]) for r in entry.crm_links(spark, SF).collect()}
    truth = {(k, k + 1_000_000) for k in range(spark.read.parquet(f"{SF}/customer.parquet").count()) if k % 5 != 4}
    assert len(pairs & truth) >= 0.95 * len(truth) and len(pairs & truth) >= 0.95 * len(pairs)


def test_entry(spark):
    assert entry.entry(spark).count() == len(C.CHANNELS)


def test_checks_are_not_vacuous(spark):
    """Every channel, intent and band occurs, and so does no prediction."""
    rows = entry._classified(spark, "/root/testdata/sf0.01").select(
        "channel", "intent", "predicted_intent", "confidence", F.col("text") != F.col("cleaned_text")
    )
    columns = [set(c) for c in zip(*rows.collect())]
    assert columns[0] == set(C.CHANNELS)
    assert columns[1] == set(C.INTENTS)
    assert columns[2] == {*C.INTENTS, None}
    assert columns[3] == {"none", "low", "medium", "high"}
    assert True in columns[4]


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def contacts(spark):
    """Straight from the scan, as a large input would be read."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return contacts_from_documents(documents)


def test_row_wise_stages_do_not_shuffle(contacts):
    plan = plan_of(classify.classify_with_confidence(clean.preprocess(contacts)))
    assert "Exchange" not in plan and "Python" not in plan
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", plan)


def test_costly_columns_are_computed_once(contacts):
    """83 rules read the folded text; it must not be inlined into each."""
    plan = plan_of(classify.classify_with_confidence(clean.preprocess(contacts)))
    assert len(re.findall(r"array_intersect\(split\(", plan)) == 1
    assert len(re.findall(r"CASE WHEN \(channel#\d+ = phone\)", plan)) == 1


def test_reports_shuffle_partial_counts_only(spark, contacts):
    found = classify.classify_with_confidence(clean.preprocess(contacts))
    plan = plan_of(found.groupBy("channel").agg(F.count_if(F.col("predicted_intent").isNull())))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_rows_are_dealt_out_only_where_splits_are_few(spark, tmp_path):
    assert "RoundRobin" in plan_of(entry.read_demo_contacts(spark, SF))
    documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(16)
    documents.write.option("maxRecordsPerFile", 5).parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    try:
        plan = plan_of(entry.queries()["classify_confidence"](spark, str(tmp_path)))
        assert "Exchange" not in plan and "Python" not in plan
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_topic_queries_count_every_contact(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, column in (("topic_info", "n"), ("topic_crosstab", "n")):
        assert entry.queries()[name](spark, SF).agg(F.sum(column)).first()[0] == n
    assert entry.queries()["topic_assignments"](spark, SF).count() == n
    dense = entry.queries()["topic_crosstab_dense"](spark, SF)
    assert sum(sum(r[1:]) for r in dense.collect()) == n
    assert dense.agg(F.sum("unknown")).first()[0] > 0
