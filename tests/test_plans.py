"""Plan audit of every registered model-free query, and skew handling of the card join."""

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from riskspark.queries import QUERIES
from riskspark.testing.oracles import ORACLE_SQL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
# Global one-row aggregates (final step after partial aggregation) may use a single partition; nothing else may.
SINGLE_PARTITION_OK = {"f11_non_null_options", "g10_filter_options", "g12_kpis", "o3_sorted_options"}


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k in ORACLE_SQL))
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"
    if name not in SINGLE_PARTITION_OK:
        assert "SinglePartition" not in plan, f"{name} moves rows to one partition"


def test_scan_is_pruned_and_filtered(spark):
    from riskspark.operators.filters import PortfolioFilters
    from riskspark.plans.analyses import by_age
    from riskspark.sources.fixtures import application
    plan = by_age(application(spark, SF_SMALL), PortfolioFilters(min_credit=1000.0)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan                      # the unused left join is removed
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in plan   # filter reaches the scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_card_join_with_hot_customer(spark):
    """One customer holds a third of the applications: its rows are salted over many tasks."""
    from riskspark.operators.profile import client_card
    n = 30000
    clients = spark.range(n).select(F.col("id").alias("SK_ID_CURR"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
                                    .alias("CUST_ID"))
    users = spark.range(1000).select(F.col("id").alias("SK_CURR_ID_INT"), F.lit(None).cast("string").alias(
        "SK_CURR_ID_STR"), F.lit("F").alias("FirstName"), F.concat(F.lit("L"), F.col("id").cast("string"))
        .alias("LastName"), F.lit(None).cast("string").alias("PhotoURL"))

    def run():
        card = client_card(clients, users, target_rows=1000)
        tasks = card.where("LastName = 'L7'").select(F.spark_partition_id().alias("p")).distinct().count()
        return card.collect(), tasks

    rows, tasks = _with_conf(spark, SKEW_CONF, run)
    assert len(rows) == n
    assert sum(1 for r in rows if r.LastName == "L7") == n // 3 + sum(
        1 for i in range(n) if i % 3 != 0 and i % 1000 == 7)
    assert tasks > 1                     # the hot key is spread, not on one task


def test_fixture_join_skew_is_split_by_aqe(spark):
    """orders x customers joins two plain shuffles: AQE splits a customer with a third of the orders."""
    from riskspark.sources.fixtures import application_from_tables
    n = 30000
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("long").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("3-MEDIUM").alias("o_orderpriority"))
    customer = spark.range(1000).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), F.col("id").cast("string")).alias("c_name"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit(100.0).alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"))
    lineitem = spark.range(n).select(F.col("id").alias("l_orderkey"), F.lit("A").alias("l_returnflag"),
                                     F.lit("F").alias("l_linestatus"))

    def run():
        app = application_from_tables(orders, customer, lineitem).select("SK_ID_CURR", "CUST_ID")
        rows = app.collect()
        return rows, app._jdf.queryExecution().executedPlan().toString()

    rows, final = _with_conf(spark, SKEW_CONF, run)
    assert len(rows) == n
    assert "skew=true" in final


def test_salted_card_join_equals_plain_join(spark):
    from riskspark.operators.profile import client_card
    from riskspark.operators.skew import hot_keys, salted_join
    n = 20000
    clients = spark.range(n).select(F.col("id").alias("SK_ID_CURR"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
                                    .alias("CUST_ID"))
    users = spark.range(0, 500, 2).select(F.col("id").alias("SK_CURR_ID_INT"),
                                          F.lit(None).cast("string").alias("SK_CURR_ID_STR"),
                                          F.lit("F").alias("FirstName"),
                                          F.concat(F.lit("L"), F.col("id").cast("string")).alias("LastName"),
                                          F.lit(None).cast("string").alias("PhotoURL"))
    assert hot_keys(clients, "CUST_ID") == {}      # none above the default: a plain join
    assert hot_keys(clients, "CUST_ID", 1000) == {7: n // 3 + 1 + sum(1 for i in range(n) if i % 3 and i % 500 == 7)}
    medium = hot_keys(clients, "CUST_ID", 20)      # a key of 0.13 % and one of a third, both exact
    assert medium[7] > 6000 and medium[11] == 27
    plain = sorted(tuple(r) for r in client_card(clients, users, salt_hot_keys=False).collect())
    salted = sorted(tuple(r) for r in client_card(clients, users, target_rows=20).collect())
    assert plain == salted
    from riskspark.operators.profile import missing_cards
    miss_plain = sorted(tuple(r) for r in missing_cards(clients, users, salt_hot_keys=False).collect())
    miss_salted = sorted(tuple(r) for r in missing_cards(clients, users, target_rows=20).collect())
    assert miss_plain == miss_salted and len(miss_plain) > n // 3     # hot key 7 has no profile
    small = users.select(F.col("SK_CURR_ID_INT").alias("k"), "LastName")
    left = salted_join(clients, small, "CUST_ID", "k", "left", target_rows=20)
    assert left.count() == n                       # left rows kept once, hot or not


def test_materialized_layout_prunes(spark):
    from riskspark.operators.filters import PortfolioFilters
    from riskspark.plans.analyses import by_age
    from riskspark.sources.cache import materialize
    from riskspark.sources.fixtures import application
    app = application(spark, SF_SMALL)
    hot = materialize(app, "layout-test", partitions=4, partition_by=["FLAG_OWN_REALTY"],
                      sort_within=["AMT_CREDIT"])
    q = by_age(hot, PortfolioFilters(realty_status="Oui", min_credit=100000.0))
    sizes = sorted(r["count"] for r in hot.groupBy(F.input_file_name()).count().collect())
    assert sizes[-1] <= 2 * hot.count() / 4       # no file of more than twice its share, though one code has most rows
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(FLAG_OWN_REALTY" in plan and "(FLAG_OWN_REALTY#" in plan
    assert "GreaterThanOrEqual(AMT_CREDIT,100000.0)" in plan
    want = {tuple(r) for r in by_age(app, PortfolioFilters(realty_status="Oui", min_credit=100000.0)).collect()}
    assert {tuple(r) for r in q.collect()} == want
