"""Derive the credit data model from the driver's star-schema tables.

The driver's tables hold no credit data, so ``application`` (one row per
order), ``users_data`` (one profile per customer, some duplicated, some
missing) and the feedback events are derived from ``orders``, ``customer``,
``lineitem`` and ``events`` with integer arithmetic only. The derivation plants
the edge cases the analyses must handle: null target, null and zero income,
the employment sentinel, null birth dates, null family status, ownership codes
other than Y/N and groups below the HAVING limits.

Scale: lineitem is aggregated per order (partial aggregation, <= 7 lines per
order) and joined on the order key; orders join customers on the customer key.
Both joins are equi-joins that Spark plans as sort-merge or broadcast joins by
size; a customer holding a large share of orders is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.schema import APPLICATION_COLUMNS, EMPLOYMENT_SENTINEL
from riskspark.sources.tables import read_table


# Family statuses of the derived table, by nation key modulo 6 (5 -> null).
FAMILY_STATUSES = ["Married", "Single / not married", "Civil marriage", "Separated", "Widow"]


def _case(key: Column, values: list, default=None) -> Column:
    """``CASE key WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... ELSE default``."""
    out = None
    for i, v in enumerate(values):
        out = F.when(key == i, F.lit(v)) if out is None else out.when(key == i, F.lit(v))
    return out.otherwise(F.lit(default))


def bureau_enquiries(lineitem: DataFrame) -> DataFrame:
    """Per order: six enquiry counters from return flag x line status (null when none)."""
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    pairs = [("rh", "A", "F"), ("rd", "A", "O"), ("rw", "N", "F"),
             ("rm", "N", "O"), ("rq", "R", "F"), ("ry", "R", "O")]
    return lineitem.groupBy("l_orderkey").agg(*[
        F.sum(F.when((rf == f) & (ls == s), F.lit(1))).cast("double").alias(name)
        for name, f, s in pairs
    ])


def application_from_tables(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The ``application`` table: one row per order, keyed by ``SK_ID_CURR``."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    nk, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    price = F.col("o_totalprice")
    lines = bureau_enquiries(lineitem)

    joined = (
        orders.join(customer, ck == F.col("c_custkey"), "inner")
        .join(lines, ok == F.col("l_orderkey"), "left")
    )
    cols = {
        "SK_ID_CURR": ok,
        "CUST_ID": ck,
        "TARGET": F.when(ok % 97 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).cast("int"),
        "AMT_CREDIT": price,
        "AMT_INCOME_TOTAL": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 12)
        .when(ck % 2 == 0, F.lit(0.0)).otherwise(F.lit(None).cast("double")),
        "NAME_CONTRACT_TYPE": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Revolving loans"))
        .otherwise(F.lit("Cash loans")),
        "FLAG_OWN_REALTY": F.when(ck % 50 == 7, F.lit("X")).when(ck % 3 == 0, F.lit("N")).otherwise(F.lit("Y")),
        "FLAG_OWN_CAR": F.when(ck % 11 == 0, F.lit(None).cast("string"))
        .when(ck % 4 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "CODE_GENDER": F.when(ck % 2 == 0, F.lit("F")).otherwise(F.lit("M")),
        "NAME_INCOME_TYPE": F.when(ok % 500 == 0, F.lit("Student"))
        .when(seg == "BUILDING", F.lit("Working"))
        .when(seg == "AUTOMOBILE", F.lit("Commercial associate"))
        .when(seg == "HOUSEHOLD", F.lit("Pensioner"))
        .when(seg == "MACHINERY", F.lit("State servant"))
        .otherwise(F.lit("Entrepreneur")),
        "NAME_FAMILY_STATUS": _case(nk % 6, FAMILY_STATUSES).cast("string"),
        "NAME_EDUCATION_TYPE": _case(ck % 5, ["Higher education", "Secondary / secondary special",
                                              "Incomplete higher", "Lower secondary"], "Academic degree"),
        "NAME_HOUSING_TYPE": _case(ck % 7, ["House / apartment", "Rented apartment", "With parents",
                                            "Municipal apartment", "Office apartment", "Co-op apartment"],
                                   "Other"),
        "NAME_TYPE_SUITE": F.when(ok % 9 == 0, F.lit(None).cast("string"))
        .when(ok % 2 == 0, F.lit("Family")).otherwise(F.lit("Unaccompanied")),
        "OCCUPATION_TYPE": F.when(ck % 3 == 0, F.lit(None).cast("string"))
        .when(ck % 3 == 1, F.lit("Laborers")).otherwise(F.lit("Managers")),
        "ORGANIZATION_TYPE": F.when(ck % 4 < 2, F.lit("Business Entity")).otherwise(F.lit("Government")),
        "FONDKAPREMONT_MODE": F.when(ck % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("reg oper account")),
        "HOUSETYPE_MODE": F.when(ck % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("block of flats")),
        "WALLSMATERIAL_MODE": F.when(ck % 5 == 0, F.lit(None).cast("string"))
        .when(ck % 2 == 0, F.lit("Panel")).otherwise(F.lit("Stone, brick")),
        "EMERGENCYSTATE_MODE": F.when(ck % 13 == 0, F.lit("Yes")).otherwise(F.lit("No")),
        "CNT_CHILDREN": F.when(ok % 200 == 1, F.lit(5)).when(ok % 10 < 6, F.lit(0))
        .when(ok % 10 < 8, F.lit(1)).when(ok % 10 == 8, F.lit(2)).otherwise(F.lit(3)).cast("int"),
        "DAYS_BIRTH": F.when(ck % 101 == 0, F.lit(None))
        .otherwise(-(F.lit(7305) + (ck * 37) % 18000)).cast("int"),
        "DAYS_EMPLOYED": F.when(ck % 6 == 0, F.lit(EMPLOYMENT_SENTINEL)).when(ck % 103 == 0, F.lit(None))
        .otherwise(-((ok * 13) % 7000)).cast("int"),
        "WEEKDAY_APPR_PROCESS_START": F.upper(F.date_format(F.col("o_orderdate"), "EEEE")),
        "AMT_REQ_CREDIT_BUREAU_HOUR": F.col("rh"),
        "AMT_REQ_CREDIT_BUREAU_DAY": F.col("rd"),
        "AMT_REQ_CREDIT_BUREAU_WEEK": F.col("rw"),
        "AMT_REQ_CREDIT_BUREAU_MON": F.col("rm"),
        "AMT_REQ_CREDIT_BUREAU_QRT": F.col("rq"),
        "AMT_REQ_CREDIT_BUREAU_YEAR": F.col("ry"),
        "AMT_ANNUITY": price / 20,
        "AMT_GOODS_PRICE": F.when(ok % 53 == 0, F.lit(None).cast("double")).otherwise(price * 0.75),
        "REGION_POPULATION_RELATIVE": ((nk * 7) % 64).cast("double") / 1024,
        "DAYS_REGISTRATION": (-((ck * 17) % 9000)).cast("double"),
        "DAYS_ID_PUBLISH": (-((ck * 19) % 6000)).cast("double"),
        "OWN_CAR_AGE": F.when(ck % 4 == 0, ck % 30).cast("double"),
        "CNT_FAM_MEMBERS": (1 + ck % 5).cast("double"),
        "EXT_SOURCE_1": F.when(ok % 2 == 0, F.lit(None)).otherwise((ok * 31) % 1024).cast("double") / 1024,
        "EXT_SOURCE_2": ((ok * 37) % 1024).cast("double") / 1024,
        "EXT_SOURCE_3": F.when(ok % 5 == 0, F.lit(None)).otherwise((ok * 41) % 1024).cast("double") / 1024,
        "OBS_30_CNT_SOCIAL_CIRCLE": (ck % 6).cast("double"),
        "DEF_30_CNT_SOCIAL_CIRCLE": (ck % 3).cast("double"),
        "OBS_60_CNT_SOCIAL_CIRCLE": (ck % 7).cast("double"),
        "DEF_60_CNT_SOCIAL_CIRCLE": (ck % 2).cast("double"),
        "DAYS_LAST_PHONE_CHANGE": (-(ok % 4000)).cast("double"),
    }
    return joined.select(*[cols[c].alias(c) for c in APPLICATION_COLUMNS])


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``application`` derived from ``orders``, ``customer`` and ``lineitem`` of ``sf_dir``."""
    return application_from_tables(
        read_table(spark, sf_dir, "orders"),
        read_table(spark, sf_dir, "customer"),
        read_table(spark, sf_dir, "lineitem"),
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    """Personal profiles (S6 input): mixed-type key as two columns, gaps and duplicates.

    Even customer keys are stored as an integer key, odd ones as text; keys
    ending in 9 have no profile; every 25th key has a second row whose last
    name carries ``-dup``.
    """
    ck = F.col("c_custkey")
    name_parts = F.split(F.col("c_name"), "#", 2)
    last = name_parts.getItem(1)
    return (
        customer.filter(ck % 10 != 9)
        .select(
            F.when(ck % 2 == 0, ck).alias("SK_CURR_ID_INT"),
            F.when(ck % 2 == 1, ck.cast("string")).alias("SK_CURR_ID_STR"),
            name_parts.getItem(0).alias("FirstName"),
            F.explode(
                F.when(ck % 25 == 0, F.array(last, F.concat(last, F.lit("-dup")))).otherwise(F.array(last))
            ).alias("LastName"),
            F.when(ck % 8 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("photos/"), ck.cast("string"), F.lit(".jpg"))).alias("PhotoURL"),
        )
    )


def users_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customer(read_table(spark, sf_dir, "customer"))


def feedback_from_events(events: DataFrame) -> DataFrame:
    """Feedback requests (S7 input) from ``events``: raw, before defaults.

    ``message`` is the event type (null for ``signup``), ``custom_dimensions``
    the ``props`` JSON as a map, ``is_positive`` false for errors, null for views.
    """
    et = F.col("event_type")
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        F.when(et == "signup", F.lit(None).cast("string")).otherwise(et).alias("message"),
        F.from_json(F.col("props"), "map<string,string>").alias("custom_dimensions"),
        F.when(et == "error", F.lit(False)).when(et == "view", F.lit(None).cast("boolean"))
        .otherwise(F.lit(True)).alias("is_positive"),
    )
