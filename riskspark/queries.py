"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the survey.

Every query reads the driver's tables of ``sf_dir`` (through the derived
``application``, ``users_data`` or feedback tables) over their whole extent.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions import client as C
from riskspark.functions import portfolio as P
from riskspark.operators.filters import PortfolioFilters, lookup_ids, missing_ids
from riskspark.operators.ntile import ntile
from riskspark.operators.preprocess import preprocess, profile_projection
from riskspark.operators.profile import client_card, missing_cards, unified_profiles
from riskspark.plans import analyses as G
from riskspark.plans.newton import gradient
from riskspark.plans.parameters import RiskParameters, feature_rows, published
from riskspark.plans.report import portfolio_report
from riskspark.plans.scoring import (classify, first_per_key, fit, fit_pipeline, flatten_response, nested_response, prepare,
                                     risk_score, score, score_clients)
from riskspark.schema import CATEGORICAL_COLS, FLAG_COLS, NUMERIC_COLS
from riskspark.session import scratch_path
from riskspark.sources.cache import export, materialize
from riskspark.sources.fixtures import application, feedback_from_events, users_data
from riskspark.sources.tables import read_application, read_table, write_application
from riskspark.streaming.feedback import (feedback_records, parse_requests, rejected_requests, request_bodies,
                                         read_outcomes, run_feedback_stream, start_outcome_stream, start_request_stream)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# --- G: the eight analyses -------------------------------------------------

@query("g1_age")
def g1_age(spark, sf_dir):
    return G.by_age(application(spark, sf_dir))


@query("g2_credit_income")
def g2_credit_income(spark, sf_dir):
    return G.by_credit_income_quintile(application(spark, sf_dir))


@query("g3_income_type")
def g3_income_type(spark, sf_dir):
    return G.by_income_type(application(spark, sf_dir))


@query("g4_employment")
def g4_employment(spark, sf_dir):
    return G.by_employment_length(application(spark, sf_dir))


@query("g5_enquiries")
def g5_enquiries(spark, sf_dir):
    return G.by_enquiries(application(spark, sf_dir))


@query("g6_contract_realty")
def g6_contract_realty(spark, sf_dir):
    return G.by_contract_and_realty(application(spark, sf_dir))


@query("g7_family_children")
def g7_family_children(spark, sf_dir):
    return G.by_family_and_children(application(spark, sf_dir))


@query("g8_weekday")
def g8_weekday(spark, sf_dir):
    return G.by_weekday(application(spark, sf_dir))


def _ratio_table(spark, sf_dir):
    return application(spark, sf_dir).select(
        "SK_ID_CURR", P.credit_income_ratio().alias("CREDIT_INCOME_RATIO"))


@query("w1_ntile")
def w1_ntile(spark, sf_dir):
    return ntile(_ratio_table(spark, sf_dir), "CREDIT_INCOME_RATIO", "SK_ID_CURR", 5, "RATIO_CATEGORY")


@query("w1_ntile_distributed")
def w1_ntile_distributed(spark, sf_dir):
    """W1 over a materialized input, which is built once and read twice."""
    ratios = materialize(_ratio_table(spark, sf_dir), "ratios")
    return ntile(ratios, "CREDIT_INCOME_RATIO", "SK_ID_CURR", 5, "RATIO_CATEGORY")


@query("g2_credit_income_distributed")
def g2_credit_income_distributed(spark, sf_dir):
    """G2 over a materialized input."""
    return G.by_credit_income_quintile(materialize(application(spark, sf_dir), "application"))


# --- G9-G12 -----------------------------------------------------------------

@query("g9_portfolio_report")
def g9_portfolio_report(spark, sf_dir):
    return portfolio_report(application(spark, sf_dir))


@query("g10_filter_options")
def g10_filter_options(spark, sf_dir):
    return G.filter_options(application(spark, sf_dir))


@query("g11_heatmap")
def g11_heatmap(spark, sf_dir):
    apps = application(spark, sf_dir)
    options = G.filter_options(apps).first().family_status_options
    return G.family_children_matrix(G.by_family_and_children(apps), statuses=options)


@query("g12_kpis")
def g12_kpis(spark, sf_dir):
    return G.portfolio_kpis(application(spark, sf_dir))


# --- A: aggregate building blocks ------------------------------------------

@query("a1_count")
def a1_count(spark, sf_dir):
    return application(spark, sf_dir).groupBy("NAME_HOUSING_TYPE").agg(P.client_count().alias("CLIENT_COUNT"))


@query("a2_default_rate")
def a2_default_rate(spark, sf_dir):
    return application(spark, sf_dir).groupBy("CODE_GENDER").agg(P.default_rate().alias("DEFAULT_RATE"))


@query("a3_rounded_mean")
def a3_rounded_mean(spark, sf_dir):
    return application(spark, sf_dir).groupBy("NAME_EDUCATION_TYPE").agg(
        P.rounded_mean("AMT_ANNUITY", 0).alias("AVG_ANNUITY"),
        P.rounded_mean("EXT_SOURCE_2", 2).alias("AVG_EXT_SOURCE_2"))


# --- F: filters (each under G1 unless stated) ------------------------------

FILTER_CASES = {
    "f1_min_credit": PortfolioFilters(min_credit=100000.0),
    "f2_max_credit": PortfolioFilters(max_credit=250000.0),
    "f3_min_income": PortfolioFilters(min_income=30000.0),
    "f4_family_status": PortfolioFilters(family_statuses=["Married", "Widow"]),
    "f5_income_type": PortfolioFilters(income_types=["Working", "Pensioner", "Student"]),
    "f6_realty_yes": PortfolioFilters(realty_status="Oui"),
    "f6_realty_no": PortfolioFilters(realty_status="Non"),
}


def _g1_under(filters):
    return lambda spark, sf_dir: G.by_age(application(spark, sf_dir), filters)


for _name, _filters in FILTER_CASES.items():
    QUERIES[_name] = _g1_under(_filters)

ALL_FILTERS = PortfolioFilters(min_credit=50000.0, max_credit=400000.0, min_income=10000.0,
                               family_statuses=["Married", "Single / not married", "Civil marriage"],
                               income_types=["Working", "Commercial associate", "Pensioner"],
                               realty_status="Oui")


@query("f7_all_filters")
def f7_all_filters(spark, sf_dir):
    return G.by_enquiries(application(spark, sf_dir), ALL_FILTERS)


@query("f8_having_income_type")
def f8_having_income_type(spark, sf_dir):
    return G.by_income_type(application(spark, sf_dir), PortfolioFilters(min_income=30000.0))


@query("f9_having_family_children")
def f9_having_family_children(spark, sf_dir):
    return G.by_family_and_children(application(spark, sf_dir), PortfolioFilters(max_credit=250000.0))


def requested_ids(spark, sf_dir) -> DataFrame:
    """A batch of requested client ids derived from ``lineitem`` (ten times each part key):
    roughly a quarter of them are not application ids at any scale factor."""
    return read_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 10).alias("SK_ID_CURR"))


@query("f10_lookup")
def f10_lookup(spark, sf_dir):
    return lookup_ids(application(spark, sf_dir), requested_ids(spark, sf_dir)).select(
        "SK_ID_CURR", "AMT_CREDIT", "NAME_INCOME_TYPE")


@query("f11_non_null_options")
def f11_non_null_options(spark, sf_dir):
    return G.filter_options(application(spark, sf_dir)).select(F.explode("family_status_options").alias("NAME_FAMILY_STATUS"))


@query("f12_missing_client")
def f12_missing_client(spark, sf_dir):
    return missing_ids(requested_ids(spark, sf_dir), application(spark, sf_dir))


# --- P: scalar functions (id + computed column over the whole table) -------

def _scalar(expr_fn, name):
    return lambda spark, sf_dir: application(spark, sf_dir).select("SK_ID_CURR", expr_fn().alias(name))


for _key, _fn, _col in [
    ("p1_age", P.age_years, "AGE"),
    ("p2_age_group", P.age_group, "AGE_GROUP"),
    ("p3_ratio", P.credit_income_ratio, "CREDIT_INCOME_RATIO"),
    ("p4_years_employed", P.years_employed, "YEARS_EMPLOYED"),
    ("p5_employment_length", P.employment_length, "EMPLOYMENT_LENGTH"),
    ("p6_total_enquiries", P.total_enquiries, "TOTAL_ENQUIRIES"),
    ("p7_enquiry_group", P.enquiry_group, "ENQUIRY_GROUP"),
    ("p8_ownership_label", P.ownership_label, "OWNERSHIP_LABEL"),
    ("p9_weekday_order", P.weekday_order, "WEEKDAY_ORDER"),
    ("p10_default_flag", P.default_flag, "DEFAULT_FLAG"),
]:
    QUERIES[_key] = _scalar(_fn, _col)


@query("p11_rounding")
def p11_rounding(spark, sf_dir):
    return application(spark, sf_dir).select(
        "SK_ID_CURR", F.round("AMT_ANNUITY", 0).alias("ROUND0"),
        F.round(F.col("EXT_SOURCE_2") * 100, 2).alias("ROUND2"))


# --- P12-P28: scoring preprocessing and client response ---------------------

@query("p12_numeric_repair")
def p12_numeric_repair(spark, sf_dir):
    return preprocess(application(spark, sf_dir)).select("SK_ID_CURR", *NUMERIC_COLS)


@query("p13_categorical_repair")
def p13_categorical_repair(spark, sf_dir):
    return preprocess(application(spark, sf_dir)).select("SK_ID_CURR", *CATEGORICAL_COLS)


@query("p14_flag_encoding")
def p14_flag_encoding(spark, sf_dir):
    return preprocess(application(spark, sf_dir)).select("SK_ID_CURR", *FLAG_COLS)


def _client_info(spark, sf_dir) -> DataFrame:
    """P18 ``client_info`` over the preprocessed table (no model needed)."""
    return preprocess(application(spark, sf_dir)).select(
        F.col("SK_ID_CURR").alias("client_id"), C.client_info().alias("client_info"))


@query("p16_client_age")
def p16_client_age(spark, sf_dir):
    return application(spark, sf_dir).select("SK_ID_CURR", C.client_age().alias("CLIENT_AGE"))


@query("p17_client_years_employed")
def p17_client_years_employed(spark, sf_dir):
    return application(spark, sf_dir).select("SK_ID_CURR", C.client_years_employed().alias("YEARS_EMPLOYED"))


@query("p18_nested_response")
def p18_nested_response(spark, sf_dir):
    return nested_response(scored_by_source(spark, sf_dir)).select("client_id", "client_info.*", "prediction.*")


@query("p19_years_display")
def p19_years_display(spark, sf_dir):
    return _client_info(spark, sf_dir).select(
        "client_id", C.years_employed_display(F.col("client_info.years_employed")).alias("years_employed"))


@query("p20_amounts")
def p20_amounts(spark, sf_dir):
    return _client_info(spark, sf_dir).select(
        "client_id", F.col("client_info.age").cast("int").alias("age"),
        C.whole_amount(F.col("client_info.income")).alias("income"),
        C.whole_amount(F.col("client_info.credit_amount")).alias("credit_amount"))


@query("p21_labels")
def p21_labels(spark, sf_dir):
    return _client_info(spark, sf_dir).select(
        "client_id", C.formatted_client_info("client_info").alias("i")).select(
        "client_id", "i.gender", "i.income_type", "i.education_type", "i.family_status", "i.housing_type")


# P22, P24, P25 take a score in [0, 1); the model-free queries use EXT_SOURCE_2 as that score
# so they can be checked against SQL. m5_batch_score applies them to model scores.
@query("p22_recommendation")
def p22_recommendation(spark, sf_dir):
    return application(spark, sf_dir).select(
        "SK_ID_CURR", C.recommendation(F.col("EXT_SOURCE_2")).alias("r")).select("SK_ID_CURR", "r.*")


@query("p23_feedback_defaults")
def p23_feedback_defaults(spark, sf_dir):
    return _feedback_columns(feedback_records(feedback_from_events(read_table(spark, sf_dir, "events"))))


def _feedback_columns(records: DataFrame) -> DataFrame:
    return records.select(
        "event_id", "message", "is_positive", "level",
        F.col("custom_dimensions").getItem("k").alias("dim_k"),
        F.size("custom_dimensions").alias("n_dims"))


@query("p24_risk_level")
def p24_risk_level(spark, sf_dir):
    return application(spark, sf_dir).select("SK_ID_CURR", C.risk_tag(F.col("EXT_SOURCE_2")).alias("RISK_TAG"))


@query("p25_score_percent")
def p25_score_percent(spark, sf_dir):
    return application(spark, sf_dir).select(
        "SK_ID_CURR", C.score_percent_text(F.col("EXT_SOURCE_2")).alias("SCORE_TEXT"))


@query("p26_display_ratio")
def p26_display_ratio(spark, sf_dir):
    info = _client_info(spark, sf_dir).select(
        "client_id", C.formatted_client_info("client_info").alias("i"))
    return info.select("client_id", C.displayed_ratio("i.credit_amount", "i.income").alias("RATIO"))


@query("p27_stamps")
def p27_stamps(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SK_ID_CURR"), C.result_stamps(F.col("o_orderdate")).alias("m")) \
        .select("SK_ID_CURR", "m.*")


@query("p28_amount_label")
def p28_amount_label(spark, sf_dir):
    return application(spark, sf_dir).select(
        "SK_ID_CURR", C.amount_label(C.whole_amount("AMT_CREDIT")).alias("AMOUNT_LABEL"))


# --- O: orderings -------------------------------------------------------------

@query("o1_label_order")
def o1_label_order(spark, sf_dir):
    return G.by_employment_length(application(spark, sf_dir), PortfolioFilters(realty_status="Oui"))


@query("o2_weekday_order")
def o2_weekday_order(spark, sf_dir):
    return G.by_weekday(application(spark, sf_dir), PortfolioFilters(min_credit=100000.0))


@query("o3_sorted_options")
def o3_sorted_options(spark, sf_dir):
    return G.filter_options(PortfolioFilters(max_credit=250000.0).apply(application(spark, sf_dir)))


@query("o4_first_row")
def o4_first_row(spark, sf_dir):
    apps = application(spark, sf_dir).select("CUST_ID", "SK_ID_CURR", "AMT_CREDIT", "NAME_CONTRACT_TYPE")
    return first_per_key(apps, "CUST_ID", "SK_ID_CURR")


# --- S: sources and sinks ----------------------------------------------------

@query("s1_read_portfolio")
def s1_read_portfolio(spark, sf_dir):
    path = scratch_path(spark, "portfolio-csv")
    write_application(application(spark, sf_dir), path)
    return read_application(spark, path, with_target=True)


@query("s2_read_scoring")
def s2_read_scoring(spark, sf_dir):
    path = scratch_path(spark, "scoring-csv")
    write_application(application(spark, sf_dir).drop("TARGET"), path)
    return read_application(spark, path, with_target=False)


@query("s3_keep_hot")
def s3_keep_hot(spark, sf_dir):
    hot = materialize(application(spark, sf_dir), "application",
                      ["SK_ID_CURR", "TARGET", "DAYS_EMPLOYED", "AMT_CREDIT", "FLAG_OWN_REALTY"])
    return G.by_employment_length(hot)


@query("s6_profiles")
def s6_profiles(spark, sf_dir):
    return unified_profiles(users_data(spark, sf_dir))


@query("s7_feedback_stream")
def s7_feedback_stream(spark, sf_dir):
    base = scratch_path(spark, "feedback")
    sink = run_feedback_stream(spark, sf_dir, f"{base}/sink", f"{base}/checkpoint", pattern="events.parquet")
    return _feedback_columns(sink)


@query("s8_export")
def s8_export(spark, sf_dir):
    result = G.by_contract_and_realty(application(spark, sf_dir))
    path = export(result, scratch_path(spark, "g6-json"), "json")
    return spark.read.schema(result.schema).json(path)


# --- J: client card -----------------------------------------------------------

@query("j1_client_card")
def j1_client_card(spark, sf_dir):
    apps = application(spark, sf_dir).select("SK_ID_CURR", "CUST_ID")
    return client_card(apps, users_data(spark, sf_dir))


@query("j2_missing_card")
def j2_missing_card(spark, sf_dir):
    apps = application(spark, sf_dir).select("SK_ID_CURR", "CUST_ID")
    return missing_cards(apps, users_data(spark, sf_dir))


# --- M: model fit and batch scoring --------------------------------------------

_MODELS: dict[tuple, object] = {}


def _once(spark, sf_dir, how):
    """A model that is fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, how)
    if key not in _MODELS:
        _MODELS[key] = how(application(spark, sf_dir))
    return _MODELS[key]


def scoring_table(spark, sf_dir) -> DataFrame:
    return application(spark, sf_dir).drop("TARGET")


@query("m6_fit")
def m6_fit(spark, sf_dir):
    """The slot dictionary of the model fitted on the whole table."""
    return _once(spark, sf_dir, fit).slot_table(spark)


@query("m6_fit_gradient")
def m6_fit_gradient(spark, sf_dir):
    """The slope of the fit's objective in every slot (0 at its optimum), worked out again from the table."""
    model = _once(spark, sf_dir, fit)
    slopes = gradient(application(spark, sf_dir), model).join(F.broadcast(model.slot_table(spark)), "slot", "right")
    return slopes.select("column", "label", (F.round(F.coalesce("gradient", F.lit(0.0)), 6) + 0.0).alias("gradient"))


@query("m1_prepare")
def m1_prepare(spark, sf_dir):
    """The sparse features of every application under the published model."""
    return feature_rows(preprocess(scoring_table(spark, sf_dir)), published())


@query("m2_classify")
def m2_classify(spark, sf_dir):
    p = F.col("probability")
    return classify(prepare(scoring_table(spark, sf_dir), published()), published()).select(
        "SK_ID_CURR", "prediction", F.round(p[0], 9).alias("probability_0"), F.round(p[1], 9).alias("probability_1"))


@query("m3_risk_score")
def m3_risk_score(spark, sf_dir):
    return _rounded(score(scoring_table(spark, sf_dir), published())).select("SK_ID_CURR", "risk_score", "prediction")


def _rounded(scored: DataFrame) -> DataFrame:
    """Scores at 9 decimals: the last bits of ``exp`` are not the same in every engine."""
    return scored.withColumn("risk_score", F.round("risk_score", 9))


def scored_by_source(spark, sf_dir) -> DataFrame:
    """Preprocessed applications with a prediction and a score that SQL can state: EXT_SOURCE_2, cut at one half."""
    return preprocess(scoring_table(spark, sf_dir)).withColumns({
        "prediction": F.when(F.col("EXT_SOURCE_2") > 0.5, 1.0).otherwise(0.0), "risk_score": F.col("EXT_SOURCE_2")})


@query("m4_fallback_score")
def m4_fallback_score(spark, sf_dir):
    """The score of a classifier that gives predictions without probabilities."""
    no_prob = scored_by_source(spark, sf_dir)
    return no_prob.select("SK_ID_CURR", "prediction", risk_score(no_prob).alias("risk_score"))


@query("m4_fallback_model")
def m4_fallback_model(spark, sf_dir):
    no_prob = classify(prepare(scoring_table(spark, sf_dir), published()), published()).drop("probability")
    return no_prob.select("SK_ID_CURR", "prediction", risk_score(no_prob).alias("risk_score"))


@query("m6_fitted_statistics")
def m6_fitted_statistics(spark, sf_dir):
    """What the fit has learned of the columns: the mean and the spread of each number, the rank of each label."""
    model = _once(spark, sf_dir, fit)
    rows = [("mean", n.column, None, n.fill) for n in model.numbers] + [("rank", c.column, label, float(i)) for c in model.categories for i, label in enumerate(c.labels)]
    rows += [("spread", n.column, None, 1 / n.scale if n.scale else 0.0) for n in model.numbers]
    return spark.createDataFrame(rows, "kind string, column string, label string, value double").withColumn(
        "value", F.when(F.col("kind") == "spread", F.round("value", 4)).otherwise(F.round("value", 6)))


@query("p12_numeric_repair_text")
def p12_numeric_repair_text(spark, sf_dir):
    """P12 over text: numbers, other text, and nothing."""
    forms = F.array(F.col("AMT_CREDIT").cast("long").cast("string"), F.lit("n/a"), F.lit(""), F.lit("-1.5e2"), F.lit(None).cast("string"))
    text = application(spark, sf_dir).select("SK_ID_CURR", F.get(forms, (F.col("SK_ID_CURR") % 5).cast("int")).alias("AMT_CREDIT"))
    return preprocess(text)


#: The time that the scored responses are stamped with, so that they can be compared.
STAMPED_AT = "2024-01-15 10:30:00"


def _responses(spark, sf_dir, **more) -> DataFrame:
    return _rounded(flatten_response(score_clients(scoring_table(spark, sf_dir), published(), at=F.lit(STAMPED_AT).cast("timestamp_ntz"), **more)))


@query("m5_batch_score")
def m5_batch_score(spark, sf_dir):
    return _responses(spark, sf_dir)


@query("m5_client_card")
def m5_client_card(spark, sf_dir):
    """M5 then J1: scored clients that also have a personal profile (the page's full card)."""
    return client_card(_responses(spark, sf_dir, carry=["CUST_ID"]), users_data(spark, sf_dir))


def _reloaded(spark) -> RiskParameters:
    """The published model, written to the shared folder and read back."""
    path = scratch_path(spark, "risk-parameters")
    published().save(path, spark)
    return RiskParameters.load(path, spark)


@query("s4_load_preprocessor")
def s4_load_preprocessor(spark, sf_dir):
    """The sparse features that a loaded model gives."""
    return feature_rows(preprocess(scoring_table(spark, sf_dir)), _reloaded(spark))


@query("s5_load_classifier")
def s5_load_classifier(spark, sf_dir):
    return _rounded(score(scoring_table(spark, sf_dir), _reloaded(spark))).select("SK_ID_CURR", "risk_score")


@query("p15_profile_projection")
def p15_profile_projection(spark, sf_dir):
    return profile_projection(scored_by_source(spark, sf_dir))


@query("s7_feedback_json_stream")
def s7_feedback_json_stream(spark, sf_dir):
    """S7 over JSON request bodies derived from ``events`` (written as text, then streamed)."""
    base = scratch_path(spark, "feedback-json")
    bodies = request_bodies(feedback_from_events(read_table(spark, sf_dir, "events")), carry=["event_id"])
    bodies.write.mode("overwrite").text(f"{base}/bodies")
    q = start_request_stream(spark, f"{base}/bodies", f"{base}/sink", f"{base}/checkpoint", extra="event_id long")
    q.awaitTermination()
    return _feedback_columns(spark.read.parquet(f"{base}/sink"))


@query("j1_client_card_salted")
def j1_client_card_salted(spark, sf_dir):
    """J1 with explicit hot-key salting (keys above 1% of the clients; the default)."""
    apps = application(spark, sf_dir).select("SK_ID_CURR", "CUST_ID")
    return client_card(apps, users_data(spark, sf_dir), salt_hot_keys=True)


@query("j1_client_card_plain")
def j1_client_card_plain(spark, sf_dir):
    """J1 as a plain equi-join (no hot-key salting), for comparison with the default."""
    apps = application(spark, sf_dir).select("SK_ID_CURR", "CUST_ID")
    return client_card(apps, users_data(spark, sf_dir), salt_hot_keys=False)


@query("m3_risk_score_pipeline")
def m3_risk_score_pipeline(spark, sf_dir):
    """M1-M3 with Spark ML's own fit, applying its stages one by one."""
    model = _once(spark, sf_dir, fit_pipeline)
    return score(scoring_table(spark, sf_dir), model, compiled=False).select("SK_ID_CURR", "risk_score", "prediction")


#: One body for each remainder of ``event_id`` by 8; ``@`` is the id.
BODIES = ["{}", "not json", "", '{"is_positive": null}', '{"is_positive": 0, "message": null}',
          '{"is_positive": "no", "message": "m@"}', '{"is_positive": false, "custom_dimensions": {"k": "@"}}', "[1]"]


@query("s7_feedback_outcomes")
def s7_feedback_outcomes(spark, sf_dir):
    """S7 with both outputs from one stream, over bodies of every kind."""
    base = scratch_path(spark, "feedback-outcomes")
    _raw_bodies(spark, sf_dir).select("body").write.text(f"{base}/bodies")
    start_outcome_stream(spark, f"{base}/bodies", f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    good, bad = read_outcomes(spark, f"{base}/sink")
    rows = good.select("message", "is_positive", "level", F.col("custom_dimensions").getItem("k").alias("dim_k"), F.lit(None).cast("string").alias("body"))
    rows = rows.unionByName(bad, allowMissingColumns=True)
    return rows.groupBy("message", "is_positive", "level", "dim_k", "body").agg(F.count(F.lit(1)).alias("bodies"))


def _raw_bodies(spark, sf_dir) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    body = F.get(F.array(*[F.lit(b) for b in BODIES]), (F.col("event_id") % 8).cast("int"))
    return events.select("event_id", F.replace(body, F.lit("@"), F.col("event_id").cast("string")).alias("body"))


@query("p23_feedback_bodies")
def p23_feedback_bodies(spark, sf_dir):
    """P23 over raw bodies: missing keys, nulls, odd types; bodies that are no JSON object come back as rejected."""
    raw = _raw_bodies(spark, sf_dir)
    good = feedback_records(parse_requests(raw), null_is_missing=False).select(
        "event_id", "message", "is_positive", "level", F.col("custom_dimensions").getItem("k").alias("dim_k"), F.lit(False).alias("rejected"))
    none = F.lit(None)
    bad = rejected_requests(raw).select("event_id", none.cast("string").alias("message"), none.cast("boolean").alias("is_positive"),
                                        none.cast("string").alias("level"), none.cast("string").alias("dim_k"), F.lit(True).alias("rejected"))
    return good.unionByName(bad)
