"""The eight portfolio analyses (G1-G8) and the option/KPI queries.

Each analysis is ``(application, filters) -> DataFrame``: filter, derive the
group key, one hash aggregate (partial on the map side, final after one
shuffle of at most a few dozen groups per partition). Results stay lazy
DataFrames; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions import portfolio as P
from riskspark.operators.filters import NO_FILTERS, PortfolioFilters
from riskspark.operators.ntile import ntile_summary

# HAVING limits of G3 and G7.
INCOME_TYPE_MIN_COUNT = 100
FAMILY_CHILDREN_MIN_COUNT = 50


def _filtered(df: DataFrame, filters: PortfolioFilters | None) -> DataFrame:
    return (filters or NO_FILTERS).apply(df)


def by_age(df: DataFrame, filters: PortfolioFilters | None = None, null_label: str | None = None) -> DataFrame:
    """G1: clients and default rate per age group.

    A null birth date counts in the oldest group, as in the reference;
    ``null_label`` gives it a group of its own instead.
    """
    return (
        _filtered(df, filters)
        .groupBy(P.age_group(null_label=null_label).alias("AGE_GROUP"))
        .agg(P.client_count().alias("CLIENT_COUNT"), P.default_rate().alias("DEFAULT_RATE"))
    )


def by_credit_income_quintile(df: DataFrame, filters: PortfolioFilters | None = None,
                              buckets: int = 5) -> DataFrame:
    """``ntile(5)`` over the credit/income ratio, then count, mean ratio, rate.

    The quintile needs no single-partition window (see ``operators.ntile``); its
    boundaries are found when this is called.
    """
    base = _filtered(df, filters).select(
        "SK_ID_CURR", P.credit_income_ratio().alias("CREDIT_INCOME_RATIO"),
        P.default_flag().alias("_d"),
    )
    return ntile_summary(
        base, value="CREDIT_INCOME_RATIO", tie="SK_ID_CURR", buckets=buckets,
        bucket_col="RATIO_CATEGORY", flag="_d",
    )


def by_income_type(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Per income type, groups with more than 100 clients (F8)."""
    return (
        _filtered(df, filters)
        .groupBy("NAME_INCOME_TYPE")
        .agg(P.client_count().alias("CLIENT_COUNT"),
             P.rounded_mean("AMT_INCOME_TOTAL", 0).alias("AVG_INCOME"),
             P.default_rate().alias("DEFAULT_RATE"))
        .filter(F.col("CLIENT_COUNT") > INCOME_TYPE_MIN_COUNT)
    )


def by_employment_length(df: DataFrame, filters: PortfolioFilters | None = None,
                         null_label: str | None = None) -> DataFrame:
    """Per seniority group, ordered by the label text (O1).

    A null employment counts as ``> 10 ans``, as in the reference;
    ``null_label`` gives it a group of its own instead.
    """
    return (
        _filtered(df, filters)
        .groupBy(P.employment_length(null_label=null_label).alias("EMPLOYMENT_LENGTH"))
        .agg(P.client_count().alias("CLIENT_COUNT"), P.default_rate().alias("DEFAULT_RATE"))
        .orderBy("EMPLOYMENT_LENGTH")
    )


def by_enquiries(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Per bureau enquiry group."""
    return (
        _filtered(df, filters)
        .groupBy(P.enquiry_group().alias("ENQUIRY_GROUP"))
        .agg(P.client_count().alias("CLIENT_COUNT"), P.default_rate().alias("DEFAULT_RATE"))
    )


def by_contract_and_realty(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Per contract type x ownership; the ownership code is labelled after the aggregate."""
    agg = (
        _filtered(df, filters)
        .groupBy("NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY")
        .agg(P.client_count().alias("CLIENT_COUNT"),
             P.rounded_mean("AMT_CREDIT", 0).alias("AVG_CREDIT"),
             P.default_rate().alias("DEFAULT_RATE"))
    )
    return agg.select("NAME_CONTRACT_TYPE", P.ownership_label().alias("FLAG_OWN_REALTY"),
                      "CLIENT_COUNT", "AVG_CREDIT", "DEFAULT_RATE")


def by_family_and_children(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Per family status x children, groups with more than 50 clients."""
    return (
        _filtered(df, filters)
        .groupBy("NAME_FAMILY_STATUS", "CNT_CHILDREN")
        .agg(P.client_count().alias("CLIENT_COUNT"), P.default_rate().alias("DEFAULT_RATE"))
        .filter(F.col("CLIENT_COUNT") > FAMILY_CHILDREN_MIN_COUNT)
    )


def by_weekday(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Per application weekday, in week order."""
    return (
        _filtered(df, filters)
        .groupBy("WEEKDAY_APPR_PROCESS_START")
        .agg(P.client_count().alias("APPLICATION_COUNT"),
             P.default_rate().alias("DEFAULT_RATE"),
             P.rounded_mean("AMT_CREDIT", 0).alias("AVG_CREDIT"))
        .withColumn("WEEKDAY_ORDER", P.weekday_order())
        .orderBy(F.asc_nulls_last("WEEKDAY_ORDER"))
    )


ANALYSES = {
    1: by_age,
    2: by_credit_income_quintile,
    3: by_income_type,
    4: by_employment_length,
    5: by_enquiries,
    6: by_contract_and_realty,
    7: by_family_and_children,
    8: by_weekday,
}


def analysis(df: DataFrame, number: int, filters: PortfolioFilters | None = None) -> DataFrame:
    """Analysis by number 1..8; an unknown number is an error, not an empty result."""
    try:
        fn = ANALYSES[number]
    except KeyError:
        raise ValueError(f"unknown analysis {number}; expected 1..8") from None
    return fn(df, filters)


def analysis_from_params(df: DataFrame, params) -> DataFrame:
    """``analysis_type`` (default 1) and the filter parameters of a request, as text."""
    try:
        number = int(params.get("analysis_type") or 1)
    except ValueError:  # not a number: the default
        number = 1
    return analysis(df, number, PortfolioFilters.from_params(params))


def filter_options(df: DataFrame) -> DataFrame:
    """Sorted distinct family statuses and income types, one pass, nulls dropped.

    ``collect_set`` aggregates partially on each partition, so the final
    one-row step only merges sets of distinct values (bounded by the number
    of categories), never the rows.
    """
    return df.agg(
        F.sort_array(F.collect_set("NAME_FAMILY_STATUS")).alias("family_status_options"),
        F.sort_array(F.collect_set("NAME_INCOME_TYPE")).alias("income_type_options"),
    )


def family_children_matrix(g7: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Default rate per children (rows) x family status (columns), from G7.

    ``statuses``: the non-null statuses (from G10); without it they are read from
    ``g7`` (one small job). A null status has the column ``Unknown``, or, where that is
    a status too, ``Unknown (null)``, and so on until the name is free. G7 has one row
    for each pair, so no rate is lost; a status that is not among ``statuses`` is refused
    when its row is met.
    """
    if statuses is None:
        statuses = [r[0] for r in g7.select("NAME_FAMILY_STATUS").where(F.col("NAME_FAMILY_STATUS").isNotNull()).distinct().collect()]
    null_name = "Unknown"
    while null_name in statuses:
        null_name += " (null)"
    status = F.col("NAME_FAMILY_STATUS")
    known = status.isNull() | status.isin(list(statuses))
    src = g7.select("CNT_CHILDREN", "DEFAULT_RATE",
                    F.when(known, F.coalesce(status, F.lit(null_name)))
                    .otherwise(F.raise_error(F.concat(F.lit("status without a column: "), status))).alias("NAME_FAMILY_STATUS"))
    return src.groupBy("CNT_CHILDREN").pivot("NAME_FAMILY_STATUS", sorted([*statuses, null_name])).agg(F.max("DEFAULT_RATE"))


def portfolio_kpis(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """Key figures of the filtered portfolio in one aggregate."""
    return _filtered(df, filters).agg(
        P.client_count().alias("CLIENT_COUNT"),
        P.default_rate().alias("DEFAULT_RATE"),
        P.rounded_mean("AMT_CREDIT", 0).alias("AVG_CREDIT"),
        P.rounded_mean("AMT_INCOME_TOTAL", 0).alias("AVG_INCOME"),
        F.round(F.sum("AMT_CREDIT"), 0).alias("TOTAL_CREDIT"),
    )
