"""All eight portfolio analyses over one filtered table.

One scan gives all of them: every filtered row goes to its group of each analysis (``GROUPING
SETS``), and each partition adds up its own map from (analysis, keys) to counts and sums before
anything is shuffled, so that what leaves a partition is bounded by the categories. The quintile is
an expression over literal boundaries, which are found beforehand by counting over the two key
columns (``operators.ntile``). Nothing is written.
``grouping_id()`` tells the analyses apart, so a null key is not confused with an unused
one. Output: one row per group of any analysis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions import portfolio as P
from riskspark.operators.filters import NO_FILTERS, PortfolioFilters
from riskspark.operators.ntile import ntile_column
from riskspark.plans.analyses import FAMILY_CHILDREN_MIN_COUNT, INCOME_TYPE_MIN_COUNT

_KEYS = ["AGE_GROUP", "NAME_INCOME_TYPE", "EMPLOYMENT_LENGTH", "ENQUIRY_GROUP",
         "NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY", "NAME_FAMILY_STATUS", "CNT_CHILDREN",
         "WEEKDAY_APPR_PROCESS_START", "RATIO_CATEGORY"]

# analysis number -> (its key columns, avg column or None, having limit or None)
_SETS = {
    1: (["AGE_GROUP"], None, None),
    2: (["RATIO_CATEGORY"], "RATIO", None),
    3: (["NAME_INCOME_TYPE"], "AMT_INCOME_TOTAL", INCOME_TYPE_MIN_COUNT),
    4: (["EMPLOYMENT_LENGTH"], None, None),
    5: (["ENQUIRY_GROUP"], None, None),
    6: (["NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY"], "AMT_CREDIT", None),
    7: (["NAME_FAMILY_STATUS", "CNT_CHILDREN"], None, FAMILY_CHILDREN_MIN_COUNT),
    8: (["WEEKDAY_APPR_PROCESS_START"], "AMT_CREDIT", None),
}


def _gid(keys: list[str]) -> int:
    """``grouping_id()`` of a set: bit i (from the left, MSB first) is 1 when key i is absent."""
    n = len(_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_KEYS) if k not in keys)


def portfolio_report(df: DataFrame, filters: PortfolioFilters | None = None) -> DataFrame:
    """``ANALYSIS int, KEY1 string, KEY2 string, CLIENT_COUNT long, DEFAULT_RATE double, AVG_VALUE double``.

    The quintile's boundaries are found when it is called; the report itself is lazy. An input that is expensive to build
    should be materialized first, as two of its columns are read a few times more."""
    base = (filters or NO_FILTERS).apply(df).withColumn("RATIO", P.credit_income_ratio())
    quintile = ntile_column(base.select("SK_ID_CURR", "RATIO"), "RATIO", "SK_ID_CURR", 5)
    base = base.select(
        P.age_group().alias("AGE_GROUP"),
        "NAME_INCOME_TYPE",
        P.employment_length().alias("EMPLOYMENT_LENGTH"),
        P.enquiry_group().alias("ENQUIRY_GROUP"),
        "NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY", "NAME_FAMILY_STATUS", "CNT_CHILDREN",
        "WEEKDAY_APPR_PROCESS_START", quintile.alias("RATIO_CATEGORY"),
        P.default_flag().alias("_d"), "AMT_INCOME_TOTAL", "AMT_CREDIT", "RATIO",
    )
    sets = [keys for keys, _, _ in _SETS.values()]
    grouped = base.groupingSets(sets, *_KEYS).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("CLIENT_COUNT"),
        F.round(F.avg("_d") * 100, 2).alias("DEFAULT_RATE"),
        *[F.round(F.avg(m), 2 if m == "RATIO" else 0).alias(f"_avg_{m}") for m in ("AMT_INCOME_TOTAL", "AMT_CREDIT", "RATIO")],
    )
    analysis = None
    key1 = key2 = avg = keep = None
    for number, (keys, avg_col, having) in _SETS.items():
        hit = F.col("_gid") == _gid(keys)
        analysis = F.when(hit, F.lit(number)) if analysis is None else analysis.when(hit, F.lit(number))
        k1 = F.col(keys[0]).cast("string")
        if number == 6:
            k2 = P.ownership_label(F.col(keys[1]))
        elif len(keys) > 1:
            k2 = F.col(keys[1]).cast("string")
        else:
            k2 = F.lit(None).cast("string")
        a = F.col(f"_avg_{avg_col}") if avg_col else F.lit(None).cast("double")
        ok = F.col("CLIENT_COUNT") > having if having is not None else F.lit(True)
        key1 = F.when(hit, k1) if key1 is None else key1.when(hit, k1)
        key2 = F.when(hit, k2) if key2 is None else key2.when(hit, k2)
        avg = F.when(hit, a) if avg is None else avg.when(hit, a)
        keep = F.when(hit, ok) if keep is None else keep.when(hit, ok)
    return grouped.filter(keep).select(
        analysis.cast("int").alias("ANALYSIS"), key1.alias("KEY1"), key2.alias("KEY2"),
        "CLIENT_COUNT", "DEFAULT_RATE", avg.alias("AVG_VALUE"),
    )
