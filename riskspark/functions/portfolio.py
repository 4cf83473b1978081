"""Column expressions of the portfolio analyses.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and Catalyst folds the literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.schema import DAYS_PER_YEAR, EMPLOYMENT_SENTINEL, ENQUIRY_COLS, WEEKDAYS

# ---------------------------------------------------------------------------
# Group labels and their upper bounds, as in the reference.
# ---------------------------------------------------------------------------
AGE_BANDS = [(25, "< 25 ans"), (35, "25-35 ans"), (45, "35-45 ans"), (55, "45-55 ans")]
AGE_LAST = "> 55 ans"
EMPLOYMENT_BANDS = [(1, "< 1 an"), (3, "1-3 ans"), (5, "3-5 ans"), (10, "5-10 ans")]
EMPLOYMENT_LAST = "> 10 ans"
ENQUIRY_NONE = "Aucune demande"
ENQUIRY_BANDS = [(2, "1-2 demandes"), (5, "3-5 demandes")]
ENQUIRY_LAST = "> 5 demandes"
OWNERSHIP_LABELS = {"Y": "Propriétaire", "N": "Non propriétaire"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bands(x: Column, bands: list[tuple[float, str]], last: str, null_label: str | None = None) -> Column:
    """``when(x < b1, l1).when(x < b2, l2)...otherwise(last)``.

    A null ``x`` fails every test and lands in ``last`` (reference behaviour);
    ``null_label`` gives it a group of its own instead.
    """
    out = F.when(x.isNull(), F.lit(null_label)) if null_label is not None else None
    for bound, label in bands:
        out = F.when(x < bound, F.lit(label)) if out is None else out.when(x < bound, F.lit(label))
    return out.otherwise(F.lit(last))


def age_years(days_birth: str | Column = "DAYS_BIRTH") -> Column:
    """Age in years, ``-DAYS_BIRTH / 365.25`` with a double literal."""
    return -_col(days_birth) / F.lit(DAYS_PER_YEAR)


def age_group(days_birth: str | Column = "DAYS_BIRTH", null_label: str | None = None) -> Column:
    """Five age groups; a null age counts as the oldest group by default."""
    return _bands(age_years(days_birth), AGE_BANDS, AGE_LAST, null_label=null_label)


def credit_income_ratio(credit: str | Column = "AMT_CREDIT", income: str | Column = "AMT_INCOME_TOTAL") -> Column:
    """``round(credit / income, 2)``; a zero or null income gives null."""
    return F.round(F.try_divide(_col(credit), _col(income)), 2)


def years_employed(days_employed: str | Column = "DAYS_EMPLOYED") -> Column:
    """Years employed, the sentinel counts as 0."""
    d = _col(days_employed)
    return F.when(d == EMPLOYMENT_SENTINEL, F.lit(0.0)).otherwise(-d / F.lit(DAYS_PER_YEAR))


def employment_length(days_employed: str | Column = "DAYS_EMPLOYED", null_label: str | None = None) -> Column:
    """P5: five seniority groups; null counts as ``> 10 ans`` by default."""
    return _bands(years_employed(days_employed), EMPLOYMENT_BANDS, EMPLOYMENT_LAST, null_label=null_label)


def total_enquiries(cols: list[str] = ENQUIRY_COLS) -> Column:
    """Sum of the six bureau counters, null counted as 0."""
    total = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        total = term if total is None else total + term
    return total


def enquiry_group(total: Column | None = None) -> Column:
    """None, 1-2, 3-5, more than 5 enquiries."""
    t = total_enquiries() if total is None else total
    return _bands_le(t)


def _bands_le(t: Column) -> Column:
    out = F.when(t == 0, F.lit(ENQUIRY_NONE))
    for bound, label in ENQUIRY_BANDS:
        out = out.when(t <= bound, F.lit(label))
    return out.otherwise(F.lit(ENQUIRY_LAST))


def ownership_label(flag: str | Column = "FLAG_OWN_REALTY") -> Column:
    """Y / N to readable text; any other code is kept."""
    f = _col(flag)
    out = None
    for code, label in OWNERSHIP_LABELS.items():
        out = F.when(f == code, F.lit(label)) if out is None else out.when(f == code, F.lit(label))
    return out.otherwise(f)


def weekday_order(day: str | Column = "WEEKDAY_APPR_PROCESS_START") -> Column:
    """MONDAY = 0 .. SUNDAY = 6, case-insensitive; null -> 0, unknown text -> null."""
    d = _col(day)
    pos = F.array_position(F.array(*[F.lit(w) for w in WEEKDAYS]), F.upper(d))
    return F.when(d.isNull(), F.lit(0)).otherwise((F.nullif(pos, F.lit(0)) - 1).cast("int"))


def default_flag(target: str | Column = "TARGET") -> Column:
    """P10: 1 when TARGET == 1, otherwise (0, other values, null) 0."""
    return F.when(_col(target) == 1, F.lit(1)).otherwise(F.lit(0))


def default_rate(target: str | Column = "TARGET") -> Column:
    """A2: default rate in percent, 2 decimals."""
    return F.round(F.avg(default_flag(target)) * 100, 2)


def rounded_mean(c: str | Column, places: int = 0) -> Column:
    """A3: ``round(avg(c), places)``."""
    return F.round(F.avg(_col(c)), places)


def client_count() -> Column:
    """A1: rows per group."""
    return F.count(F.lit(1))
