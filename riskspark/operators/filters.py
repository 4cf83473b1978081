"""Portfolio filters (F1-F7) and the id lookups.

A filter set is a frozen value; ``predicate()`` turns it into one Column, so
Catalyst merges it with any other condition and pushes it to the scan.
"""

from __future__ import annotations

import json
import operator
from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Realty choice as sent by the page ("Tous" = all, "Oui" = yes).
REALTY_ALL = "Tous"
REALTY_YES = "Oui"


@dataclass(frozen=True)
class PortfolioFilters:
    """F1-F6; a field left at ``None`` (or an empty list, or ``"Tous"``) is off."""

    min_credit: float | None = None
    max_credit: float | None = None
    min_income: float | None = None
    family_statuses: Sequence[str] | None = None
    income_types: Sequence[str] | None = None
    realty_status: str | None = None

    @staticmethod
    def from_params(params: Mapping[str, str | None]) -> "PortfolioFilters":
        """Build from request-style parameters: numbers as text, lists as JSON text.

        Keys: ``min_credit``, ``max_credit``, ``min_income`` (float text),
        ``family_statuses``, ``income_types`` (JSON arrays), ``realty_status``.
        Missing or empty values, and numbers that are none, leave the filter off.
        """
        def num(key):
            try:
                return float(params.get(key) or "")
            except ValueError:
                return None

        def lst(key):
            v = params.get(key)
            return list(json.loads(v)) if v else None

        return PortfolioFilters(min_credit=num("min_credit"), max_credit=num("max_credit"),
                                min_income=num("min_income"), family_statuses=lst("family_statuses"),
                                income_types=lst("income_types"), realty_status=params.get("realty_status"))

    def realty_code(self) -> str | None:
        """``Tous`` / empty -> off, ``Oui`` -> ``Y``, anything else -> ``N``."""
        if not self.realty_status or self.realty_status == REALTY_ALL:
            return None
        return "Y" if self.realty_status == REALTY_YES else "N"

    def predicates(self) -> list[Column]:
        preds: list[Column] = []
        if self.min_credit is not None:                     # F1
            preds.append(F.col("AMT_CREDIT") >= F.lit(float(self.min_credit)))
        if self.max_credit is not None:                     # F2
            preds.append(F.col("AMT_CREDIT") <= F.lit(float(self.max_credit)))
        if self.min_income is not None:                     # F3
            preds.append(F.col("AMT_INCOME_TOTAL") >= F.lit(float(self.min_income)))
        if self.family_statuses:                            # F4
            preds.append(F.col("NAME_FAMILY_STATUS").isin(list(self.family_statuses)))
        if self.income_types:                               # F5
            preds.append(F.col("NAME_INCOME_TYPE").isin(list(self.income_types)))
        code = self.realty_code()
        if code is not None:                                # F6
            preds.append(F.col("FLAG_OWN_REALTY") == F.lit(code))
        return preds

    def predicate(self) -> Column | None:
        """conjunction of the present filters, ``None`` when none is set."""
        preds = self.predicates()
        return reduce(operator.and_, preds) if preds else None

    def apply(self, df: DataFrame) -> DataFrame:
        """Filter ``df``. Apply before any persist so the filter reaches the scan."""
        pred = self.predicate()
        return df.filter(pred) if pred is not None else df


NO_FILTERS = PortfolioFilters()


def lookup_ids(df: DataFrame, ids: DataFrame | Sequence[int] | int, key: str = "SK_ID_CURR") -> DataFrame:
    """rows of ``df`` whose ``key`` is requested.

    One id or a list of ids is a plain filter, pushed to the scan (Spark turns a long list
    into a hash set); for very many ids pass a DataFrame: a left semi join that Spark plans by
    size. The columns keep their order.
    """
    if isinstance(ids, DataFrame):
        # distinct() combines repeated requests on each partition before the shuffle, so an
        # id requested very many times does not pile up in one join task.
        wanted = ids.select(F.col(ids.columns[0]).alias("_wanted")).distinct()
        return df.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")
    if isinstance(ids, int):
        return df.filter(F.col(key) == F.lit(ids))
    return df.filter(F.col(key).isin([int(i) for i in ids]))


def missing_ids(ids: DataFrame, df: DataFrame, key: str = "SK_ID_CURR",
                template: str = "Client ID {} non trouvé dans les données") -> DataFrame:
    """requested ids absent from ``df`` with the reference's error text.

    ``left_anti`` join; no count per id.
    """
    prefix, suffix = template.split("{}")
    req = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    return req.join(df.select(key), on=key, how="left_anti").select(
        F.col(key), F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(suffix)).alias("error")
    )
