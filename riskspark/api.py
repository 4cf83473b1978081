"""One object with the reference's four entry points, over DataFrames.

The reference exposes ``/get_dataviz``, ``/get_filter_options``,
``/predict_default`` and ``/feedback``. ``CreditRiskService`` offers the same
calls on explicit DataFrames (no shared globals, no HTTP): each returns a
DataFrame, and ``predict`` takes any number of client ids at once. Fitting, the
quintiles and the card run jobs when called; the rest is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.filters import PortfolioFilters, missing_ids
from riskspark.operators.profile import client_card, missing_cards
from riskspark.plans import analyses as G
from riskspark.plans.scoring import RiskModel, fit, score_clients


@dataclass
class CreditRiskService:
    """``portfolio``: labelled applications; ``scoring``: applications to score;
    ``users``: personal profiles (optional); ``model``: fitted on demand if absent."""

    portfolio: DataFrame
    scoring: DataFrame | None = None
    users: DataFrame | None = None
    model: RiskModel | None = None
    profile_key: str = "SK_ID_CURR"
    _fitted: dict = field(default_factory=dict, repr=False)

    # --- /get_dataviz -------------------------------------------------------
    def dataviz(self, analysis_type: int = 1, filters: PortfolioFilters | None = None) -> tuple[DataFrame, dict]:
        """One analysis (1..8) under ``filters``; returns the data and its metadata."""
        f = filters or PortfolioFilters()
        data = G.analysis(self.portfolio, analysis_type, f)
        return data, {"analysis_type": analysis_type, "filters": filters_metadata(f)}

    def dataviz_from_params(self, params: Mapping[str, Any]) -> tuple[DataFrame, dict]:
        """Same, from request-style parameters (numbers as text, lists as JSON text)."""
        try:
            number = int(params.get("analysis_type") or 1)
        except ValueError:  # not a number: the default
            number = 1
        return self.dataviz(number, PortfolioFilters.from_params(params))

    # --- /get_filter_options ----------------------------------------------------
    def filter_options(self) -> DataFrame:
        return G.filter_options(self.portfolio)

    # --- /predict_default ---------------------------------------------------
    def fitted(self) -> RiskModel:
        if self.model is None:
            if "model" not in self._fitted:
                self._fitted["model"] = fit(self.portfolio)
            return self._fitted["model"]
        return self.model

    def predict(self, client_ids=None, *, at: Column | None = None) -> DataFrame:
        """One answer per requested client (all clients when ``client_ids`` is None): the scored
        response, or, for an id that is not in the table, its ``error`` with the rest null."""
        table = self.scoring if self.scoring is not None else self.portfolio.drop("TARGET")
        found = score_clients(table, self.fitted(), client_ids, at=at)
        if client_ids is None:
            return found.withColumn("error", F.lit(None).cast("string"))
        unknown = self.unknown_clients(client_ids).withColumnRenamed("SK_ID_CURR", "client_id")
        return found.unionByName(unknown, allowMissingColumns=True)

    def unknown_clients(self, client_ids) -> DataFrame:
        """Requested ids (an int, a list or a DataFrame) that are not in the scoring table, with the reference's error text."""
        table = self.scoring if self.scoring is not None else self.portfolio
        if not isinstance(client_ids, DataFrame):
            ids = [client_ids] if isinstance(client_ids, int) else list(client_ids)
            client_ids = table.sparkSession.createDataFrame([(int(i),) for i in ids], "SK_ID_CURR long")
        return missing_ids(client_ids, table)

    def cards(self, client_ids=None) -> DataFrame:
        """Scored clients that also have a personal profile (the page's full card)."""
        if self.users is None:
            raise ValueError("no personal profiles were given")
        table = self.scoring if self.scoring is not None else self.portfolio.drop("TARGET")
        keyed = table.withColumn("_profile_key", F.col(self.profile_key))
        scored = score_clients(keyed, self.fitted(), client_ids, carry=["_profile_key"])
        return client_card(scored, self.users, key="_profile_key").drop("_profile_key")

    # --- /feedback ------------------------------------------------------------
    @staticmethod
    def feedback(spark, bodies_dir: str, sink_path: str, checkpoint_path: str, *, available_now: bool = True):
        """Start the feedback stream over JSON request bodies (S7); returns the StreamingQuery."""
        from riskspark.streaming.feedback import start_request_stream
        return start_request_stream(spark, bodies_dir, sink_path, checkpoint_path, available_now=available_now)

    def cards_missing(self) -> DataFrame:
        if self.users is None:
            raise ValueError("no personal profiles were given")
        table = self.scoring if self.scoring is not None else self.portfolio
        return missing_cards(table.select("SK_ID_CURR", F.col(self.profile_key).alias("_k")), self.users,
                             key="_k")


def filters_metadata(f: PortfolioFilters) -> dict:
    """The applied filters as the reference reports them: present keys only, realty as Y/N."""
    out: dict[str, Any] = {}
    for name in ("min_credit", "max_credit", "min_income"):
        if getattr(f, name) is not None:
            out[name] = getattr(f, name)
    if f.family_statuses:
        out["family_statuses"] = list(f.family_statuses)
    if f.income_types:
        out["income_types"] = list(f.income_types)
    if f.realty_code() is not None:
        out["realty_status"] = f.realty_code()
    return out
