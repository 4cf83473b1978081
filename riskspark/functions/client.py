"""Client-level expressions of the scoring response.

The reference computes these in Python per client on the driver; here they
are Column expressions applied to the whole scored table in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.schema import DAYS_PER_YEAR, EMPLOYMENT_SENTINEL

# ---------------------------------------------------------------------------
# Display translations (code -> French label), as in the reference.
# ---------------------------------------------------------------------------
TRANSLATIONS = {
    "gender": {"M": "Homme", "F": "Femme"},
    "income_type": {
        "Working": "Salarié",
        "Commercial associate": "Commercial",
        "Pensioner": "Retraité",
        "State servant": "Fonctionnaire",
        "Entrepreneur": "Entrepreneur",
    },
    "education_type": {
        "Higher education": "Enseignement supérieur",
        "Secondary / secondary special": "Secondaire",
        "Incomplete higher": "Supérieur incomplet",
        "Lower secondary": "Premier cycle secondaire",
        "Academic degree": "Diplôme universitaire",
    },
    "family_status": {
        "Married": "Marié(e)",
        "Single / not married": "Célibataire",
        "Civil marriage": "Pacs",
        "Separated": "Séparé(e)",
        "Widow": "Veuf/veuve",
    },
    "housing_type": {
        "House / apartment": "Maison / appartement",
        "Rented apartment": "Location",
        "With parents": "Chez les parents",
        "Municipal apartment": "Logement social",
        "Office apartment": "Logement de fonction",
        "Co-op apartment": "Coopérative",
    },
}

# ---------------------------------------------------------------------------
# Recommendation per score band (lower bound inclusive), as in the reference.
# ---------------------------------------------------------------------------
REFUSE_FROM = 0.70
CONDITIONAL_FROM = 0.40
RECOMMENDATIONS = {
    "refuse": {
        "decision": "Refus recommandé",
        "explanation": "Le niveau de risque est trop élevé pour accorder le crédit aux conditions demandées.",
        "alternative": "Proposer un montant réduit avec garanties supplémentaires.",
        "risk_level": "Élevé",
        "action_plan": [
            "Refuser le crédit aux conditions demandées",
            "Proposer un montant réduit (max 30% du revenu)",
            "Exiger des garanties supplémentaires (caution, hypothèque)",
            "Orienter le client vers un accompagnement budgétaire",
        ],
    },
    "conditional": {
        "decision": "Acceptation conditionnelle",
        "explanation": "Le dossier présente un risque modéré qui nécessite des garanties supplémentaires.",
        "alternative": "Envisager un co-emprunteur ou une caution solidaire.",
        "risk_level": "Moyen",
        "action_plan": [
            "Accepter sous réserve de garanties supplémentaires",
            "Ajuster le taux d'intérêt pour compenser le risque",
            "Proposer une durée d'emprunt plus courte",
            "Mettre en place un suivi trimestriel",
        ],
    },
    "accept": {
        "decision": "Acceptation recommandée",
        "explanation": "Le profil présente un faible risque de défaut.",
        "alternative": "Procéder à l'octroi du crédit aux conditions standards.",
        "risk_level": "Faible",
        "action_plan": [
            "Accorder le crédit aux conditions standards",
            "Proposer des produits complémentaires (assurance, épargne)",
            "Appliquer le processus de suivi standard",
            "Réévaluer le risque annuellement",
        ],
    },
}

# Page risk tag bands (upper bound exclusive) and result stamps.
RISK_TAGS = [(0.4, "Risque Faible"), (0.7, "Risque Moyen")]
RISK_TAG_LAST = "Risque Élevé"
STAMP_VERSION = "1.2.3"
STAMP_MODEL_TYPE = "Régression logistique"
STAMP_DATA_SOURCE = "Historique clients 2020-2024"
DATE_PATTERN = "dd/MM/yyyy"
TIME_PATTERN = "HH:mm"
CURRENCY_SUFFIX = " €"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def python_round(x: str | Column, places: int) -> Column:
    """Python's ``round(x, places)`` for doubles: half-even on the exact binary value.

    ``F.round`` rounds half-up on the printed decimal, so 1122.965 (stored as
    1122.96499...) gives 1122.97 where Python gives 1122.96. ``format_number``
    rounds the exact value half-even; its text (without grouping commas) is
    read back as a double.
    """
    return F.regexp_replace(F.format_number(_col(x), places), ",", "").cast("double")


def client_age(days_birth: str | Column = "DAYS_BIRTH") -> Column:
    """``-int(DAYS_BIRTH / 365.25)``, truncating toward zero; null stays null."""
    return -((_col(days_birth) / F.lit(DAYS_PER_YEAR)).cast("int"))


def client_years_employed(days_employed: str | Column = "DAYS_EMPLOYED") -> Column:
    """``-DAYS_EMPLOYED / 365.25``; null or the sentinel give 0."""
    d = _col(days_employed)
    return F.when(d.isNull() | (d == EMPLOYMENT_SENTINEL), F.lit(0.0)).otherwise(-d / F.lit(DAYS_PER_YEAR))


def years_employed_display(years: str | Column = "years_employed") -> Column:
    """Values above 100 wrap modulo 100, then Python's ``round(y, 1)``."""
    y = _col(years)
    return python_round(F.when(y > 100, y % 100).otherwise(y), 1)


def whole_amount(x: str | Column) -> Column:
    """P20: amount rounded to a whole number as Python's ``round(x)`` (half-even); null kept."""
    return F.rint(_col(x)).cast("long")


def translate(field: str, c: str | Column) -> Column:
    """Code -> French label for ``field``; unmapped values are kept."""
    mapping = TRANSLATIONS[field]
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    col = _col(c)
    return F.coalesce(F.try_element_at(m, col), col)


def _recommendation_struct(rec: dict) -> Column:
    return F.struct(
        F.lit(rec["decision"]).alias("decision"),
        F.lit(rec["explanation"]).alias("explanation"),
        F.lit(rec["alternative"]).alias("alternative"),
        F.lit(rec["risk_level"]).alias("risk_level"),
        F.array(*[F.lit(s) for s in rec["action_plan"]]).alias("action_plan"),
    )


def recommendation(score: str | Column = "risk_score") -> Column:
    """``struct<decision, explanation, alternative, risk_level, action_plan>``; null score -> null."""
    s = _col(score)
    return (
        F.when(s.isNull(), F.lit(None))
        .when(s >= REFUSE_FROM, _recommendation_struct(RECOMMENDATIONS["refuse"]))
        .when(s >= CONDITIONAL_FROM, _recommendation_struct(RECOMMENDATIONS["conditional"]))
        .otherwise(_recommendation_struct(RECOMMENDATIONS["accept"]))
    )


def risk_tag(score: str | Column = "risk_score") -> Column:
    """Page tag by score band; null score -> null."""
    s = _col(score)
    out = F.when(s.isNull(), F.lit(None).cast("string"))
    for bound, label in RISK_TAGS:
        out = out.when(s < bound, F.lit(label))
    return out.otherwise(F.lit(RISK_TAG_LAST))


def score_percent_text(score: str | Column = "risk_score") -> Column:
    """P25: score in percent as text with one decimal, e.g. ``42.5%``.

    ``format_number`` rounds half-even on the exact binary value, as Python's
    ``f"{x:.1f}"`` in the reference does (``format_string`` would round 6.25 up).
    Scores are in [0, 1], so no thousands separator appears.
    """
    return F.concat(F.format_number(_col(score) * 100, 1), F.lit("%"))


def displayed_ratio(credit: str | Column = "credit_amount", income: str | Column = "income") -> Column:
    """Both amounts truncated to whole numbers, then Python's ``round(credit / income, 2)``.

    A zero or null income gives null (the reference raises).
    """
    return python_round(F.try_divide(_col(credit).cast("long"), _col(income).cast("long")), 2)


def amount_label(credit: str | Column = "credit_amount") -> Column:
    """``"<amount> €"``."""
    return F.concat(_col(credit).cast("string"), F.lit(CURRENCY_SUFFIX))


def result_stamps(at: Column | None = None) -> Column:
    """Analysis date and time plus fixed version, model and data source labels.

    ``at`` defaults to the query's current timestamp; pass a column to make it reproducible.
    """
    ts = F.current_timestamp() if at is None else at
    return F.struct(
        F.date_format(ts, DATE_PATTERN).alias("analysis_date"),
        F.date_format(ts, TIME_PATTERN).alias("analysis_time"),
        F.lit(STAMP_VERSION).alias("version"),
        F.lit(STAMP_MODEL_TYPE).alias("model_type"),
        F.lit(STAMP_DATA_SOURCE).alias("data_source"),
    )


def client_info() -> Column:
    """P18 ``client_info`` struct from the profile columns (P15) of a scored table."""
    return F.struct(
        F.col("CODE_GENDER").alias("gender"),
        client_age().alias("age"),
        F.col("CNT_CHILDREN").cast("int").alias("children_count"),
        F.col("AMT_INCOME_TOTAL").cast("double").alias("income"),
        F.col("AMT_CREDIT").cast("double").alias("credit_amount"),
        F.col("NAME_INCOME_TYPE").alias("income_type"),
        F.col("NAME_EDUCATION_TYPE").alias("education_type"),
        F.col("NAME_FAMILY_STATUS").alias("family_status"),
        F.col("NAME_HOUSING_TYPE").alias("housing_type"),
        client_years_employed().alias("years_employed"),
    )


def formatted_client_info(info: str | Column = "client_info") -> Column:
    """P19-P21 applied to a ``client_info`` struct (the middleware's formatting step)."""
    i = _col(info)
    return F.struct(
        translate("gender", i["gender"]).alias("gender"),
        i["age"].cast("int").alias("age"),
        i["children_count"].alias("children_count"),
        whole_amount(i["income"]).alias("income"),
        whole_amount(i["credit_amount"]).alias("credit_amount"),
        translate("income_type", i["income_type"]).alias("income_type"),
        translate("education_type", i["education_type"]).alias("education_type"),
        translate("family_status", i["family_status"]).alias("family_status"),
        translate("housing_type", i["housing_type"]).alias("housing_type"),
        years_employed_display(i["years_employed"]).alias("years_employed"),
    )
