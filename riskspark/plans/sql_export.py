"""A risk model as ANSI SQL: the same margins, scores and feature slots in any database.

The statements read a table of preprocessed applications (numbers as doubles, categories without
nulls, flags as 0/1), take each term in the order of the slots, and hold nothing but the model's
own numbers.
"""

from __future__ import annotations

import math

from riskspark.plans.parameters import RiskParameters


def _number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _filled(column: str, fill: float) -> str:
    return f"CASE WHEN {column} IS NULL OR isnan({column}) THEN {_number(fill)} ELSE {column} END"


def margin_sql(model: RiskParameters) -> str:
    """The linear margin as an expression over the preprocessed columns."""
    terms = [_number(model.intercept)]
    terms += [f"({_filled(n.column, n.fill)}) * {_number(n.scale * n.weight)}" for n in model.numbers]
    for c in model.categories:
        whens = " ".join(f"WHEN {_text(label)} THEN {_number(s * w)}" for label, s, w in zip(c.labels, c.scales, c.weights))
        terms.append(f"CASE {c.column} {whens} ELSE {_number(0.0)} END" if whens else _number(0.0))
    terms += [f"{f.column} * {_number(f.scale * f.weight)}" for f in model.flags]
    return " + ".join(terms)


def scores_sql(model: RiskParameters, table: str, keep: str = "SK_ID_CURR") -> str:
    """``keep``, ``margin``, ``risk_score`` and ``prediction`` of every row of ``table``."""
    cut = math.log(model.threshold / (1 - model.threshold))
    return (f"SELECT {keep}, margin, 1 / (1 + exp(-margin)) AS risk_score, CASE WHEN margin > {_number(cut)} THEN {_number(1.0)} ELSE {_number(0.0)} END AS prediction "
            f"FROM (SELECT *, {margin_sql(model)} AS margin FROM {table}) scored")


def features_sql(model: RiskParameters, table: str, key: str = "SK_ID_CURR") -> str:
    """The sparse features: ``key, slot, value`` of the slots that are not 0."""
    parts, slot = [], 0
    for n in model.numbers:
        parts.append(f"SELECT {key}, {slot} AS slot, ({_filled(n.column, n.fill)}) * {_number(n.scale)} AS value FROM {table}")
        slot += 1
    for c in model.categories:
        for label, scale in zip(c.labels, c.scales):
            parts.append(f"SELECT {key}, {slot}, {_number(scale)} FROM {table} WHERE {c.column} = {_text(label)}")
            slot += 1
    for f in model.flags:
        parts.append(f"SELECT {key}, {slot}, {f.column} * {_number(f.scale)} FROM {table}")
        slot += 1
    return f"SELECT {key}, CAST(slot AS INTEGER) AS slot, value FROM ({' UNION ALL '.join(parts)}) slots WHERE value <> 0"
