"""Every registered query with an oracle equals its DuckDB SQL (sf0.001 here; the driver uses sf0.01)."""

import pytest

from paths import SF_SMALL
from riskspark.queries import QUERIES
from riskspark.testing.compare import compare, duckdb_connection
from riskspark.testing.oracles import ORACLE_SQL

MODEL_FREE = sorted(k for k in QUERIES if k in ORACLE_SQL)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", MODEL_FREE)
def test_query_matches_oracle(spark, con, name):
    out = compare(name, QUERIES[name](spark, SF_SMALL), con, ORACLE_SQL[name])
    assert out.ok, f"{name}: rows {out.rows_spark}/{out.rows_oracle} cols={out.columns_match} {out.detail}"


def test_every_oracle_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_anchor_values_sf0_01(spark):
    """Anchors of the survey at sf0.01, no filters."""
    from paths import SF_ORACLE
    g1 = {r.AGE_GROUP: (r.CLIENT_COUNT, r.DEFAULT_RATE) for r in QUERIES["g1_age"](spark, SF_ORACLE).collect()}
    assert g1["< 25 ans"] == (1906, 33.11) and g1["> 55 ans"] == (4343, 32.12)
    g2 = {r.RATIO_CATEGORY: (r.COUNT, r.AVG_RATIO, r.DEFAULT_RATE)
          for r in QUERIES["g2_credit_income"](spark, SF_ORACLE).collect()}
    assert g2[1] == (3000, 0.55, 32.4) and g2[5] == (3000, 63.11, 32.53)
    g8 = {r.WEEKDAY_APPR_PROCESS_START: (r.APPLICATION_COUNT, r.AVG_CREDIT, r.DEFAULT_RATE)
          for r in QUERIES["g8_weekday"](spark, SF_ORACLE).collect()}
    assert g8["MONDAY"] == (2159, 248947, 33.3)
