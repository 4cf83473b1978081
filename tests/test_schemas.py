"""Output schemas of the analyses and responses, as listed in FIXTURES.md §5."""

import pytest

from paths import SF_SMALL
from riskspark.api import CreditRiskService
from riskspark.sources.fixtures import application

EXPECTED = {
    1: [("AGE_GROUP", "string"), ("CLIENT_COUNT", "bigint"), ("DEFAULT_RATE", "double")],
    2: [("RATIO_CATEGORY", "int"), ("COUNT", "bigint"), ("AVG_RATIO", "double"), ("DEFAULT_RATE", "double")],
    3: [("NAME_INCOME_TYPE", "string"), ("CLIENT_COUNT", "bigint"), ("AVG_INCOME", "double"),
        ("DEFAULT_RATE", "double")],
    4: [("EMPLOYMENT_LENGTH", "string"), ("CLIENT_COUNT", "bigint"), ("DEFAULT_RATE", "double")],
    5: [("ENQUIRY_GROUP", "string"), ("CLIENT_COUNT", "bigint"), ("DEFAULT_RATE", "double")],
    6: [("NAME_CONTRACT_TYPE", "string"), ("FLAG_OWN_REALTY", "string"), ("CLIENT_COUNT", "bigint"),
        ("AVG_CREDIT", "double"), ("DEFAULT_RATE", "double")],
    7: [("NAME_FAMILY_STATUS", "string"), ("CNT_CHILDREN", "int"), ("CLIENT_COUNT", "bigint"),
        ("DEFAULT_RATE", "double")],
    8: [("WEEKDAY_APPR_PROCESS_START", "string"), ("APPLICATION_COUNT", "bigint"), ("DEFAULT_RATE", "double"),
        ("AVG_CREDIT", "double"), ("WEEKDAY_ORDER", "int")],
}


@pytest.fixture(scope="module")
def service(spark):
    return CreditRiskService(portfolio=application(spark, SF_SMALL))


@pytest.mark.parametrize("number", sorted(EXPECTED))
def test_analysis_schema(service, number):
    data, meta = service.dataviz(number)
    assert data.dtypes == EXPECTED[number]
    assert meta["analysis_type"] == number


def test_options_and_response_schema(service):
    assert service.filter_options().dtypes == [("family_status_options", "array<string>"),
                                               ("income_type_options", "array<string>")]
    resp = service.predict([1, 2, 3])
    fields = {f.name: f.dataType.simpleString() for f in resp.schema.fields}
    assert fields["prediction"] == "struct<risk_score:double,predicted_default:int>"
    assert fields["recommendation"] == ("struct<decision:string,explanation:string,alternative:string,"
                                        "risk_level:string,action_plan:array<string>>")
    assert fields["metadata"] == ("struct<analysis_date:string,analysis_time:string,version:string,"
                                  "model_type:string,data_source:string>")
    info = resp.schema["client_info"].dataType.fieldNames()
    assert info == ["gender", "age", "children_count", "income", "credit_amount", "income_type",
                    "education_type", "family_status", "housing_type", "years_employed"]
