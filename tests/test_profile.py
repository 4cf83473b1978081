"""Mixed-type profile keys, first match defined, missing cards."""

from riskspark.operators.profile import client_card, missing_cards, unified_profiles

USERS = "SK_CURR_ID_INT long, SK_CURR_ID_STR string, FirstName string, LastName string, PhotoURL string"


def test_int_key_wins_and_lowest_last_name(spark):
    users = spark.createDataFrame([
        (1, None, "A", "Zed", None),
        (None, "1", "B", "Aaa", None),          # text key for the same client: int wins
        (2, None, "C", "Bob-dup", "p"),
        (2, None, "C", "Bob", "p"),              # lowest last name wins
        (None, "3", "D", "Dee", None),           # text only: fallback
        (None, "04", "E", "Eve", None),          # not canonical text of 4: matches nothing
        (None, "abc", "F", "Fox", None),         # not a number: matches nothing
    ], USERS)
    prof = {r.PROFILE_KEY: (r.SK_CURR_ID, r.LastName) for r in unified_profiles(users).collect()}
    assert prof == {1: ("1", "Zed"), 2: ("2", "Bob"), 3: ("3", "Dee")}
    clients = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, 4)], "SK_ID_CURR long, CUST_ID long")
    card = {r.SK_ID_CURR: r.LastName for r in client_card(clients, users).collect()}
    assert card == {10: "Zed", 11: "Bob", 12: "Dee"}
    missing = missing_cards(clients, users).collect()
    assert [r.SK_ID_CURR for r in missing] == [13]
    assert "13" in missing[0].error
