"""Client card: scored applications x personal profiles.

Profiles key clients by ``SK_CURR_ID`` stored either as an integer or as
text. The reference looks up the integer first and the text as a fallback,
and takes the first match. Here both key forms are folded into one long key
with a priority (integer before text) and one row per key (lowest
``LastName``, so the choice is defined), all by aggregation; the card is then
a single equi-join that Spark plans by size (broadcast or sort-merge), with
hot client keys salted (see ``client_card``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.skew import TARGET_ROWS, salted_join

# Fixed value: message shown when the full card cannot be built.
MISSING_CARD = ("Impossible de récupérer les informations complètes pour le client ID : {}. "
                "Veuillez vérifier l'identifiant et que l'API est bien lancée.")

PROFILE_FIELDS = ["LastName", "FirstName", "PhotoURL"]


def unified_profiles(users: DataFrame) -> DataFrame:
    """One row per client key: ``PROFILE_KEY long``, ``SK_CURR_ID string`` (as stored), profile fields.

    A text key matches only when it is the canonical text of a number (as
    ``str(int)`` would print it); other text matches nothing. One scan: each
    profile row yields its candidate keys (integer key first, priority 0;
    text key, priority 1), then one aggregate keeps the best row per key.
    """
    fields = F.struct(*[F.col(c) for c in PROFILE_FIELDS])
    as_long = F.col("SK_CURR_ID_STR").try_cast("long")
    text_ok = as_long.cast("string") == F.col("SK_CURR_ID_STR")
    candidates = F.array(
        F.struct(F.col("SK_CURR_ID_INT").cast("long").alias("k"), F.lit(0).alias("prio"),
                 F.col("SK_CURR_ID_INT").cast("string").alias("id")),
        F.struct(F.when(text_ok, as_long).alias("k"), F.lit(1).alias("prio"),
                 F.col("SK_CURR_ID_STR").alias("id")),
    )
    keyed = users.select(fields.alias("_p"), F.explode(candidates).alias("_c")) \
        .where(F.col("_c.k").isNotNull()) \
        .select(F.col("_c.k").alias("PROFILE_KEY"), F.col("_c.prio").alias("_prio"),
                F.col("_c.id").alias("SK_CURR_ID"), "_p")
    # Per key: lowest priority first, then the smallest profile (LastName, FirstName, PhotoURL).
    best = keyed.groupBy("PROFILE_KEY").agg(
        F.min(F.struct(F.col("_prio"), F.col("_p"), F.col("SK_CURR_ID"))).alias("_best"))
    return best.select("PROFILE_KEY", F.col("_best.SK_CURR_ID").alias("SK_CURR_ID"),
                       *[F.col(f"_best._p.{c}").alias(c) for c in PROFILE_FIELDS])


def client_card(clients: DataFrame, users: DataFrame, key: str = "CUST_ID",
                salt_hot_keys: bool = True, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Clients that have a profile, with the profile fields (both sides required).

    The profile side comes out of an aggregate on the key, so AQE cannot split
    a skewed key in this join. Keys with more clients than one task should take
    are therefore salted explicitly (``operators.skew``, one counting job when this is
    called); ``salt_hot_keys=False`` gives the plain equi-join.
    """
    prof = unified_profiles(users)
    if salt_hot_keys:
        return salted_join(clients, prof, key, "PROFILE_KEY", "inner", target_rows=target_rows).drop("PROFILE_KEY")
    return clients.join(prof, F.col(key) == F.col("PROFILE_KEY"), "inner").drop("PROFILE_KEY")


def missing_cards(clients: DataFrame, users: DataFrame, id_col: str = "SK_ID_CURR",
                  key: str = "CUST_ID", salt_hot_keys: bool = True, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Ids whose card cannot be built, with the page's error text (hot keys salted)."""
    prof = unified_profiles(users).select("PROFILE_KEY")
    prefix, suffix = MISSING_CARD.split("{}")
    if salt_hot_keys:
        missing = salted_join(clients, prof, key, "PROFILE_KEY", "left_anti", target_rows=target_rows)
    else:
        missing = clients.join(prof, F.col(key) == F.col("PROFILE_KEY"), "left_anti")
    return missing.select(
        F.col(id_col), F.concat(F.lit(prefix), F.col(id_col).cast("string"), F.lit(suffix)).alias("error"))
