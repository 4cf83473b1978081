"""Explicit salting of hot join keys.

AQE splits a skewed sort-merge partition at run time, but only when both
join inputs are plain shuffles. When one side comes out of an aggregate on
the join key (its partitioning is reused, as for de-duplicated profiles),
or AQE is off, a key that holds many rows still lands on one task.
``salted_join`` counts the rows of each key (a partial aggregate), and spreads
those of a key above ``target_rows`` over as many salts as it has such shares.
It replicates only the matching rows of the other side, which has one row per
key here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key that one task may take.
TARGET_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, target_rows: int = TARGET_ROWS) -> dict:
    """The keys with more than ``target_rows`` rows and their exact counts.

    At most rows / ``target_rows`` keys come back.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return {r.k: r.n for r in counts.where(F.col("n") > target_rows).collect()}


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
                *, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``big`` joined to ``small`` (one row per key) on ``big_key == small_key``, salting hot keys.

    Rows of a hot key get a salt from a hash of the whole row; a key of n rows has
    ceil(n / ``target_rows``) salts, and the small side's row for it is repeated once per salt.
    Other keys keep salt 0 and are not repeated. Each big row meets exactly one copy of its
    match, so the result equals the plain join for ``inner``, ``left``, ``left_semi`` and
    ``left_anti``. One job counts the keys when it is called.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salted_join supports inner, left, left_semi and left_anti joins")
    hot = hot_keys(big, big_key, target_rows)
    if not hot:
        return big.join(small, F.col(big_key) == F.col(small_key), how)
    salts = F.create_map(*[F.lit(x) for k, n in hot.items() for x in (k, -(-n // target_rows))])
    # Deterministic salt (a retried task computes the same one): hash of the hashable columns.
    hashable = [F.col(f.name) for f in big.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.coalesce(F.try_element_at(salts, F.col(big_key)), F.lit(1)).cast("long")))
    copies = F.coalesce(F.try_element_at(salts, F.col(small_key)), F.lit(1)).cast("long")
    salted_small = small.withColumn("_salt_s", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    cond = (F.col(big_key) == F.col(small_key)) & (F.col("_salt") == F.col("_salt_s"))
    joined = salted_big.join(salted_small, cond, how)
    return joined.drop("_salt", "_salt_s") if how in ("inner", "left") else joined.drop("_salt")
