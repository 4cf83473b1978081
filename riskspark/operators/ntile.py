"""Exact ``ntile(k) OVER (ORDER BY value NULLS FIRST, tie)`` without a global window.

``Window.orderBy`` without a partition key moves every row to one task. Here the ``k - 1`` boundary
keys are searched by counting, and no row is shuffled or sorted:

1. One pass takes a random sample of the two key columns, ``SKETCH`` rows whatever the table's size;
   partitions collect their parts, which merge. The sorted sample gives each boundary rank a narrow
   range of keys that holds it with near certainty.
2. The next pass counts, for all boundaries at once, the rows below each range and in it, and samples
   inside the range. The counts say exactly on which side the rank lies, so that a range that misses
   it costs one more pass and never a wrong answer. Each pass narrows a range some thirty times.
3. A range of ``SKETCH`` rows or less is taken whole, sorted, and the rank's key picked.
4. A row's bucket is ``1 + #boundaries <= (value, tie)``: a projection over literals, no
   join and no shuffle of whole rows. ``k`` should stay small (quintiles, percentiles).

150,000 rows take three small jobs (the count, the sample, the ranges), a trillion take eight. The
largest thing in one place is a sample. ``tie`` is a unique key of any type that Spark orders:
numbers, text, dates and so on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH = 24_000  # keys of all samples of a pass

_UNORDERED = (T.MapType, T.VariantType, T.CalendarIntervalType)


def _key(value: str, tie: str) -> Column:
    """The sort key of a row; a null value comes first, as in a struct's order."""
    return F.struct(F.col(value).alias("v"), F.col(tie).alias("t"))


def boundary_ranks(n: int, k: int) -> list[int]:
    """The 0-based ranks of the rows that open buckets 2..k, as far as there are rows."""
    q, m = divmod(n, k)
    ranks = [b * (q + 1) if b <= m else m * (q + 1) + (b - m) * q for b in range(1, k)]
    return [r for r in ranks if r < n]


@dataclass(frozen=True)
class _Range:
    """The keys from ``low`` (included) to ``high`` (not); None is open. ``below`` rows come before, about ``rows`` lie inside."""

    low: tuple | None = None
    high: tuple | None = None
    below: int = 0
    rows: float = 0


def _literal(key: tuple, types: tuple) -> Column:
    return F.struct(*(F.lit(x).cast(t).alias(n) for x, t, n in zip(key, types, "vt")))


def _pass(keys: DataFrame, types: tuple, wanted: dict[_Range, list[int]], seed: int) -> dict[_Range, tuple]:
    """For each range: the rows below it, equal to its low key and in it, the size of a sample of it, and for each wanted rank
    the sampled keys (low, high) around it, or (key, None) where the sample is the whole range."""
    room = max(2000, SKETCH // len(wanted))
    bounds, counts, picks = [_key("v", "t").alias("key"), F.rand(seed).alias("x")], [], []
    for i, (r, ranks) in enumerate(wanted.items()):
        bounds += [_literal(k, types).alias(f"{n}{i}") for n, k in (("low", r.low), ("high", r.high)) if k is not None]
        under = "false" if r.low is None else f"key < low{i}"
        inside = f"NOT ({under})" + ("" if r.high is None else f" AND key < high{i}")
        part = min(1.0, room / r.rows) if r.rows > room else 1.0
        taken = inside if part == 1.0 else f"{inside} AND x < {part!r}D"
        counts += [f"count_if({under}) AS u{i}", f"count_if({'false' if r.low is None else f'key = low{i}'}) AS e{i}", f"count_if({inside}) AS n{i}",
                   f"sort_array(collect_list(CASE WHEN {taken} THEN key END)) AS s{i}"]
        at = lambda x, i=i: f"CASE WHEN {x} BETWEEN 0 AND size(s{i}) - 1 THEN s{i}[CAST({x} AS INT)] END"
        pairs = []
        for rank in ranks:
            if part == 1.0:
                near = f"({rank}L - u{i})", "-1"
            else:  # five standard deviations around the rank's place in the sample
                middle, wide = f"({rank}L - u{i}) / greatest(n{i}, 1) * size(s{i})", f"(2.5D * sqrt(size(s{i})) + 2)"
                near = f"floor({middle} - {wide})", f"ceil({middle} + {wide})"
            pairs.append(f"named_struct('a', {at(near[0])}, 'b', {at(near[1])})")
        picks += [f"u{i}", f"e{i}", f"n{i}", f"size(s{i}) AS m{i}", f"array({', '.join(pairs)}) AS p{i}", f"{'true' if part == 1.0 else 'false'} AS w{i}"]
    row = keys.select(*bounds).agg(*map(F.expr, counts)).selectExpr(*picks).first()
    pair = lambda x: None if x is None else tuple(x)
    return {r: (row[f"u{i}"], row[f"e{i}"], row[f"n{i}"], row[f"m{i}"], [(pair(p.a), pair(p.b)) for p in row[f"p{i}"]], row[f"w{i}"]) for i, r in enumerate(wanted)}


def boundaries(df: DataFrame, value: str, tie: str, buckets: int) -> list[tuple]:
    """The keys ``(value, tie)`` of the rows that open buckets 2..k, in order."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    for c in (value, tie):
        if isinstance(df.schema[c].dataType, _UNORDERED):
            raise TypeError(f"{c} has no order: {df.schema[c].dataType.simpleString()}")
    types = df.schema[value].dataType, df.schema[tie].dataType
    keys = df.select(F.col(value).alias("v"), F.col(tie).alias("t"))
    total = keys.count()
    # For each rank the range that is known to hold it, and the narrower one to try.
    known = {rank: _Range(rows=total) for rank in boundary_ranks(total, buckets)}
    tried, found, seed = dict(known), {}, 1
    while tried:
        wanted: dict[_Range, list[int]] = {}
        for rank, r in tried.items():
            wanted.setdefault(r, []).append(rank)
        for r, (under, same, inside, size, picks, whole) in _pass(keys, types, wanted, seed).items():
            for rank, (low, high) in zip(wanted[r], picks):
                sure = known[rank]
                if rank < under:  # it lies between the two ranges' low keys
                    known[rank] = tried[rank] = _Range(sure.low, r.low, sure.below, under - sure.below)
                elif rank < under + same:
                    found[rank] = r.low
                elif rank >= under + inside:
                    known[rank] = tried[rank] = _Range(r.high, sure.high, under + inside, sure.below + sure.rows - under - inside)
                elif whole:
                    found[rank] = low
                else:
                    known[rank] = _Range(r.low, r.high, under, inside)
                    share = (5 * size ** 0.5 + 6) / max(size, 1)
                    tried[rank] = _Range(low or r.low, high or r.high, 0, max(1.0, share * inside))
        tried = {rank: r for rank, r in tried.items() if rank not in found}
        seed += 1
    return [found[rank] for rank in sorted(found)]


def ntile_column(df: DataFrame, value: str, tie: str, buckets: int) -> Column:
    """The bucket (1..k) as an expression over ``value`` and ``tie``. Jobs run when it is called."""
    types = df.schema[value].dataType, df.schema[tie].dataType
    bucket = F.lit(1)
    for bound in boundaries(df, value, tie, buckets):
        bucket = bucket + F.when(_literal(bound, types) <= _key(value, tie), 1).otherwise(0)
    return bucket.cast("int")


def ntile(df: DataFrame, value: str, tie: str, buckets: int, out: str = "ntile") -> DataFrame:
    """``df`` plus ``out`` = ``ntile(buckets) OVER (ORDER BY value NULLS FIRST, tie)``.

    The boundaries are found when it is called (small jobs over the two key columns); the
    returned DataFrame is lazy. An input that is expensive to build should be materialized
    first, as its two key columns are read a few times.
    """
    return df.withColumn(out, ntile_column(df, value, tie, buckets))


def ntile_summary(df: DataFrame, value: str, tie: str, buckets: int, bucket_col: str, flag: str) -> DataFrame:
    """G2 shape: per bucket ``COUNT``, ``AVG_RATIO`` (2 places), ``DEFAULT_RATE`` (% of ``flag``)."""
    with_bucket = ntile(df, value, tie, buckets, bucket_col)
    return with_bucket.groupBy(bucket_col).agg(
        F.count(F.lit(1)).alias("COUNT"),
        F.round(F.avg(value), 2).alias("AVG_RATIO"),
        F.round(F.avg(flag) * 100, 2).alias("DEFAULT_RATE"),
    )
