"""Positions and quotas that hold at any size: no task orders a whole group.

A group's rows are spread over buckets by the leading digits of a hash, or by ranges of a position. How many buckets there are follows the number of rows.
Buckets are counted (a small table), a running sum over the counts says where each bucket starts, and rows are numbered inside their bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seeded_hash
from ..runtime import Workspace, small_side

#: Rows that one bucket should hold at most; ranges of a position that are told apart by quantiles, each of which is cut further into equal widths.
BUCKET_ROWS, RANGES = 100_000, 256


def numbered(df: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str = "rank", weight: Column | None = None) -> DataFrame:
    """df plus `name`: the row's number from 1 within its group (or, with `weight`, the sum of the weights before it), in the order of (bucket, order).

    `bucket` must be an integer that rises with the order. One shuffle of the rows; the buckets' counts are summed on the map side.
    """
    value = F.lit(1) if weight is None else weight
    placed = df.withColumns({"__b": bucket, "__w": value.cast("long")})
    sums = placed.groupBy(*group, "__b").agg(F.sum("__w").alias("__s"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1) if group else Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, "__b", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__start"))  # a row for each bucket: one in BUCKET_ROWS of the rows
    inner = Window.partitionBy(*group, "__b").orderBy(*order)
    inside = F.row_number().over(inner) if weight is None else F.coalesce(F.sum("__w").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = placed.withColumn("__i", inside)
    on = [local[c].eqNullSafe(starts[c]) for c in [*group, "__b"]]
    joined = local.join(starts, on)
    return joined.select(*[local[c] for c in df.columns], (F.col("__start") + F.col("__i")).cast("long").alias(name))


def _in_one_bucket(df: DataFrame, group: list[str], order: list[Column], name: str, weight: Column | None = None) -> DataFrame:
    """`numbered` where each group is one bucket."""
    inner = Window.partitionBy(*group, F.lit(0)).orderBy(*order)
    if weight is None:
        return df.withColumn(name, F.row_number().over(inner).cast("long"))
    return df.withColumn(name, F.coalesce(F.sum(weight.cast("long")).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))


def hash_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Hex digits that cut so many rows into buckets of `bucket_rows` or fewer."""
    digits = 0
    while rows > bucket_rows * 16**digits and digits < 8:
        digits += 1
    return digits


def hash_rank(df: DataFrame, group: list[str], seed: str | int, keys: list[str], name: str = "rank", rows: int | None = None) -> DataFrame:
    """df plus `name`: its number from 1 in the group's random but repeatable order, by sha256(seed:keys). `rows` of the largest group set the number of buckets; they are counted if not given."""
    if rows is None:
        rows = (df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0) if group else df.count()
    digits = hash_digits(rows)
    hashed = df.withColumn("__h", seeded_hash(seed, *[F.col(k) for k in keys]))
    if not digits:
        return _in_one_bucket(hashed, group, [F.col("__h"), *[F.col(k) for k in keys]], name).drop("__h")
    bucket = F.conv(F.substring("__h", 1, digits), 16, 10).cast("long")
    return numbered(hashed, group, bucket, [F.col("__h"), *[F.col(k) for k in keys]], name).drop("__h")


def _bucket_of(position: Column, cuts: list, widths: list[int]) -> Column:
    """The range that a position lies in, by a binary search written as nested conditions, and the part of that range: one integer that rises with the position."""

    def between(a: int, b: int) -> Column:
        if a == b:
            low = F.lit(cuts[a - 1] if a else cuts[0])
            part = F.least(F.greatest(F.floor((position - low) / widths[a]), F.lit(0)), F.lit((1 << 20) - 1)) if a else F.greatest(F.floor((position - low) / widths[0]), F.lit(-(1 << 20) + 1))
            return F.lit(a * (1 << 21) + (1 << 20)) + part
        mid = (a + b) // 2
        return F.when(position < cuts[mid], between(a, mid)).otherwise(between(mid + 1, b))

    return between(0, len(cuts)).cast("long")


def position_rank(df: DataFrame, group: list[str], position: str, name: str = "rank", weight: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """df plus `name` by an integer position that is unique in the group.

    Buckets are ranges of the position: quantiles (approximate, RANGES at most) part the rows evenly however sparse or clustered the positions are, and beyond RANGES x `bucket_rows` rows each range is cut into
    equal widths. So a bucket never holds one row each, and no task orders all rows.
    """
    p = F.col(position)
    rows = df.count()
    ranges = min(RANGES, -(-rows // bucket_rows))
    if ranges <= 1:
        return _in_one_bucket(df, group, [p], name, weight)
    found, low, high = df.agg(F.percentile_approx(p, [k / ranges for k in range(1, ranges)], 10_000), F.min(p), F.max(p)).first()
    if not found:  # no row has a position
        return _in_one_bucket(df, group, [p], name, weight)
    cuts = sorted(set(found))
    parts = max(1, -(-rows // (ranges * bucket_rows)))
    edges = [low, *cuts, high + 1]
    widths = [max(1, -(-(b - a) // parts)) for a, b in zip(edges, edges[1:], strict=False)]
    return numbered(df, group, _bucket_of(p, cuts, widths), [p], name, weight)


def first_per_key(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The rows that come first for their key by `order`, which must be unique; a null key is a key.

    Keys and orders are written once. A key with a third of all rows is one row of the table of firsts; the orders of later rows come back by a broadcast if they are few, so the rows themselves aren't shuffled.
    """
    work = Workspace(df.sparkSession)
    keyed = work.write(df.select(key.alias("__k"), F.col(order)), "keys")
    firsts = work.write(keyed.groupBy("__k").agg(F.min(order).alias("__first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    there = small_side(firsts.withColumnRenamed("__k", "__key"))
    later = work.write(keyed.join(there, F.col("__k").eqNullSafe(F.col("__key"))).where(F.col(order) > F.col("__first")).select(order), "later")
    return df.join(small_side(later), order, "left_anti")
