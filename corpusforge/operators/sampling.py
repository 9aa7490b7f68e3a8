"""Samples with fixed sizes: which rows are drawn hangs on a seed and the rows' keys alone, never on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seeded_hash
from ..runtime import Workspace, small_side
from .ranking import hash_rank, position_rank


def _by_quota(df: DataFrame, stratum: str, quotas: DataFrame, seed: str | int, key: str) -> DataFrame:
    """The first `quota` rows of each stratum in hash order; quotas: (stratum, n, quota), one row for each stratum."""
    ranked = hash_rank(df, [stratum], seed, [key], "__rank", quotas.agg(F.max("n")).first()[0] or 0)
    joined = ranked.join(small_side(quotas.withColumnRenamed(stratum, "__s")), F.col(stratum).eqNullSafe(F.col("__s")))
    return joined.where("__rank <= quota").select(*df.columns)


def _sizes(df: DataFrame, stratum: str) -> DataFrame:
    """(stratum, n, total), counted once and kept as a table of one row for each stratum."""
    every = Window.partitionBy(F.lit(1))  # over the strata's counts, one row each
    return Workspace(df.sparkSession).write(df.groupBy(stratum).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(every)), "sizes")


def proportional(df: DataFrame, stratum: str, most: int, seed: str | int, key: str) -> DataFrame:
    """All rows if there are `most` or fewer, else max(1, int(n * most / total)) of each stratum; their sum may pass `most`."""
    quota = F.when(F.col("total") <= most, F.col("n")).otherwise(F.greatest(F.lit(1), F.expr(f"n * {most} div total")))
    return _by_quota(df, stratum, _sizes(df, stratum).select(stratum, "n", quota.alias("quota")), seed, key)


def fraction(df: DataFrame, stratum: str, share: float, seed: str | int, key: str, most: int | None = None) -> DataFrame:
    """max(1, int(n * share)) rows of each stratum, `most` at most."""
    quota = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(share))).cast("long")
    return _by_quota(df, stratum, _sizes(df, stratum).select(stratum, "n", (F.least(quota, F.lit(most)) if most else quota).alias("quota")), seed, key)


def source_cap(df: DataFrame, stratum: str, most: int, seed: str | int, key: str) -> DataFrame:
    """min(n, max(1, round(most * n / total))) of each stratum (half to even), then a random trim to `most`; all rows if there are no more than that."""
    quota = F.when(F.col("total") <= most, F.col("n")).otherwise(F.least(F.greatest(F.lit(1), F.bround(F.lit(float(most)) * F.col("n") / F.col("total"))), F.col("n"))).cast("long")
    sizes = _sizes(df, stratum).select(stratum, "n", quota.alias("quota"))
    drawn = _by_quota(df, stratum, sizes, seed, key)
    return hash_rank(drawn, [], f"{seed}:trim", [key], "__rank", sizes.agg(F.sum("quota")).first()[0] or 0).where(F.col("__rank") <= most).select(*df.columns)


def equal_quota(df: DataFrame, stratum: str, most: int, seed: str | int, key: str) -> DataFrame:
    """most // k of each of k strata, one more of the largest (most % k of them, ties by name), each as far as it has rows; nothing is handed on."""
    every = Window.partitionBy(F.lit(1))
    place = F.row_number().over(every.orderBy(F.desc("n"), F.col(stratum)))
    k = F.count("*").over(every)
    target = F.floor(F.lit(most) / k) + F.when(place <= F.lit(most) - F.floor(F.lit(most) / k) * k, 1).otherwise(0)
    return _by_quota(df, stratum, _sizes(df, stratum).select(stratum, "n", F.least(F.col("n"), target).cast("long").alias("quota")), seed, key)


def window_slice(df: DataFrame, position: str, previous: int = 0, most: int | None = None) -> DataFrame:
    """Rows number previous..most-1 by position, for incremental runs; all from `previous` on without `most`."""
    ranked = position_rank(df, [], position, "__rank").where(F.col("__rank") > previous)
    return (ranked.where(F.col("__rank") <= most) if most is not None else ranked).drop("__rank")


def head(df: DataFrame, group: list[str], position: str, n: int) -> DataFrame:
    """The first n rows of each group by a unique position."""
    return position_rank(df, group, position, "__rank").where(F.col("__rank") <= n).drop("__rank")


def shuffled(df: DataFrame, seed: str | int, keys: list[str]) -> DataFrame:
    """A repeatable random order, as a range sort."""
    return df.orderBy(seeded_hash(seed, *[F.col(k) for k in keys]), *keys)


def choose(options: Column, k: int, seed: str | int, *keys: Column) -> Column:
    """k of an array of strings for each row, in random order that hangs on the seed, the keys and the option: as an array, without a join."""
    order = F.array_sort(F.transform(options, lambda o: F.struct(seeded_hash(seed, *keys, o).alias("h"), o.alias("o"))))
    return F.transform(F.slice(order, 1, k), lambda s: s["o"])


def half(df: DataFrame, stratum: list[str], seed: str | int, key: str, name: str = "use_tool") -> DataFrame:
    """df plus `name`: true for one half of each stratum (the smaller one where the count is odd)."""
    sizes = df.groupBy(*stratum).agg(F.count("*").alias("__n")) if stratum else df.agg(F.count("*").alias("__n"))
    ranked = hash_rank(df, stratum, seed, [key], "__rank")
    joined = ranked.join(sizes, stratum) if stratum else ranked.join(sizes)
    return joined.withColumn(name, F.col("__rank") * 2 <= F.col("__n")).select(*df.columns, name)
