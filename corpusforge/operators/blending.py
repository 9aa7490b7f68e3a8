"""Blending pools of conversations to target shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import hash_rank

#: Published blends: the full pipeline's, and the documented alternative.
BLEND = {"qa": 0.42, "treatment_reasoning": 0.15, "beyond_evidence": 0.05, "self_correction": 0.05, "continuation": 0.33}
ALTERNATIVE = {"qa": 0.40, "treatment_reasoning": 0.20, "beyond_evidence": 0.20, "continuation": 0.20}


class NoQuestions(RuntimeError):
    """The qa pool, from which all sizes follow, is empty."""


def union_pools(pools: list[DataFrame], dedup_on: list[str] | None = None) -> DataFrame:
    """All rows of pools with differing columns, as a bag; without repetitions of `dedup_on`, if given."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pools)
    return rows.dropDuplicates(dedup_on) if dedup_on else rows


def targets(sizes: dict[str, int], shares: dict[str, float]) -> dict[str, int]:
    """Rows wanted of each type: int(T * share) with T = int(n_qa / share_qa). Types without rows are left out and the rest isn't scaled up."""
    if not sizes.get("qa"):
        raise NoQuestions("no qa rows")
    active = {k: s for k, s in shares.items() if sizes.get(k)}
    total = int(sizes["qa"] / active.get("qa", BLEND["qa"]))
    return {k: int(total * s) for k, s in active.items()}


def blend(df: DataFrame, seed: str | int, key: str, data_type: str = "data_type", shares: dict[str, float] | None = None) -> DataFrame:
    """Rows of each type to its target: a sample where there are enough, else whole repetitions and a sample for the rest. df plus `copy` from 1.

    One action counts the types (one row each).
    """
    sizes = {r[0]: r[1] for r in df.groupBy(data_type).count().collect()}
    wanted = targets(sizes, shares or BLEND)
    ranked = hash_rank(df.where(F.col(data_type).isin(list(wanted))), [data_type], seed, [key], "__rank")
    t = F.create_map(*[F.lit(x) for k, v in wanted.items() for x in (k, v)])[F.col(data_type)]
    n = F.create_map(*[F.lit(x) for k in wanted for x in (k, sizes[k])])[F.col(data_type)]
    copies = (F.floor(t / n) + F.when(F.col("__rank") <= t % n, 1).otherwise(0)).cast("int")
    return ranked.select(*df.columns, F.posexplode(F.array_repeat(F.lit(1), copies)).alias("__c", "__one")).withColumn("copy", F.col("__c") + 1).drop("__c", "__one")
