"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame expressions only.

The hash needs 64-bit multiplication that wraps; SQL arithmetic raises on overflow (ANSI mode), so the
generator's state is kept in two 32-bit halves and multiplied by parts that never leave a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Workspace

#: The hash's linear congruential generator.
MULTIPLIER, MODULUS = 2862933555777941757, 18446744073709551616
#: Steps written out before the rare remainder goes through a loop over all shards; a hash over n shards takes about ln(n) steps.
UNROLLED = 3


def _limbs(state: str) -> str:
    """SQL for the next generator state; a state is a struct of two 32-bit halves held in longs, so that no product exceeds 2**62."""
    m_hi, m_lo = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
    p0, p1 = f"(({state}.lo & 65535L) * {m_lo}L)", f"(shiftright({state}.lo, 16) * {m_lo}L)"
    low = f"({p0} + shiftleft({p1} & 65535L, 16) + 1L)"
    cross = lambda part, factor: f"(({part} & 65535L) * {factor}L + shiftleft((shiftright({part}, 16) * {factor}L) & 65535L, 16))"
    high = f"(shiftright({low}, 32) + shiftright({p1}, 16) + {cross(f'{state}.hi', m_lo)} + {cross(f'{state}.lo', m_hi)})"
    return f"named_struct('hi', {high} & 4294967295L, 'lo', {low} & 4294967295L)"


def _step(s: str, n: str) -> str:
    """One jump of the state struct s(g, b, j) while j < n."""
    g = _limbs(f"{s}.g")
    return (
        f"CASE WHEN {s}.j >= {n} THEN {s} ELSE "
        f"transform(array({g}), q -> named_struct('g', q, 'b', {s}.j, 'j', CAST((CAST({s}.j AS DOUBLE) + 1D) * (2147483648D / CAST(shiftright(q.hi, 1) + 1L AS DOUBLE)) AS BIGINT)))[0] END"
    )


def jump_shard(key: str, shards: int) -> Column:
    """Shard 0..shards-1 of the long column `key` (SQL text); NULL counts as key 0.

    One more shard moves rows only into itself. The loop runs as long as a row needs, at most `shards` steps.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    k = f"coalesce(CAST({key} AS BIGINT), 0L)"
    n = f"{shards}L"
    first = f"named_struct('g', named_struct('hi', shiftrightunsigned({k}, 32), 'lo', {k} & 4294967295L), 'b', -1L, 'j', 0L)"
    body = first
    for _ in range(UNROLLED):
        body = f"transform(array({body}), s -> {_step('s', n)})[0]"
    walk = lambda state, steps: f"aggregate(sequence(1, {steps}), {state}, (s, i) -> {_step('s', n)})"
    likely = min(shards, 64 + 4 * shards.bit_length())  # a hash takes about ln(shards) steps; more than this many are as good as impossible, and still counted
    rest = f"transform(array({walk('s', likely)}), s -> CASE WHEN s.j >= {n} THEN s ELSE {walk('s', shards)} END)[0]" if likely < shards else walk("s", shards)
    return F.expr(f"CAST(transform(array({body}), s -> CASE WHEN s.j >= {n} THEN s ELSE {rest} END)[0].b AS INT)")


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id", rows_per_bucket: int = 200_000, rows: int | None = None) -> DataFrame:
    """df plus `shard`, `grown_shard` (with one more shard) and `slot`, the row's gapless position from 0 within its shard.

    Slots: each shard's rows fall into hash buckets of bounded size; a bucket is numbered locally and starts where the buckets before it end, so no task orders a whole shard. The bucket count follows the row count (`rows`, counted if not given).
    A bucket that one key fills beyond four times `rows_per_bucket` (null keys share one key, 0) is cut further by a hash of all columns: only rows that are equal in every column stay together.
    Rows are ordered by bucket, then key, then all other columns, so repeated rows are interchangeable. An empty table gives an empty result; columns called shard, grown_shard or slot are replaced.
    """
    rows = df.count() if rows is None else rows
    buckets = max(64, -(-rows // (rows_per_bucket * shards)))
    clean = df.drop("shard", "grown_shard", "slot")
    k = f"coalesce(CAST(`{key}` AS BIGINT), 0L)"
    mixed = f"pmod(pmod({k}, 2147483629L) * 48271L + 11L, 2147483647L)"  # below 2**47
    placed = clean.withColumns({
        "shard": jump_shard(f"`{key}`", shards),
        "grown_shard": jump_shard(f"`{key}`", shards + 1),
        "__bucket": F.expr(f"CAST(pmod({mixed}, {buckets}L) AS INT)"),
    })
    at = ["shard", "__bucket"]
    sizes = Workspace(df.sparkSession).write(placed.groupBy(*at).agg(F.count("*").alias("__n")), "sizes")  # shards x buckets rows
    hashable = [F.col(f"`{c}`") for c, kind in clean.dtypes if not kind.startswith(("map", "variant"))]
    full = sizes.where(F.col("__n") > 4 * rows_per_bucket)
    if not full.isEmpty():
        cut = full.select(*at, F.ceil(F.col("__n") / rows_per_bucket).alias("__cut"))  # one row at most for so many rows
        placed = placed.join(F.broadcast(cut), at, "left").withColumn("__part", F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.lit(5), *hashable), F.col("__cut")))).drop("__cut")
        at = [*at, "__part"]
        sizes = placed.groupBy(*at).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy(*at[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*at, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    order = [F.col(f"`{key}`"), *(F.col(f"`{c}`") for c, kind in clean.dtypes if c != key and not kind.startswith(("map", "variant")))]
    local = Window.partitionBy(*at).orderBy(*order)
    numbered = placed.withColumn("__row", F.row_number().over(local) - 1)
    return (
        numbered.join(starts, at)
        .withColumn("slot", (F.col("__start") + F.col("__row")).cast("long"))
        .select(*[F.col(f"`{c}`") for c in clean.columns], "shard", "slot", "grown_shard")
    )
