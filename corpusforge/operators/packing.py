"""Sequence packing: all texts' tokens one after the other, cut into blocks of one size; the tail is dropped.

A running sum over all rows needs no single task: ranges of positions are summed first and start where the ranges before them end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import position_rank


def offsets(df: DataFrame, position: str, length: Column) -> DataFrame:
    """df plus token_start and token_end (exclusive) in the whole stream; each text has `length` tokens and one end."""
    sized = df.withColumn("__n", length.cast("long") + 1)
    return position_rank(sized, [], position, "token_start", weight=F.col("__n")).withColumn("token_end", F.col("token_start") + F.col("__n")).drop("__n")


def report(df: DataFrame, length: Column, block: int) -> DataFrame:
    """Tokens, whole blocks, tail and use in percent."""
    total = F.coalesce(F.sum(length.cast("long") + 1), F.lit(0))
    out = df.agg(total.alias("total_tokens")).withColumn("blocks", F.floor(F.col("total_tokens") / block).cast("long"))
    tail = F.col("total_tokens") - F.col("blocks") * block
    return out.withColumns({"tail_waste": tail, "utilisation": F.round(F.when(F.col("total_tokens") > 0, (F.col("total_tokens") - tail) * 100.0 / F.col("total_tokens")).otherwise(0.0), 4)})


def block_spans(packed: DataFrame, keep: list[str], block: int, total: DataFrame | None = None) -> DataFrame:
    """Which part of which text stands in which block: (keep, block, text_from, text_to, at). Only whole blocks; `total` is `report`'s row."""
    first, last = F.floor(F.col("token_start") / block), F.floor((F.col("token_end") - 1) / block)
    spans = packed.select(*keep, "token_start", "token_end", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("token_start"), F.col("block") * block)
    end = F.least(F.col("token_end"), (F.col("block") + 1) * block)
    out = spans.select(*keep, "block", (start - F.col("token_start")).alias("text_from"), (end - F.col("token_start")).alias("text_to"), (start - F.col("block") * block).alias("at"))
    return out if total is None else out.join(total.select(F.col("blocks").alias("__blocks"))).where("block < __blocks").drop("__blocks")


def pack_tokens(df: DataFrame, position: str, tokens: str, end: int, block: int) -> DataFrame:
    """(block, tokens): arrays of `block` token ids. A block gathers no more than its own `block` ids."""
    ids = F.concat(F.col(tokens), F.array(F.lit(end)))
    placed = offsets(df.select(F.col(position).alias("__p"), ids.alias("__ids")), "__p", F.size("__ids") - 1)
    spans = placed.select("__ids", "token_start", "token_end", F.explode(F.sequence(F.floor(F.col("token_start") / block), F.floor((F.col("token_end") - 1) / block))).alias("block"))
    start = F.greatest(F.col("token_start"), F.col("block") * block)
    part = F.slice("__ids", (start - F.col("token_start") + 1).cast("int"), (F.least(F.col("token_end"), (F.col("block") + 1) * block) - start).cast("int"))
    gathered = spans.select("block", start.alias("start"), part.alias("part")).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("parts"))
    return gathered.select(F.col("block").cast("long"), F.flatten(F.transform("parts", lambda p: p["part"])).alias("tokens")).where(F.size("tokens") == block)
