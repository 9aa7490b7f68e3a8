"""Preference pairs: building, checking, lengths, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

MIN_ANSWER = 50


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def make_pair(system: Column, user: Column, chosen: Column, rejected: Column) -> tuple[Column, Column]:
    """(chosen, rejected): message arrays with one prompt."""
    prompt = [message("system", system), message("user", user)]
    return F.array(*prompt, message("assistant", chosen)).alias("chosen"), F.array(*prompt, message("assistant", rejected)).alias("rejected")


def pairs(df: DataFrame, system: Column, user: Column, chosen: Column, rejected: Column, source: str, keep: list[str]) -> DataFrame:
    """Pairs of rows whose parts are all there and whose answers have MIN_ANSWER characters or more."""
    there = (F.coalesce(user, F.lit("")) != "") & (F.length(T._text(chosen)) >= MIN_ANSWER) & (F.length(T._text(rejected)) >= MIN_ANSWER)
    return df.where(there).select(*keep, *make_pair(system, user, chosen, rejected), F.lit(source).alias("source"))


def pair_error(chosen: Column, rejected: Column) -> Column:
    return F.when(chosen.isNull() | rejected.isNull(), "missing side").when((F.size(chosen) < 3) | (F.size(rejected) < 3), "too few messages")


def prompt_error(chosen: Column, rejected: Column) -> Column:
    """Whether the prompts (all but the last message) differ, and how."""
    head = lambda m: F.slice(m, F.lit(1), F.greatest(F.size(m) - 1, F.lit(0)))
    return F.when(F.size(chosen) != F.size(rejected), "prompt length").when(~head(chosen).eqNullSafe(head(rejected)), "prompt content")


def common_prefix(a: Column, b: Column) -> Column:
    """The number of messages that both start with."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False)
    return F.when(at == 0, F.least(F.size(a), F.size(b))).otherwise(at - 1).cast("int")


def prefix_ok(a: Column, b: Column) -> Column:
    n = common_prefix(a, b)
    return (n >= 2) & (n < F.size(a)) & (n < F.size(b))


def chat_template(messages: Column, generation_prompt: bool = False) -> Column:
    """Messages as tagged text."""
    body = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>\n"))), "")
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if generation_prompt else body


def render(messages: Column) -> Column:
    """A single assistant message as its content, anything else by the template."""
    only = (F.size(messages) == 1) & (F.get(messages, F.lit(0))["role"] == "assistant")
    return F.when(only, F.get(messages, F.lit(0))["content"]).otherwise(chat_template(messages))


def split_texts(df: DataFrame, keep: list[str]) -> DataFrame:
    """Prompt, chosen and rejected as texts; the prompt is what both sides start with."""
    n = common_prefix(F.col("chosen"), F.col("rejected"))
    tail = lambda c: F.slice(c, n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    return df.select(*keep, chat_template(F.slice(F.col("chosen"), F.lit(1), n), True).alias("prompt"), render(tail(F.col("chosen"))).alias("chosen"), render(tail(F.col("rejected"))).alias("rejected"))


def within_budget(df: DataFrame, most: int, tokens=T.approximate_tokens) -> DataFrame:
    """Pairs whose prompt and longer answer have `most` tokens or fewer."""
    return df.where(tokens(F.col("prompt")) + F.greatest(tokens(F.col("chosen")), tokens(F.col("rejected"))) <= most)


def length_stats(df: DataFrame) -> DataFrame:
    """Whole-number averages and extremes of the three texts, and how many of each side think."""
    out = []
    for c in ("prompt", "chosen", "rejected"):
        n = F.length(c)
        out += [F.floor(F.avg(n)).cast("long").alias(f"{c}_avg"), F.min(n).alias(f"{c}_min"), F.max(n).alias(f"{c}_max")]
    return df.agg(F.count("*").alias("n"), *out, F.count_if(T.has_thinking(F.col("chosen"))).alias("chosen_thinking"), F.count_if(T.has_thinking(F.col("rejected"))).alias("rejected_thinking"))


def source_shares(df: DataFrame) -> DataFrame:
    """Pairs by source, their percentage and its bar."""
    counts = df.groupBy("source").agg(F.count("*").alias("n"))
    percent = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("source", "n", F.round(percent, 4).alias("percent"), T.bar(percent).alias("bar"))


def lookup_chunks(items: DataFrame, chunks: DataFrame, key: str = "chunk_key", position: str = "pos", fallback_to_key: bool = True) -> DataFrame:
    """items plus `chunk` by the chunks' first characters; of chunks with one key the last by position counts. A miss has the key itself, or ''.

    The lookup is one row for each key, so a frequent key in the items is split by the engine, not gathered.
    """
    last = chunks.groupBy(T.key_prefix(F.col("chunk")).alias(key)).agg(F.max_by("chunk", position).alias("chunk"))
    joined = items.drop("chunk").join(last, key, "left")
    return joined.withColumn("chunk", F.coalesce("chunk", F.col(key) if fallback_to_key else F.lit(""), F.lit("")))
