"""Tool-call augmentation of question and answer records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pick, pick_number, seeded_hash
from .conversations import system_prompt, turn
from .preference import make_pair
from .sampling import half

#: Tools that a caller may replace by others.
TOOLS = ("deep_search", "trial_registry", "guideline_lookup", "evidence_search", "literature_index", "product_registry")
TEMPORAL = ("What are the latest updates on this: ", "What is the most recent data since 2025 regarding: ", "According to current guidelines: ")
FAILURE_SHARE = 0.15


def rotate(position: Column, tools: tuple[str, ...] = TOOLS) -> Column:
    """Tools in turn, by a row's position from 0."""
    return F.element_at(F.array(*map(F.lit, tools)), F.pmod(position, F.lit(len(tools))).cast("int") + 1)


def serialize_call(tool: Column, query: Column) -> Column:
    return F.concat(F.lit('<call name="'), tool, F.lit('">'), F.to_json(F.struct(query.alias("query"))), F.lit("</call>"))


def serialize_response(tool: Column, body: Column) -> Column:
    return F.concat(F.lit('<response name="'), tool, F.lit('">\n'), body, F.lit("\n</response>"))


def temporal(question: Column, digest: Column) -> Column:
    """A question that asks for what is new, so that it calls for a tool."""
    return F.concat(pick(TEMPORAL, digest), question)


def snapshot_id(key: Column) -> Column:
    return F.concat(F.lit("TRAINING-SNAPSHOT-"), F.upper(F.substring(F.sha2(key.cast("string"), 256), 1, 12)))


def tool_conversation(question: Column, answer: Column, tool: Column, key: Column, fails: Column, kind: Column | None = None) -> Column:
    """system, question, call, response, answer; a failed call is answered without it."""
    result = F.when(fails, "ERROR: the tool did not answer").otherwise(F.concat(snapshot_id(key), F.lit("\n"), F.left(answer, F.lit(200))))
    final = F.when(fails, F.concat(F.lit("The tool did not answer; from what is known: "), answer)).otherwise(answer)
    prompt = F.concat(system_prompt(kind), F.lit("\n\nTool: "), tool)
    return F.array(turn("system", prompt), turn("human", question), turn("gpt", serialize_call(tool, question)), turn("human", serialize_response(tool, result)), turn("gpt", final))


def augment(df: DataFrame, position: str, key: str, question: str = "question", answer: str = "answer", kind: str | None = None, seed: str | int = 42, failure: float = FAILURE_SHARE) -> DataFrame:
    """df plus use_tool (one half), tool (in rotation), tool_failed and the conversation of each record."""
    rows = half(df, [], seed, key).withColumn("tool", rotate(F.col(position)))
    digest = seeded_hash(f"{seed}:fail", F.col(key))
    fails = F.col("use_tool") & (pick_number(digest, 10_000) < int(failure * 10_000))
    k = F.col(kind) if kind else None
    asked = F.when(F.col("use_tool"), temporal(F.col(question), seeded_hash(f"{seed}:temporal", F.col(key)))).otherwise(F.col(question))
    prompt = F.concat(system_prompt(k), F.lit("\n\nTool: "), F.col("tool"))
    direct = F.array(turn("system", prompt), turn("human", F.col(question)), turn("gpt", F.col(answer)))
    return rows.withColumns({"tool_failed": fails, "conversations": F.when(F.col("use_tool"), tool_conversation(asked, F.col(answer), F.col("tool"), F.col(key), fails, k)).otherwise(direct)})


def tool_pairs(df: DataFrame, keep: list[str], question: Column, answer: Column, tool: Column) -> DataFrame:
    """Pairs that prefer the call to an answer without it."""
    return df.select(*keep, *make_pair(F.concat(system_prompt(), F.lit("\n\nTool: "), tool), question, serialize_call(tool, question), answer))


def multi_document(df: DataFrame, kind: str, position: str, text: str, size: int = 3) -> DataFrame:
    """Neighbouring records of a type as one context of up to `size` texts: (kind, group, context, n)."""
    from .ranking import position_rank

    ranked = position_rank(df, [kind], position, "__rank")
    grouped = ranked.groupBy(kind, F.floor((F.col("__rank") - 1) / size).cast("long").alias("group")).agg(F.array_sort(F.collect_list(F.struct("__rank", F.col(text).alias("t")))).alias("ts"))
    return grouped.select(kind, "group", F.array_join(F.transform("ts", lambda x: x["t"]), "\n\n---\n\n").alias("context"), F.size("ts").alias("n"))


def generation_manifest(df: DataFrame, source: str, seed: int, output: str) -> DataFrame:
    """One JSON row: where the records came from and how many there are of each kind."""
    return df.agg(F.count("*").alias("records"), F.count_if("use_tool").alias("tool_calls"), F.count_if("tool_failed").alias("failures")).select(F.to_json(F.struct(F.lit(source).alias("source"), F.lit(seed).alias("seed"), F.lit(output).alias("output"), "records", "tool_calls", "failures")).alias("manifest"))


__all__ = ["TOOLS", "augment", "generation_manifest", "multi_document", "rotate", "serialize_call", "serialize_response", "snapshot_id", "temporal", "tool_conversation", "tool_pairs"]
