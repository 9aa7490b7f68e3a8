"""Conversations and messages as arrays of structs: building, checking and profiling them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import seeded_hash
from ..runtime import Workspace
from .ranking import BUCKET_ROWS, hash_digits, numbered

TURN = "struct<`from`:string,value:string,train:boolean>"
CONVERSATION = f"array<{TURN}>"
MESSAGES = "array<struct<role:string,content:string>>"
TURNS = 4
BASE_PROMPT = "You are a domain expert. Answer from the evidence and say where it ends."
ROLES = {"system": "system", "human": "user", "gpt": "assistant"}
PUSHBACKS = (
    "Are you sure? Please check your answer against the evidence.",
    "I doubt that. Can you go over your reasoning once more?",
    "That differs from what I have read. Would you reconsider?",
    "Something in your answer looks wrong. Please re-examine it.",
    "Wait, can you verify that claim and correct it if needed?",
)


def system_prompt(kind: Column | None = None, base: str = BASE_PROMPT) -> Column:
    """The base prompt, with a sentence on the type's topic where there is a type."""
    if kind is None:
        return F.lit(base)
    topic = F.concat(F.lit(base + "\n\nThe topic at hand is "), T.display_name(kind), F.lit("."))
    return F.when(F.coalesce(kind, F.lit("")) == "", base).otherwise(topic)


def turn(role: str, value: Column, train: bool | None = None) -> Column:
    return F.struct(F.lit(role).alias("from"), value.alias("value"), F.lit(train).cast("boolean").alias("train"))


def three_turns(system: Column, human: Column, gpt: Column) -> Column:
    return F.array(turn("system", system), turn("human", human), turn("gpt", gpt))


def correction_turns(system: Column, question: Column, flawed: Column, pushback: Column, correction: Column) -> Column:
    """Five turns; the flawed answer is masked from training."""
    return F.array(turn("system", system), turn("human", question), turn("gpt", flawed, False), turn("human", pushback), turn("gpt", correction))


def first_value(conv: Column, role: str) -> Column:
    """The value of the first turn of a role that isn't empty, '' if there is none."""
    hits = F.filter(conv, lambda t: (t["from"] == role) & (F.coalesce(t["value"], F.lit("")) != ""))
    return F.coalesce(F.get(hits, F.lit(0))["value"], F.lit(""))


def value_at(conv: Column, at: int, role: str) -> Column:
    """The value of turn `at` if it has that role, else ''."""
    t = F.get(conv, F.lit(at))
    return F.when(t["from"] == role, F.coalesce(t["value"], F.lit(""))).otherwise("")


def is_good(conv: Column) -> Column:
    """Every gpt turn is of quality."""
    return F.forall(F.filter(conv, lambda t: t["from"] == "gpt"), lambda t: ~T.is_low_quality(t["value"]))


def to_messages(conv: Column) -> Column:
    """Roles of messages for those of conversations; an unknown role is an error."""
    role = lambda t: F.coalesce(*[F.when(t["from"] == a, b) for a, b in ROLES.items()], F.raise_error(F.concat(F.lit("unknown role: "), F.coalesce(t["from"], F.lit("null")))))
    return F.transform(conv, lambda t: F.struct(role(t).alias("role"), t["value"].alias("content")))


def coalesce_messages(messages: Column, conversations: Column) -> Column:
    """Native messages, else those of conversations."""
    return F.coalesce(messages, to_messages(conversations))


def with_defaults(df: DataFrame, **values: str) -> DataFrame:
    """df with missing data types and types named: data_type 'qa', cancer_type 'unknown', and what else is given."""
    wanted = {"data_type": "qa", "cancer_type": "unknown"} | values
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in wanted if c not in df.columns]).fillna(wanted)


def format_error(conv: Column) -> Column:
    """The first break of system, human, gpt, human, gpt, ...; null if there is none."""
    expected = lambda i: F.when(i == 0, "system").when(i % 2 == 1, "human").otherwise("gpt")
    wrong = F.filter(F.transform(conv, lambda t, i: F.when(~t["from"].eqNullSafe(expected(i)), i)), lambda i: i.isNotNull())
    at = F.get(wrong, F.lit(0))
    return F.when(conv.isNull() | (F.size(conv) < 3), "too few turns").when(
        at.isNotNull(), F.concat(F.lit("turn "), at.cast("string"), F.lit(": expected "), expected(at), F.lit(", got "), F.coalesce(F.get(conv, at)["from"], F.lit("null")))
    )


def strict_format_error(conv: Column) -> Column:
    """format_error, and an even number of turns."""
    return F.coalesce(format_error(conv), F.when(F.size(conv) % 2 == 0, "even number of turns"))


def has_empty_end(conv: Column) -> Column:
    """The last turn says nothing: such rows go, those with other errors are reported and stay."""
    return T.strip(F.coalesce(F.get(conv, F.size(conv) - 1)["value"], F.lit(""))) == ""


def messages_error(messages: Column) -> Column:
    end = F.get(messages, F.size(messages) - 1)
    return (
        F.when(messages.isNull() | (F.size(messages) < 3), "too few messages")
        .when(~F.get(messages, F.lit(0))["role"].eqNullSafe(F.lit("system")) | ~F.get(messages, F.lit(1))["role"].eqNullSafe(F.lit("user")), "starts wrong")
        .when(~end["role"].eqNullSafe(F.lit("assistant")), "ends wrong")
        .when(T.strip(F.coalesce(end["content"], F.lit(""))) == "", "empty end")
    )


def batches(df: DataFrame, group: list[str], seed: str | int, keys: list[str], size: int = TURNS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """df plus batch and slot: rows of a group (a chunk's or a patient's questions) in random order, `size` to a batch.

    The rows are written once: groups of more than `bucket_rows` rows are rare (they are counted first) and are numbered by buckets of their hash; for all others a window over the group does.
    """
    df = Workspace(df.sparkSession).write(df, "items")
    large = df.groupBy(*group).count().where(F.col("count") > bucket_rows)
    most = large.agg(F.max("count")).first()[0]
    if most is None:
        order = Window.partitionBy(*group).orderBy(seeded_hash(seed, *[F.col(k) for k in keys]), *keys)
        place = F.row_number().over(order) - 1
        return df.withColumns({"batch": F.floor(place / size).cast("int"), "slot": (place % size).cast("int")})
    hashed = df.withColumn("__h", seeded_hash(seed, *[F.col(k) for k in keys]))
    marked = hashed.join(F.broadcast(large.select(*group, F.lit(True).alias("__large"))), [hashed[c].eqNullSafe(large[c]) for c in group], "left")  # one row at most in `bucket_rows`
    marked = marked.select(*[hashed[c] for c in hashed.columns], "__large")
    bucket = F.when(F.col("__large"), F.conv(F.substring("__h", 1, hash_digits(most, bucket_rows)), 16, 10).cast("long")).otherwise(F.lit(0))
    place = F.col("__place") - 1
    ranked = numbered(marked, group, bucket, [F.col("__h"), *[F.col(k) for k in keys]], "__place")
    return ranked.withColumns({"batch": F.floor(place / size).cast("int"), "slot": (place % size).cast("int")}).drop("__h", "__large", "__place")


def assemble(df: DataFrame, group: list[str], seed: str | int, keys: list[str], question: str = "question", answer: str = "answer", kind: str = "cancer_type", data_type: str = "qa", size: int = TURNS) -> DataFrame:
    """Multi-turn conversations of up to `size` questions of one group each; (*group, batch, conversations, data_type, `kind`), those of quality only."""
    placed = batches(df, group, seed, keys, size)
    pairs = F.array_sort(F.collect_list(F.struct("slot", F.col(question).alias("q"), F.col(answer).alias("a"))))
    built = placed.groupBy(*dict.fromkeys([*group, kind]), "batch").agg(pairs.alias("__pairs"))  # `size` pairs at most
    turns = F.flatten(F.transform("__pairs", lambda p: F.array(turn("human", p["q"]), turn("gpt", p["a"]))))
    conv = F.concat(F.array(turn("system", system_prompt(F.col(kind)))), turns)
    return built.select(*dict.fromkeys([*group, kind]), "batch", conv.alias("conversations"), F.lit(data_type).alias("data_type")).where(is_good(F.col("conversations")))


def per_action(df: DataFrame, keep: list[str], conv: str = "conversations") -> DataFrame:
    """One row for each gpt turn: the turns before it as prompt, its value as completion, and whether it is trained on."""
    rows = df.select(*keep, conv, F.posexplode(conv).alias("at", "turn")).where(F.col("turn.from") == "gpt")
    return rows.select(*keep, "at", F.slice(F.col(conv), F.lit(1), F.col("at")).alias("prompt"), F.col("turn.value").alias("completion"), F.coalesce("turn.train", F.lit(True)).alias("train"))


def profile(df: DataFrame, data_type: str = "data_type", kind: str = "cancer_type", top: int = 10) -> DataFrame:
    """Counts by data type and type, the `top` types of each."""
    counts = df.groupBy(data_type, kind).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(data_type).orderBy(F.desc("n"), kind))  # over counts
    return counts.withColumn("place", place).where(F.col("place") <= top)


def thinking_share(df: DataFrame, data_type: str = "data_type", conv: str = "conversations") -> DataFrame:
    """Conversations and those with a thinking gpt turn, and each data type's percentage of all."""
    thinks = F.exists(F.filter(conv, lambda t: t["from"] == "gpt"), lambda t: T.has_thinking(t["value"]))
    counts = df.groupBy(data_type).agg(F.count("*").alias("n"), F.count_if(thinks).alias("n_thinking"))
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))


def turn_histogram(df: DataFrame, conv: str = "conversations") -> DataFrame:
    return df.groupBy(F.size(conv).alias("turns")).agg(F.count("*").alias("n"))


def role_sequences(df: DataFrame, conv: str = "conversations", top: int = 5) -> DataFrame:
    roles = F.array_join(F.transform(conv, lambda t: t["from"]), ",")
    return df.groupBy(roles.alias("roles")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "roles").limit(top)


def first_sample(df: DataFrame, group: str, position: str, value: Column) -> DataFrame:
    """The value of each group's first row by position."""
    return df.groupBy(group).agg(F.min_by(value, position).alias("sample"))
