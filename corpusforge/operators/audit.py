"""Audits of finished conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import pick_number, seeded_hash

#: Phrases that speak of material that must stand in the turns before.
PHANTOM = ("the abstract", "the provided text", "the tool result", "the search results", "the image", "the attached", "as shown above")
NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def first_sentence(text: Column) -> Column:
    """The lower-cased first sentence, words and single blanks only."""
    bare = F.regexp_replace(F.lower(T.strip(F.regexp_replace(T._text(text), r"(?s)[.!?\n].*$", ""))), r"[^a-z0-9 ]", "")
    return F.trim(F.regexp_replace(bare, r" +", " "))


def first_words(text: Column, n: int = 4) -> Column:
    return F.array_join(F.slice(F.split(first_sentence(text), " "), 1, n), " ")


def opener_frequency(df: DataFrame, group: str, opener: Column, top: int = 10) -> DataFrame:
    """The `top` openers of each group with their share of it in percent."""
    counts = df.groupBy(group, opener.alias("opener")).agg(F.count("*").alias("n"))
    share = F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(group)), 4)  # over counts
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "opener"))
    return counts.withColumns({"percent": share, "place": place}).where(F.col("place") <= top)


def phantom_context(conv: Column) -> Column:
    """Whether a gpt turn speaks of material that no turn before it mentions; a turn without anything before it can only fail."""
    def bad(t: Column, i: Column) -> Column:
        before = F.lower(F.array_join(F.transform(F.slice(conv, F.lit(1), i), lambda x: F.coalesce(x["value"], F.lit(""))), "\n"))
        low = F.lower(F.coalesce(t["value"], F.lit("")))
        return (t["from"] == "gpt") & F.exists(F.array(*map(F.lit, PHANTOM)), lambda p: F.contains(low, p) & ~F.contains(before, p))

    return F.exists(F.transform(conv, lambda t, i: bad(t, i)), lambda x: x)


def unsupported_numbers(answer: Column, evidence: Column) -> Column:
    """The distinct numbers of an answer that its evidence lacks, sorted."""
    found = lambda c: F.expr("array()").cast("array<string>") if c is None else F.regexp_extract_all(T._text(c), F.lit(NUMBER), F.lit(0))
    return F.array_sort(F.array_distinct(F.array_except(found(answer), found(evidence))))


def disjoint_split(source: Column, seed: str | int = 42, train: int = 90, validation: int = 5) -> Column:
    """train, validation or test by a hash of the source: all its records fall on one side."""
    n = pick_number(seeded_hash(seed, source), 100)
    return F.when(n < train, "train").when(n < train + validation, "validation").otherwise("test")


def trainable_share(df: DataFrame, data_type: str = "data_type", conv: str = "conversations") -> DataFrame:
    """By data type: characters in all turns and in gpt turns that are trained on, and the share in percent."""
    size = lambda t: F.length(F.coalesce(t["value"], F.lit(""))).cast("long")
    total = F.aggregate(F.transform(conv, size), F.lit(0).cast("long"), lambda a, x: a + x)
    trained = F.aggregate(F.transform(F.filter(conv, lambda t: (t["from"] == "gpt") & F.coalesce(t["train"], F.lit(True))), size), F.lit(0).cast("long"), lambda a, x: a + x)
    out = df.groupBy(data_type).agg(F.sum(total).alias("chars"), F.sum(trained).alias("trainable"))
    return out.withColumn("percent", F.round(F.when(F.col("chars") > 0, F.col("trainable") * 100.0 / F.col("chars")).otherwise(0.0), 4))


def label_spans(conv: Column) -> Column:
    """For each turn: where its characters start and end in the joined text, and whether they are trained on. Unmasked gpt turns only are."""
    size = lambda t: F.length(F.coalesce(t["value"], F.lit("")))
    start = lambda i: F.aggregate(F.slice(conv, F.lit(1), i), F.lit(0), lambda a, t: a + size(t))
    return F.transform(conv, lambda t, i: F.struct(start(i).alias("start"), (start(i) + size(t)).alias("end"), ((t["from"] == "gpt") & F.coalesce(t["train"], F.lit(True))).alias("train")))


def tool_order_ok(conv: Column) -> Column:
    """Every response comes after a call that no response has used up."""
    balance = F.aggregate(
        F.transform(conv, lambda t: F.coalesce(t["value"], F.lit(""))), F.struct(F.lit(0).alias("open"), F.lit(True).alias("ok")),
        lambda a, v: F.struct((a["open"] + F.regexp_count(v, F.lit("<call name=")) - F.regexp_count(v, F.lit("<response name="))).alias("open"), (a["ok"] & (a["open"] + F.regexp_count(v, F.lit("<call name=")) >= F.regexp_count(v, F.lit("<response name=")))).alias("ok")),
    )
    return balance["ok"]


def dataset_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows and an order-free hash (the sum of 60-bit row hashes modulo 2**61 - 1), the same for any partitioning."""
    digest = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns]), 256)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.pmod(F.coalesce(F.sum(number), F.lit(0)), F.lit((1 << 61) - 1).cast("decimal(38,0)")).cast("long").alias("hash"))


def canary(grounded: DataFrame, stratum: str, each: int, seed: str | int, key: str, evidence: Column, others: list[tuple[DataFrame, int]] | None = None) -> DataFrame:
    """A small balanced set: `each` rows of every stratum with their first evidence sentence, and a fixed number of rows of other kinds."""
    from .ranking import hash_rank

    take = lambda df, group, n: hash_rank(df, group, seed, [key], "__rank").where(F.col("__rank") <= n).drop("__rank")
    parts = [take(grounded, [stratum], each).withColumn("evidence", F.get(evidence, F.lit(0)))] + [take(df, [], n) for df, n in others or []]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def with_provenance(df: DataFrame, **values: str | Column) -> DataFrame:
    """df plus a struct of where each record comes from."""
    return df.withColumn("provenance", F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()]))
