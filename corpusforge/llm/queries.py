"""The queries of this subpackage: each operator over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread
from .oracle import ORACLE_SQL as ORACLE_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    """Columns of all documents, dealt to all cores where the table has fewer parts."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def id_remainder(modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    docs = documents(spark, sf_dir, "doc_id", "text")
    return count_tokens(docs, tokenizer_path("byte_bpe_50k.json"), keep=["doc_id"])


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign_shards

    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents(spark, sf_dir, "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return assign_shards(docs, 8, "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    docs = documents(spark, sf_dir, "doc_id", "text", F.coalesce(id_remainder(3) == 1, F.lit(True)).alias("held_out"))
    return score_toxicity(docs, toxicity_lexicon(spark, sf_dir, docs), keep=["doc_id", "held_out"])


def toxicity_lexicon(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """Learned from labelled rows outside the held-out third.

    The labels are sampled before they meet the texts (they are broadcast if a count finds them few enough), and the labelled texts are written once for the passes over them: the corpus itself is never shuffled.
    """
    from ..runtime import Workspace, small_side
    from .toxicity import SAMPLE_ROWS, learn_lexicon

    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(id_remainder(3) != 1)
    share = max(1, -(-labels.count() // SAMPLE_ROWS))
    sample = labels.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(share)) == 0)
    work = Workspace(spark)
    try:
        return learn_lexicon(work.write(docs.select("doc_id", "text").join(small_side(work.write(sample, "sample")), "doc_id"), "labelled"))
    finally:
        work.close()


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import store_texts

    stored = store_texts(documents(spark, sf_dir, "doc_id", "text"), with_media=False, keep=["doc_id"])
    return stored.withColumn("keyframes", F.array_join(F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"].cast("string"), k["length"].cast("string"))), ","))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_leaks

    return find_leaks(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import default_forest, scan_secrets

    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    return scan_secrets(docs, default_forest(spark), path_col="source").select("doc_id", "n_candidates", "n_secrets", "secrets")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import score_texts

    return score_texts(documents(spark, sf_dir, "doc_id", "text"), id_remainder(7) != 2)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a directory, with a directory for each thousand ids and one for each fifty in it."""
    from .licenses import inherit_licenses, match_licenses

    path = F.format_string("/%s/%d/%d/%d.txt", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50), "doc_id")
    docs = documents(spark, sf_dir, "doc_id", "text", path.alias("path"))
    return inherit_licenses(match_licenses(docs, keep=["doc_id", "path"]))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_bpe import encode_pieces

    return encode_pieces(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path("piece_bpe_32k.model"), with_ids=False, keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontamination, op2_token_counts, op3_sharding, op4_toxicity, op5_media_columns, op6_secret_scans, op7_minhash_dedup, op8_lm_scoring, op9_license_scans, op10_sentencepiece)}
