"""A corpus pipeline of five stages; each takes and returns documents, and the last one their token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import queries
from corpusforge.llm.decontam import find_leaks
from corpusforge.llm.neardup import near_duplicates
from corpusforge.llm.piece_bpe import encode_pieces
from corpusforge.llm.secrets import default_forest, scan_secrets
from corpusforge.llm.toxicity import score_toxicity
from corpusforge.runtime import Workspace, small_side

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled ones, does not reject."""
    lexicon = queries.toxicity_lexicon(spark, sf_dir, docs)
    return score_toxicity(docs, lexicon).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id. Of rows under one id the one with the smallest text stays (then language, source, length). Those without an id stay."""
    work = Workspace(spark)
    gone = work.write(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "gone")
    left = docs.join(small_side(gone), "doc_id", "left_anti").select(*COLUMNS)
    again = work.write(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return left
    several = left.join(small_side(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return left.join(small_side(again), "doc_id", "left_anti").select(*COLUMNS).unionByName(several)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return find_leaks(docs, queries.table(spark, sf_dir, "benchmark")).where("NOT leaked").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret masked in the text."""
    scanned = scan_secrets(docs, default_forest(spark), path_col="source", redact=True)
    return scanned.withColumns({"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids of each document."""
    pieces = encode_pieces(docs.select("doc_id", "text"), queries.tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"])
    return pieces.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", mask_secrets),
    ("sentencepiece", encode),
]

#: SQL has no word for learned lexicons, forests or merges: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`, each written and read again in the shared work folder."""
    work = Workspace(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            work.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
