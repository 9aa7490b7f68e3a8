"""The library's functions under names that SQL can call."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .sentences import CHUNK, OVERLAP, fold_chunks, split_sentences


class ChunkText:
    """A table function: (ix, chunk) of a text."""

    def eval(self, text: str, size: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple[int, str]]:
        yield from enumerate(fold_chunks(split_sentences(text), size, overlap))


def register(spark: SparkSession) -> None:
    """SELECT ... FROM docs, LATERAL chunk_text(text, 1500, 2)."""
    from ..runtime import ship_package

    ship_package(spark)
    spark.udtf.register("chunk_text", udtf(ChunkText, returnType="ix int, chunk string"))
