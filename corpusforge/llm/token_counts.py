"""Token counts by a two-tier lookup on the map side; no pre-token is shuffled.

Tier one is a broadcast table of the lengths (in tokens) of frequent pre-tokens; its size is bounded by `table_size`.
Tier two encodes what the table lacks with the tokenizer itself and keeps the length in the worker's own bounded cache.
What the table holds never changes a count, only how often the tokenizer is called; so it is learned from a bounded sample.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField

from ..runtime import ship_package
from .arrow import append, pieces, texts_of

#: Fixed value: the split of byte-level BPE into pre-tokens; letters first, which changes nothing as only contractions start with an apostrophe.
PRE_TOKENS = r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A worker keeps two generations of so many lengths; longer pre-tokens are never kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64
#: The frequent table: entries, and the documents it is learned from (a hash sample of about so many).
TABLE_SIZE, SAMPLE_DOCS, SAMPLE_TOP = 65_536, 1_024, 4_096


class UnsupportedTokenizer(ValueError):
    """The tokenizer file asks for something that the split into pre-tokens doesn't know."""


def check_file(path: str) -> None:
    """Raise UnsupportedTokenizer unless the file is byte-level BPE without normaliser and prefix blank, with the usual split, and its added tokens are taken as they stand."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    wrong = [
        what for what, bad in (
            ("normaliser", spec.get("normalizer") is not None), ("pre-tokenizer", split.get("type") != "ByteLevel" or not split.get("use_regex", True)), ("prefix blank", bool(split.get("add_prefix_space"))), ("model", model.get("type") != "BPE"),
            ("dropout", bool(model.get("dropout"))), ("added tokens", any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))),
        ) if bad
    ]
    if wrong:
        raise UnsupportedTokenizer(f"{path}: {', '.join(wrong)}")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    check_file(path)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    specials = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return tokenizer, specials


@lru_cache(maxsize=1)
def _splitter():
    return regex.compile(PRE_TOKENS, regex.V1)


class Lengths(dict):
    """Pre-token -> tokens; a miss is encoded and kept while there is room."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encode, self.frequent, self.old, self.most = _tokenizer(path)[0].encode, frequent, {}, len(frequent) + CACHE_ENTRIES

    def __missing__(self, pre_token: str) -> int:
        n = self.old.get(pre_token)
        if n is None:
            n = len(self.encode(pre_token, add_special_tokens=False).ids)
        if len(pre_token) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
                self.update(self.frequent)
            self[pre_token] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, _splitter().findall(text)))


_WORKER: dict[tuple, Lengths] = {}


def _lengths(path: str, table, key: str) -> Lengths:
    """This worker's cache, kept from task to task."""
    if (path, key) not in _WORKER:
        _WORKER.clear()
        _WORKER[path, key] = Lengths(path, unpack(table.value))
    return _WORKER[path, key]


def pack(table: dict[str, int]) -> tuple[bytes, bytes]:
    """Compact: all keys in one blob, parted by NUL-free separators, and their lengths."""
    items = [(k, v) for k, v in sorted(table.items()) if "\0" not in k and v < 256]
    return "\0".join(k for k, _ in items).encode(), bytes(v for _, v in items)


def unpack(packed: tuple[bytes, bytes]) -> dict[str, int]:
    return dict(zip(packed[0].decode().split("\0"), packed[1], strict=True)) if packed[1] else {}


def frequent_lengths(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE_SIZE, sample_docs: int = SAMPLE_DOCS) -> tuple[bytes, bytes]:
    """Lengths of the most frequent pre-tokens in a hash sample of about `sample_docs` rows; each task sends its SAMPLE_TOP at most."""
    share = max(1, df.count() // sample_docs)
    sample = df.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(share)) == 0).select(text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                seen.update(t for t in _splitter().findall(text) if len(t) <= CACHE_CHARS)
                if len(seen) > 50 * SAMPLE_TOP:
                    seen = Counter(dict(seen.most_common(10 * SAMPLE_TOP)))
        top = seen.most_common(SAMPLE_TOP)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], names=["pre_token", "n"])

    total: Counter[str] = Counter()
    for row in sample.mapInArrow(count, "pre_token string, n long").collect():
        total[row.pre_token] += row.n
    encode = _tokenizer(path)[0].encode
    return pack({k: len(encode(k, add_special_tokens=False).ids) for k in heapq.nsmallest(table_size, total, key=lambda k: (-total[k], k))})


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, keep: list[str] | None = None) -> DataFrame:
    """df plus n_bytes (UTF-8), n_tokens (as the tokenizer file counts, without added special tokens) and over_limit (n_tokens > limit).

    Texts are encoded whole. Strings of special tokens inside a text are one token each, as is the library's default.
    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted each; an empty table gives an empty result; clashing columns are replaced.
    """
    spark = df.sparkSession
    ship_package(spark)
    packed = frequent_lengths(df, path, id_col, text_col)
    table, key = spark.sparkContext.broadcast(packed), str(hash(packed))

    def compute(batches: Iterator[pa.RecordBatch]):
        lengths, specials = _lengths(path, table, key), _tokenizer(path)[1]
        cut = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        for batch in batches:
            for rows in pieces(batch, text_col, 8 << 20):
                n_bytes = pc.fill_null(pc.binary_length(rows.column(text_col)), 0).cast(pa.int64())
                counts = []
                for text in texts_of(rows.column(text_col)):
                    if cut and (found := cut.findall(text)):
                        counts.append(len(found) + sum(map(lengths.count, cut.split(text))))
                    else:
                        counts.append(lengths.count(text))
                yield rows, [n_bytes, pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]

    return append(df, [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())], compute, keep)
