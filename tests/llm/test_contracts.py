"""Each opN_ query over whole tables: the columns and types that it owes, a row for each document, and what follows from the texts alone."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import queries

OWED = {
    "op1_decontamination": {"doc_id": "bigint", "leaked": "boolean", "n_items": "bigint", "item_ids": "array<bigint>"},
    "op2_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op3_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_media_columns": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op6_secret_scans": {"doc_id": "bigint", "n_candidates": "bigint", "n_secrets": "bigint"},
    "op7_minhash_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op9_license_scans": {"doc_id": "bigint", "license": "string", "license_score": "double", "license_file": "boolean", "effective_license": "string"},
    "op10_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    """The smallest tables, with a document that has no id and no text, an empty one, and a repeated row."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    null = {f.name: None for f in docs.schema.fields}
    more = spark.createDataFrame([tuple(null.values()), tuple((null | {"doc_id": 10**6, "text": ""}).values()), tuple(docs.first())], docs.schema)
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder), [(r.doc_id, r.text) for r in docs.unionByName(more).select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(OWED))
def test_contract(spark, tables, name):
    folder, docs = tables
    df = queries.QUERIES[name](spark, folder)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in OWED[name]} == OWED[name]
    rows = df.collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, (i for i, _ in docs)))
    raw = {i: (t or "").encode() for i, t in docs}
    remainder = lambda i, m: zlib.crc32(str(i).encode()) % m
    for r in rows:
        text = raw[r.doc_id]
        if name == "op2_token_counts":
            assert r.n_bytes == len(text) and r.over_limit == (r.n_tokens > 1024)
        elif name == "op3_sharding":
            assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key") and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        elif name == "op4_toxicity":
            assert r.held_out == (r.doc_id is None or remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        elif name == "op5_media_columns":
            payload = text + bytes(-len(text) % 64 or 64 * (not text))
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        elif name == "op8_lm_scoring":
            assert r.held_out == (r.doc_id is None or remainder(r.doc_id, 7) == 2) and r.n_known <= r.n_tokens and math.isfinite(r.score) and r.base_score <= 0
    if name == "op3_sharding":
        for shard in range(8):
            slots = sorted(r.slot for r in rows if r.shard == shard)
            assert slots == list(range(len(slots)))
    if name == "op7_minhash_dedup":
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_equal_texts_get_equal_values(spark, tables):
    folder, docs = tables
    text = dict(docs)
    for name in ("op2_token_counts", "op5_media_columns", "op10_sentencepiece"):
        by_text = {}
        for r in queries.QUERIES[name](spark, folder).collect():
            by_text.setdefault(text[r.doc_id] or "", set()).add(repr([v for k, v in r.asDict().items() if k != "doc_id"]))
        assert all(len(v) == 1 for v in by_text.values())


def test_the_model_beats_its_base(spark, sf):
    rows = queries.op8_lm_scoring(spark, sf).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows.s > rows.b
