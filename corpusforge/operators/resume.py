"""Resuming: shards with fingerprints, rounds that are done, response tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import exists, read_manifest, write_manifest
from .ranking import position_rank

SHARD = 64


def fingerprint(config: dict) -> str:
    """SHA-256 of a configuration as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def shard_ranges(df: DataFrame, position: str, size: int = SHARD) -> DataFrame:
    """df plus pos (from 0) and shard: ranges of `size` rows by position."""
    ranked = position_rank(df, [], position, "__rank").withColumn("pos", F.col("__rank") - 1)
    return ranked.withColumn("shard", F.floor(F.col("pos") / size).cast("long")).drop("__rank")


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the checkpoint table lacks."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def rounds_to_run(types: list[str], rounds: int, checkpoint: dict[str, dict[int, int]]) -> list[tuple[str, int]]:
    """(type, round) pairs without a checkpoint; rounds that gave no questions never have one."""
    return [(t, r) for t in types for r in range(rounds) if r not in {int(k) for k in checkpoint.get(t, {})}]


class ShardCache:
    """Results by shard under a path: computed once, checked when read, computed again where a shard is missing, short or of another configuration."""

    def __init__(self, spark: SparkSession, path: str, config: dict, size: int = SHARD):
        self.spark, self.path, self.size, self.config = spark, path.rstrip("/"), size, fingerprint(config)

    def _valid(self, expected: DataFrame) -> DataFrame:
        """Shards whose stored rows are as many as expected, each position once."""
        stored = self.spark.read.parquet(f"{self.path}/shards").where(F.col("fingerprint") == self.config)
        have = stored.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("d"))
        return have.join(expected, "shard").where("n = expected AND d = expected").select("shard")

    def run(self, df: DataFrame, position: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """compute's rows for all of df: it gets (df's columns, pos, shard) and must keep pos and shard."""
        sharded = shard_ranges(df, position, self.size)
        expected = sharded.groupBy("shard").agg(F.count("*").alias("expected"))
        todo = sharded.join(self._valid(expected), "shard", "left_anti") if exists(self.spark, f"{self.path}/shards") else sharded
        fresh = compute(todo).withColumn("fingerprint", F.lit(self.config))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{self.path}/shards")
        done = self._valid(expected).count()
        total = expected.count()
        write_manifest(self.spark, f"{self.path}/manifest.json", {"fingerprint": self.config, "shards": done, "expected": total, "status": "complete" if done == total else "partial"})
        if done != total:
            raise RuntimeError(f"{total - done} of {total} shards are incomplete")
        return self.spark.read.parquet(f"{self.path}/shards").where(F.col("fingerprint") == self.config)

    def manifest(self) -> dict | None:
        return read_manifest(self.spark, f"{self.path}/manifest.json")
