"""Reading and writing collections: JSON lines, CSV, Parquet, reports and manifests. All paths go through Spark, so any store it knows will do."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cleaning import detect_columns
from ..runtime import Workspace

FORMATS = {".csv": "csv", ".jsonl": "json", ".json": "json", ".parquet": "parquet", ".orc": "orc"}


class MissingSource(FileNotFoundError):
    """A source that must be there has no files or no rows."""


def read(spark: SparkSession, path: str, kind: str | None = None, schema: StructType | str | None = None, **options: str) -> DataFrame:
    """A table by its format, which the path's ending gives if not named."""
    kind = kind or next((k for end, k in FORMATS.items() if path.rstrip("/*").endswith(end)), "parquet")
    reader = spark.read.format(kind).options(**({"header": "true", "multiLine": "true", "escape": '"'} if kind == "csv" else {}), **options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_any(spark: SparkSession, paths: Sequence[str], **how) -> DataFrame:
    """The union of those paths that can be read; MissingSource if none can."""
    found = []
    for path in paths:
        try:
            found.append(read(spark, path, **how))
        except AnalysisException:
            continue
    if not found:
        raise MissingSource(f"none of {list(paths)}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_roles(spark: SparkSession, path: str, **how) -> DataFrame:
    """A raw table with its columns renamed to title, abstract and, if there is one, category."""
    df = read(spark, path, **how)
    roles = detect_columns(df.columns)
    return df.select(*[F.col(f"`{c}`").alias(role) for role, c in roles.items() if c is not None])


def with_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """df plus gapless row numbers from 0 in a fixed order, without one task for all: ranges are sorted, counted, and start where the ranges before them end.

    One action counts the ranges' rows (one number for each).
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()})
    ranged = Workspace(df.sparkSession).write(ranged, "ranged")  # a table, not a cache: lost executors lose nothing
    starts, at = [], 0
    for row in ranged.groupBy("__p").count().orderBy("__p").collect():
        starts += [F.lit(row["__p"]), F.lit(at)]
        at += row["count"]
    base = F.create_map(*starts)[F.col("__p")] if starts else F.lit(0)
    return ranged.withColumn(name, (F.col("__m").bitwiseAND((1 << 33) - 1) + base).cast("long")).drop("__p", "__m")


def with_file_key(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """df plus `file_key`: the stem of each row's file, without the given endings."""
    key = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.[^.]*$", "")
    for end in drop:
        key = F.regexp_replace(key, f"{end}$", "")
    return df.withColumn("file_key", key)


def first_with_rows(candidates: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that can be read and has rows."""
    for make in candidates:
        try:
            df = make()
            if not df.isEmpty():
                return df
        except AnalysisException:
            continue
    raise MissingSource("no source has rows")


def require(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise MissingSource(f"{what} has no rows")
    return df


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    if missing := set(needed) - set(df.columns):
        raise MissingSource(f"missing columns: {sorted(missing)}")
    return df


def write_by_type(df: DataFrame, path: str, kind: str = "cancer_type", form: str = "json", mode: str = "overwrite") -> None:
    """One folder for each type."""
    df.write.mode(mode).partitionBy(kind).format(form).save(path)


def write_round(df: DataFrame, path: str, keys: Sequence[str] = ("cancer_type", "round")) -> None:
    """Append a round so that writing it again replaces it and nothing else."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_split(judged: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], validated: str, rejects: str, kind: str) -> None:
    """Both sides of a split from one pass over the judged rows."""
    held = judged.persist()
    try:
        for part, path in zip(split(held), (validated, rejects), strict=True):
            write_by_type(part, path, kind)
    finally:
        held.unpersist()


def write_report(df: DataFrame, path: str) -> None:
    """A one-column table of JSON texts."""
    df.write.mode("overwrite").text(path)


def write_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Write once; later runs read what is there, such as a sample that must not change."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_dataset(df: DataFrame, path: str) -> None:
    """A finished dataset under a path: Parquet, and a manifest with its rows and columns, which comes last and so marks it complete."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    saved = df.sparkSession.read.parquet(f"{path}/data")
    write_manifest(df.sparkSession, f"{path}/manifest.json", {"rows": saved.count(), "columns": [list(c) for c in saved.dtypes]})


def load_dataset(spark: SparkSession, path: str, needed: Sequence[str] = ()) -> DataFrame:
    """What `save_dataset` saved; MissingSource if it is incomplete, has other rows than it says, or lacks a needed column."""
    said = read_manifest(spark, f"{path}/manifest.json")
    if said is None:
        raise MissingSource(f"{path} has no complete dataset")
    df = require_columns(spark.read.parquet(f"{path}/data"), needed)
    if [list(c) for c in df.dtypes] != said["columns"] or df.count() != said["rows"]:
        raise MissingSource(f"{path} isn't what its manifest says")
    return df


def count_lines(spark: SparkSession, path: str, containing: str | None = None) -> int:
    lines = spark.read.text(path)
    return lines.where(F.contains("value", F.lit(containing)) if containing else F.trim("value") != "").count()


def prompt_map(df: DataFrame, kind: str, prompt: Column, position: str) -> DataFrame:
    """One JSON row: each type's first prompt."""
    firsts = df.groupBy(kind).agg(F.min_by(prompt, position).alias("p"))
    return firsts.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, "p"))))).alias("value"))


def write_manifest(spark: SparkSession, path: str, values: dict) -> None:
    """Small driver-side JSON: written beside its place, then renamed over it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    beside = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(values, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    modes = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    modes[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, target, modes)  # a reader finds the old file or the new one, never none


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What `write_manifest` wrote; None if there is no file or no JSON in it."""
    if not exists(spark, path):
        return None
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))
    except ValueError:
        return None


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def training_columns(df: DataFrame, needed: Sequence[str] = ("conversations",), keep: Sequence[str] = ()) -> DataFrame:
    """Only what training reads: the needed columns, which must be there, and those of `keep` that are."""
    require_columns(df, needed)
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*needed, *(k for k in keep if k in df.columns)])])


def publish_by_type(df: DataFrame, path: str, kind: str = "cancer_type", end: str = "") -> None:
    """JSON lines of each type under a name of its own in one folder: <type><end>-<n>.jsonl. Written by partition first, then renamed, one file after the other."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    beside, target = jvm.org.apache.hadoop.fs.Path(path + ".parts"), jvm.org.apache.hadoop.fs.Path(path)
    write_by_type(df.withColumn("__kind", F.col(kind)), path + ".parts", "__kind")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for folder in fs.listStatus(beside):
        name = folder.getPath().getName()
        if folder.isDirectory():
            for n, part in enumerate(sorted(str(p.getPath()) for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-"))):
                fs.rename(jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(f"{path}/{name.partition('=')[2]}{end}-{n}.jsonl"))
    fs.delete(beside, True)
