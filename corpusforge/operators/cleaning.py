"""Cleaning: column roles, the drop cascade, dedup and its reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from ..runtime import Workspace, ship_package, small_side

MIN_TITLE, MIN_ABSTRACT, MAX_ABSTRACT, MIN_NOTE, MIN_NOTE_USED = 10, 200, 15_000, 50, 100
REASONS = ("no_title", "short_abstract", "too_long", "retracted", "non_english", "duplicate")
#: What ids and report keys start with, unless the caller names something else.
RECORD_PREFIX, CASE_PREFIX, RECORD_REPORT, CASE_REPORT = "record", "case", "records", "cases"
CATEGORY_NAMES = ("label", "cancer", "type", "category")


class MissingColumns(ValueError):
    """No columns could be found for the roles."""


def detect_columns(columns: Sequence[str]) -> dict[str, str | None]:
    """Roles by parts of lower-cased names: title, else abstract, else category; the last match wins, the first and second column stand in."""
    roles: dict[str, str | None] = {"title": None, "abstract": None, "category": None}
    for c in columns:
        low = c.lower()
        role = "title" if "title" in low else "abstract" if "abstract" in low else "category" if any(n in low for n in CATEGORY_NAMES) else None
        if role:
            roles[role] = c
    if roles["title"] is None and columns:
        roles["title"] = columns[0]
    if roles["abstract"] is None and len(columns) > 1:
        roles["abstract"] = columns[1]
    if roles["title"] is None or roles["abstract"] is None:
        raise MissingColumns(f"no title or abstract among {list(columns)}")
    return roles


def drop_reason(title: Column, abstract: Column) -> Column:
    """The first rule that a record fails, null if none; cheap rules first. Duplicates are found afterwards."""
    return (
        F.when(F.length(title) < MIN_TITLE, "no_title").when(F.length(abstract) < MIN_ABSTRACT, "short_abstract").when(F.length(abstract) > MAX_ABSTRACT, "too_long")
        .when(T.is_retracted(title, abstract), "retracted").when(~T.is_english(abstract), "non_english")
    )


def _reason_of(title: str, abstract: str) -> str | None:
    """`drop_reason` for one normalised record in Python."""
    if len(title) < MIN_TITLE:
        return "no_title"
    if len(abstract) < MIN_ABSTRACT:
        return "short_abstract"
    if len(abstract) > MAX_ABSTRACT:
        return "too_long"
    if T.is_retracted_text(title, abstract):
        return "retracted"
    return None if T.is_english_text(abstract) else "non_english"


def normalised(df: DataFrame, title: str, abstract: str, category: str | None, index: str, entities: bool = True) -> DataFrame:
    """(idx, title, abstract, cancer_type, reason, fp): each record normalised once, with the rule it fails or the fingerprint of its abstract. One pass, on Arrow batches."""
    ship_package(df.sparkSession)
    texts = df.select(F.col(index).alias("idx"), F.col(title).alias("title"), F.col(abstract).alias("abstract"), (T.category(F.col(category)) if category else F.lit("unknown")).alias("cancer_type"))
    schema = StructType([*texts.schema.fields, StructField("reason", StringType()), StructField("fp", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            titles, abstracts = ([T.normalize_text(t, entities) for t in batch.column(k).to_pylist()] for k in (1, 2))
            reasons = list(map(_reason_of, titles, abstracts))
            prints = [T.fingerprint_text(a) if r is None else None for a, r in zip(abstracts, reasons, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (titles, abstracts)), batch.column(3), *(pa.array(x, pa.string()) for x in (reasons, prints))], names=schema.names)

    return texts.mapInArrow(run, schema)


def annotate(df: DataFrame, title: str = "title", abstract: str = "abstract", category: str | None = "category", index: str = "idx", entities: bool = True, work: Workspace | None = None) -> DataFrame:
    """(idx, title, abstract, cancer_type, drop_reason): normalised records with the reason why each goes, null for those that stay.

    Of records with one fingerprint that pass all rules, the one with the smallest `index` (unique) stays. The normalised records are written once; of them only fingerprints are shuffled, and the
    indexes of later copies come back by a broadcast if they are few, so no text is shuffled. The tables are in `work`, if given, which the caller closes once the result is used.
    """
    work = work or Workspace(df.sparkSession)
    ruled = work.write(normalised(df, title, abstract, category, index, entities), "normalised")
    passed = ruled.where("reason IS NULL").select("idx", "fp")
    firsts = work.write(passed.groupBy("fp").agg(F.min("idx").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")  # a fingerprint with a third of all rows is one row here
    later = work.write(passed.join(small_side(firsts), "fp").where("idx > first").select("idx", F.lit(True).alias("__later")), "later")
    joined = ruled.join(small_side(later), "idx", "left")
    return joined.select("idx", "title", "abstract", "cancer_type", F.when(F.col("__later"), "duplicate").otherwise(F.col("reason")).alias("drop_reason"))


def clean_records(annotated: DataFrame, prefix: str = RECORD_PREFIX) -> DataFrame:
    """The clean records of annotated ones; ids are the prefix, the type and the index."""
    passage = F.concat("title", F.lit("\n\n"), "abstract")
    kept = annotated.where("drop_reason IS NULL").withColumn("passage", passage)
    return kept.select(
        F.format_string(f"{prefix}_%s_%d", "cancer_type", "idx").alias("id"), "title", "abstract", "passage", "cancer_type",
        F.length("passage").alias("char_count"), T.word_count(F.col("passage")).alias("word_count"),
    )


def drop_counts(annotated: DataFrame) -> DataFrame:
    """(drop_reason, n): rows by reason, 'kept' for the clean ones."""
    return annotated.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))


def type_report(annotated: DataFrame) -> DataFrame:
    """Raw and clean counts and the whole-number average length of clean passages, by type."""
    kept = F.col("drop_reason").isNull()
    size = F.length("title") + F.length("abstract") + 2
    return annotated.groupBy("cancer_type").agg(
        F.count("*").alias("n_raw"), F.count_if(kept).alias("n_clean"),
        F.floor(F.coalesce(F.sum(F.when(kept, size)), F.lit(0)) / F.greatest(F.count_if(kept), F.lit(1))).cast("long").alias("avg_chars"),
    )


def cleaning_report(annotated: DataFrame, cases: DataFrame | None = None, key: str = RECORD_REPORT, cases_key: str = CASE_REPORT) -> DataFrame:
    """One row with the JSON report of a run, its parts under `key` and `cases_key`."""
    as_map = lambda df, k, v: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias("m"))  # noqa: E731  one entry for each type or reason
    types = annotated.groupBy("cancer_type").agg(F.count("*").alias("raw"), F.count_if(F.col("drop_reason").isNull()).alias("clean"))
    raw = as_map(types, "cancer_type", "raw").select(F.col("m").alias("per_type_raw"))
    clean = as_map(types, "cancer_type", "clean").select(F.col("m").alias("per_type_clean"))
    dropped = as_map(annotated.where("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count("*").alias("n")), "drop_reason", "n").select(F.col("m").alias("dropped"))
    totals = annotated.agg(F.count("*").alias("total_raw"), F.count_if(F.col("drop_reason") == "duplicate").alias("dedup_removed"), F.count_if(F.col("drop_reason").isNull()).alias("total_clean"))
    one = raw.join(clean).join(dropped).join(totals)  # one row each
    report = F.struct("total_raw", "per_type_raw", "per_type_clean", "dropped", "dedup_removed", "total_clean").alias(key)
    if cases is None:
        return one.select(F.to_json(F.struct(report)).alias("report"))
    subsets = as_map(cases.groupBy("subset").agg(F.count("*").alias("n")), "subset", "n").select(F.col("m").alias(cases_key))
    return one.join(subsets).select(F.to_json(F.struct(report, cases_key)).alias("report"))


def clean_cases(df: DataFrame, subset: str, note: str = "patient_note", label: str = "label", patient: str | None = None, index: str = "idx", prefix: str = CASE_PREFIX) -> DataFrame:
    """Patient cases with a note of MIN_NOTE characters or more."""
    text = T.normalize(F.col(note))
    own = F.format_string(f"{prefix}_{subset}_%d", index)
    rows = df.select((F.coalesce(F.col(patient).cast("string"), own) if patient else own).alias("id"), text.alias("patient_note"), T.normalize(F.col(label)).alias("treatment_recommendation"), F.lit(subset).alias("subset"))
    return rows.withColumn("char_count", F.length("patient_note")).where(F.col("char_count") >= MIN_NOTE)
