"""python -m corpusforge: clean raw tables into one folder for each type, with a report."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import cleaning
from .sources import io


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusforge", description=__doc__)
    p.add_argument("--abstracts", nargs="*", default=[], help="raw tables with a title, an abstract and, if there is one, a category")
    p.add_argument("--cases", nargs="*", default=[], metavar="SUBSET=PATH", help="raw patient cases by subset")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--skip-abstracts", action="store_true", help="leave the abstracts out")
    p.add_argument("--skip-cases", action="store_true", help="leave the patient cases out")
    p.add_argument("--id-prefix", default=cleaning.RECORD_PREFIX, help="what the ids of abstracts start with")
    p.add_argument("--quiet", action="store_true")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusforge").getOrCreate()
    annotated = cases = None
    if args.abstracts and not args.skip_abstracts:
        raw = io.require(io.read_any(spark, args.abstracts), "abstracts")
        roles = cleaning.detect_columns(raw.columns)
        named = raw.select(*[F.col(f"`{c}`").alias(r) for r, c in roles.items() if c])
        indexed = io.with_index(named, named.columns)
        annotated = cleaning.annotate(indexed, category="category" if roles["category"] else None)
        io.write_by_type(cleaning.clean_records(annotated, args.id_prefix), f"{args.output_dir}/abstracts")
    if args.cases and not args.skip_cases:
        for pair in args.cases:
            subset, _, path = pair.partition("=")
            rows = io.read(spark, path)
            part = cleaning.clean_cases(io.with_index(rows, ["patient_note"]), subset, patient="patient_id" if "patient_id" in rows.columns else None)
            cases = part if cases is None else cases.unionByName(part)
        io.write_by_type(cases, f"{args.output_dir}/cases", "subset")
    if annotated is not None:
        io.write_report(cleaning.cleaning_report(annotated, cases), f"{args.output_dir}/report")
        if not args.quiet:
            cleaning.drop_counts(annotated).orderBy("drop_reason").show(truncate=False)


if __name__ == "__main__":
    main()
