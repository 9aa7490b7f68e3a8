from pyspark.sql import functions as F

from corpusforge.__main__ import main
from corpusforge.functions import sentences as S
from corpusforge.functions.sql import register


def test_clean_command(spark, tmp_path):
    text = "A sentence of some length about the trial and its results. " * 5
    rows = [("A proper title", text, "Lung Cancer"), ("A proper title", text, "Lung Cancer"), ("x", text, None)]
    spark.createDataFrame(rows, "title string, abstract string, label string").write.parquet(f"{tmp_path}/raw.parquet")
    spark.createDataFrame([("n" * 60, "r", "p1"), ("short", "r", "p2")], "patient_note string, label string, patient_id string").write.parquet(f"{tmp_path}/cases.parquet")
    main(["--abstracts", f"file://{tmp_path}/raw.parquet", "--cases", f"structured=file://{tmp_path}/cases.parquet", "--output-dir", f"file://{tmp_path}/out", "--quiet"], spark)
    assert spark.read.json(f"{tmp_path}/out/abstracts").count() == 1 and spark.read.json(f"{tmp_path}/out/cases").count() == 1
    report = spark.read.text(f"{tmp_path}/out/report").first()[0]
    assert '"total_raw":3' in report and '"structured":1' in report and '"duplicate":1' in report


def test_table_function_equals_expression(spark, sf):
    register(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    docs.createOrReplaceTempView("docs")
    by_sql = spark.sql("SELECT doc_id, ix, chunk FROM docs, LATERAL chunk_text(text, 1500, 2)")
    by_column = docs.select("doc_id", F.posexplode(S.chunks(F.col("text"))).alias("ix", "chunk"))
    assert by_sql.exceptAll(by_column).isEmpty() and by_column.exceptAll(by_sql).isEmpty()
