"""Gates on generated answers: quality profiles, grounding verdicts, failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


class GateFailed(RuntimeError):
    """A statistical gate stops the pipeline."""


def quality_profile(df: DataFrame, kind: str, answer: str) -> DataFrame:
    """By type: answers, percentage that think and that have a marker, average length, status (PASS from 80, WARN from 50 percent thinking)."""
    a = F.col(answer)
    pct = lambda c: F.round(F.count_if(c) * 100.0 / F.count("*"), 4)
    out = df.groupBy(kind).agg(F.count("*").alias("total"), pct(T.mentions_thinking(a)).alias("think_pct"), pct(T.has_marker(a)).alias("marker_pct"), F.floor(F.avg(F.length(T._text(a)))).cast("long").alias("avg_len"))
    return out.withColumn("status", F.when(F.col("think_pct") >= 80, "PASS").when(F.col("think_pct") >= 50, "WARN").otherwise("FAIL"))


def quality_gate(profile: DataFrame) -> DataFrame:
    """One row over all types, each weighted by its answers: think_pct, marker_pct, gate (fail below 50, warn below 80) and marker_gate (warn below 70)."""
    weighted = lambda c: F.round(F.sum(F.col("total") * F.col(c)) / F.sum("total"), 4)
    out = profile.agg(F.sum("total").alias("total"), weighted("think_pct").alias("think_pct"), weighted("marker_pct").alias("marker_pct"))
    return out.withColumns({"gate": F.when(F.col("think_pct") < 50, "fail").when(F.col("think_pct") < 80, "warn").otherwise("pass"), "marker_gate": F.when(F.col("marker_pct") < 70, "warn").otherwise("pass")})


def check_gate(gate: DataFrame) -> None:
    row = gate.first()
    if row is None or row.gate == "fail":
        raise GateFailed(f"thinking share {row and row.think_pct} is below 50")


def verdicts(df: DataFrame, answer: str, reply: Column, strict: bool = False) -> DataFrame:
    """df plus grounding_verdict: leaked_reference before any judge is asked, else what the judge's reply says. A missing reply counts as grounded."""
    return df.withColumn("grounding_verdict", F.when(T.is_leaked(F.col(answer), strict), "leaked_reference").otherwise(T.parse_verdict(reply)))


def judged_text(answer: Column) -> Column:
    """What the judge reads: the answer without its thinking, or all of it if too little is left."""
    bare = T.strip_thinking(answer)
    return F.when(F.length(bare) < 30, answer).otherwise(bare)


def split_verdicts(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(validated, rejects): leaked answers are in neither."""
    return judged.where("grounding_verdict IN ('grounded', 'extrapolated')"), judged.where("grounding_verdict = 'hallucinated'")


def verdict_counts(judged: DataFrame, kind: str) -> DataFrame:
    """Verdicts by type, the hallucination rate in percent of the judged, and whether it warns (over 20)."""
    v = F.col("grounding_verdict")
    out = judged.groupBy(kind).agg(*[F.count_if(v == name).alias(name) for name in ("grounded", "extrapolated", "hallucinated", "leaked_reference")])
    n = F.col("grounded") + F.col("extrapolated") + F.col("hallucinated")
    return out.withColumn("rate", F.round(F.when(n > 0, F.col("hallucinated") * 100.0 / n).otherwise(0.0), 4)).withColumn("warns", F.col("rate") > 20)


def failure_rates(df: DataFrame, phase: str = "phase", status: str = "status", fatal: float = 0.95, samples: int = 5) -> DataFrame:
    """By phase: calls, errors, timeouts, whether the share of failures is fatal, and the first few error texts by name."""
    failed = F.col(status) != "ok"
    out = df.groupBy(phase).agg(F.count("*").alias("calls"), F.count_if(F.col(status) == "error").alias("errors"), F.count_if(F.col(status) == "timeout").alias("timeouts"))
    return out.withColumn("fatal", (F.col("errors") + F.col("timeouts")) / F.col("calls") >= fatal) if "message" not in df.columns else out.withColumn("fatal", (F.col("errors") + F.col("timeouts")) / F.col("calls") >= fatal).join(
        df.where(failed & F.col("message").isNotNull()).groupBy(phase, "message").count().groupBy(phase).agg(F.slice(F.array_sort(F.collect_set(F.left("message", F.lit(300)))), 1, samples).alias("samples")), phase, "left"
    )


def check_failures(rates: DataFrame) -> None:
    bad = rates.where("fatal").limit(1).collect()
    if bad:
        raise GateFailed(f"{bad[0][0]}: {bad[0].errors + bad[0].timeouts} of {bad[0].calls} calls failed")
