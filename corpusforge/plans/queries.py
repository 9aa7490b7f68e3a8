"""Queries over the test tables: each operator as a DataFrame, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sentences as S
from ..functions import text as T
from ..functions.text import pick, seeded_hash
from ..operators import audit, blending, cleaning, judging, multimodal, packing, preference, resume, sampling, tools
from ..operators import conversations as C
from ..operators import generate as G
from ..runtime import spread
from . import oracle as O
from . import pipelines as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- inputs -------------------------------------------------------------------------------------------------------------


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", F.left("text", F.lit(80)).alias("title"), F.col("text").alias("abstract"), "source")
    return cleaning.annotate(spread(docs), category="source", index="doc_id")


def chunk_rows_of(spark: SparkSession, sf: str) -> DataFrame:
    return P.chunk_table(spread(load(spark, sf, "documents").select("doc_id", "text", "source")), "doc_id", "text", "source")


def conversations_of(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, conv): turns in order; every third conversation's answers think."""
    wrapped = F.when((F.col("conv_id") % 3 == 0) & (F.col("role") == "assistant"), F.concat(F.lit("<think>"), F.left("text", F.lit(40)), F.lit("</think>"), "text")).otherwise(F.col("text"))
    role = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    turns = F.array_sort(F.collect_list(F.struct("turn", role.alias("from"), wrapped.alias("value"))))
    rows = load(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value"), F.lit(None).cast("boolean").alias("train"))).alias("conv"))


def qa_of(spark: SparkSession, sf: str) -> DataFrame:
    return P.generate_qa(chunk_rows_of(spark, sf), "doc_id", "source")


def judged_of(spark: SparkSession, sf: str) -> DataFrame:
    labels = load(spark, sf, "labels")
    answer = F.concat("answer", F.when((F.col("doc_id") + F.col("ix")) % 11 == 0, " " + T.LEAKS[2]).otherwise(""))
    reply = F.when(F.col("toxic") == 1, "VERDICT: HALLUCINATED").when(F.col("quality") == 0, "VERDICT: EXTRAPOLATED").when(F.col("quality") == 1, "VERDICT: GROUNDED").otherwise("unclear")
    return judging.verdicts(qa_of(spark, sf).withColumn("answer", answer).join(labels, "doc_id", "left"), "answer", reply)


def pairs_of(spark: SparkSession, sf: str) -> DataFrame:
    """A pair for each conversation with an answer: its first answer against the same backwards."""
    conv = F.col("conv")
    rows = conversations_of(spark, sf).select("conv_id", C.first_value(conv, "human").alias("q"), C.first_value(conv, "gpt").alias("a"))
    kind = F.when(F.col("conv_id") % 4 == 0, "self_correction").otherwise("hallucination")
    out = preference.pairs(rows, C.system_prompt(), F.col("q"), F.col("a"), F.reverse(T.strip_thinking(F.col("a"))), "x", ["conv_id"])
    return out.withColumn("source", kind)


# --- cleaning -----------------------------------------------------------------------------------------------------------


@query(f"WITH {O.CLEAN} SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM annotated GROUP BY 1")
def clean_drop_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_counts(annotated(spark, sf))


@query(f"WITH {O.CLEAN} SELECT cancer_type, count(*) AS n_raw, count(*) FILTER (drop_reason IS NULL) AS n_clean, CAST(floor(coalesce(sum(length(title) + length(abstract) + 2) FILTER (drop_reason IS NULL), 0) / greatest(count(*) FILTER (drop_reason IS NULL), 1)) AS BIGINT) AS avg_chars FROM annotated GROUP BY 1")
def clean_report_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.type_report(annotated(spark, sf))


@query(f"WITH {O.CLEAN} SELECT 'record_' || cancer_type || '_' || idx AS id, title, abstract, title || chr(10) || chr(10) || abstract AS passage, cancer_type, length(title) + length(abstract) + 2 AS char_count, {O.word_count('(title || chr(10) || chr(10) || abstract)')} AS word_count FROM annotated WHERE drop_reason IS NULL")
def clean_records(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_records(annotated(spark, sf))


@query(f"SELECT doc_id, 'case_docs_' || doc_id AS id, length(t) AS char_count FROM (SELECT doc_id, {O.normalize('text')} AS t FROM documents) WHERE length(t) >= 50")
def clean_cases(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", F.col("text").alias("patient_note"), F.lit("").alias("label"))
    return cleaning.clean_cases(docs, "docs", index="doc_id").select(F.regexp_extract("id", r"(\d+)$", 1).cast("long").alias("doc_id"), "id", "char_count")


@query(f"SELECT doc_id, {O.normalize(chr(39) + '  “' + chr(39) + ' || text || ' + chr(39) + '—​ ’  ' + chr(39))} AS text FROM documents")
def normalize_table(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", T.normalize(F.concat(F.lit("  “"), "text", F.lit("—​ ’  "))).alias("text"))


_UNESCAPED = "html"
for _entity, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):  # those that the table has; the ampersand last, so that nothing is decoded twice
    _UNESCAPED = f"regexp_replace({_UNESCAPED}, '&{_entity};?', '{_char}', 'g')"


@query(f"SELECT page_id, {O.normalize(f'nfc_normalize({_UNESCAPED})')} AS text FROM pages")
def html_unescape_pages(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", T.normalize(F.col("html")).alias("text"))


@query(f"SELECT fp, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, {O.fingerprint('text')} AS fp FROM documents) GROUP BY 1 HAVING count(*) > 1")
def fingerprint_groups(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fp"))
    return docs.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {O.fingerprint('text')}")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.ranking import first_per_key

    return first_per_key(load(spark, sf, "documents").select("doc_id", "text"), T.fingerprint(F.col("text")), "doc_id").select("doc_id")


@query(f"SELECT doc_id, coalesce({O.english('text')}, false) AS is_english, regexp_matches(lower(t), {O.q(T.RETRACTION)}) AS is_retracted FROM (SELECT *, text || CASE WHEN doc_id % 7 = 0 THEN ' Withdrawn by the authors' WHEN doc_id % 11 = 0 THEN ' notwithdrawn' ELSE '' END AS t FROM documents)")
def english_and_retraction(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    t = F.concat("text", F.when(F.col("doc_id") % 7 == 0, " Withdrawn by the authors").when(F.col("doc_id") % 11 == 0, " notwithdrawn").otherwise(""))
    return docs.select("doc_id", F.coalesce(T.is_english(F.col("text")), F.lit(False)).alias("is_english"), T.is_retracted(F.lit(""), t).alias("is_retracted"))


@query(f"SELECT {O.category('p_type')} AS category, count(*) AS n FROM part GROUP BY 1")
def category_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").groupBy(T.category(F.col("p_type")).alias("category")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, length(text) AS char_count, {O.word_count('text')} AS word_count, length(text) // 4 AS tokens, substr(text, 1, 100) AS key, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents")
def length_columns(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return load(spark, sf, "documents").select("doc_id", F.length(t).alias("char_count"), T.word_count(t).alias("word_count"), T.approximate_tokens(t).alias("tokens"), T.key_prefix(t).alias("key"), T.preview(t).alias("preview"))


# --- sentences and chunks -----------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, i - 1 AS ix, sents[i] AS sentence FROM (SELECT doc_id, sents, unnest(range(1, len(sents) + 1)) AS i FROM ({O.SENTENCES}))")
def sentence_rows(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", F.posexplode(S.sentences(F.col("text"))).alias("ix", "sentence"))


@query(O.CHUNKS.replace("SELECT doc_id, source, ix - 1 AS ix, cs[ix] AS chunk", "SELECT doc_id, source, ix - 1 AS ix, cs[ix] AS chunk, substr(cs[ix], 1, 100) AS chunk_key", 1))
def chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_rows_of(spark, sf)


@query(f"""SELECT CASE WHEN grouping(d.source) = 1 THEN 'TOTAL' ELSE d.source END AS source, count(DISTINCT d.doc_id) AS records, count(c.doc_id) AS chunks,
  CAST(floor(coalesce(sum(length(chunk)), 0) / greatest(count(c.doc_id), 1)) AS BIGINT) AS avg_chars, count(c.doc_id) * 3 AS est_qa, count(c.doc_id) * 3 // 4 AS est_conversations
  FROM documents d LEFT JOIN ({O.CHUNKS}) c ON d.doc_id = c.doc_id GROUP BY ROLLUP (d.source)""")
def chunk_stats_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return P.chunk_statistics(load(spark, sf, "documents"), chunk_rows_of(spark, sf), "doc_id", "source")


@query(O.TOKEN_CHUNKS)
def token_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", "source", F.posexplode(S.token_chunks(F.col("text"))).alias("ix", "chunk"))


@query(f"SELECT doc_id, ix, {O.pick(P.INSTRUCTIONS, O.order_hash('continue', 'doc_id', 'ix'))} AS instruction, seed, completion, source FROM ({O.SEED_SPLIT}) WHERE length(completion) >= {S.LEAST_COMPLETION}")
def continuation_convs(spark: SparkSession, sf: str) -> DataFrame:
    return P.continuations(load(spark, sf, "documents"), "doc_id", "text", "source").select("doc_id", "ix", "instruction", "seed", "completion", "source")


@query(f"""WITH c AS ({O.CHUNKS}), last AS (SELECT substr(chunk, 1, 100) AS k, max_by(chunk, doc_id * 1000000 + ix) AS chunk FROM c GROUP BY 1)
  SELECT d.doc_id, d.ix, coalesce(last.chunk, d.k) AS chunk FROM (SELECT doc_id, ix, CASE WHEN doc_id % 5 = 0 THEN 'missing' ELSE substr(chunk, 1, 100) END AS k FROM c) d LEFT JOIN last ON d.k = last.k""")
def chunk_key_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunk_rows_of(spark, sf).withColumn("pos", F.col("doc_id") * 1_000_000 + F.col("ix"))
    items = chunks.select("doc_id", "ix", F.when(F.col("doc_id") % 5 == 0, "missing").otherwise(F.col("chunk_key")).alias("chunk_key"))
    return preference.lookup_chunks(items, chunks.select("chunk", "pos")).select("doc_id", "ix", "chunk")


# --- samples ------------------------------------------------------------------------------------------------------------


@query(O.sampled("documents", "source", "doc_id", "7", "CASE WHEN total <= 300 THEN n ELSE greatest(1, n * 300 // total) END"))
def stratified_proportional(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.proportional(load(spark, sf, "documents").select("doc_id", "source"), "source", 300, 7, "doc_id")


@query(O.sampled("orders", "o_orderpriority", "o_orderkey", "7", "greatest(1, floor(n * 0.15))"))
def fraction_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.fraction(load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", 0.15, 7, "o_orderkey")


@query(f"SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (ORDER BY {O.order_hash('7:trim', 'o_orderkey')}, o_orderkey) AS t FROM ({O.sampled('orders', 'o_orderpriority', 'o_orderkey', '7', 'CASE WHEN total <= 997 THEN n ELSE least(n, greatest(1, round_even(997.0 * n / total, 0))) END')})) WHERE t <= 997")
def source_cap_bround(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.source_cap(load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", 997, 7, "o_orderkey")


@query(f"""WITH s AS (SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS place, count(*) OVER () AS k FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)),
  r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {O.order_hash('7', 'doc_id')}, doc_id) AS r FROM documents)
  SELECT r.doc_id, r.source FROM r JOIN s ON r.source = s.source WHERE r.r <= least(s.n, 210 // k + CASE WHEN place <= 210 - 210 // k * k THEN 1 ELSE 0 END)""")
def equal_quota_cap(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.equal_quota(load(spark, sf, "documents").select("doc_id", "source"), "source", 210, 7, "doc_id")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) WHERE r > 100 AND r <= 900")
def slice_window(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.window_slice(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 100, 900)


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 5")
def head_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.head(load(spark, sf, "documents").select("doc_id", "source"), ["source"], "doc_id", 5)


@query(f"""SELECT doc_id, question FROM (SELECT doc_id, question, row_number() OVER (PARTITION BY doc_id ORDER BY {O.order_hash('patient:direct', 'doc_id', 'question')}, question) AS r
  FROM documents, (SELECT unnest({O.strings(P.TREATMENT_QUESTIONS)}) AS question) WHERE length(text) >= 100) WHERE r <= 3""")
def k_of_n_choice(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").where(F.length("text") >= 100).select("doc_id")
    return P.patient_questions(docs, "doc_id").where("question_type = 'direct'").select("doc_id", "question")


@query(f"""SELECT doc_id, replace(template, '{{' || name || '}}', CASE name {' '.join(f"WHEN {O.q(n)} THEN {O.pick(fills, O.order_hash(f'patient:{n}', 'doc_id'))}" for n, (_, fills) in P.WHATIF.items())} END) AS question FROM (
  SELECT doc_id, name, template, row_number() OVER (PARTITION BY doc_id ORDER BY {O.order_hash('patient:whatif', 'doc_id', 'name')}, name) AS r
  FROM documents, (VALUES {', '.join(f'({O.q(n)}, {O.q(t)})' for n, (t, _) in P.WHATIF.items())}) w(name, template) WHERE length(text) >= 100) WHERE r <= 2""")
def whatif_expand(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").where(F.length("text") >= 100).select("doc_id")
    return P.patient_questions(docs, "doc_id").where("question_type = 'whatif'").select("doc_id", "question")


# --- generated sets (by the stub) and their gates -----------------------------------------------------------------------


@query(f"SELECT doc_id, ix, question_ix, question, answer, chunk_key, source FROM ({O.QA})")
def qa_pairs_stub(spark: SparkSession, sf: str) -> DataFrame:
    return qa_of(spark, sf).select("doc_id", "ix", "question_ix", "question", "answer", "chunk_key", "source")


@query(f"""WITH c AS (SELECT *, doc_id * 1000000 + ix AS key FROM ({O.CHUNKS})), s AS ({O.sampled('c', 'source', 'key', 'beyond', 'greatest(1, floor(n * 0.3))')}),
  a AS (SELECT *, {O.stub_question(8, 'question_ix + 1')} AS question FROM (SELECT c.*, unnest([0, 1]) AS question_ix FROM c JOIN s ON c.key = s.key)), b AS (SELECT *, {O.STUB_ANSWER} AS answer FROM a WHERE length(question) > 15)
  SELECT doc_id, ix, question_ix, question, answer, regexp_matches(answer, '(?s)<think>.*?</think>') AS has_thinking FROM b WHERE NOT {O.low_quality('answer')}""")
def beyond_stub(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunk_rows_of(spark, sf).withColumn("key", F.col("doc_id") * 1_000_000 + F.col("ix"))
    return P.beyond_evidence(chunks, "doc_id", "source", "key").select("doc_id", "ix", "question_ix", "question", "answer", "has_thinking")


@query(f"""WITH i AS (SELECT *, doc_id * 1000000 + ix * 10 + question_ix AS key FROM ({O.QA})), s AS ({O.sampled('i', 'source', 'key', 'correct', 'greatest(1, floor(n * 0.15))')}),
  f AS (SELECT i.*, {O.strip("('[synthetic flaw] ' || reverse(substr(chunk, 1, 120)))")} AS flawed, {O.pick(C.PUSHBACKS, O.order_hash('correct:pushback', 'i.key'))} AS pushback FROM i JOIN s ON i.key = s.key),
  g AS (SELECT *, {O.with_reasoning("('Corrected from the source: ' || substr(chunk, 1, 200))", 'pushback')} AS correction FROM f WHERE length(flawed) >= 50)
  SELECT key, flawed, pushback, correction FROM g WHERE NOT {O.low_quality('correction')}""")
def correction_stub(spark: SparkSession, sf: str) -> DataFrame:
    items = qa_of(spark, sf).withColumn("key", F.col("doc_id") * 1_000_000 + F.col("ix") * 10 + F.col("question_ix"))
    conv = F.col("conversations")
    return P.self_corrections(items, "source", "key").select("key", C.value_at(conv, 2, "gpt").alias("flawed"), C.value_at(conv, 3, "human").alias("pushback"), C.value_at(conv, 4, "gpt").alias("correction"))


_ASKED = f"""SELECT doc_id, 'direct' AS question_type, r - 1 AS question_ix, question, text FROM (SELECT doc_id, text, question, row_number() OVER (PARTITION BY doc_id ORDER BY {O.order_hash('patient:direct', 'doc_id', 'question')}, question) AS r
  FROM documents, (SELECT unnest({O.strings(P.TREATMENT_QUESTIONS)}) AS question) WHERE length(text) >= 100) WHERE r <= 3 UNION ALL
  SELECT doc_id, 'whatif', r + 2, replace(template, '{{' || name || '}}', CASE name {' '.join(f"WHEN {O.q(n)} THEN {O.pick(fills, O.order_hash(f'patient:{n}', 'doc_id'))}" for n, (_, fills) in P.WHATIF.items())} END), text FROM (
  SELECT doc_id, text, name, template, row_number() OVER (PARTITION BY doc_id ORDER BY {O.order_hash('patient:whatif', 'doc_id', 'name')}, name) AS r
  FROM documents, (VALUES {', '.join(f'({O.q(n)}, {O.q(t)})' for n, (t, _) in P.WHATIF.items())}) w(name, template) WHERE length(text) >= 100) WHERE r <= 2"""


@query(f"""SELECT doc_id AS patient_id, CAST(question_ix AS INT) AS question_ix, question, answer, substr(text, 1, 100) AS patient_note_key, question_type, regexp_matches(answer, '(?s)<think>.*?</think>') AS has_thinking
  FROM (SELECT *, {O.strip(O.STUB_ANSWER.replace('substr(chunk', 'substr(text'))} AS answer FROM ({_ASKED})) WHERE NOT {O.low_quality('answer')}""")
def treatment_stub(spark: SparkSession, sf: str) -> DataFrame:
    return P.treatment_reasoning(load(spark, sf, "documents"), "doc_id", "text")


_ANSWERS = f"(SELECT conv_id, turn, {O.THINK} AS answer FROM conversations WHERE role = 'assistant')"
_MARKED = O.contains_any("lower(coalesce(answer, ''))", tuple(m.lower() for m in T.MARKERS))


def answers_of(spark: SparkSession, sf: str) -> DataFrame:
    rows = conversations_of(spark, sf).select("conv_id", F.posexplode("conv").alias("turn", "t")).where(F.col("t.from") == "gpt")
    return rows.select("conv_id", "turn", F.col("t.value").alias("answer"), (F.col("conv_id") % 5).alias("kind"))


@query(f"""SELECT kind, total, think_pct, marker_pct, avg_len, CASE WHEN think_pct >= 80 THEN 'PASS' WHEN think_pct >= 50 THEN 'WARN' ELSE 'FAIL' END AS status FROM (
  SELECT conv_id % 5 AS kind, count(*) AS total, round(count(*) FILTER (contains(answer, '<think>')) * 100.0 / count(*), 4) AS think_pct, round(count(*) FILTER ({_MARKED}) * 100.0 / count(*), 4) AS marker_pct, CAST(floor(avg(length(answer))) AS BIGINT) AS avg_len FROM {_ANSWERS} GROUP BY 1)""")
def quality_gate_profile(spark: SparkSession, sf: str) -> DataFrame:
    return judging.quality_profile(answers_of(spark, sf), "kind", "answer")


@query(f"""SELECT total, think_pct, marker_pct, CASE WHEN think_pct < 50 THEN 'fail' WHEN think_pct < 80 THEN 'warn' ELSE 'pass' END AS gate, CASE WHEN marker_pct < 70 THEN 'warn' ELSE 'pass' END AS marker_gate FROM (
  SELECT CAST(sum(total) AS BIGINT) AS total, round(sum(total * think_pct) / sum(total), 4) AS think_pct, round(sum(total * marker_pct) / sum(total), 4) AS marker_pct FROM (
  SELECT conv_id % 5 AS kind, count(*) AS total, round(count(*) FILTER (contains(answer, '<think>')) * 100.0 / count(*), 4) AS think_pct, round(count(*) FILTER ({_MARKED}) * 100.0 / count(*), 4) AS marker_pct FROM {_ANSWERS} GROUP BY 1))""")
def quality_gate_global(spark: SparkSession, sf: str) -> DataFrame:
    return judging.quality_gate(judging.quality_profile(answers_of(spark, sf), "kind", "answer"))


@query(O.VERDICT)
def grounding_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return judged_of(spark, sf).select("doc_id", "ix", "question_ix", "source", F.col("grounding_verdict").alias("verdict"))


@query(f"""SELECT *, rate > 20 AS warns FROM (SELECT *, round(CASE WHEN grounded + extrapolated + hallucinated > 0 THEN hallucinated * 100.0 / (grounded + extrapolated + hallucinated) ELSE 0.0 END, 4) AS rate FROM (
  SELECT source, count(*) FILTER (verdict = 'grounded') AS grounded, count(*) FILTER (verdict = 'extrapolated') AS extrapolated, count(*) FILTER (verdict = 'hallucinated') AS hallucinated, count(*) FILTER (verdict = 'leaked_reference') AS leaked_reference FROM ({O.VERDICT}) GROUP BY 1))""")
def hallucination_rate(spark: SparkSession, sf: str) -> DataFrame:
    return judging.verdict_counts(judged_of(spark, sf), "source")


@query(f"SELECT CASE WHEN verdict = 'hallucinated' THEN 'rejects' ELSE 'validated' END AS side, count(*) AS n FROM ({O.VERDICT}) WHERE verdict <> 'leaked_reference' GROUP BY 1")
def split_validated_rejects(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = judging.split_verdicts(judged_of(spark, sf))
    return good.select(F.lit("validated").alias("side")).unionByName(bad.select(F.lit("rejects").alias("side"))).groupBy("side").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'error' WHEN o_orderstatus = 'P' THEN 'timeout' ELSE 'ok' END IS NOT NULL AS seen, o_orderpriority AS phase, count(*) AS calls, count(*) FILTER (o_orderstatus = 'F') AS errors, count(*) FILTER (o_orderstatus = 'P') AS timeouts, count(*) FILTER (o_orderstatus IN ('F', 'P')) / count(*) >= 0.95 AS fatal FROM orders GROUP BY 1, 2")
def failure_rates(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "error").when(F.col("o_orderstatus") == "P", "timeout").otherwise("ok")
    return judging.failure_rates(load(spark, sf, "orders").select(F.col("o_orderpriority").alias("phase"), status.alias("status"))).withColumn("seen", F.lit(True))


# --- conversations ------------------------------------------------------------------------------------------------------


@query(f"""WITH b AS (SELECT *, (row_number() OVER (PARTITION BY chunk_key, source ORDER BY {O.order_hash('turns', 'doc_id', 'ix', 'question_ix')}, doc_id, ix, question_ix) - 1) AS place FROM ({O.QA}))
  SELECT chunk_key, source, place // 4 AS batch, count(*) AS n_pairs, string_agg(question, '|' ORDER BY place) AS questions FROM b GROUP BY 1, 2, 3""")
def assemble_multi_turn(spark: SparkSession, sf: str) -> DataFrame:
    convs = C.assemble(qa_of(spark, sf), ["chunk_key", "source"], "turns", ["doc_id", "ix", "question_ix"], kind="source")
    asked = F.filter("conversations", lambda t: t["from"] == "human")
    return convs.select("chunk_key", "source", "batch", F.size(asked).cast("long").alias("n_pairs"), F.array_join(F.transform(asked, lambda t: t["value"]), "|").alias("questions"))


@query(f"SELECT conv_id, {O.FORMAT_ERROR} AS error, coalesce({O.FORMAT_ERROR}, CASE WHEN len(conv) % 2 = 0 THEN 'even number of turns' END) AS strict_error, {O.strip('conv[-1].value')} = '' AS empty_end FROM ({O.CONV})")
def format_errors(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("conv")
    return conversations_of(spark, sf).select("conv_id", C.format_error(c).alias("error"), C.strict_format_error(c).alias("strict_error"), C.has_empty_end(c).alias("empty_end"))


@query(f"""SELECT conv_id, CASE WHEN len(conv) < 3 THEN 'too few messages' WHEN conv[1]."from" <> 'system' OR conv[2]."from" <> 'human' THEN 'starts wrong' WHEN conv[-1]."from" <> 'gpt' THEN 'ends wrong' WHEN {O.strip('conv[-1].value')} = '' THEN 'empty end' END AS error FROM ({O.CONV})""")
def messages_format(spark: SparkSession, sf: str) -> DataFrame:
    return conversations_of(spark, sf).select("conv_id", C.messages_error(C.to_messages(F.col("conv"))).alias("error"))


@query(f"SELECT conv_id, list_bool_and(list_transform(conv, lambda t: t.\"from\" <> 'gpt' OR NOT {O.low_quality('t.value')})) AS good, coalesce(list_filter(conv, lambda t: t.\"from\" = 'human' AND t.value <> '')[1].value, '') AS question, CASE WHEN conv[2].\"from\" = 'human' THEN conv[2].value ELSE '' END AS second FROM ({O.CONV})")
def conversation_quality(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("conv")
    return conversations_of(spark, sf).select("conv_id", C.is_good(c).alias("good"), C.first_value(c, "human").alias("question"), C.value_at(c, 1, "human").alias("second"))


@query(f"SELECT len(conv) AS turns, count(*) AS n FROM ({O.CONV}) GROUP BY 1")
def turn_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return C.turn_histogram(conversations_of(spark, sf), "conv")


@query(f"SELECT array_to_string(list_transform(conv, lambda t: t.\"from\"), ',') AS roles, count(*) AS n FROM ({O.CONV}) GROUP BY 1 ORDER BY n DESC, roles LIMIT 5")
def role_sequences_top5(spark: SparkSession, sf: str) -> DataFrame:
    return C.role_sequences(conversations_of(spark, sf), "conv")


@query("SELECT event_type AS data_type, p AS cancer_type, n, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, p) AS place FROM (SELECT event_type, user_id % 37 AS p, count(*) AS n FROM events GROUP BY 1, 2)) WHERE place <= 10")
def dtype_by_type_top10(spark: SparkSession, sf: str) -> DataFrame:
    return C.profile(load(spark, sf, "events").select(F.col("event_type").alias("data_type"), (F.col("user_id") % 37).alias("cancer_type")))


@query("SELECT event_type, min_by(event_id || ':' || user_id, event_id) AS sample FROM events GROUP BY 1")
def first_sample_per_type(spark: SparkSession, sf: str) -> DataFrame:
    return C.first_sample(load(spark, sf, "events"), "event_type", "event_id", F.concat(F.col("event_id").cast("string"), F.lit(":"), F.col("user_id").cast("string")))


@query(f"""SELECT data_type, n, n_thinking, round(n * 100.0 / sum(n) OVER (), 4) AS percent FROM (SELECT conv_id % 4 AS data_type, count(*) AS n,
  count(*) FILTER (list_bool_or(list_transform(list_filter(conv, lambda t: t."from" = 'gpt'), lambda t: regexp_matches(t.value, '(?s)<think>.*?</think>')))) AS n_thinking FROM ({O.CONV}) GROUP BY 1)""")
def percent_of_total(spark: SparkSession, sf: str) -> DataFrame:
    return C.thinking_share(conversations_of(spark, sf).withColumn("data_type", F.col("conv_id") % 4), conv="conv")


@query(f"SELECT conv_id, i - 1 AS at, i - 1 AS prompt_turns, conv[i].value AS completion FROM (SELECT conv_id, conv, unnest(range(1, len(conv) + 1)) AS i FROM ({O.CONV})) WHERE conv[i].\"from\" = 'gpt'")
def prompt_per_action(spark: SparkSession, sf: str) -> DataFrame:
    return C.per_action(conversations_of(spark, sf), ["conv_id"], "conv").select("conv_id", "at", F.size("prompt").alias("prompt_turns"), "completion")


# --- blending -----------------------------------------------------------------------------------------------------------

_POOL = "(SELECT event_id, CASE WHEN event_id % 10 < 5 THEN 'qa' WHEN event_id % 10 < 8 THEN 'continuation' WHEN event_id % 100 = 8 THEN 'beyond_evidence' ELSE 'treatment_reasoning' END AS data_type FROM events)"


def pool_of(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    kind = F.when(e % 10 < 5, "qa").when(e % 10 < 8, "continuation").when(e % 100 == 8, "beyond_evidence").otherwise("treatment_reasoning")
    return load(spark, sf, "events").select("event_id", kind.alias("data_type"))


_BLEND = f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY {O.order_hash('42', 'event_id')}, event_id) AS r, count(*) OVER (PARTITION BY data_type) AS n FROM {_POOL}),
  t AS (SELECT *, CAST(floor(floor((SELECT count(*) FROM p WHERE data_type = 'qa') / CAST(0.42 AS DOUBLE)) * CASE data_type WHEN 'qa' THEN CAST(0.42 AS DOUBLE) WHEN 'continuation' THEN CAST(0.33 AS DOUBLE) WHEN 'treatment_reasoning' THEN CAST(0.15 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END) AS BIGINT) AS target FROM p),
  c AS (SELECT event_id, data_type, target // n + CASE WHEN r <= target % n THEN 1 ELSE 0 END AS copies FROM t)
  SELECT event_id, data_type, unnest(range(1, copies + 1)) AS copy FROM c"""


@query(_BLEND)
def blend_rows(spark: SparkSession, sf: str) -> DataFrame:
    return blending.blend(pool_of(spark, sf), 42, "event_id")


@query(f"SELECT data_type, count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM ({_BLEND}) GROUP BY 1")
def blend_counts(spark: SparkSession, sf: str) -> DataFrame:
    return blend_rows(spark, sf).groupBy("data_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_distinct"))


# --- preference pairs ---------------------------------------------------------------------------------------------------

_PAIRS = f"""SELECT conv_id, q, a, reverse({O.strip_thinking('a')}) AS r, CASE WHEN conv_id % 4 = 0 THEN 'self_correction' ELSE 'hallucination' END AS source FROM (
  SELECT conv_id, coalesce(list_filter(conv, lambda t: t."from" = 'human' AND t.value <> '')[1].value, '') AS q, coalesce(list_filter(conv, lambda t: t."from" = 'gpt' AND t.value <> '')[1].value, '') AS a FROM ({O.CONV}))
  WHERE q <> '' AND length(a) >= 50 AND length({O.strip_thinking('a')}) >= 50"""


@query(f"SELECT conv_id, source, q AS user_text, a AS chosen_text, r AS rejected_text FROM ({_PAIRS})")
def dpo_pairs(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda c, i: F.get(c, F.lit(i))["content"]
    return pairs_of(spark, sf).select("conv_id", "source", at("chosen", 1).alias("user_text"), at("chosen", 2).alias("chosen_text"), at("rejected", 2).alias("rejected_text"))


@query(f"""SELECT conv_id, CASE WHEN conv_id % 6 = 0 THEN 'too few messages' END AS pair_error, CASE WHEN conv_id % 6 = 0 THEN 'prompt length' WHEN conv_id % 6 = 1 THEN 'prompt content' END AS prompt_error,
  CASE WHEN conv_id % 6 = 0 THEN 2 WHEN conv_id % 6 = 1 THEN 1 WHEN r = a THEN 3 ELSE 2 END AS common, conv_id % 6 > 1 AND r <> a AS prefix_ok FROM ({_PAIRS})""")
def dpo_checks(spark: SparkSession, sf: str) -> DataFrame:
    other = F.when(F.col("conv_id") % 6 == 0, F.slice("rejected", 1, 2)).when(F.col("conv_id") % 6 == 1, F.transform("rejected", lambda m, i: F.struct(m["role"].alias("role"), F.when(i == 1, "other").otherwise(m["content"]).alias("content")))).otherwise(F.col("rejected"))
    c, r = F.col("chosen"), F.col("other")
    return pairs_of(spark, sf).withColumn("other", other).select("conv_id", preference.pair_error(c, r).alias("pair_error"), preference.prompt_error(c, r).alias("prompt_error"), preference.common_prefix(c, r).alias("common"), preference.prefix_ok(c, r).alias("prefix_ok"))


_DPO_TEXT = f"""SELECT conv_id, source, '<|im_start|>system' || chr(10) || {O.q(C.BASE_PROMPT)} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || q || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt, a AS chosen, r AS rejected FROM ({_PAIRS}) WHERE a <> r"""


@query(f"SELECT * FROM ({_DPO_TEXT}) WHERE length(prompt) // 4 + greatest(length(chosen) // 4, length(rejected) // 4) <= 300")
def token_budget_filter(spark: SparkSession, sf: str) -> DataFrame:
    good = pairs_of(spark, sf).where(preference.prefix_ok(F.col("chosen"), F.col("rejected")))
    return preference.within_budget(preference.split_texts(good, ["conv_id", "source"]), 300)


@query(f"""SELECT count(*) AS n, {', '.join(f"CAST(floor(avg(length({c}))) AS BIGINT) AS {c}_avg, min(length({c})) AS {c}_min, max(length({c})) AS {c}_max" for c in ('prompt', 'chosen', 'rejected'))},
  count(*) FILTER (regexp_matches(chosen, '(?s)<think>.*?</think>')) AS chosen_thinking, count(*) FILTER (regexp_matches(rejected, '(?s)<think>.*?</think>')) AS rejected_thinking FROM ({_DPO_TEXT})""")
def dpo_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    good = pairs_of(spark, sf).where(preference.prefix_ok(F.col("chosen"), F.col("rejected")))
    return preference.length_stats(preference.split_texts(good, ["conv_id", "source"]))


@query(f"SELECT source, n, round(n * 100.0 / sum(n) OVER (), 4) AS percent, repeat('█', CAST(floor(n * 100.0 / sum(n) OVER () / 2) AS INT)) AS bar FROM (SELECT source, count(*) AS n FROM ({_PAIRS}) GROUP BY 1)")
def dpo_source_shares(spark: SparkSession, sf: str) -> DataFrame:
    return preference.source_shares(pairs_of(spark, sf))


# --- packing ------------------------------------------------------------------------------------------------------------


@query(f"SELECT conv_id, {O.TEMPLATE} AS text FROM ({O.CONV})")
def chatml_render(spark: SparkSession, sf: str) -> DataFrame:
    return conversations_of(spark, sf).select("conv_id", preference.chat_template(C.to_messages(F.col("conv"))).alias("text"))


@query(f"SELECT total_tokens, total_tokens // 512 AS blocks, total_tokens % 512 AS tail_waste, round((total_tokens - total_tokens % 512) * 100.0 / total_tokens, 4) AS utilisation FROM (SELECT CAST(sum(length({O.TEMPLATE}) // 4 + 1) AS BIGINT) AS total_tokens FROM ({O.CONV}))")
def packing_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.report(chatml_render(spark, sf), T.approximate_tokens(F.col("text")), 512)


@query(f"""WITH t AS (SELECT conv_id, CAST(coalesce(sum(n) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s, n FROM (SELECT conv_id, length({O.TEMPLATE}) // 4 + 1 AS n FROM ({O.CONV}))),
  b AS (SELECT conv_id, s, s + n AS e, unnest(range(s // 512, (s + n - 1) // 512 + 1)) AS block FROM t)
  SELECT conv_id, block, greatest(s, block * 512) - s AS text_from, least(e, (block + 1) * 512) - s AS text_to, greatest(s, block * 512) - block * 512 AS at FROM b WHERE block < (SELECT sum(n) // 512 FROM t)""")
def pack_blocks(spark: SparkSession, sf: str) -> DataFrame:
    texts = chatml_render(spark, sf)
    placed = packing.offsets(texts, "conv_id", T.approximate_tokens(F.col("text")))
    return packing.block_spans(placed, ["conv_id"], 512, packing.report(texts, T.approximate_tokens(F.col("text")), 512))


@query("SELECT o_orderkey, pos, pos // 64 AS shard FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)")
def shard_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return resume.shard_ranges(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')")
def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    done = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
    return resume.not_done(orders.select("o_orderkey", "o_orderpriority"), done, ["o_orderkey"])


# --- audits, tools, requests --------------------------------------------------------------------------------------------

_OPENER = "trim(regexp_replace(regexp_replace(lower(" + O.strip("regexp_replace(text, '(?s)[.!?\\n].*$', '')") + "), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"


@query(f"""SELECT role, opener, n, percent, place FROM (SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY role), 4) AS percent, row_number() OVER (PARTITION BY role ORDER BY n DESC, opener) AS place FROM (
  SELECT role, {_OPENER} AS opener, count(*) AS n FROM conversations GROUP BY 1, 2)) WHERE place <= 10""")
def opener_first_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return audit.opener_frequency(load(spark, sf, "conversations"), "role", audit.first_sentence(F.col("text")))


@query(f"""SELECT role, opener, n, percent, place FROM (SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY role), 4) AS percent, row_number() OVER (PARTITION BY role ORDER BY n DESC, opener) AS place FROM (
  SELECT role, array_to_string(string_split({_OPENER}, ' ')[1:4], ' ') AS opener, count(*) AS n FROM conversations GROUP BY 1, 2)) WHERE place <= 10""")
def opener_4gram(spark: SparkSession, sf: str) -> DataFrame:
    return audit.opener_frequency(load(spark, sf, "conversations"), "role", audit.first_words(F.col("text")))


_HAUNTED = f"SELECT conv_id, list_transform(conv, lambda t: {{'from': t.\"from\", 'value': t.value || CASE WHEN conv_id % 4 = 0 AND t.\"from\" = 'gpt' THEN ' As The Abstract says' WHEN conv_id % 8 = 4 AND t.\"from\" = 'human' THEN ' see the abstract' ELSE '' END}}) AS conv FROM ({O.CONV})"


@query(f"SELECT conv_id, {O.PHANTOM_SQL} AS phantom FROM ({_HAUNTED})")
def phantom_context(spark: SparkSession, sf: str) -> DataFrame:
    said = lambda t: F.when((F.col("conv_id") % 4 == 0) & (t["from"] == "gpt"), " As The Abstract says").when((F.col("conv_id") % 8 == 4) & (t["from"] == "human"), " see the abstract").otherwise("")
    rows = conversations_of(spark, sf).withColumn("conv", F.transform("conv", lambda t: F.struct(t["from"].alias("from"), F.concat(t["value"], said(t)).alias("value"))))
    return rows.select("conv_id", audit.phantom_context(F.col("conv")).alias("phantom"))


_NUMBERS = lambda x: f"regexp_extract_all({x}, '{audit.NUMBER}')"


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter({_NUMBERS('substr(text, length(text) // 2 + 1)')}, lambda v: NOT list_contains({_NUMBERS('substr(text, 1, length(text) // 2)')}, v)))), ',') AS numbers FROM documents")
def unsupported_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", F.array_join(audit.unsupported_numbers(F.expr("substr(text, length(text) div 2 + 1)"), F.expr("substr(text, 1, length(text) div 2)")), ",").alias("numbers"))


@query(f"SELECT CASE WHEN n < 90 THEN 'train' WHEN n < 95 THEN 'validation' ELSE 'test' END AS side, count(*) AS docs, count(DISTINCT k) AS sources FROM (SELECT *, {O.pick_number(O.order_hash('42', 'k'), 100)} AS n FROM (SELECT doc_id // 10 AS k FROM documents)) GROUP BY 1")
def disjoint_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select(F.floor(F.col("doc_id") / 10).alias("k"))
    return docs.groupBy(audit.disjoint_split(F.col("k")).alias("side")).agg(F.count("*").alias("docs"), F.count_distinct("k").alias("sources"))


@query(f"SELECT data_type, chars, trainable, round(CASE WHEN chars > 0 THEN trainable * 100.0 / chars ELSE 0.0 END, 4) AS percent FROM (SELECT conv_id % 4 AS data_type, CAST(sum(coalesce(list_sum(list_transform(conv, lambda t: length(t.value))), 0)) AS BIGINT) AS chars, CAST(sum(coalesce(list_sum(list_transform(list_filter(conv, lambda t: t.\"from\" = 'gpt'), lambda t: length(t.value))), 0)) AS BIGINT) AS trainable FROM ({O.CONV}) GROUP BY 1)")
def trainable_share(spark: SparkSession, sf: str) -> DataFrame:
    return audit.trainable_share(conversations_of(spark, sf).withColumn("data_type", F.col("conv_id") % 4), conv="conv")


@query("SELECT count(*) AS n, CAST(sum(CAST(CAST('0x' || substr(sha256(doc_id || chr(1) || text), 1, 15) AS BIGINT) AS HUGEINT)) % 2305843009213693951 AS BIGINT) AS hash FROM documents")
def dataset_hash(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dataset_hash(load(spark, sf, "documents"), ["doc_id", "text"])


@query(f"""SELECT conv_id, ({O.TOOL_NAMES})[conv_id % 6 + 1] AS tool, '<call name="' || ({O.TOOL_NAMES})[conv_id % 6 + 1] || '">{{"query":"q' || conv_id || '"}}</call>' AS called, '<response name="' || ({O.TOOL_NAMES})[conv_id % 6 + 1] || '">' || chr(10) || 'TRAINING-SNAPSHOT-' || upper(substr(sha256(CAST(conv_id AS VARCHAR)), 1, 12)) || chr(10) || '</response>' AS answered FROM (SELECT DISTINCT conv_id FROM conversations)""")
def tool_serialise(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "conversations").select("conv_id").distinct().withColumn("tool", tools.rotate(F.col("conv_id")))
    return rows.select("conv_id", "tool", tools.serialize_call(F.col("tool"), F.concat(F.lit("q"), F.col("conv_id").cast("string"))).alias("called"), tools.serialize_response(F.col("tool"), tools.snapshot_id(F.col("conv_id"))).alias("answered"))


@query(f"""SELECT doc_id, ({O.TOOL_NAMES})[doc_id % 6 + 1] AS tool, use_tool, use_tool AND {O.pick_number(O.order_hash('42:fail', 'doc_id'), 10000)} < 1500 AS tool_failed FROM (
  SELECT doc_id, row_number() OVER (ORDER BY {O.order_hash('42', 'doc_id')}, doc_id) * 2 <= count(*) OVER () AS use_tool FROM documents)""")
def tool_rotation(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", F.left("text", F.lit(40)).alias("question"), F.col("text").alias("answer"))
    return tools.augment(docs, "doc_id", "doc_id").select("doc_id", "tool", "use_tool", "tool_failed")


@query("SELECT source, \"group\", string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY doc_id) AS context, count(*) AS n FROM (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 3 AS \"group\" FROM documents) GROUP BY 1, 2")
def multi_document_context(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("t"))
    return tools.multi_document(docs, "source", "doc_id", "t").withColumn("n", F.col("n").cast("long"))


@query(f"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'plain ' || page_id ELSE '### [IMAGE ANALYSIS - DOCUMENT #1]' || chr(10) || 'seen ' || url || chr(10) || chr(10) || '---' || chr(10) || {O.q(multimodal.TASK)} || 'look ' || page_id END AS content FROM pages""")
def multimodal_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    part = F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.concat(F.lit("look "), F.col("page_id").cast("string")).alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url")), F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(F.col("url")).alias("image_url"))))
    content = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("plain "), F.col("page_id").cast("string"))).otherwise(part)
    rows = load(spark, sf, "pages").select("page_id", content.alias("content"), F.array().cast("array<struct<url:string>>").alias("images"))
    return multimodal.rewrite(rows, "page_id", _Seen()).select("page_id", "content")


class _Seen:
    """A vision model that says which address it saw."""

    def generate(self, prompts, settings):
        return [("seen " + p.rpartition("\n")[2], None, "ok") for p in prompts]


@query(f"SELECT doc_id, {O.pick(C.PUSHBACKS, O.order_hash('row', 'doc_id'))} AS choice FROM documents")
def choice_per_row(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", pick(C.PUSHBACKS, seeded_hash("row", F.col("doc_id"))).alias("choice"))


@query(f"SELECT doc_id, {O.stub_question(0, '1').replace('chunk', 'text')} || '|' || {O.stub_question(0, '2').replace('chunk', 'text')} AS questions, 'extrapolated' AS verdict, 'http://x/v1/chat/completions' AS url FROM documents")
def parse_model_replies(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    reply: Column = F.concat(F.lit("```json\n"), G.stub_questions(F.col("text"), 2), F.lit("\n```"))
    return docs.select("doc_id", F.array_join(T.parse_questions(reply, 2, 15), "|").alias("questions"), T.parse_verdict(F.lit("so VERDICT: EXTRAPOLATED")).alias("verdict"), T.chat_url(F.lit("http://x/v1/")).alias("url"))


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: clean the corpus and report why records go, by source."""
    return annotated(spark, sf).groupBy("cancer_type", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))
