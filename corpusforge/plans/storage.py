"""Queries over sources, sinks, resuming, generation and pools: what is written is read again, so that each has rows to compare."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import pick_number, seeded_hash
from ..operators import audit, blending, cleaning, judging, preference, resume, tools
from ..operators import conversations as C
from ..operators import generate as G
from ..runtime import shared_dir
from ..sources import io
from . import oracle as O
from . import pipelines as P
from .queries import annotated, chunk_rows_of, conversations_of, load, pool_of, qa_of, query

# --- sources and sinks ---------------------------------------------------------------------------------------------------


@query("SELECT doc_id, source AS file_key, length(text) AS chars FROM documents")
def file_key_scan(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines, one set of files for each type, read by a glob; the type is taken from the file's name."""
    path = shared_dir(spark)
    io.publish_by_type(load(spark, sf, "documents").select("doc_id", "text", "source"), path, "source", "_clean")
    rows = io.with_file_key(io.read(spark, f"{path}/*.jsonl", schema="doc_id long, text string"), [r"_clean-\d+"])
    return rows.select("doc_id", "file_key", F.length("text").alias("chars"))


@query("SELECT doc_id, source, n_chars FROM documents")
def partitioned_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark)
    io.write_by_type(load(spark, sf, "documents").select("doc_id", "source", "n_chars"), path, "source", "parquet")
    return io.read(spark, path).select("doc_id", "source", "n_chars")


@query("SELECT r_regionkey AS key, r_name AS name, NULL::INTEGER AS region FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def read_any_skips_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A missing path is passed over; the others are united by name."""
    path = shared_dir(spark)
    load(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")).write.parquet(f"{path}/a.parquet")
    load(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("region")).write.parquet(f"{path}/b.parquet")
    return io.read_any(spark, [f"{path}/missing.parquet", f"{path}/a.parquet", f"{path}/b.parquet"]).select("key", "name", "region")


@query("SELECT source AS category, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS abstract_chars, CAST(sum(length(substr(text, 1, 80))) AS BIGINT) AS title_chars FROM documents GROUP BY 1")
def column_roles(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark)}/raw.parquet"
    load(spark, sf, "documents").select("doc_id", F.left("text", F.lit(80)).alias("Paper_Title"), F.col("text").alias("full_abstract"), F.col("source").alias("tumour_type")).write.parquet(path)
    rows = io.read_roles(spark, path)
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.sum(F.length("abstract")).alias("abstract_chars"), F.sum(F.length("title")).alias("title_chars"))


@query("SELECT n_nationkey, n_name FROM nation")
def first_source_with_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first candidate can't be read, the second has no rows."""
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    return io.require(io.first_with_rows([lambda: io.read(spark, f"{sf}/nothing.parquet"), lambda: nation.where("n_nationkey < 0"), lambda: nation]), "nation")


@query("SELECT n_nationkey, n_regionkey AS cancer_type, round, n_nationkey * 10 + round AS value FROM nation, (VALUES (0), (1)) r(round)")
def append_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Round 1 is written twice; the second writing replaces the first."""
    path = shared_dir(spark)
    rows = lambda r, value: load(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("cancer_type"), F.lit(r).alias("round"), (F.col("n_nationkey") * 10 + value).alias("value"))
    for r, value in ((0, 0), (1, 7), (1, 1)):
        io.write_round(rows(r, value), path)
    return io.read(spark, path).select("n_nationkey", F.col("cancer_type").cast("int"), "round", "value")


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'rejects' ELSE 'validated' END AS side, o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 1, 2")
def split_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark)
    judged = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("kind"), F.when(F.col("o_orderstatus") == "F", "hallucinated").otherwise("grounded").alias("grounding_verdict"))
    io.write_split(judged, judging.split_verdicts, f"{path}/validated", f"{path}/rejects", "kind")
    sides = [spark.read.json(f"{path}/{side}").select("kind", F.lit(side).alias("side")) for side in ("validated", "rejects")]
    return sides[0].unionByName(sides[1]).groupBy("side", "kind").agg(F.count("*").alias("n"))


_PER_TYPE = lambda what: f"(SELECT '{{' || string_agg('\"' || cancer_type || '\":' || n, ',' ORDER BY cancer_type) || '}}' FROM (SELECT cancer_type, {what} AS n FROM annotated GROUP BY 1))"
_REPORT = f"""WITH {O.CLEAN} SELECT '{{"records":{{"total_raw":' || count(*) || ',"per_type_raw":' || {_PER_TYPE('count(*)')} || ',"per_type_clean":' || {_PER_TYPE('count(*) FILTER (drop_reason IS NULL)')}
  || ',"dropped":{{' || (SELECT string_agg('"' || drop_reason || '":' || n, ',' ORDER BY drop_reason) FROM (SELECT drop_reason, count(*) AS n FROM annotated WHERE drop_reason IS NOT NULL GROUP BY 1))
  || '}},"dedup_removed":' || count(*) FILTER (drop_reason = 'duplicate') || ',"total_clean":' || count(*) FILTER (drop_reason IS NULL) || '}}}}' AS report FROM annotated"""


@query(_REPORT)
def cleaning_report_json(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON report, written and read again."""
    path = shared_dir(spark)
    io.write_report(cleaning.cleaning_report(annotated(spark, sf)), path)
    return spark.read.text(path).withColumnRenamed("value", "report")


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def write_once(spark: SparkSession, sf: str) -> DataFrame:
    """What is there already is read, not written over."""
    path = shared_dir(spark)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    io.write_if_absent(orders, path)
    return io.write_if_absent(orders.where("o_orderkey < 0"), path)


@query("SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def dataset_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset saved over an older one and loaded again, checked against its manifest."""
    path = shared_dir(spark)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    io.save_dataset(orders.limit(3), path)
    io.save_dataset(orders, path)
    return io.load_dataset(spark, path, ["o_orderkey"])


@query("""SELECT 'documents' AS source, (SELECT count(*) FROM documents) AS n, 42 AS seed, 'qa,dpo' AS outputs""")
def manifest_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest that replaces an older one, read again."""
    path = f"{shared_dir(spark)}/manifest.json"
    io.write_manifest(spark, path, {"source": "older"})
    io.write_manifest(spark, path, {"source": "documents", "n": load(spark, sf, "documents").count(), "seed": 42, "outputs": ["qa", "dpo"]})
    read = io.read_manifest(spark, path) or {}
    return spark.createDataFrame([(read["source"], read["n"], read["seed"], ",".join(read["outputs"]))], "source string, n long, seed int, outputs string")


@query(f"""SELECT '{{' || string_agg('"' || source || '":"' || replace({O.system_prompt('source')}, chr(10), '\\n') || '"', ',' ORDER BY source) || '}}' AS value FROM (SELECT DISTINCT source FROM documents)""")
def prompt_map_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark)
    io.write_report(io.prompt_map(load(spark, sf, "documents"), "source", C.system_prompt(F.col("source")), "doc_id"), path)
    return spark.read.text(path)


@query("SELECT count(*) FILTER (line <> '') AS filled, count(*) FILTER (contains(line, 'src1')) AS holding FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN '' ELSE source || ' ' || doc_id END AS line FROM documents)")
def line_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark)
    load(spark, sf, "documents").select(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat_ws(" ", "source", "doc_id"))).write.text(path)
    return spark.createDataFrame([(io.count_lines(spark, path), io.count_lines(spark, path, "src1"))], "filled long, holding long")


@query(f"WITH {O.CLEAN} SELECT count(*) AS n, count(DISTINCT {O.fingerprint('abstract')}) AS texts FROM annotated WHERE drop_reason IS NULL")
def command_line_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning command over a raw table; its output read again."""
    from ..__main__ import main

    path = shared_dir(spark)
    load(spark, sf, "documents").select(F.left("text", F.lit(80)).alias("title"), F.col("text").alias("abstract"), F.col("source").alias("category")).write.parquet(f"{path}/raw.parquet")
    main(["--abstracts", f"{path}/raw.parquet", "--output-dir", f"{path}/out", "--skip-cases", "--quiet"], spark)
    return spark.read.json(f"{path}/out/abstracts").agg(F.count("*").alias("n"), F.count_distinct(T.fingerprint(F.col("abstract"))).alias("texts"))


# --- resuming ---------------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, pos, pos // 64 AS shard, o_orderkey * 2 AS value FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)")
def shard_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Shards computed under one configuration, under another (which makes the first ones invalid), and once more without anything left to do."""
    path = shared_dir(spark)
    orders = load(spark, sf, "orders").select("o_orderkey")
    times = lambda k: (lambda todo: todo.withColumn("value", F.col("o_orderkey") * k))
    resume.ShardCache(spark, path, {"k": 1}).run(orders, "o_orderkey", times(1))
    resume.ShardCache(spark, path, {"k": 2}).run(orders, "o_orderkey", times(2))
    again = resume.ShardCache(spark, path, {"k": 2}).run(orders, "o_orderkey", times(99))
    return again.select("o_orderkey", "pos", F.col("shard").cast("long").alias("shard"), "value")


@query("SELECT n_name AS type, round FROM nation, (VALUES (0), (1), (2)) r(round) WHERE NOT (n_regionkey = 1 AND round = 0 OR n_regionkey = 2 AND round < 2)")
def rounds_to_run(spark: SparkSession, sf: str) -> DataFrame:
    nations = load(spark, sf, "nation").select("n_name", "n_regionkey").collect()
    done = {r.n_name: {k: 5 for k in range(r.n_regionkey)} for r in nations if r.n_regionkey in (1, 2)}
    return spark.createDataFrame(resume.rounds_to_run([r.n_name for r in nations], 3, done), "type string, round int")


@query("SELECT sha256('{\"block\": 512, \"n\": ' || (SELECT count(*) FROM documents) || ', \"seed\": 42}') AS fingerprint")
def config_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(resume.fingerprint({"seed": 42, "block": 512, "n": load(spark, sf, "documents").count()}),)], "fingerprint string")


# --- records ----------------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, ix, question_ix, {O.system_prompt('source')} AS system, question, answer, 'qa' AS data_type FROM ({O.QA}) WHERE NOT {O.low_quality('answer')}")
def three_turn_conversations(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.single_turns(qa_of(spark, sf), "source", "qa", ["doc_id", "ix", "question_ix"])
    c = F.col("conversations")
    return io.training_columns(rows, ["conversations"], ["doc_id", "ix", "question_ix", "data_type", "not there"]).select("doc_id", "ix", "question_ix", C.value_at(c, 0, "system").alias("system"), C.value_at(c, 1, "human").alias("question"), C.value_at(c, 2, "gpt").alias("answer"), "data_type")


@query(f"SELECT doc_id, replace(replace(replace(replace(replace({O.q(P.QUESTION_PROMPT)}, '{{{{', '{{'), '}}}}', '}}'), '{{n}}', '3'), '{{kind}}', source), '{{chunk}}', text) AS prompt FROM documents")
def template_fill(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", G.fill(P.QUESTION_PROMPT, n=F.lit(3), kind=F.col("source"), chunk=F.col("text")).alias("prompt"))


@query("SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, 'qa') AS data_type, coalesce(CASE WHEN event_id % 5 > 0 THEN 'k' || user_id END, 'unknown') AS cancer_type FROM events")
def default_values(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    rows = load(spark, sf, "events").select(e, F.when(e % 3 > 0, F.col("event_type")).alias("data_type"), F.when(e % 5 > 0, F.concat(F.lit("k"), F.col("user_id").cast("string"))).alias("cancer_type"))
    return C.with_defaults(rows)


@query(f"SELECT conv_id, coalesce(list_bool_or(list_transform(list_filter(conv, lambda t: t.\"from\" = 'gpt'), lambda t: starts_with({O.strip('t.value')}, '<think>'))), false) AS starts FROM ({O.CONV})")
def starts_with_thinking(spark: SparkSession, sf: str) -> DataFrame:
    return conversations_of(spark, sf).select("conv_id", F.exists(F.filter("conv", lambda t: t["from"] == "gpt"), lambda t: T.starts_thinking(t["value"])).alias("starts"))


@query(f"""WITH c AS ({O.CHUNKS}), last AS (SELECT substr(chunk, 1, 100) AS k, max_by(chunk, doc_id * 1000000 + ix) AS chunk FROM c GROUP BY 1)
  SELECT d.doc_id, d.ix, coalesce(last.chunk, '') AS chunk FROM (SELECT doc_id, ix, CASE WHEN doc_id % 5 = 0 THEN 'missing' ELSE substr(chunk, 1, 100) END AS k FROM c) d LEFT JOIN last ON d.k = last.k""")
def chunk_lookup_or_empty(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunk_rows_of(spark, sf).withColumn("pos", F.col("doc_id") * 1_000_000 + F.col("ix"))
    items = chunks.select("doc_id", "ix", F.when(F.col("doc_id") % 5 == 0, "missing").otherwise(F.col("chunk_key")).alias("chunk_key"))
    return preference.lookup_chunks(items, chunks.select("chunk", "pos"), fallback_to_key=False).select("doc_id", "ix", "chunk")


@query(f"SELECT p_partkey, {O.display(O.category('p_type'))} AS name FROM part")
def display_names(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", T.display_name(T.category(F.col("p_type"))).alias("name"))


@query(f"SELECT event_id, row_number() OVER (ORDER BY {O.order_hash('42', 'event_id')}, event_id) AS place FROM events")
def global_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """Every row's place in the random order."""
    from ..operators.ranking import hash_rank

    return hash_rank(load(spark, sf, "events").select("event_id"), [], 42, ["event_id"], "place")


_POOLS = "SELECT event_id, event_type AS kind, true AS has_thinking FROM events UNION ALL SELECT event_id, event_type, NULL FROM events WHERE event_id % 4 = 0 UNION ALL SELECT o_orderkey, o_orderpriority, NULL FROM orders"


@query(f"SELECT kind, count(*) AS n, count(has_thinking) AS with_flag FROM ({_POOLS}) GROUP BY 1")
def union_of_pools(spark: SparkSession, sf: str) -> DataFrame:
    """A bag: rows that come in two pools stay twice."""
    return blending.union_pools(_pools(spark, sf)).groupBy("kind").agg(F.count("*").alias("n"), F.count("has_thinking").alias("with_flag"))


@query(f"SELECT kind, count(*) AS n FROM (SELECT DISTINCT event_id, kind FROM ({_POOLS})) GROUP BY 1")
def union_without_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return blending.union_pools(_pools(spark, sf), ["event_id", "kind"]).groupBy("kind").agg(F.count("*").alias("n"))


def _pools(spark: SparkSession, sf: str) -> list[DataFrame]:
    events = load(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"))
    return [events.withColumn("has_thinking", F.lit(True)), events.where("event_id % 4 = 0"), load(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("kind"))]


_ALTERNATIVE = f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY {O.order_hash('7', 'event_id')}, event_id) AS r, count(*) OVER (PARTITION BY data_type) AS n FROM (
  SELECT event_id, CASE WHEN event_id % 10 < 5 THEN 'qa' WHEN event_id % 10 < 8 THEN 'continuation' WHEN event_id % 100 = 8 THEN 'beyond_evidence' ELSE 'treatment_reasoning' END AS data_type FROM events)),
  t AS (SELECT *, CAST(floor(floor((SELECT count(*) FROM p WHERE data_type = 'qa') / CAST(0.4 AS DOUBLE)) * CASE data_type WHEN 'qa' THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) END) AS BIGINT) AS target FROM p)
  SELECT event_id, data_type, unnest(range(1, target // n + CASE WHEN r <= target % n THEN 1 ELSE 0 END + 1)) AS copy FROM t"""


@query(_ALTERNATIVE)
def alternative_blend(spark: SparkSession, sf: str) -> DataFrame:
    return blending.blend(pool_of(spark, sf), 7, "event_id", shares=blending.ALTERNATIVE)


@query(f"""SELECT conv_id, CASE WHEN len(conv) = 1 AND conv[1]."from" = 'gpt' THEN conv[1].value ELSE {O.TEMPLATE} END AS text FROM (SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN list_filter(conv, lambda t: t."from" = 'gpt')[1:1] ELSE conv END AS conv FROM ({O.CONV}))""")
def render_messages(spark: SparkSession, sf: str) -> DataFrame:
    """A single answer as it is, anything else by the template."""
    conv = F.when(F.col("conv_id") % 2 == 0, F.slice(F.filter("conv", lambda t: t["from"] == "gpt"), 1, 1)).otherwise(F.col("conv"))
    return conversations_of(spark, sf).select("conv_id", preference.render(C.to_messages(conv)).alias("text"))


# --- generation -------------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, reply_status, CASE WHEN reply_status = 'ok' THEN {O.strip("('to ' || source || ': ' || left(text, 60))")} END AS reply FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'timeout' WHEN doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS reply_status FROM documents)")
def generator_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Calls through the generator interface, with system messages; failed ones have a status and no reply."""
    docs = load(spark, sf, "documents")
    prompt = F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.left("text", F.lit(60)))
    return G.call(docs.select("doc_id", "text", "source"), prompt, Echo(), "answer", "reply", F.col("source")).select("doc_id", "reply_status", "reply")


class Echo:
    """An offline model that names its system message and repeats its prompt; some ids fail."""

    def generate(self, prompts, settings, systems=None):
        out = []
        for prompt, system in zip(prompts, systems or [None] * len(prompts), strict=True):
            i, _, text = prompt.partition("|")
            out.append((None, None, "timeout") if int(i) % 7 == 0 else (None, None, "error") if int(i) % 11 == 0 else (f"to {system}: {text}", None, "ok"))
        return out


class Extractive:
    """An offline model that answers the filled prompts of the phases: it asks about a text's first words and answers with the text's start."""

    def generate(self, prompts, settings, systems=None):
        out = []
        for prompt in prompts:
            text = prompt.split("\n---\n")[1]
            out.append((json.dumps({"questions": [f"What is said about {text[:20]}, part {k}?" for k in range(2)]}) if settings.json_mode else f"It says: {text[:120]} and no more than that.", None, "ok"))
        return out


@query(f"""SELECT doc_id, ix, question_ix, question, answer FROM (SELECT *, {O.strip("('It says: ' || substr(chunk, 1, 120) || ' and no more than that.')")} AS answer FROM (
  SELECT *, {O.strip("('What is said about ' || substr(chunk, 1, 20) || ', part ' || question_ix || '?')")} AS question FROM (SELECT *, unnest([0, 1]) AS question_ix FROM ({O.CHUNKS})))) WHERE NOT {O.low_quality('answer')}""")
def qa_by_generator(spark: SparkSession, sf: str) -> DataFrame:
    """Questions and answers through filled prompts and a model, as a real run makes them."""
    return P.generate_qa(chunk_rows_of(spark, sf), "doc_id", "source", n=2, phase=P.Phase(Extractive())).select("doc_id", "ix", "question_ix", "question", "answer")


_STUB_FLAWED = O.strip("('[synthetic flaw] ' || reverse(substr(chunk, 1, 120)))")


def _pair_sql(start: str, source: str) -> str:
    chosen = O.with_reasoning(f"('{start}' || substr(chunk, 1, 200))", "('Asked: ' || question)")
    return f"SELECT key, source AS kind, '{source}' AS source, question, chosen, rejected FROM (SELECT *, doc_id * 1000000 + ix * 10 + question_ix AS key, {O.strip(chosen)} AS chosen, {_STUB_FLAWED} AS rejected FROM ({O.QA})) WHERE length(chosen) >= 50 AND length(rejected) >= 50"


def _pairs(pairs: DataFrame) -> DataFrame:
    at = lambda side, i: F.get(side, F.lit(i))["content"]
    return pairs.select("key", "kind", "source", at("chosen", 1).alias("question"), at("chosen", 2).alias("chosen"), at("rejected", 2).alias("rejected"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return qa_of(spark, sf).withColumn("key", F.col("doc_id") * 1_000_000 + F.col("ix") * 10 + F.col("question_ix")).withColumnRenamed("source", "kind")


@query(_pair_sql("The source says: ", "hallucination"))
def preference_pairs_stub(spark: SparkSession, sf: str) -> DataFrame:
    """Strictly grounded against made-up answers."""
    return _pairs(P.collect_preferences(_items(spark, sf), "kind", "key"))


@query(_pair_sql("The source does not settle this. It only says: ", "beyond_evidence"))
def beyond_preference_stub(spark: SparkSession, sf: str) -> DataFrame:
    """Answers made anew that say where the evidence ends, against made-up ones."""
    return _pairs(P.beyond_preferences(_items(spark, sf), "kind", "key"))


@query(f"""WITH i AS (SELECT *, doc_id * 1000000 + ix * 10 + question_ix AS key FROM ({O.QA})), s AS ({O.sampled('i', 'source', 'key', 'correct', 'greatest(1, floor(n * 0.15))')}),
  f AS (SELECT i.*, {_STUB_FLAWED} AS flawed, {O.pick(C.PUSHBACKS, O.order_hash('correct:pushback', 'i.key'))} AS pushback FROM i JOIN s ON i.key = s.key),
  g AS (SELECT *, {O.with_reasoning("('Corrected from the source: ' || substr(chunk, 1, 200))", 'pushback')} AS correction FROM f WHERE length(flawed) >= 50)
  SELECT key, question, correction AS chosen, flawed AS rejected FROM g WHERE NOT {O.low_quality('correction')}""")
def correction_preference_stub(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections against the flawed answers before them."""
    items = qa_of(spark, sf).withColumn("key", F.col("doc_id") * 1_000_000 + F.col("ix") * 10 + F.col("question_ix"))
    pairs = P.correction_preferences(P.self_corrections(items, "source", "key"), "source", ["key"])
    at = lambda side, i: F.get(side, F.lit(i))["content"]
    return pairs.select("key", at("chosen", 1).alias("question"), at("chosen", 2).alias("chosen"), at("rejected", 2).alias("rejected"))


# --- tools and audits -------------------------------------------------------------------------------------------------------

_USE = f"(SELECT doc_id, text, row_number() OVER (ORDER BY {O.order_hash('42', 'doc_id')}, doc_id) * 2 <= count(*) OVER () AS use_tool FROM documents)"


@query(f"""SELECT doc_id, use_tool, CASE WHEN use_tool THEN 5 ELSE 3 END AS turns, CASE WHEN use_tool THEN {O.pick(tools.TEMPORAL, O.order_hash('42:temporal', 'doc_id'))} ELSE '' END || left(text, 40) AS question,
  CASE WHEN use_tool AND {O.pick_number(O.order_hash('42:fail', 'doc_id'), 10000)} < 1500 THEN 'The tool did not answer; from what is known: ' ELSE '' END || text AS answer, true AS ordered FROM {_USE}""")
def tool_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations with and without tool calls; calls come before their responses."""
    docs = load(spark, sf, "documents").select("doc_id", F.left("text", F.lit(40)).alias("question"), F.col("text").alias("answer"))
    rows = tools.augment(docs, "doc_id", "doc_id")
    c = F.col("conversations")
    return rows.select("doc_id", "use_tool", F.size(c).alias("turns"), C.value_at(c, 1, "human").alias("question"), F.get(c, F.size(c) - 1)["value"].alias("answer"), audit.tool_order_ok(c).alias("ordered"))


@query("SELECT conv_id, conv_id % 3 <> 1 AS ordered FROM (SELECT DISTINCT conv_id FROM conversations)")
def tool_order(spark: SparkSession, sf: str) -> DataFrame:
    """Every third conversation answers before it calls."""
    call, answer = F.lit('<call name="x">{}</call>'), F.lit('<response name="x">y</response>')
    first, second = (F.when(F.col("conv_id") % 3 == 1, a).otherwise(b) for a, b in ((answer, call), (call, answer)))
    rows = conversations_of(spark, sf).withColumn("conv", F.concat(F.array(C.turn("gpt", first), C.turn("human", second)), F.col("conv")))
    return rows.select("conv_id", audit.tool_order_ok(F.col("conv")).alias("ordered"))


@query(f"SELECT doc_id, source, left(sents[1], 60) AS evidence FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {O.order_hash('3', 'doc_id')}, doc_id) AS r FROM ({O.SENTENCES})) WHERE r <= 4")
def canary_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Four documents of each source with their first sentence as evidence."""
    from ..functions import sentences as S

    docs = load(spark, sf, "documents").select("doc_id", "source", "text")
    return audit.canary(docs, "source", 4, 3, "doc_id", S.sentences(F.col("text"))).select("doc_id", "source", F.left("evidence", F.lit(60)).alias("evidence"))


@query(f"SELECT doc_id, 'documents' AS origin, source AS kind, '2' AS version, {O.pick_number(O.order_hash('p', 'doc_id'), 100)} AS draw FROM documents")
def provenance_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = audit.with_provenance(load(spark, sf, "documents"), origin="documents", kind=F.col("source"), version="2", draw=pick_number(seeded_hash("p", F.col("doc_id")), 100))
    return rows.select("doc_id", "provenance.*")


@query(f"""SELECT conv_id, i - 1 AS at, CAST(coalesce(list_sum(list_transform(conv[1:i - 1], lambda t: length(t.value))), 0) AS INT) AS start, CAST(list_sum(list_transform(conv[1:i], lambda t: length(t.value))) AS INT) AS "end", conv[i]."from" = 'gpt' AS train
  FROM (SELECT conv_id, conv, unnest(range(1, len(conv) + 1)) AS i FROM ({O.CONV}))""")
def label_mask_spans(spark: SparkSession, sf: str) -> DataFrame:
    return conversations_of(spark, sf).select("conv_id", F.posexplode(audit.label_spans(F.col("conv"))).alias("at", "s")).select("conv_id", "at", "s.*")



