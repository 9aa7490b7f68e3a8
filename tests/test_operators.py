import random

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import audit, blending, cleaning, judging, multimodal, packing, preference, resume, sampling
from corpusforge.operators import conversations as C
from corpusforge.operators import generate as G
from corpusforge.operators.ranking import first_per_key, hash_rank, position_rank
from corpusforge.plans import pipelines as P
from corpusforge.sources import io

TURNS = "id long, conversations array<struct<`from`:string,value:string,train:boolean>>"


def records(spark):
    good = "The results show that the treatment works well in most of the cases. " * 4
    rows = [(0, "A fine title", good, "Lung"), (1, "A fine title", good.upper(), "Lung"), (2, "short", good, "Lung"), (3, "x" * 9, good, None), (4, "x" * 10, good + " new", None), (5, "A fine title", "a" * 199, "B"), (6, "A fine title", "b" * 200, "B"), (7, "A fine title", "c" * 15000, "B"), (8, "A fine title", "d" * 15001, "B"), (9, "Retracted: title", good, "B"), (10, "A fine title", "中" * 300, "B"), (11, None, None, "B")]
    return spark.createDataFrame(rows, "idx long, title string, abstract string, category string")


def test_drop_cascade(spark):
    got = {r.idx: r.drop_reason for r in cleaning.annotate(records(spark)).collect()}
    assert got == {0: None, 1: "duplicate", 2: "no_title", 3: "no_title", 4: None, 5: "short_abstract", 6: None, 7: None, 8: "too_long", 9: "retracted", 10: "non_english", 11: "no_title"}
    counts = {r.drop_reason: r.n for r in cleaning.drop_counts(cleaning.annotate(records(spark))).collect()}
    assert sum(counts.values()) == 12 and counts["kept"] == 4
    assert '"total_raw":12' in cleaning.cleaning_report(cleaning.annotate(records(spark))).first()[0]


def test_columns():
    assert cleaning.detect_columns(["Title", "my_abstract", "Cancer Type"]) == {"title": "Title", "abstract": "my_abstract", "category": "Cancer Type"}
    assert cleaning.detect_columns(["a", "b"]) == {"title": "a", "abstract": "b", "category": None}
    with pytest.raises(cleaning.MissingColumns):
        cleaning.detect_columns(["a"])


def strata(spark, parts=3):
    rnd = random.Random(3)
    return spark.createDataFrame([(i, rnd.choice("aaaabbc")) for i in range(500)] + [(500, "d"), (501, None)], "id long, s string").repartition(parts)


@pytest.mark.parametrize("how", [lambda d: sampling.proportional(d, "s", 100, 1, "id"), lambda d: sampling.fraction(d, "s", 0.1, 1, "id"), lambda d: sampling.source_cap(d, "s", 50, 1, "id"), lambda d: sampling.equal_quota(d, "s", 50, 1, "id"), lambda d: sampling.half(d, ["s"], 1, "id").where("use_tool").select("id", "s"), lambda d: blending.blend(d.withColumn("t", F.when(F.col("s") == "a", "qa").otherwise("continuation")), 1, "id", "t").select("id", "copy")])
def test_samples_do_not_hang_on_partitions(spark, how):
    a, b = sorted(how(strata(spark, 1)).collect(), key=str), sorted(how(strata(spark, 7)).collect(), key=str)
    assert a == b and a


def test_sample_sizes(spark):
    df = strata(spark)
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    got = {r.s: r["count"] for r in sampling.proportional(df, "s", 100, 1, "id").groupBy("s").count().collect()}
    assert got == {s: max(1, k * 100 // 502) for s, k in n.items()}
    assert sampling.proportional(df, "s", 1000, 1, "id").count() == 502
    assert sampling.source_cap(df, "s", 50, 1, "id").count() <= 50
    quota = {r.s: r["count"] for r in sampling.equal_quota(df.where("s IS NOT NULL"), "s", 50, 1, "id").groupBy("s").count().collect()}
    assert quota == {"a": 13, "b": 13, "c": 12, "d": 1}
    assert sorted(r.id for r in sampling.window_slice(df, "id", 10, 15).collect()) == [10, 11, 12, 13, 14]
    assert sorted(r.id for r in sampling.window_slice(df, "id", 499).collect()) == [499, 500, 501]


def test_ranks(spark):
    df = spark.range(0, 3000, 7, 5)
    assert [r[0] for r in position_rank(df, [], "id", bucket_rows=50).orderBy("id").select("rank").collect()] == list(range(1, 430))
    assert sorted(r[0] for r in hash_rank(df, [], 5, ["id"]).select("rank").collect()) == list(range(1, 430))
    dup = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None)], "id long, k string")
    assert sorted(r.id for r in first_per_key(dup, F.col("k"), "id").collect()) == [1, 3]


def test_blend_targets():
    assert blending.targets({"qa": 100, "continuation": 10, "self_correction": 0}, blending.BLEND) == {"qa": 99, "continuation": 78}  # int(238 * 0.42) is 99
    with pytest.raises(blending.NoQuestions):
        blending.targets({"qa": 0}, blending.BLEND)


def test_formats(spark):
    t = lambda *roles: [(r, "x", None) for r in roles]
    rows = [(0, t("system", "human", "gpt")), (1, t("human", "gpt", "human")), (2, t("system", "human", "human")), (3, t("system", "human")), (4, t("system", "human", "gpt", "human")), (5, [("system", "s", None), ("human", "h", None), ("gpt", " ", None)]), (6, None)]
    df = spark.createDataFrame(rows, TURNS).orderBy("id")
    c = F.col("conversations")
    got = df.select(C.format_error(c), C.strict_format_error(c), C.has_empty_end(c)).collect()
    assert [r[0] for r in got] == [None, "turn 0: expected system, got human", "turn 2: expected gpt, got human", "too few turns", None, None, "too few turns"]
    assert got[4][1] == "even number of turns" and [r[2] for r in got] == [False, False, False, False, False, True, True]
    assert [r[0] for r in df.limit(6).select(C.messages_error(C.to_messages(c))).collect()] == [None, "starts wrong", "ends wrong", "too few messages", "ends wrong", "empty end"]
    with pytest.raises(Exception, match="unknown role"):
        spark.createDataFrame([(0, t("robot"))], TURNS).select(C.to_messages(c)).collect()


def test_assembly(spark):
    rows = [(i, g, f"q{i}", "a" * 60, "k") for g, n in ((1, 1), (2, 4), (3, 5), (4, 8)) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, g int, question string, answer string, cancer_type string")
    got = C.assemble(df, ["g"], 1, ["i"]).collect()
    assert sorted((r.g, len(r.conversations)) for r in got) == [(1, 3), (2, 9), (3, 3), (3, 9), (4, 9), (4, 9)]
    assert all(x[0] is None for x in C.assemble(df, ["g"], 1, ["i"]).select(C.strict_format_error(F.col("conversations"))).collect())


def test_pairs(spark):
    m = lambda *x: [(r, c) for r, c in x]
    rows = [(m(("s", "1"), ("u", "2"), ("a", "3")), m(("s", "1"), ("u", "2"), ("a", "4"))), (m(("s", "1"), ("u", "2"), ("a", "3")), m(("s", "1"), ("u", "2"))), (m(("s", "1")), m(("s", "2"))), (m(("s", "1"), ("u", "2"), ("a", "3")),) * 2]
    df = spark.createDataFrame(rows, "a array<struct<role:string,content:string>>, b array<struct<role:string,content:string>>").coalesce(1)
    a, b = F.col("a"), F.col("b")
    got = df.select(preference.common_prefix(a, b), preference.prompt_error(a, b), preference.prefix_ok(a, b)).collect()
    assert [tuple(r) for r in got] == [(2, None, True), (2, "prompt length", False), (0, None, False), (3, None, False)]


def test_packing_conserves_tokens(spark):
    rnd = random.Random(1)
    lists = [[rnd.randrange(9) for _ in range(rnd.randrange(12))] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(lists)), "p long, ids array<int>")
    stream = [t for x in lists for t in [*x, -1]]
    got = [r.tokens for r in packing.pack_tokens(df, "p", "ids", -1, 16).orderBy("block").collect()]
    assert [t for b in got for t in b] == stream[: len(stream) // 16 * 16]
    rep = packing.report(df, F.size("ids"), 16).first()
    assert (rep.total_tokens, rep.blocks, rep.tail_waste) == (len(stream), len(stream) // 16, len(stream) % 16)
    empty = packing.report(df.limit(0), F.size("ids"), 16).first()
    assert (empty.total_tokens, empty.blocks, empty.utilisation) == (0, 0, 0.0)


def test_shards_resume(spark, tmp_path):
    calls = []

    def compute(df):
        calls.append(df.count())
        return df.select("pos", "shard", (F.col("id") * 2).alias("v"))

    cache = resume.ShardCache(spark, f"file://{tmp_path}/c", {"m": 1}, 10)
    df = spark.range(35)
    assert cache.run(df, "id", compute).count() == 35 and cache.manifest()["status"] == "complete"
    import shutil

    shutil.rmtree(tmp_path / "c/shards/shard=1")
    assert sorted(r.v for r in cache.run(df, "id", compute).collect()) == [2 * i for i in range(35)]
    assert calls == [35, 10]
    resume.ShardCache(spark, f"file://{tmp_path}/c", {"m": 2}, 10).run(df, "id", compute)
    assert calls[-1] == 35
    assert resume.rounds_to_run(["a", "b"], 2, {"a": {0: 5}}) == [("a", 1), ("b", 0), ("b", 1)]


class Echo:
    def generate(self, prompts, settings):
        return [(None, None, "timeout") if "fail" in p else (f"seen {len(p)}", "why", "ok") for p in prompts]


def test_generator_and_tracker(spark):
    df = spark.createDataFrame([(1, "a"), (2, "fail")], "id int, p string")
    got = {r.id: (r.reply, r.reply_status) for r in G.call(df, F.col("p"), Echo(), "answer").collect()}
    assert got == {1: ("<think>\nwhy\n</think>\n\nseen 1", "ok"), 2: (None, "timeout")}
    rates = judging.failure_rates(spark.createDataFrame([("x", "error")] * 19 + [("x", "ok")], "phase string, status string"))
    with pytest.raises(judging.GateFailed):
        judging.check_failures(rates)


def test_images(spark):
    rows = [(1, '[{"type":"text","text":"old"},{"type":"image_url","image_url":{"url":"u1"}},{"type":"text","text":"new"}]', [("u2",), ("",)]), (2, "plain", []), (3, "plain", [("fail",)])]
    df = spark.createDataFrame(rows, "id int, content string, images array<struct<url:string>>")
    got = {r.id: r for r in multimodal.rewrite(df, "id", Echo()).collect()}
    assert got[2].content == "plain" and got[1].content.endswith("> new") and "#2]" in got[1].content and got[1].images == []
    assert "ERROR" in got[3].content


def test_audits(spark):
    rows = [(1, [("human", "hi", None), ("gpt", "The abstract says 5", None)]), (2, [("human", "see the abstract", None), ("gpt", "The abstract says", False)]), (3, [("human", "<response name=\"x\">", None)])]
    df = spark.createDataFrame(rows, TURNS).orderBy("id")
    c = F.col("conversations")
    assert [r[0] for r in df.select(audit.phantom_context(c)).collect()] == [True, False, False]
    assert [r[0] for r in df.select(audit.tool_order_ok(c)).collect()] == [True, True, False]
    assert spark.range(1).select(audit.unsupported_numbers(F.lit("5 and 7.5 and 7.5"), F.lit("5"))).first()[0] == ["7.5"]
    h = audit.dataset_hash(spark.range(100).repartition(7), ["id"]).first()
    assert h == audit.dataset_hash(spark.range(100).coalesce(1), ["id"]).first()
    assert df.select(audit.label_spans(c)).first()[0][1].train is True


def test_sources(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([("a title here", "b", "lung")], "Title string, Abstract string, label string").coalesce(1).write.option("header", True).csv(f"{path}/in.csv")
    assert io.read_roles(spark, f"{path}/in.csv").columns == ["title", "abstract", "category"]
    assert io.read_any(spark, [f"{path}/none.csv", f"{path}/in.csv"]).count() == 1
    with pytest.raises(io.MissingSource):
        io.read_any(spark, [f"{path}/none.csv"])
    assert [r.idx for r in io.with_index(spark.range(50).repartition(7), ["id"]).orderBy("id").collect()] == list(range(50))
    io.write_manifest(spark, f"{path}/m.json", {"a": 1})
    assert io.read_manifest(spark, f"{path}/m.json") == {"a": 1} and io.read_manifest(spark, f"{path}/no.json") is None
    df = spark.createDataFrame([(1, "x", 0), (2, "y", 0)], "id int, cancer_type string, round int")
    io.write_round(df, f"{path}/rounds")
    io.write_round(df, f"{path}/rounds")
    assert spark.read.parquet(f"{path}/rounds").count() == 2


def test_stream_leaves_out_what_was_seen(spark, tmp_path):
    from corpusforge.streaming.incremental import clean_stream

    path = f"file://{tmp_path}"
    for k in range(2):
        records(spark).withColumn("idx", F.col("idx") + 100 * k).coalesce(1).write.mode("append").parquet(f"{path}/in")
        q = clean_stream(spark, f"{path}/in", records(spark).schema, f"{path}/out", f"{path}/cp")
        q.awaitTermination(120)
        assert spark.read.parquet(f"{path}/out").count() == 4


def test_sft_and_dpo_preparation(spark):
    rows = [(i, [("system", "s", None), ("human", "q" * 40, None), ("gpt", "a" * 80 if i % 5 else " ", None)], "k" if i % 2 else "l") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, conversations array<struct<`from`:string,value:string,train:boolean>>, cancer_type string")
    spans, rep = P.prepare_sft(df, "id", 64)
    assert spans.count() == 32 and rep.first().total_tokens == spans.agg(F.max("token_end")).first()[0]
    pairs = preference.pairs(df, F.lit("s"), F.lit("u"), F.concat(F.lit("c" * 60), F.col("id").cast("string")), F.lit("r" * 60), "h", ["id"])
    assert P.prepare_dpo(pairs, "id", 10, 1000).count() == 10 and P.prepare_dpo(pairs, "id", 10, 10).count() == 0


def test_treatment_has_notes_of_any_length(spark, sf):
    from corpusforge.plans import queries

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    asked = {r.patient_id for r in queries.QUERIES["treatment_stub"](spark, sf).select("patient_id").collect()}
    assert asked == {r.doc_id for r in docs.where("length(text) >= 100").select("doc_id").collect()}


def test_ranks_of_sparse_and_clustered_positions(spark):
    positions = [*range(0, 300), *(10**15 + 7 * k for k in range(300)), *(k * 10**12 for k in range(1, 300)), -5, 2**62]
    df = spark.createDataFrame([(p, i % 3) for i, p in enumerate(positions)], "p long, g int")
    ranked = position_rank(df, [], "p", bucket_rows=20).orderBy("p").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(positions) + 1))
    held = position_rank(df, ["g"], "p", weight=F.col("g") + 1, bucket_rows=20).orderBy("g", "p").collect()
    for g in range(3):
        assert [r["rank"] for r in held if r.g == g] == [k * (g + 1) for k in range(sum(r.g == g for r in held))]
    assert position_rank(df.where("p IS NULL"), [], "p").count() == 0


def test_batches_of_a_very_large_group(spark):
    df = spark.range(900).select("id", F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 20).alias("g"))
    by = lambda rows: {(r.id, r.batch, r.slot) for r in C.batches(df, ["g"], 1, ["id"], 4, rows).collect()}
    assert by(50) == by(10_000)


def test_system_messages_reach_the_generator(spark):
    class Says:
        def generate(self, prompts, settings, systems=None):
            return [(f"{s} / {p}", None, "ok") for p, s in zip(prompts, systems or [None] * len(prompts))]

    df = spark.createDataFrame([("a", "b")], "kind string, q string")
    phase = P.Phase(Says())
    row = phase.reply(df, "x", "answer", F.col("q"), F.lit(""), F.col("kind")).first()
    assert row.x == P.SYSTEMS["answer"].replace("{kind}", "A") + " / b"
    assert phase.reply(df, "x", "questions", F.col("q"), F.lit("")).first().x == "None / b"


def test_token_counter_can_be_given(spark):
    from corpusforge.functions import sentences as S

    text = "One two three four five six seven eight nine ten. " * 8
    df = spark.createDataFrame([(text,)], "t string").select(S.token_chunks(F.col("t"), 20, lambda s: len(s.split())).alias("c"))
    assert [len(c.split()) for c in df.first().c] == [20, 20, 20, 20]
    by_words = T.tokens_by(lambda s: len(s.split()))
    rows = spark.createDataFrame([("a b", "c " * 5, "d"), ("a b", "c", "d " * 9)], "prompt string, chosen string, rejected string")
    assert preference.within_budget(rows, 7, by_words).count() == 1 and spark.createDataFrame([(None,)], "t string").select(by_words("t")).first()[0] == 0


def test_datasets_and_manifests(spark, tmp_path):
    path = f"file://{tmp_path}"
    df = spark.range(5)
    io.save_dataset(df, f"{path}/d")
    assert io.load_dataset(spark, f"{path}/d", ["id"]).count() == 5
    with pytest.raises(io.MissingSource):
        io.load_dataset(spark, f"{path}/d", ["other"])
    df.write.mode("append").parquet(f"{path}/d/data")
    with pytest.raises(io.MissingSource):
        io.load_dataset(spark, f"{path}/d")
    with pytest.raises(io.MissingSource):
        io.load_dataset(spark, f"{path}/nothing")
    assert io.read_manifest(spark, f"{path}/none.json") is None
    io.write_manifest(spark, f"{path}/m.json", {"a": 1})
    io.write_manifest(spark, f"{path}/m.json", {"a": 2})
    assert io.read_manifest(spark, f"{path}/m.json") == {"a": 2} and not (tmp_path / "m.json.tmp").exists()
    (tmp_path / "m.json").write_text("no json")
    (tmp_path / ".m.json.crc").unlink(missing_ok=True)
    assert io.read_manifest(spark, f"{path}/m.json") is None


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from corpusforge import runtime

    conf = SimpleNamespace(get=lambda *_: None)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077", applicationId="a"))
    with pytest.raises(RuntimeError):
        runtime.application_dir(far)
    work = runtime.Workspace(spark)
    table = work.write(spark.range(3), "t")
    assert table.count() == 3 and runtime.application_dir(spark) in work.root
    work.close()
    with pytest.raises(Exception):
        spark.read.parquet(f"{work.root}/t")
