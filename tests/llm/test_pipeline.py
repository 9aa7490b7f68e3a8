"""The pipeline's stages against plain code, on a small corpus with planted cases."""

import random

import sentencepiece

import corpus_pipeline as P
from corpusforge.llm import queries


def test_stages(spark, tmp_path):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice(["ba", "do", "li", "me", "ru", "ta"]) for _ in range(rnd.randint(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(30)
    rows, labels = [], []
    for i in range(300):
        t = text(60)
        if toxic := i % 10 == 0:
            t += " zorgle plimf " + text(3) + " zorgle"
        rows.append((i, t))
        labels.append((i, 1, int(toxic)))
    rows += [(300, text(40) + " " + item + " " + text(40)), (301, rows[1][1]), (302, rows[1][1] + " ru"), (303, text(50) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + text(9)), (304, None), (305, ""), (306, rows[2][1]), (306, rows[2][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", docs), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    kept = [i for i in range(300) if i % 10] + [303, 304, 305]
    assert sorted(r.doc_id for r in out) == kept
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    clean = {i: (t or "").replace("24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "[SECRET]") for i, t in rows}
    assert all(r.ids == sp.encode(clean[r.doc_id], add_bos=True, add_eos=True) for r in out)
    assert 3 < len(P.STAGES) < 6 and P.ORACLE_SQL is None


def test_empty(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
