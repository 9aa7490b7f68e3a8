import html
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as T


def apply(spark, f, values, *more):
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    return [r[0] for r in df.select(f(F.col("v"), *more)).collect()]


def test_normalize_entities_and_table(spark):
    cases = ["a &amp; b", "&#x2019;x", "é", "a​b﻿", "a\t \tb", "a\n\n\n\nb", "“q” — –", "  x 　", None, ""]
    got = apply(spark, T.normalize, cases)

    def expected(t):
        t = unicodedata.normalize("NFC", html.unescape(t or ""))
        for a, b in [*T.REPLACED.items(), *((d, "") for d in T.DROPPED)]:
            t = t.replace(a, b)
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    assert got == [expected(c) for c in cases]


@pytest.mark.parametrize(("text", "expected"), [("a" * 19, False), ("a" * 20, True), ("a" * 85 + "一" * 15, False), ("a" * 86 + "一" * 14, True), (None, False)])
def test_english(spark, text, expected):
    assert (apply(spark, T.is_english, [text])[0] or False) is expected


def test_fingerprint_ignores_case_and_signs(spark):
    a, b, c, d, e = apply(spark, T.fingerprint, ["Hello,  World!", "hello world", "hello world", "中文", ""])
    assert a == b == c and d == e and len(a) == 16


def test_low_quality(spark):
    assert apply(spark, T.is_low_quality, [None, " ", "x" * 49, "x" * 50, "x" * 60 + " As an AI", "<think>as an ai</think>" + "x" * 60]) == [True, True, True, False, True, True]


def test_thinking(spark):
    cases = ["<think>a</think>b", "<think>a", "a</think>b", "<think>a\nb</think>c<think>d</think>e", None]
    assert apply(spark, T.has_thinking, cases) == [True, False, False, True, False]
    assert apply(spark, T.process_answer, cases, False) == ["b", "", "a", "ce", ""]
    assert apply(spark, T.starts_thinking, [" <think>x", "x<think>"]) == [True, False]


def test_verdicts(spark):
    cases = ["VERDICT: GROUNDED", "verdict: extrapolated ... VERDICT: HALLUCINATED", "x" * 200 + " it is extrapolated", "hallucinated " + "x" * 200, None]
    assert apply(spark, T.parse_verdict, cases) == ["grounded", "hallucinated", "extrapolated", "grounded", "grounded"]


def test_questions(spark):
    cases = ['{"questions": [" a? ", "", 3, "b?"]}', '```json\n{"questions": ["x"]}\n```', "no json", None, '{"questions": []}']
    assert apply(spark, T.parse_questions, cases) == [["a?", "b?"], ["x"], [], [], []]
    assert apply(spark, T.parse_questions, ['{"questions": ["short", "a long question indeed", "another long question", "third long question"]}'], 2, 15) == [["a long question indeed", "another long question"]]


def test_category_names_and_urls(spark):
    assert apply(spark, T.category, [" Lung Cancer ", "A-B/c", None, "!!"]) == ["lung_cancer", "abc", "unknown", "unknown"]
    assert apply(spark, lambda c: T.display_name(c, "set_"), ["set_lung_cancer"]) == ["Lung Cancer"]
    assert apply(spark, T.chat_url, ["http://h/v1/", "http://h", "http://h/v1/chat/completions"]) == ["http://h/v1/chat/completions"] * 3


def test_retraction(spark):
    df = spark.createDataFrame([("Retracted: x", "y"), ("t", "patients withdrawn from study"), ("t", "a contraction"), (None, None)], "t string, a string")
    assert [r[0] for r in df.coalesce(1).select(T.is_retracted(F.col("t"), F.col("a"))).collect()] == [True, True, False, False]


def test_leaks_and_markers(spark):
    assert apply(spark, T.is_leaked, ["According to the text, x", "this abstract says"]) == [True, False]
    assert apply(spark, T.is_leaked, ["this abstract says"], True) == [True]
    assert apply(spark, T.has_marker, ["EGFR positive"]) == [True]
    assert apply(spark, T.has_marker, ["EGFR positive"], True) == [False]


def test_python_and_native_rules_agree(spark):
    """Texts put together from pieces that the rules treat apart: each function on a Python text gives what the expression gives."""
    import random

    from corpusforge.functions import sentences as S

    rnd = random.Random(1)
    pieces = ["vs.", "al.", "e.g.", "U.S.", "no.", "Fig.", "The", "word", '"Hi', "(a)", "end!", 'what?"', "\n", "\n\n", "\t", "..", "3.5", "i.e.", "ß.", "É", "_vs.", "1vs.", "\xa0", ".)", "al.vs.", "e.g.al.", "p.o.o.", "&amp;", "“q”", "—", "\x1f", "retracted", "Withdrawn", "é", "İ", "日本"]
    rows = [(i, "".join(rnd.choice(pieces) + rnd.choice(["", " ", "  "]) for _ in range(rnd.randint(0, 50)))) for i in range(1500)]
    t = F.col("t")
    df = spark.createDataFrame(rows, "id int, t string").select("t", S.sentences(t).alias("s"), T.normalize(t).alias("n"), T.fingerprint(t).alias("f"), F.coalesce(T.is_english(t), F.lit(False)).alias("e"), T.is_retracted(F.lit(""), t).alias("r"))
    for r in df.collect():
        assert (S.split_sentences(r.t), T.normalize_text(r.t), T.fingerprint_text(r.t), T.is_english_text(r.t), T.is_retracted_text("", r.t)) == (r.s, r.n, r.f, r.e, r.r)
