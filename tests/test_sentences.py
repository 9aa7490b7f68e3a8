from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import sentences as S


def split(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(S.sentences(F.col("t"))).first()[0]


def test_abbreviations_hold_sentences_together(spark):
    assert split(spark, "Given i.v. by Dr. Smith et al. in Fig. 3. Next one vs. other. \"Quoted.\" End!\nNew line") == ["Given i.v. by Dr. Smith et al. in Fig. 3.", "Next one vs. other.", "\"Quoted.\"", "End!", "New line"]
    assert split(spark, None) == [] and split(spark, " \n ") == []


sents = st.lists(st.text(alphabet="ab c", min_size=1, max_size=60).map(str.strip).filter(bool), max_size=30)


@settings(max_examples=60, deadline=None)
@given(sents, st.integers(20, 120), st.integers(0, 2))
def test_chunks_are_runs_of_sentences(items, most, overlap):
    groups = S.pack(items, most, overlap, len, 1)
    assert (not items) == (not groups)
    for a, b in zip(groups, groups[1:], strict=False):
        carry = a[-overlap:] if overlap else []
        assert b[: len(carry)] == carry
    flat = [s for k, g in enumerate(groups) for s in (g if k == 0 else g[min(overlap, len(groups[k - 1])) :])]
    assert flat == items


def test_separator_is_counted_before_the_carry():
    assert S.pack(["aaaa", "bbbb", "cccc"], 9, 0, len, 1) == [["aaaa", "bbbb"], ["cccc"]]
    assert S.pack(["aaaa", "bbbbb", "ccc", "d"], 9, 0, len, 1) == [["aaaa"], ["bbbbb"], ["ccc", "d"]]  # 5 + 1 and 3 + 1 are over 9
    assert S.fold_chunks(["x" * 2000]) == ["x" * 2000] and S.fold_chunks(["x" * 50]) == []


def test_seed():
    assert S.fold_seed(["x" * 400], 100) is None
    assert S.fold_seed(["x" * 100, "y" * 400], 60 + 20) is None
    start, rest = S.fold_seed(["x" * 100, "y" * 100, "z" * 400], 150)
    assert (len(start), len(rest)) == (201, 400)
    start, rest = S.fold_seed(["x" * 400, "y" * 10], 102)
    assert rest == "y" * 10
