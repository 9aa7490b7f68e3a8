import random

import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with every odd case: nulls, empty and blank texts, a very long text, ties, a repeated row, and columns whose names clash with results."""
    rnd = random.Random(5)
    long = " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(60_000))
    texts = [None, "", "  \n ", "one two three", "one two three four five six seven", "One TWO three four five six seven", long, "x" * 50_000, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok', "Released under the MIT License.", "You stupid idiot."]
    rows = [(i, t, "src", 9, 9.5, True, "k") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "one two three four five six seven", None, None, None, None, None), (99, None, None, 1, 1.0, False, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int, score double, kept boolean, shard string")


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with exact and near copies, short texts and shared passages."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice(["the", "an", "or", "er", "ti", "on", "sh"]) for _ in range(rnd.randint(1, 4)))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        base = [word() for _ in range(rnd.choice([1, 3, 4, 5, 7, 12, 40, 120, 400]))]
        if rnd.random() < 0.3:
            base += passage
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 0, 1, 3, 9])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(("\n" if rnd.random() < 0.5 else " ").join(copy))
    rnd.shuffle(texts)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
