"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits and signs that stand for letters), the lexicon is matched by Aho-Corasick on whole
words, hits inside exception phrases don't count, and the weights are set against the text's length. Entries, exceptions (beside
those that a caller states) and the four numbers that turn hits into a probability are learned from labelled rows.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField

from .arrow import append, pieces, texts_of

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ß", "ſ": "s",
}
#: Digits and signs that stand for letters. Signs count inside a word only, with a letter next to them on both sides or after them at its start.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l", "€": "e", "£": "l", "+": "t"}
#: Entries known before any labels are seen, and phrases that make a hit harmless.
SEED_LEXICON = ("idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "trash", "clown")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown", "class clown", "pond scum", "soap scum", "loser pays")
#: Learning: labelled rows used at most (a hash sample beyond), entries at most, least toxic rows for an entry, least lift, and how many standard deviations its toxic rows must lie above chance; rows of each label that a separate third must have to calibrate on it.
SAMPLE_ROWS, LEXICON_SIZE, LEAST_ROWS, LEAST_LIFT, LEAST_SIGMA, LEAST_CALIBRATION = 20_000, 2_000, 3, 3.0, 7.0, 20


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in HOMOGLYPHS.items()}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]:  # accents and full-width forms
        if code not in table and len(base := unicodedata.normalize("NFKD", chr(code)).lower()) and base[0].isascii() and base[0].isalpha() and all(unicodedata.combining(c) for c in base[1:]):
            table[code] = base[0]
    return table


@lru_cache(maxsize=1)
def _sign_rule():
    signs = "".join(map(regex.escape, SIGNS))
    return regex.compile(rf"(?<=\p{{L}})[{signs}]+(?=\p{{L}})|(?<![\p{{L}}{signs}])[{signs}](?=\p{{L}})")


@lru_cache(maxsize=1)
def _digit_rule():
    signs = "".join(map(regex.escape, SIGNS))
    return regex.compile(rf"[\p{{L}}{signs}]*\d[\p{{L}}\d{signs}]*"), str.maketrans(DIGITS)


def _letters_for_digits(m) -> str:
    """Digits stand for letters in a word that has letters; a plain number stays a number."""
    word = m.group()
    return word.translate(_digit_rule()[1]) if any(c.isalpha() for c in word) else word


_ZERO_WIDTH = {0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None, 0xFEFF: None}


_HAS_DIGIT = regex.compile(r"[0-9]")


def fold(text: str) -> str:
    """Lower case, without accents, look-alikes and substitutions."""
    folded = text.lower()
    if not folded.isascii():
        folded = folded.translate(_fold_table() | _ZERO_WIDTH)
    if _HAS_DIGIT.search(folded):
        folded = _digit_rule()[0].sub(_letters_for_digits, folded)
    if any(s in folded for s in SIGNS):
        folded = _sign_rule().sub(lambda m: "".join(SIGNS[c] for c in m.group()), folded)
    return folded


WORDS = regex.compile(r"\p{L}+")
_WORD_BEFORE, _WORD_AFTER = regex.compile(r"(\p{L}+) $"), regex.compile(r" (\p{L}+)")


@dataclass
class Lexicon:
    """Entries (folded) with weights, harmless phrases, and how hits become a probability."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    model: tuple[float, ...] = (-4.0, 1.5, 1.0, 0.3)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "model": self.model, "_automaton": None}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for phrase in map(fold, self.exceptions):
                self._automaton.add_word(phrase, (len(phrase), None, phrase))
            for word, weight in self.weights.items():
                if word not in map(fold, self.exceptions):
                    self._automaton.add_word(word, (len(word), weight, word))
            self._automaton.make_automaton()
        return self._automaton

    def hits(self, text: str) -> tuple[list[tuple[int, int, float, str]], str]:
        """(start, end, weight, entry) in the folded text, whole words outside exception phrases; and that text."""
        folded = fold(text)
        if not len(self.automaton()):
            return [], folded
        found, harmless = [], []
        for end, (n, weight, entry) in self.automaton().iter(folded):
            start, stop = end + 1 - n, end + 1
            if (start and folded[start - 1].isalnum()) or (stop < len(folded) and folded[stop].isalnum()):
                continue
            (harmless if weight is None else found).append((start, stop, weight, entry))
        if harmless:
            found = [h for h in found if not any(a <= h[0] and h[1] <= b for a, b, _, _ in harmless)]
        return found, folded

    def features(self, text: str) -> tuple[float, float, float, int]:
        """Sum of weights by hundred words (damped), log of the sum, the largest weight, and the number of hits. An entry that comes again adds less and less, so that a repeated line weighs little more than one."""
        found, folded = self.hits(text)
        if not found:
            return 0.0, 0.0, 0.0, 0
        times = Counter(h[3] for h in found)
        total = sum(self.weights[entry] * (1.0 + math.log(n)) for entry, n in times.items())
        words = folded.count(" ") + folded.count("\n") + 1
        return math.log1p(max(0.0, 100.0 * total / (words + 20))), math.log1p(max(0.0, total)), max(h[2] for h in found), len(found)

    def score(self, features: tuple[float, float, float, int]) -> float:
        z = self.model[0] + sum(a * b for a, b in zip(self.model[1:], features[:3], strict=True))
        return 1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0


def _words_by_class(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Folded words: the numbers of toxic and of other rows that have them, summed on the map side first."""
    from ..runtime import ship_package

    ship_package(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            labels = batch.column(1).to_pylist()
            for text, label in zip(texts_of(batch.column(0)), labels, strict=True):
                for word in set(WORDS.findall(fold(text))):
                    if len(word) >= 2:
                        seen.setdefault(word, [0, 0])[1 if label else 0] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["word", "toxic", "other"])

    return df.select(text_col, F.col(label_col).cast("int")).mapInArrow(count, "word string, toxic long, other long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _harmless_phrases(df: DataFrame, text_col: str, label_col: str, lexicon: Lexicon, size: int) -> list[str]:
    """Two-word phrases around an entry that LEAST_ROWS or more rows have and no toxic one, `size` at most, those of most rows first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                hits, folded = lexicon.hits(text)
                phrases = set()
                for start, stop, _, entry in hits:
                    if (m := _WORD_BEFORE.search(folded, max(0, start - 60), start)) is not None:
                        phrases.add(f"{m[1]} {entry}")
                    if (m := _WORD_AFTER.match(folded, stop)) is not None:
                        phrases.add(f"{entry} {m[1]}")
                for phrase in phrases:
                    seen.setdefault(phrase, [0, 0])[1 if label else 0] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["phrase", "toxic", "other"])

    counted = df.select(text_col, F.col(label_col).cast("int")).mapInArrow(count, "phrase string, toxic long, other long").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    return [r.phrase for r in counted.where((F.col("toxic") == 0) & (F.col("other") >= LEAST_ROWS)).orderBy(F.desc("other"), "phrase").limit(size).collect()]


def learn_lexicon(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, size: int = LEXICON_SIZE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Fit on labelled rows (0/1), at most about `sample_rows` of them, by a hash of `id_col`; null labels are left out.

    An entry is a word whose rate among toxic rows is LEAST_LIFT times its rate among others or more, in LEAST_ROWS toxic rows or more; its weight is the log of the smoothed ratio of rates.
    Phrases of two words around an entry that occur in other rows only become exceptions. At most `size` entries and `size` phrases come to the driver, those of most weight first. Without labelled rows the seed lexicon stands alone.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    n = {bool(r[0]): r[1] for r in rows.groupBy(F.col(label_col) > 0).count().collect()}
    share = max(1, -(-sum(n.values()) // sample_rows))
    if share > 1:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(share)) == 0)
        n = {bool(r[0]): r[1] for r in rows.groupBy(F.col(label_col) > 0).count().collect()}
    toxic, other = n.get(True, 0), n.get(False, 0)
    if not toxic or not other:
        return Lexicon(dict.fromkeys(SEED_LEXICON, 4.0), exceptions)
    fold = F.pmod(F.xxhash64(F.lit(9), F.col(id_col)), F.lit(3)) == 0  # entries and calibration come from different rows, else chance entries look certain
    m = {bool(r[0]): r[1] for r in rows.where(fold).groupBy(F.col(label_col) > 0).count().collect()}
    calibrating = rows.where(fold)
    if min(m.get(True, 0), m.get(False, 0)) >= LEAST_CALIBRATION:
        rows, toxic, other = rows.where(~fold), toxic - m[True], other - m[False]
    else:
        calibrating = rows
    lift = ((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("other") + 0.5) / (other + 1.0))
    counted = _words_by_class(rows, text_col, label_col).where((F.col("toxic") >= LEAST_ROWS) & (lift >= LEAST_LIFT)).withColumn("weight", F.log(lift))
    # words that are as rare as chance would make them are kept out: the lift must hold against the spread of the counts
    sure = F.col("toxic") - (F.col("toxic") + F.col("other")) * (toxic / (toxic + other)) >= LEAST_SIGMA * F.sqrt((F.col("toxic") + F.col("other")) * (toxic / (toxic + other)) * (other / (toxic + other)) + 1e-9)
    best = counted.where(sure).orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "word").limit(size).collect()
    weights = {r.word: float(r.weight) for r in best}
    for word in SEED_LEXICON:
        weights.setdefault(word, 2.0)
    lexicon = Lexicon(weights, tuple(dict.fromkeys([*exceptions, *_harmless_phrases(rows, text_col, label_col, Lexicon(weights, exceptions), size)])))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [lexicon.features(t)[:3] for t in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in f], pa.float64()) for k in range(3)] + [batch.column(1)], names=["a", "b", "c", "y"])

    table = np.array([tuple(r) for r in calibrating.select(text_col, (F.col(label_col) > 0).cast("int").alias("y")).mapInArrow(featurise, "a double, b double, c double, y int").collect()])  # four numbers for each sampled row
    table = table[np.lexsort(table.T)]
    lexicon.model = _logistic(table[:, :3], table[:, 3])
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Newton's method with a ridge; intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def score_toxicity(df: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """df plus score (0 to 1), predicted (1 if score >= threshold) and toxic_hits.

    Whole texts are scored; a null or empty text has no hits and the lowest score. Repeated rows are scored each; an empty table gives an empty result; clashing columns are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON_SIZE bounds it

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for rows in pieces(batch, text_col, 4 << 20):
                features = [shared.value.features(t) for t in texts_of(rows.column(text_col))]
                scores = [shared.value.score(f) for f in features]
                yield rows, [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array([f[3] for f in features], pa.int64())]

    return append(df, [StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("toxic_hits", LongType())], compute, keep)
