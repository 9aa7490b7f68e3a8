"""Sentences and chunks.

Sentences are found by regular expressions that Java and RE2 read alike. Chunks split and fold a text in one Arrow-batched UDF: interpreted SQL
folds give the same chunks at a third of the speed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship_package
from .text import BLANK_CHARS, WS, strip

#: Abbreviations whose full stop ends no sentence.
DOTTED = ("i.v.", "i.m.", "s.c.", "p.o.", "e.g.", "i.e.", "U.S.", "E.U.")
ABBREVIATIONS = (
    "approx", "avg", "ca", "dept", "diam", "div", "est", "fig", "figs", "gov", "hr", "hrs", "mg", "ml", "mo", "mos", "no", "nos", "pt", "pts", "vol", "wk", "wks", "yr", "yrs", "vs",
    "admin", "adj", "assoc", "diff", "diag", "eval", "max", "min", "neg", "pos", "prev", "prog", "qual", "quant", "resp", "sig", "supp", "surg", "ther", "tx", "dx",
    "dr", "prof", "mr", "mrs", "ms", "al", "ed", "eds", "eg", "esp", "ie", "inc", "ltd", "corp", "univ", "del", "ins", "mut", "amp", "chr",
)
#: Stand-ins for a protected full stop and for a border; neither occurs in texts.
STOP, BORDER = "\u0002", "\u0001"
ABBREVIATION = rf"(?i)(^|[^\p{{L}}\p{{N}}_])({'|'.join(ABBREVIATIONS)})\."
SENTENCE_END = r"([.!?]+[\"')\]]*)[ \t\r\f]+([A-ZÀ-ÖØ-Þ0-9\"'(\[])"
LINE_END = r"[ \t\r\f]*\n[ \t\r\n\f]*"
CHUNK, OVERLAP, LEAST, TOKEN_CHUNK, SEED_TOKENS, LEAST_COMPLETION = 1500, 2, 50, 500, 60, 100


def protect(c: Column) -> Column:
    for dotted in DOTTED:
        c = F.regexp_replace(c, f"(?i)({dotted[0]})\\.({dotted[2]})\\.", f"$1{STOP}$2{STOP}")
    return F.regexp_replace(c, ABBREVIATION, f"$1$2{STOP}")


def restore(c: Column) -> Column:
    return F.translate(c, STOP, ".")


def sentences(c: Column) -> Column:
    """The non-empty sentences of a text, stripped; [] for null."""
    marked = F.regexp_replace(protect(F.coalesce(c, F.lit(""))), LINE_END, BORDER)
    marked = F.regexp_replace(marked, SENTENCE_END, f"$1{BORDER}$2")
    return F.filter(F.transform(F.split(restore(marked), BORDER), strip), lambda s: s != "")


_BLANKS = BLANK_CHARS
_DOTTED = frozenset(d.lower() for d in DOTTED)
_SHORT = frozenset(ABBREVIATIONS)
_LONGEST = max(map(len, ABBREVIATIONS))
_END = re.compile(r"[.!?][\"')\]]*[ \t\r\f]+(?=[A-ZÀ-ÖØ-Þ0-9\"'(\[])")
_AFTER = re.compile(r"[\"')\]]*")


def _is_protected(text: str, dot: int) -> bool:
    """Whether the full stop at `dot` ends an abbreviation. The border before an abbreviation can't be the full stop of the one before it, which the pattern has used up."""
    if text[dot - 3 : dot + 1].lower() in _DOTTED and dot >= 3:
        return True
    start = dot
    while start and dot - start <= _LONGEST and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    if text[start:dot].lower() not in _SHORT:
        return False
    if not start:
        return True
    before = text[start - 1]
    if before.isalnum() or before == "_":
        return False
    return not (before == "." and not (start >= 4 and text[start - 4 : start].lower() in _DOTTED) and _is_protected(text, start - 1))


def split_sentences(text: str | None) -> list[str]:
    """The sentences that `sentences` finds, for one text in Python: only full stops before a possible start are looked at."""
    text = text or ""
    cuts = [0]
    for m in _END.finditer(text):
        at = m.start()
        if text[at] != "." or not _is_protected(text, at):
            cuts.append(_AFTER.match(text, at + 1).end())
    cuts.append(len(text))
    return [s for a, b in zip(cuts, cuts[1:]) for line in text[a:b].split("\n") if (s := line.strip(_BLANKS))]


def pack(sents: list[str], most: int, overlap: int, weigh: Callable[[str], int], joint: int) -> list[list[str]]:
    """Sentences in groups of up to `most` in weight: a group is closed when the next sentence would exceed it, and its last `overlap` sentences start the next one.

    The weight of a joint is asked for before the carry, as the published chunker does; a sentence over the limit stays whole.
    """
    groups: list[list[str]] = []
    held: list[str] = []
    total = 0
    for s in sents:
        w = weigh(s) + (joint if held else 0)
        if held and total + w > most:
            groups.append(held)
            held = held[-overlap:] if overlap else []
            total = sum(map(weigh, held)) + joint * max(0, len(held) - 1)
        held = [*held, s]
        total += w
    return [*groups, held] if held else groups


def fold_chunks(sents: list[str], most: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    return [t for g in pack(sents, most, overlap, len, 1) if len(t := " ".join(g)) > LEAST]


def _by_four(text: str) -> int:
    """Tokens as characters by four."""
    return len(text) // 4


def fold_token_chunks(sents: list[str], most: int = TOKEN_CHUNK, count: Callable[[str], int] = _by_four) -> list[str]:
    return [t for g in pack(sents, most, 0, count, 0) if len(t := " ".join(g).strip()) > LEAST]


def fold_seed(sents: list[str], total: int, seed: int = SEED_TOKENS, count: Callable[[str], int] = _by_four) -> tuple[str, str] | None:
    """(start, rest): sentences up to 0.6 of the seed, none that would pass 1.3 of it unless first; one sentence at least is left."""
    if len(sents) < 2 or total <= seed + 20:
        return None
    size = taken = 0
    for s in sents:
        w = count(s)
        if taken and size + w > seed * 1.3:
            break
        size, taken = size + w, taken + 1
        if size >= seed * 0.6:
            break
    taken = min(taken, len(sents) - 1)
    start, rest = " ".join(sents[:taken]).strip(), " ".join(sents[taken:]).strip()
    return (start, rest) if start and rest else None


def _folded(fold: Callable[[str | None], list[str]]) -> Callable[[Column], Column]:
    """A function from texts to lists of texts as an Arrow-batched column function: sentences are split and folded in one place."""
    ship_package(SparkSession.active())

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fold)

    return run


def chunks(c: Column, most: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Chunks of whole sentences of about `most` characters that share `overlap` sentences; those of LEAST characters or fewer are left out."""
    return _folded(lambda t: fold_chunks(split_sentences(t), most, overlap))(c)


def token_chunks(c: Column, most: int = TOKEN_CHUNK, count: Callable[[str], int] | None = None) -> Column:
    """Chunks of whole sentences of up to `most` tokens without overlap; `count` gives a text's tokens, characters by four if it isn't given."""
    return _folded(lambda t: fold_token_chunks(split_sentences(t), most, count or _by_four))(c)


def seed_completion(c: Column, seed: int = SEED_TOKENS, count: Callable[[str], int] | None = None) -> Column:
    """struct(seed, completion) of a chunk, null where it can't be split."""
    ship_package(SparkSession.active())
    weigh = count or _by_four

    @F.pandas_udf("struct<seed string, completion string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        parts = [fold_seed(split_sentences(t), weigh(t or ""), seed, weigh) or (None, None) for t in texts]
        return pd.DataFrame(parts, columns=["seed", "completion"])

    split = run(c)
    return F.when(split["seed"].isNotNull(), split)


__all__ = ["WS", "chunks", "fold_chunks", "fold_seed", "fold_token_chunks", "pack", "protect", "restore", "seed_completion", "sentences", "split_sentences", "token_chunks"]
