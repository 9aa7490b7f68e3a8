"""Text functions as native expressions; only HTML entities and NFC need Python, and only for texts that have any."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Blanks in the sense of Unicode, spelled out so that every regex engine agrees.
WS = r"[\t\n\x{000B}\f\r\x{001C}-\x{001F} \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters as one string, for native trims.
BLANK_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Characters replaced one by one, and those dropped.
REPLACED = {"’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}
DROPPED = ("​", "‎", "‏", "﻿")
#: Phrases and markers looked for in lower-cased texts.
RETRACTION = r"(^|[^\p{L}\p{N}_])(retracted|withdrawn?|retraction)($|[^\p{L}\p{N}_])"
AI_SPEAK = ("as an ai", "as a language model", "i cannot fulfill", "i'm sorry, but i")
LEAKS = (
    "according to the text", "as stated in the passage", "the text mentions", "the abstract states", "as described in the text", "the passage indicates",
    "based on the provided text", "the given abstract", "in the provided passage", "the text says", "as per the abstract", "the source text",
)
MORE_LEAKS = (
    "based on the provided abstract", "based on the abstract", "based strictly on the provided", "based strictly on the abstract", "the provided abstract", "the provided abstracts",
    "the abstracts provided", "according to the abstract", "this abstract", "in the abstract", "the above abstract", "the research finding above", "the finding above", "the study above",
)
MARKERS = (
    "tumor", "tumour", "cancer", "carcinoma", "adenocarcinoma", "metastas", "oncolog", "chemotherap", "radiation", "immunotherap", "biomarker", "prognos", "survival", "staging", "biopsy", "resect", "pathway",
    "mutation", "expression", "receptor", "inhibitor", "kinase", "apoptosis", "proliferat", "angiogenesis", "lymph node", "metastat", "p53", "EGFR", "HER2", "BRCA", "PD-L1", "checkpoint",
)
VERDICTS = ("hallucinated", "extrapolated", "grounded")  # the first that occurs counts


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


@F.pandas_udf(StringType())
def _unescape_nfc(texts: pd.Series) -> pd.Series:
    import html
    import unicodedata

    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", html.unescape(t)))


def unescape_nfc(c: Column) -> Column:
    """HTML entities decoded, then Unicode NFC; texts that can't change stay in the JVM."""
    return F.when(c.rlike(r"&|[^\x00-\x7F]"), _unescape_nfc(c)).otherwise(c)


def replace_characters(c: Column) -> Column:
    return F.translate(c, "".join(REPLACED) + "".join(DROPPED), "".join(REPLACED.values()))


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")


def strip(c: Column) -> Column:
    """Blanks of Unicode taken off both ends."""
    return F.btrim(c, F.lit(BLANK_CHARS))


def normalize(c: Column, entities: bool = True) -> Column:
    """Entities and NFC, character table, blanks, ends; null is ''."""
    c = _text(c)
    return strip(collapse_blanks(replace_characters(unescape_nfc(c) if entities else c)))


def category(c: Column) -> Column:
    """A lower-case name of letters, digits and underscores; 'unknown' if nothing is left."""
    name = F.regexp_replace(F.translate(strip(F.lower(_text(c))), " ", "_"), "[^a-z0-9_]", "")
    return F.when(name == "", "unknown").otherwise(name)


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(_text(c), f"{WS}+"), lambda x: x != ""))


def fingerprint(c: Column) -> Column:
    """16 hex digits of the SHA-256 of the lower-cased letters, digits and single blanks."""
    kept = F.regexp_replace(F.lower(_text(c)), WS.replace("[", "[^a-z0-9", 1), "")
    return F.substring(F.sha2(strip(F.regexp_replace(kept, f"{WS}+", " ")), 256), 1, 16)


def is_english(c: Column) -> Column:
    """20 letters or more, of which more than 0.85 lie below U+0250."""
    letters = F.length(F.regexp_replace(_text(c), r"[^\p{L}]", ""))
    latin = F.length(F.regexp_replace(F.regexp_replace(_text(c), r"[^\p{L}]", ""), r"[^\x{0000}-\x{024F}]", ""))
    return (letters >= 20) & (latin / letters > 0.85)


def is_retracted(title: Column, abstract: Column) -> Column:
    return F.lower(F.concat(_text(title), F.lit(" "), _text(abstract))).rlike(RETRACTION)


def contains_any(c: Column, phrases: tuple[str, ...]) -> Column:
    """Whether the text holds one of the phrases. One pattern, so that what makes the text is computed once wherever the condition is pushed to."""
    return c.rlike(any_of(phrases))


def any_of(phrases: tuple[str, ...]) -> str:
    """A pattern that finds any of the phrases as they stand, grouped by their first character so that a place is left at once where none can start."""
    by_start: dict[str, list[str]] = {}
    for p in dict.fromkeys(phrases):
        by_start.setdefault(p[0], []).append(re.escape(p[1:]))
    return "(?:" + "|".join(f"{re.escape(a)}(?:{'|'.join(rest)})" for a, rest in by_start.items()) + ")"


@lru_cache(maxsize=1)
def _plain_rules() -> dict:
    """What the functions on one Python text need: the same tables and patterns as the expressions."""
    import regex

    letters = bytes(b for b in range(128) if not chr(b).isalpha())
    kept = bytes(b for b in range(128) if not (chr(b).isdigit() or "a" <= chr(b) <= "z" or chr(b) in BLANK_CHARS))
    return {
        "table": str.maketrans(REPLACED | dict.fromkeys(DROPPED)), "moved": re.compile(f"[{re.escape(''.join(REPLACED) + ''.join(DROPPED))}]"), "blanks": re.compile(r"[ \t]+"), "lines": re.compile(r"\n{3,}"), "not_letters": letters, "not_kept": kept, "retraction": regex.compile(RETRACTION),
        "letters": regex.compile(r"[^\p{L}]+"), "latin": re.compile("[^\u0000-\u024f]+"), "others": re.compile("[^\x00-\x7f]+"), "far_blanks": re.compile(f"[{''.join(b for b in BLANK_CHARS if not b.isascii())}]"), "dropped": re.compile(f"[^a-z0-9{re.escape(BLANK_CHARS)}]+"),
    }


def normalize_text(text: str | None, entities: bool = True) -> str:
    """`normalize` for one text in Python."""
    import html
    import unicodedata

    rules, text = _plain_rules(), text or ""
    if entities and "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        if entities and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if rules["moved"].search(text):
            text = text.translate(rules["table"])
    if "  " in text or "\t" in text:
        text = rules["blanks"].sub(" ", text)
    return (rules["lines"].sub("\n\n", text) if "\n\n\n" in text else text).strip(BLANK_CHARS)


def is_english_text(text: str) -> bool:
    """`is_english` for one text in Python."""
    rules = _plain_rules()
    plain = len(text.encode("ascii", "ignore").translate(None, rules["not_letters"]))
    if text.isascii():
        return plain >= 20
    others = rules["letters"].sub("", "".join(rules["others"].findall(text)))
    n = plain + len(others)
    return n >= 20 and (plain + len(rules["latin"].sub("", others))) / n > 0.85


def is_retracted_text(title: str, abstract: str) -> bool:
    """`is_retracted` for one record in Python."""
    low = f"{title} {abstract}".lower()
    return ("retract" in low or "withdraw" in low) and _plain_rules()["retraction"].search(low) is not None


def fingerprint_text(text: str) -> str:
    """`fingerprint` for one text in Python."""
    rules, low = _plain_rules(), text.lower()
    if rules["far_blanks"].search(low):
        bare = rules["dropped"].sub("", low)
    else:  # of all other characters only ASCII ones stay
        bare = low.encode("ascii", "ignore").translate(None, rules["not_kept"]).decode()
    return hashlib.sha256(" ".join(bare.split()).encode()).hexdigest()[:16]


def is_low_quality(c: Column) -> Column:
    """Fewer than 50 characters, or a phrase of assistants in any case."""
    return ~strip(_text(c)).rlike(rf"(?is)\A(?=.{{50}})(?!.*{any_of(AI_SPEAK)})")


def has_thinking(c: Column) -> Column:
    return _text(c).rlike(r"(?s)<think>.*?</think>")


def starts_thinking(c: Column) -> Column:
    return F.startswith(strip(_text(c)), F.lit("<think>"))


def mentions_thinking(c: Column) -> Column:
    return F.contains(_text(c), F.lit("<think>"))


def is_leaked(c: Column, strict: bool = False) -> Column:
    """Whether an answer speaks of its source text; `strict` has the longer list."""
    return contains_any(F.lower(_text(c)), LEAKS + (MORE_LEAKS if strict else ()))


def has_marker(c: Column, as_published: bool = False) -> Column:
    """Whether a text has one of the markers. `as_published` leaves the upper-case markers as they are, which lower-cased texts never have."""
    return contains_any(F.lower(_text(c)), MARKERS if as_published else tuple(m.lower() for m in MARKERS))


def strip_thinking(c: Column) -> Column:
    return strip(F.regexp_replace(_text(c), r"(?s)<think>.*?</think>", ""))


def process_answer(c: Column, keep_thinking: bool = True) -> Column:
    """An answer as it is trained on: with its thinking, or without closed, unclosed and stray blocks."""
    if keep_thinking:
        return strip(_text(c))
    return strip(F.regexp_replace(strip(F.regexp_replace(strip_thinking(c), r"(?s)<think>.*", "")), r"(?s)</think>.*", ""))


def with_reasoning(content: Column, reasoning: Column) -> Column:
    content, reasoning = strip(_text(content)), strip(_text(reasoning))
    return F.when(reasoning != "", F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n"), content)).otherwise(content)


def strip_fence(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(_text(c)), r"^```(?:json)?[ \t\r\n]*", ""), r"[ \t\r\n]*```$", ""))


def parse_questions(c: Column, most: int | None = None, longer_than: int = 0) -> Column:
    """The non-blank strings of {"questions": [...]}, stripped; [] for anything else. Items that aren't strings are left out."""
    raw = F.from_json(strip_fence(c), "questions array<variant>")["questions"]
    kind = lambda q: F.schema_of_variant(q) == "STRING"
    texts = F.transform(F.filter(raw, lambda q: kind(q)), lambda q: strip(q.cast("string")))
    found = F.coalesce(F.filter(texts, lambda q: F.length(q) > longer_than), F.array().cast("array<string>"))
    return F.slice(found, 1, most) if most else found


def parse_verdict(c: Column) -> Column:
    """grounded, extrapolated or hallucinated; a reply that says none is grounded."""
    low = F.lower(strip(_text(c)))
    out = F.lit("grounded")
    for v in VERDICTS[1::-1]:
        out = F.when(F.contains(F.right(low, F.lit(100)), F.lit(v)), v).otherwise(out)
    for v in VERDICTS[::-1]:
        out = F.when(F.contains(low, F.lit(f"verdict: {v}")), v).otherwise(out)
    return out


def display_name(c: Column, prefix: str = "") -> Column:
    """A type's name for readers: without the prefix, underscores as blanks, in title case."""
    bare = F.replace(_text(c), F.lit(prefix), F.lit("")) if prefix else _text(c)
    return F.initcap(F.replace(bare, F.lit("_"), F.lit(" ")))


def approximate_tokens(c: Column) -> Column:
    """Characters by four: the deterministic stand-in for a tokenizer."""
    return F.floor(F.length(_text(c)) / 4).cast("int")


def tokens_by(count: Callable[[str], int]) -> Callable[[Column], Column]:
    """A stand-in for `approximate_tokens` by any tokenizer: `count` gives a text's tokens and runs on Arrow batches in the workers, so it must be picklable. A null text has none."""

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: 0 if t is None else count(t))

    return run


def preview(c: Column, most: int = 300) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def key_prefix(c: Column, size: int = 100) -> Column:
    """The lossy key of a chunk: its first characters."""
    return F.substring(c, 1, size)


def bar(percent: Column) -> Column:
    return F.repeat(F.lit("█"), F.floor(percent / 2).cast("int"))


def chat_url(c: Column) -> Column:
    """An API address that ends in /chat/completions."""
    base = strip(c)
    bare = F.regexp_replace(base, "/+$", "")
    return F.when(F.endswith(base, F.lit("/chat/completions")), base).when(F.endswith(bare, F.lit("/v1")), F.concat(bare, F.lit("/chat/completions"))).otherwise(F.concat(bare, F.lit("/v1/chat/completions")))


def seeded_hash(seed: str | int, *keys: Column) -> Column:
    """A hex digest that orders rows at random, the same in every engine and for every partitioning."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def pick_number(digest: Column, n: int) -> Column:
    """0..n-1 from a digest's first eight hex digits."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n).cast("int")


def pick(options: list[str] | tuple[str, ...], digest: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), pick_number(digest, len(options)) + 1)
