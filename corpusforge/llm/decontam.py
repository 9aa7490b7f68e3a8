"""Benchmark decontamination: every passage of every text is a query to a BM25 index of the test items.

The index holds the items in blocks. For each passage the sum of its words' block maxima bounds the score of all items of a block, for all
blocks at once; only blocks that could reach the threshold are searched by WAND, with the block's own maxima. The threshold is absolute
for each item (a share of the score that the item's own text has), so all items above it are found. Items too long for a passage are in indexes of
their own, whose passages hold them whole. Word weights and lengths are those of all items, so it doesn't matter which items share an index.
A hit counts once the passage and its surroundings hold enough of the item's question and of its answer.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField

from ..runtime import Workspace
from .arrow import append
from .wordhash import mix, separators, stretches, text_buffer, word_hashes

#: BM25; passage length and step in words (for items of up to PASSAGE words; see `passage_of`); share of an item's own score; blocks at most; words of an overlap gram; least shares of question and answer.
K1, B, PASSAGE, STEP, SHARE, BLOCKS, GRAM, OVERLAP = 1.2, 0.75, 64, 32, 0.5, 32, 3, 0.6
#: An item's last words count as its answer where no marker says which part that is.
ANSWER_SHARE = 0.3
ANSWER_MARKERS = ("\nanswer:", "\na:", " answer:")
#: One index holds items of about so many bytes; more items make more indexes. A pass over the texts has so many bytes of items at once; more items make more passes.
INDEX_BYTES, PASS_BYTES = 8 << 20, 16 << 20


def passage_of(n_words: int) -> int:
    """Words of the passages that an item of so many words is searched in: for an item longer than PASSAGE the power of two (times PASSAGE) such that a passage has it whole wherever it starts, with steps of half a passage."""
    size = PASSAGE
    while size < n_words:
        size *= 2
    return size if n_words <= PASSAGE else 2 * size


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, borders = text_buffer(pc.utf8_lower(texts))
    return word_hashes(raw, borders, separators("letters"))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    size = max(1, min(size, len(words)))
    joined = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(joined)])
    return joined


@dataclass
class Item:
    id: int | str
    question: np.ndarray  # grams
    answer: np.ndarray
    gram: int  # words in one of its grams


class Statistics:
    """What BM25 knows of all items: their number, their mean length, and in how many each word occurs. Filled in parts."""

    def __init__(self):
        self.n = self.total = 0
        self.terms, self.df = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, texts: list[str]) -> None:
        words, first = _words(pa.array(texts, pa.string()))
        lengths = np.diff(first)
        self.n += int((lengths > 0).sum())
        self.total += int(lengths.sum())
        item = np.repeat(np.arange(len(texts)), lengths)
        order = np.lexsort((item, words))
        words, item = words[order], item[order]
        once = words[np.append(True, (words[1:] != words[:-1]) | (item[1:] != item[:-1]))] if len(words) else words
        terms, where = np.unique(np.concatenate([self.terms, once]), return_inverse=True)
        self.terms, self.df = terms, np.bincount(where, np.concatenate([self.df, np.ones(len(once), np.int64)]), minlength=len(terms)).astype(np.int64)

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[np.searchsorted(self.terms, terms)]
        return np.log1p((self.n - df + 0.5) / (df + 0.5))


class Index:
    """An inverted index with impacts divided by each item's threshold: a score of 1 reaches it. Postings are arrays, ordered by term, block and item."""

    def __init__(self, ids: list, texts: list[str], share: float = SHARE, blocks: int = BLOCKS, passage: int = PASSAGE, known: Statistics | None = None):
        self.passage = passage
        if known is None:
            known = Statistics()
            known.add(texts)
        lists = []
        for i, text in zip(ids, texts, strict=True):
            words, _ = _words(pa.array([text], pa.string()))
            if len(words):
                cut = next((len(_words(pa.array([text[:at]], pa.string()))[0]) for m in ANSWER_MARKERS if (at := text.lower().find(m)) > 0), 0)
                lists.append((i, words, cut or max(1, round(len(words) * (1 - ANSWER_SHARE)))))
        lists.sort(key=lambda x: (len(x[1]), x[0]))  # items of like length share a block: like thresholds
        self.items = []
        for i, words, cut in lists:
            gram = max(1, min(GRAM, cut, len(words) - cut if len(words) > cut else GRAM))
            grams = _grams(words, gram)
            at = max(1, cut - gram + 1)
            self.items.append(Item(i, np.unique(grams[:at]), np.unique(grams[at:]) if len(grams) > at else np.unique(grams), gram))
        n = len(lists)
        self.terms, which = np.unique(np.concatenate([w for _, w, _ in lists]), return_inverse=True) if n else (np.empty(0, np.uint64), np.empty(0, np.int64))
        lengths = np.array([len(w) for _, w, _ in lists], np.int64)
        item_of = np.repeat(np.arange(n), lengths)
        pairs, tf = np.unique(which.astype(np.int64) * max(1, n) + item_of, return_counts=True)
        term, item = pairs // max(1, n), pairs % max(1, n)
        impact = known.idf(self.terms)[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / max(1.0, known.total / max(1, known.n))))
        own = np.bincount(item, impact, minlength=n)
        self.size = max(1, -(-n // blocks))
        self.n_blocks = -(-n // self.size)
        self.impacts, self.places = impact / (share * own[item]), item.astype(np.int32)
        self.starts = np.searchsorted(term * max(1, self.n_blocks) + item // self.size, np.arange(len(self.terms) * self.n_blocks + 1)).astype(np.int32)
        self.maxima = np.zeros((len(self.terms), self.n_blocks))
        np.maximum.at(self.maxima, (term, item // self.size), self.impacts)

    def postings(self, term: int, block: int) -> tuple[list[int], list[float]]:
        """(items ascending, impacts) of a term in a block."""
        a, b = self.starts[term * self.n_blocks + block : term * self.n_blocks + block + 2]
        return self.places[a:b].tolist(), self.impacts[a:b].tolist()

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.searchsorted(self.terms, words)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == words, at, -1)

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """All items of a block that reach score 1 for a set of terms, by document-at-a-time search with pivots."""
        cursors = []  # [item, at, maximum, items, impacts]
        for t in terms:
            items, impacts = self.postings(t, block)
            if items:
                cursors.append([items[0], 0, self.maxima[t, block], items, impacts])
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2]
                if bound >= 1.0 - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            if cursors[0][0] == item:
                score = 0.0
                for c in cursors:
                    if c[0] != item:
                        break
                    score += c[4][c[1]]
                    c[1] += 1
                    c[0] = c[3][c[1]] if c[1] < len(c[3]) else -1
                if score >= 1.0 - 1e-9:
                    found.append((item, score))
            else:
                for c in cursors[:pivot]:
                    c[1] = bisect_left(c[3], item, c[1])
                    c[0] = c[3][c[1]] if c[1] < len(c[3]) else -1
            cursors = [c for c in cursors if c[0] != -1]
        return found


def passages(first: np.ndarray, size: int = PASSAGE, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, word after the last) of the passages of rows with these word borders: `size` words each `step` words, the last one ends with the text."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - size) // step)), 0)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    end = np.minimum(first[row] + k * step + size, first[row + 1])
    return row, np.maximum(end - size, first[row]), end


def search(index: Index, words: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], float]:
    """{(row, item's place): best score} of all verified hits in the passages of these rows."""
    hits: dict[tuple[int, int], float] = {}
    size = index.passage
    row, start, end = passages(first, size, size * STEP // PASSAGE)
    if not len(row) or not index.items:
        return hits
    term = index.lookup(words)
    at = np.flatnonzero(term >= 0)
    sums = np.zeros((len(at) + 1, index.n_blocks))
    np.cumsum(index.maxima[term[at]], axis=0, out=sums[1:])
    bound = sums[np.searchsorted(at, end)] - sums[np.searchsorted(at, start)]  # a word counts each time it occurs: never too low
    near = np.flatnonzero(bound.max(axis=1) >= 1.0 - 1e-6)
    for p in near.tolist():
        own = np.unique(term[start[p] : end[p]])
        own = own[own >= 0]
        exact = index.maxima[own].sum(axis=0)
        blocks = np.flatnonzero(exact >= 1.0 - 1e-9)
        if not len(blocks):
            continue
        terms = own.tolist()
        for block in blocks.tolist():
            for place, score in index.wand(terms, block):
                key = (int(row[p]), place)
                if score > hits.get(key, 0.0) and verified(index.items[place], words[max(first[row[p]], start[p] - size) : min(first[row[p] + 1], end[p] + size)]):
                    hits[key] = score
    return hits


def verified(item: Item, words: np.ndarray) -> bool:
    """Whether these words hold enough of the item's question and of its answer."""
    if len(words) < item.gram:
        return False
    there = _grams(words, item.gram)
    return min(np.isin(item.question, there).mean(), np.isin(item.answer, there).mean()) >= OVERLAP


def _indexes(items: DataFrame, id_col: str, text_col: str, share: float, index_bytes: int, pass_bytes: int) -> Iterator[list[Index]]:
    """The indexes of each pass: one for each length of passages, or several where the items are more than `index_bytes`. Items come to the driver a part at a time, first for the statistics of all, then for their indexes."""
    id_type = "string" if items.schema[id_col].dataType.simpleString() == "string" else "long"
    rows = items.select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    parts = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // index_bytes))
    part = lambda k: rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == k).orderBy("id", "text").collect()  # noqa: E731  about `index_bytes`
    known = Statistics()
    held = None
    for k in range(parts):
        held = part(k)
        if held:
            known.add([r.text for r in held])
    live: list[Index] = []
    for k in range(parts):
        held = held if parts == 1 else part(k)
        if not held:
            continue
        long: dict[int, list] = {}
        n_words = np.diff(_words(pa.array([r.text for r in held], pa.string()))[1]).tolist()
        for r, n in zip(held, n_words, strict=True):
            long.setdefault(passage_of(n), []).append(r)
        live += [Index([r.id for r in rows_of], [r.text for r in rows_of], share, passage=size, known=known) for size, rows_of in sorted(long.items())]
        if (k + 1) % max(1, pass_bytes // index_bytes) == 0:
            yield live
            live = []
    if live:
        yield live


def find_leaks(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE, keep: list[str] | None = None, index_bytes: int = INDEX_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """df plus leaked, n_items, item_ids (ascending) and best_score (the largest BM25 score of a verified passage, as a multiple of its item's threshold; null without hits).

    Whole texts are searched for items of any length. Null, empty and wordless texts have no hits; null items are left out, and without items nothing leaks. Items with equal texts are all reported. Item ids may be whole numbers or strings.
    Repeated rows are searched each; an empty table gives an empty result; clashing columns are replaced. `index_bytes` and `pass_bytes` change memory and time, not results.
    """
    sc = df.sparkSession.sparkContext
    text_id = items.schema[item_id].dataType.simpleString() == "string"
    kind, arrow_kind = (StringType(), pa.string()) if text_id else (LongType(), pa.int64())
    fields = [StructField("leaked", BooleanType()), StructField("n_items", LongType()), StructField("item_ids", ArrayType(kind)), StructField("best_score", DoubleType())]

    def searched(table: DataFrame, live: list[Index], first_pass: bool) -> DataFrame:
        shared = [sc.broadcast(index) for index in live]

        def compute(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                raw, borders = text_buffer(pc.utf8_lower(batch.column(text_col)))
                for a, b in stretches(borders):
                    words, first = word_hashes(raw[borders[a] : borders[b]], borders[a : b + 1] - borders[a], separators("letters"))
                    rows = batch.slice(a, b - a)
                    found: list[dict] = [{} for _ in range(b - a)]
                    best: list[float | None] = [None] * (b - a) if first_pass else rows.column("best_score").to_pylist()
                    if not first_pass:
                        found = [dict.fromkeys(ids) for ids in rows.column("item_ids").to_pylist()]
                    for index in shared:
                        for (row, place), score in search(index.value, words, first).items():
                            found[row][index.value.items[place].id] = None
                            best[row] = max(score, best[row] or 0.0)
                    yield rows, [pa.array([bool(f) for f in found], pa.bool_()), pa.array([len(f) for f in found], pa.int64()), pa.array([sorted(f) for f in found], pa.list_(arrow_kind)), pa.array(best, pa.float64())]

        return append(table, fields, compute, None)

    out = None
    wanted = [c for c in df.columns if keep is None or c in keep or c == text_col]
    table = df.select(*[F.col(f"`{c}`") for c in wanted])
    for live in _indexes(items, item_id, item_text, share, index_bytes, pass_bytes):
        if out is not None:
            table = Workspace(df.sparkSession).write(out, "pass")  # one pass after the other: an executor never holds the indexes of two
        out = searched(table, live, out is None)
    if out is None:
        out = searched(table, [], True)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c in {f.name for f in fields} or keep is None or c in keep])
