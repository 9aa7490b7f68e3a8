"""SentencePiece encoding and decoding (merge type) with a prefix table.

For merge-based pieces each prefix of a text has one last piece: the piece that ends there and is compatible with the last
piece of what stands before it. An automaton finds the pieces that end at each position, a test on the pair decides, and the
ids are recovered backwards from the end. The work is linear in the text, however long a run without blanks is.
A text falls apart, without any change, where no piece can reach across; such parts are kept in a bounded worker cache.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from .arrow import append, pieces, texts_of

BLANK = "▁"
CACHE_ENTRIES, CACHE_CHARS, PAIR_ENTRIES = 180_000, 48, 500_000


class UnsupportedModel(ValueError):
    """The model's type, normaliser or blanks are none that the prefix table knows."""


#: Texts on which a model's own encoding and decoding must agree with the table's: blanks in all places, other scripts and forms, bytes, and what is no piece.
PROBES = ("", " ", "a", " a", "a ", "  a   b  ", "a\tb\nc\r\n d", "\u3000x\u00a0y", "Ａｂｃ ﬁ ½ ①", "é e\u0301 ß ẞ İ", "日本語 한국어 हिन्दी", "😀 \u200d \ufeff \u2581 x", "x\u0000y", "The quick brown fox, 12345.67!", "<s> </s> <unk> <0x41>")


class PieceTable:
    """What a merge-type model's pieces say: ranks, how each piece was merged, and which characters pieces may join."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.text = {i: model.id_to_piece(i) for i in normal}
        self.id = {t: i for i, t in self.text.items()}
        by_score = sorted((i for i in normal if len(self.text[i]) > 1), key=lambda i: -model.get_score(i))
        self.rank = {i: r for r, i in enumerate(by_score, 1)} | {i: 0 for i in normal if len(self.text[i]) == 1}  # 0: a character
        self.halves: dict[int, tuple[int, int]] = {}
        reached = [i for i in normal if len(self.text[i]) == 1]
        for i in by_score:
            parts = self._merge(self.text[i])
            if len(parts) == 1 and parts[0][0] == i and parts[0][1] is not None:
                self.halves[i] = parts[0][1]
                reached.append(i)
        joined = {c for i in by_score for c in self.text[i]}
        self.single = {c: (self.id[c],) for c in self.id if len(c) == 1 and c not in joined}
        self.automaton = ahocorasick.Automaton()
        for i in reached:
            self.automaton.add_word(self.text[i], (i, len(self.text[i])))
        self.automaton.make_automaton()
        self.length = {i: len(t) for i, t in self.text.items()}
        self.whole = {self.text[i]: i for i in reached}
        self._loose = {c for c in joined if c not in self.id}  # occurs in pieces, but is none itself: never merged
        self.joined = frozenset(joined - self._loose)
        letters = "".join(regex.escape(c) for c in sorted(self.joined) if c != BLANK)
        if any(BLANK in t.lstrip(BLANK) for t in self.text.values()):
            raise UnsupportedModel(f"{path}: a piece has a blank inside")
        self.parts = regex.compile(f"{BLANK}*[{letters}]+|{BLANK}+|.", regex.S | regex.V0)
        self.raw = [b"" if model.is_control(i) or model.is_unused(i) else bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else b" \xe2\x81\x87 " if model.is_unknown(i) else self.text[i].replace(BLANK, " ").encode() for i in range(size)]
        self.pairs: dict[int, bool] = {}

    def _merge(self, text: str) -> list[tuple[int | None, tuple[int, int] | None]]:
        """Plain merging, best piece first and leftmost on ties: used on the vocabulary itself to learn how each piece comes about."""
        parts: list[tuple[int | None, tuple[int, int] | None]] = [(self.id.get(c), None) for c in text]
        spans = list(text)
        while True:
            best = min(((self.rank[i], k, i) for k in range(len(spans) - 1) if (i := self.id.get(spans[k] + spans[k + 1])) is not None), default=None)
            if best is None:
                return parts
            _, k, i = best
            left, right = parts[k][0], parts[k + 1][0]
            parts[k : k + 2] = [(i, None if left is None or right is None else (left, right))]
            spans[k : k + 2] = [spans[k] + spans[k + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' joint text leaves exactly this pair.

        The merges are undone, latest first, along the border. A piece across the border that ranks before the merge just undone would have come first.
        At the same rank the one further left comes first.
        """
        rank, halves, text, ids = self.rank, self.halves, self.text, self.id
        bound = 1 << 60
        while True:
            across = ids.get(text[left] + text[right])
            if across is not None and rank[across] < bound:
                return False
            a, b = rank[left], rank[right]
            if a == 0 and b == 0:
                return True
            if a > b:
                bound, left = a, halves[left][1]
            else:
                bound, right = b + 1, halves[right][0]

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part between borders that no piece crosses."""
        if (i := self.whole.get(part)) is not None:
            return [i]
        if len(part) == 1:
            return [self.byte_ids[b] for b in part.encode()] if self.byte_ids else [self.unk]
        last = [-1] * (len(part) + 1)  # by the prefix's length
        known, compatible = self.pairs, self.compatible
        if len(known) >= PAIR_ENTRIES:
            known.clear()
        for end, (piece, n) in self.automaton.iter(part):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - n]
            if before < 0:  # only the empty prefix has no last piece
                last[end + 1] = piece
                continue
            key = before << 32 | piece
            fits = known.get(key)
            if fits is None:
                fits = known[key] = compatible(before, piece)
            if fits:
                last[end + 1] = piece
        ids, at, length = [], len(part), self.length
        while at:
            ids.append(last[at])
            at -= length[last[at]]
        ids.reverse()
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec(dict):
    """A word, as it stands between single blanks -> its ids (with the blank before it) as little-endian 32-bit integers.

    Two generations bound the memory: a full one becomes the old one, from which words still in use come back.
    """

    def __init__(self, path: str):
        super().__init__()
        self.table, self.old = PieceTable(path), {}
        for probe in PROBES:
            ids = self.encode(probe)
            if ids.tolist() != self.table.model.encode(probe, add_bos=True, add_eos=True) or self.decode(ids) != self.table.model.decode(ids.tolist()):
                raise UnsupportedModel(f"{path}: {probe!r} is encoded in another way")

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._pieces(BLANK + word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _pieces(self, marked: str) -> bytes:
        encode = self.table.encode_part
        if self.table.joined.issuperset(marked) and BLANK not in marked.lstrip(BLANK):
            return _packed(encode(marked))
        return b"".join([_packed(encode(part)) for part in self.table.parts.findall(marked)])

    def encode(self, text: str, bos: bool = True, eos: bool = True) -> np.ndarray:
        """The ids of a whole text. Blanks are marked, and one is put in front, as the model does; an empty text has no pieces."""
        if not text:
            body = b""
        elif "  " in text or BLANK in text or text[0] == " " or text[-1] == " ":  # runs of blanks are joined
            body = self._pieces(BLANK + text.replace(" ", BLANK))
        else:
            body = b"".join(map(self.__getitem__, text.split(" ")))
        return np.frombuffer((_packed([self.table.bos]) if bos else b"") + body + (_packed([self.table.eos]) if eos else b""), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids; the blank that encoding put in front goes. Broken byte pieces are left to the library."""
        raw = b"".join(map(self.table.raw.__getitem__, ids.tolist()))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return self.table.model.decode(ids.tolist())
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_pieces(df: DataFrame, path: str, text_col: str = "text", bos: bool = True, eos: bool = True, with_ids: bool = True, digests: bool = True, keep: list[str] | None = None) -> DataFrame:
    """df plus n_tokens and, as asked, `ids` (array<int>) and `decoded`, or their digests ids_sha256 and decoded_sha256.

    Ids equal those of the sentencepiece library on the same model; a model whose type, normaliser or treatment of blanks the table doesn't know raises UnsupportedModel (PROBES are compared when it is read). A null text counts as empty and has the begin and end ids only.
    Texts are encoded whole, of any length. Repeated rows are encoded each; an empty table gives an empty result; clashing columns are replaced.
    """

    def compute(batches: Iterator[pa.RecordBatch]):
        coder = codec(path)
        for batch in batches:
            for rows in pieces(batch, text_col, 2 << 20):
                n, lists, texts, shas = [], [], [], ([], [])
                for text in texts_of(rows.column(text_col)):
                    ids = coder.encode(text, bos, eos)
                    decoded = coder.decode(ids)
                    n.append(len(ids))
                    if with_ids:
                        lists.append(ids.astype(np.int32))
                        texts.append(decoded)
                    if digests:
                        shas[0].append(hashlib.sha256(ids.tobytes()).hexdigest())
                        shas[1].append(hashlib.sha256(decoded.encode()).hexdigest())
                out = [pa.array(n, pa.int64())]
                if with_ids:
                    out += [pa.array(lists, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                if digests:
                    out += [pa.array(x, pa.string()) for x in shas]
                yield rows, out

    fields = [StructField("n_tokens", LongType())]
    if with_ids:
        fields += [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    if digests:
        fields += [StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return append(df, fields, compute, keep)
