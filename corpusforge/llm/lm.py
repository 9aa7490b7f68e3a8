"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(subclass | class, before) * P(word | subclass). Both class factors are softmaxes over hashed features of the words
before: the last word, the last two as a pair, and two skip features; the second factor has the nearer three of them, hashed together with the class. Subclasses part the head of
the vocabulary into CLASSES x SUBCLASSES parts of about equal mass, so that frequent words have one of their own and context alone tells them. Their biases are the log masses,
so that untrained weights give exactly the add-one unigram model and gradient updates only add to it. The factor of a word in its subclass is its
share of the counts. Events are the training words and one for all unknown words; the probabilities sum to one.

Training: each partition takes gradient steps on its own texts from the same start, and the weights are averaged, row by row by how often the row was
seen, in a tree of bounded groups. So the weights (not the base score) hang a little on how rows lie in partitions. Counts are shuffled, never broadcast: only a head
of HEAD frequent words is known to every task, and the counts of all other words, which share one class, are joined to the texts.

Rows of weights grow with the tokens without a bound: up to MOST_FEATURES a factor are known to every task; a corpus of more than SHARD_TOKENS has as many shards
of that many rows as it has SHARD_TOKENS. A shard holds the contexts of its own last words (of a very frequent last word: of its own last three words). All positions go to the shard
of their context, packed; one task starts from the averaged weights, takes gradient steps on the shard's training positions, scores all its positions and
sends their sums back to the texts. No task and no driver ever holds the weights of two shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import Workspace, ship_package
from .wordhash import mix, separators, stretches, text_buffer, word_hashes

#: Hashed feature rows of each factor of a shard: one for so many training tokens, rounded up to a power of two, between a least and a most (2**16 or less, so that sorting them is a radix sort). Clusters of words; classes and subclasses of the head (with one more class for the tail); head words at most; gradient rounds.
TOKENS_PER_FEATURE, LEAST_FEATURES, MOST_FEATURES = 256, 1 << 12, 1 << 15
CLUSTERS, CLASSES, SUBCLASSES, HEAD, ROUNDS = 4, 16, 16, 1 << 18, 2
#: Tokens that a shard's rows are meant for; positions that are packed together; tasks at most for all shards (a task takes several shards one after another).
SHARD_TOKENS, BLOCK_TOKENS, SHARD_TASKS = TOKENS_PER_FEATURE * MOST_FEATURES, 1 << 20, 8_192
#: Groups of texts that share a most frequent word; they tell clusters of words apart.
GROUPS = 8
BATCH, RATE, FAN_IN, BLOCK_ROWS = 16_384, 0.25, 16, 2_048
END = np.uint64(0xE17D0FDEADBEEF01)
_LOG10E = 0.4342944819032518


def _token_rows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, tokens, token borders) of stretches of a batch; each row ends with END."""
    raw, borders = text_buffer(column)
    parts = separators()
    for a, b in stretches(borders):
        words, first = word_hashes(raw[borders[a] : borders[b]], borders[a : b + 1] - borders[a], parts)
        tokens = np.insert(words, first[1:], END)
        yield a, b, tokens, first + np.arange(b - a + 1)


def count_words(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n, g0, g1, ...): each token's count, and the parts of it in each group of texts. Summed in the workers first, then on the map side."""
    ship_package(texts.sparkSession)
    most = 1 << 19

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for _, _, tokens, first in _token_rows(batch.column(0)):
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    words, counts = np.unique(tokens[a:b], return_counts=True)
                    group = mix(words[counts.argmax() : counts.argmax() + 1])[0] >> np.uint64(61) if b - a > 1 else np.uint64(0)
                    # the lowest bits of a word's hash make room for the group: 61 bits still tell words apart
                    held.append((tokens[a:b] & ~np.uint64(7)) | group)
                    n += b - a
                if n >= most:
                    yield _counted(held)
                    held, n = [], 0
        if held:
            yield _counted(held)

    rows = texts.select(text_col).mapInArrow(run, "token long, n long")
    group = F.col("token").bitwiseAND(7)
    return rows.groupBy("token").agg(F.sum("n").alias("n")).groupBy(F.col("token").bitwiseAND(-8).alias("word")).agg(F.sum("n").alias("n"), *[F.sum(F.when(group == g, F.col("n")).otherwise(0)).alias(f"g{g}") for g in range(GROUPS)])


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    tokens, counts = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts, pa.int64())], names=["token", "n"])


@dataclass
class Model:
    words: np.ndarray  # head, ascending hashes
    classes: np.ndarray  # of each head word
    subclasses: np.ndarray
    counts: np.ndarray
    mass: np.ndarray  # of each subclass of each class: its words' counts, each plus one
    tail: float  # the same of all other words, and one more for unknown words: a class of its own
    weights: tuple[np.ndarray, np.ndarray]  # of both factors: feature rows x classes and the tail, feature rows x subclasses
    total: int  # training tokens
    distinct: int

    def slots(self) -> tuple[np.ndarray, np.uint64]:
        """A table by hash with the place of one head word in each slot, and the shift that gives a token's slot."""
        bits = max(1, len(self.words).bit_length() + 2)
        shift = np.uint64(64 - bits)
        table = np.zeros(1 << bits, np.int32)
        table[self.words >> shift] = np.arange(len(self.words))
        return table, shift

    def lookup(self, tokens: np.ndarray, slots: tuple[np.ndarray, np.uint64]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the head or -1, class, subclass). Most words are found in their slot at once; only the others are searched for."""
        tail = len(self.mass)
        if not len(self.words):
            return np.full(len(tokens), -1), np.full(len(tokens), tail), np.zeros(len(tokens), np.int64)
        tokens = tokens & ~np.uint64(7)
        at = slots[0].take(tokens >> slots[1])
        rest = np.flatnonzero(self.words.take(at) != tokens)
        if len(rest):
            asked = tokens[rest]
            found = np.searchsorted(self.words, asked)
            found[found == len(self.words)] = 0
            at[rest] = np.where(self.words[found] == asked, found, -1)
        known = at >= 0
        return at, np.where(known, self.classes.take(at, mode="clip"), tail), np.where(known, self.subclasses.take(at, mode="clip"), 0)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the subclasses of each class; what has no word can't come."""
        top = np.append(self.mass.sum(axis=1), self.tail)
        with np.errstate(divide="ignore", invalid="ignore"):
            first = np.log(top / top.sum())
            second = np.log(self.mass / self.mass.sum(axis=1, keepdims=True))
        return tuple(np.where(np.isfinite(x), x, -1e30).astype(np.float32) for x in (first, second))

    def log_mass(self, classes: np.ndarray, subclasses: np.ndarray) -> np.ndarray:
        """log10 of the mass that a word shares."""
        logs = np.log10(np.maximum(np.vstack([self.mass, np.full((1, self.mass.shape[1]), self.tail)]), 1))
        return logs[classes, subclasses]


def feature_rows(total: int) -> int:
    """Rows of weights of a shard for so many training tokens."""
    rows = LEAST_FEATURES
    while rows < min(MOST_FEATURES, total / TOKENS_PER_FEATURE):
        rows *= 2
    return rows


def shard_count(total: int, share: float = 1.0, shard_tokens: int = SHARD_TOKENS) -> int:
    """Shards for so many training tokens, which are `share` of all tokens: one if a shard's rows are enough for them, else one for every `shard_tokens` of all tokens."""
    return 1 if total <= shard_tokens else int(-(-total // (shard_tokens * min(1.0, max(share, 1e-9)))))


def _before(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The last word, the one before it, and the third last of each position; what stands before a text's start counts as END."""
    n = len(tokens)
    before = []
    for k in (1, 2, 3):
        shifted = np.full(n, END)
        shifted[k:] = tokens[: n - k] if n > k else tokens[:0]
        for j in range(k):
            starts = first[:-1] + j
            shifted[starts[starts < first[1:]]] = END
        before.append(shifted)
    return before


def features(tokens: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """The hashed features (below `size`) of each position, one row each."""
    return _hashed(_before(tokens, first), size)


def _hashed(before: list[np.ndarray], size: int) -> np.ndarray:
    one, two, three = before
    hashed = [mix(one + np.uint64(1)), mix(two + np.uint64(2)), mix(three + np.uint64(3)), mix(mix(one) * np.uint64(3) + two)]
    return np.stack([(h >> np.uint64(40)) & np.uint64(size - 1) for h in hashed]).astype(np.uint16)


def within(rows: np.ndarray, classes: np.ndarray, size: int) -> np.ndarray:
    """The last word, the one before it and the pair, hashed together with the class."""
    salt = (mix(np.arange(1, int(classes.max(initial=0)) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(size - 1)).astype(np.uint16)
    return rows[[0, 1, 3]] ^ salt[classes]


def _probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The softmax of each position; rows: four features for each position; bias: one row, or one for each position."""
    z = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += weights.take(r, axis=0)
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def update(weights: np.ndarray, squares: np.ndarray, seen: np.ndarray, bias: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> None:
    """One step on a batch: the gradient of its log-likelihood, summed by feature row, with a rate for each row that falls as its gradients add up."""
    n = len(classes)
    if not n:
        return
    gradient = _probabilities(weights, bias, rows)
    np.negative(gradient, out=gradient)
    gradient[np.arange(n), classes] += 1
    flat = rows.reshape(-1)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    lead = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    summed = np.add.reduceat(gradient.take(order % n, axis=0), lead, axis=0)
    touched = ordered[lead]
    size = np.diff(np.append(lead, len(ordered)))
    seen[touched] += size
    squares[touched] += np.einsum("ij,ij->i", summed, summed) / size
    weights[touched] += (RATE / np.sqrt(squares[touched] * size + 1e-6))[:, None] * summed


def _learn(weights: list[np.ndarray], squares: list[np.ndarray], seen: list[np.ndarray], biases: tuple[np.ndarray, np.ndarray], rows: np.ndarray, classes: np.ndarray, subclasses: np.ndarray) -> None:
    """Steps of both factors on all positions, a batch at a time."""
    (size, tail), (outer, inner) = (len(weights[0]), weights[0].shape[1] - 1), biases
    for a in range(0, len(classes), BATCH):
        some, c, sub = rows[:, a : a + BATCH], classes[a : a + BATCH], subclasses[a : a + BATCH]
        update(weights[0], squares[0], seen[0], outer, some, c)
        if (c == tail).any():
            head = np.flatnonzero(c != tail)
            some, c, sub = some[:, head], c[head], sub[head]
        update(weights[1], squares[1], seen[1], inner[c], np.ascontiguousarray(within(some, c, size)), sub)


def _log_probabilities(weights: tuple[np.ndarray, np.ndarray], biases: tuple[np.ndarray, np.ndarray], rows: np.ndarray, classes: np.ndarray, subclasses: np.ndarray) -> np.ndarray:
    """log10 of the probability of each position's class and subclass."""
    (size, tail), (outer, inner) = (len(weights[0]), weights[0].shape[1] - 1), biases
    logs = np.empty(len(classes))
    for s in range(0, len(classes), BATCH):
        some, c = rows[:, s : s + BATCH], classes[s : s + BATCH]
        p = _probabilities(weights[0], outer, some)
        chosen = p[np.arange(len(c)), c]
        head = np.flatnonzero(c != tail)
        if len(head):
            q = _probabilities(weights[1], inner[c[head]], within(some[:, head], c[head], size))
            chosen[head] *= q[np.arange(len(head)), subclasses[s + head]]
        logs[s : s + BATCH] = np.log10(np.maximum(chosen, 1e-30))
    return logs


def train(texts: DataFrame, text_col: str, model: Model, rounds: int = ROUNDS, pick: Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights after `rounds` rounds, each over its own share of the texts: gradient steps in every partition, then the average."""
    spark = texts.sparkSession
    weights = model.weights
    size = len(weights[0])
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((model, weights))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, start = shared.value
            local = [w.copy() for w in start]
            squares, seen = ([np.zeros(size, np.float32) for _ in range(2)] for _ in range(2))
            biases, used, slots = known.biases(), False, known.slots()
            for batch in batches:
                for _, _, tokens, first in _token_rows(batch.column(0)):
                    used = True
                    _, classes, subclasses = known.lookup(tokens, slots)
                    _learn(local, squares, seen, biases, features(tokens, first, size), classes, subclasses)
            if used:
                for level in range(2):
                    local[level] *= seen[level][:, None]  # sums, to be divided by how often each row was seen
                    for block in range(0, size, BLOCK_ROWS):
                        part = slice(block, block + BLOCK_ROWS)
                        if seen[level][part].any():
                            yield pa.RecordBatch.from_arrays([pa.array([level * size + block], pa.int32()), pa.array([local[level][part].tobytes()], pa.binary()), pa.array([seen[level][part].tobytes()], pa.binary())], names=["block", "sums", "seen"])

        part = texts.where(F.pmod(F.xxhash64(F.lit(5), pick), F.lit(rounds)) == turn) if pick is not None else texts
        gathered = part.select(text_col).mapInArrow(run, "block int, sums binary, seen binary").withColumn("part", F.spark_partition_id())
        groups = max(1, part.rdd.getNumPartitions())
        while groups > 1:
            groups = -(-groups // FAN_IN)
            gathered = gathered.withColumn("part", F.pmod(F.col("part"), F.lit(groups))).groupBy("block", "part").applyInPandas(_added, "block int, sums binary, seen binary, part int")
        was = [w.copy() for w in weights]
        for r in gathered.toLocalIterator():  # feature rows x classes numbers in all, a block at a time
            level, block = divmod(r.block, size)
            seen = np.frombuffer(r.seen, np.float32)
            there = seen > 0
            rows = was[level][block : block + BLOCK_ROWS]
            rows[there] = np.frombuffer(r.sums, np.float32).reshape(-1, rows.shape[1])[there] / seen[there, None]
        weights = (was[0], was[1])
        shared.unpersist()
    return weights


def _added(rows):
    """Sums of at most FAN_IN partial sums."""
    import pandas as pd

    sums = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in rows["sums"]).astype(np.float32)
    seen = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in rows["seen"]).astype(np.float32)
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "sums": [sums.tobytes()], "seen": [seen.tobytes()], "part": [rows["part"].iloc[0]]})


def _clusters(profile: np.ndarray, weight: np.ndarray, k: int, steps: int = 20) -> np.ndarray:
    """Weighted k-means of the words' profiles over groups of texts, each against the groups' own sizes; starts from the heaviest words that lie far apart."""
    share = profile / np.maximum(profile.sum(axis=1, keepdims=True), 1)
    unit = np.sqrt(share)
    centres = [unit[weight.argmax()]]
    for _ in range(k - 1):
        far = (1 - np.max(unit @ np.array(centres).T, axis=1)) * np.sqrt(weight)
        centres.append(unit[far.argmax()])
    centre = np.array(centres)
    for _ in range(steps):
        label = (unit @ centre.T).argmax(axis=1)
        for c in range(k):
            if (own := label == c).any():
                mean = (unit[own] * weight[own, None]).sum(axis=0)
                centre[c] = mean / max(1e-12, np.linalg.norm(mean))
    return (unit @ centre.T).argmax(axis=1)


def _head(counts: DataFrame, most: int) -> DataFrame:
    """The words above the lowest count that leaves at most `most` of them; found from a histogram of counts."""
    level = F.floor(F.log2("n") * 16)
    histogram = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()  # a few hundred rows
    kept, cut = 0, None
    for r in sorted(histogram, key=lambda r: -r.level):
        if kept + r.words > most:
            break
        kept, cut = kept + r.words, r.level
    return counts.where(level >= cut) if cut is not None else counts.where(F.lit(False))


def _by_mass(n: np.ndarray, parts: int) -> np.ndarray:
    """Parts 0..parts-1 of about equal mass, in order."""
    mass = np.cumsum(n)
    return np.minimum(parts - 1, ((mass - n) / mass[-1] * parts).astype(np.int64)) if len(n) else np.zeros(0, np.int64)


def fit(texts: DataFrame, text_col: str, counts: DataFrame, pick: Column | None, head: int = HEAD, rounds: int = ROUNDS, classes: int = CLASSES, subclasses: int = SUBCLASSES) -> Model:
    """Classes from all counts, then weights from all texts."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = _head(counts, head).select("word", "n", *[f"g{g}" for g in range(GROUPS)]).toPandas()  # `head` rows at most
    top = top.sort_values(["n", "word"], ascending=[False, True])
    n = top["n"].to_numpy(np.float64)
    outer, inner = np.zeros(len(top), np.int64), np.zeros(len(top), np.int64)
    clusters = max(1, min(CLUSTERS, classes))
    if len(top):
        cluster = _clusters(top[[f"g{g}" for g in range(GROUPS)]].to_numpy(np.float64), n, clusters)
        for c in range(clusters):
            own = np.flatnonzero(cluster == c)
            outer[own] = c * (classes // clusters) + _by_mass(n[own], classes // clusters)
        for c in range(classes):
            own = np.flatnonzero(outer == c)
            inner[own] = _by_mass(n[own], subclasses)
    mass = np.bincount(outer * subclasses + inner, n + 1, minlength=classes * subclasses).astype(np.float64).reshape(classes, subclasses)
    tail = float(total - n.sum() + (distinct - len(top)) + 1)
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    size = feature_rows(int(total))
    weights = (np.zeros((size, classes + 1), np.float32), np.zeros((size, subclasses), np.float32))
    model = Model(words[order], outer[order], inner[order], n[order], mass, tail, weights, int(total), int(distinct))
    if total:
        model.weights = train(texts, text_col, model, rounds, pick)
    return model


def _shard_of(known: Model, before: list[np.ndarray], place: np.ndarray, first: np.ndarray, end_place: int, shards: int) -> np.ndarray:
    """The shard of each position's context: by its last word, or by its last three where the last is so frequent that it would fill an eighth of a shard."""
    one, two, three = before
    key = mix(one + np.uint64(5))
    # where no word of the head is so frequent, none is: the head has the most frequent ones
    frequent = np.append(known.counts > known.total / (8 * shards), False)  # the last place stands for -1
    if frequent.any():
        last = np.empty(len(place), bool)
        last[1:] = frequent[place[:-1]]
        starts = first[:-1]
        last[starts[starts < len(place)]] = frequent[end_place]
        key = np.where(last, mix(mix(key + two) * np.uint64(3) + three), key)
    return ((key >> np.uint64(32)) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.uint32)


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Numbers of two bytes and more are stored byte by byte in planes, which compress better."""
    planes = [x.tobytes() if x.itemsize == 1 else np.ascontiguousarray(x.reshape(-1, 1).view(np.uint8).T).tobytes() for x in arrays]
    return pa.Codec("zstd", compression_level=1).compress(b"".join(planes), asbytes=True)


def _unpack(data: bytes, kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """Arrays of these types and lengths."""
    sizes = [np.dtype(kind).itemsize * n for kind, n in kinds]
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, sum(sizes), asbytes=True), np.uint8)
    out, at = [], 0
    for (kind, n), size in zip(kinds, sizes, strict=True):
        plane = raw[at : at + size]
        out.append(np.ascontiguousarray(plane.reshape(-1, n).T).reshape(-1).view(kind) if n else np.empty(0, kind))
        at += size
    return out


def _pack_block(held: list[tuple], shards: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """(shard, positions, runs of positions of one text, packed features, the rest packed) of each shard that has positions in a block of texts."""
    rows, classes, subclasses, shard, text, learn = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
    order = np.argsort(shard, kind="stable")  # a shard's positions stay in the order of the texts
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[s] : edges[s + 1]]
        of = text[own]
        lead = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        sizes = np.diff(np.append(lead, len(of))).astype(np.uint32)
        # position by position: pairs of words come again
        features_of = pa.Codec("zstd", compression_level=1).compress(np.ascontiguousarray(rows[:, own].T).tobytes(), asbytes=True)
        yield s, len(own), len(lead), features_of, _pack([classes[own], subclasses[own], np.diff(of[lead], prepend=np.uint32(0)), sizes, learn[own[lead]]])


def _unpack_block(n: int, runs: int, features_of: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, classes, subclasses, texts of the runs, their sizes, whether they are learned from)."""
    rows = np.frombuffer(pa.Codec("zstd").decompress(features_of, n * 8, asbytes=True), np.uint16).reshape(n, 4)
    classes, subclasses, text, sizes, learn = _unpack(data, [(np.uint8, n)] * 2 + [(np.uint32, runs)] * 2 + [(np.uint8, runs)])
    return np.ascontiguousarray(rows.T), classes.astype(np.int64), subclasses.astype(np.int64), np.cumsum(text, dtype=np.uint32), sizes.astype(np.int64), learn.astype(bool)


def _shard_sums(known: Model, biases: tuple[np.ndarray, np.ndarray], held: list[tuple[int, int, int, bytes, bytes]], learning: bool) -> Iterator[tuple[int, int, bytes]]:
    """Weights of one shard from its training positions, then (block, runs, packed sums of log10 probabilities by text) of each of its blocks."""
    weights = [w.copy() for w in known.weights]
    if learning:
        squares, seen = ([np.zeros(len(w), np.float32) for w in weights] for _ in range(2))
        waiting, n = [], 0
        for k, (_, *packed) in enumerate(held):
            rows, classes, subclasses, _, sizes, learn = _unpack_block(*packed)
            at = np.flatnonzero(np.repeat(learn, sizes))
            waiting.append((rows[:, at], classes[at], subclasses[at]))
            n += len(at)
            if n >= BATCH or k == len(held) - 1:  # pieces of many shards are small
                _learn(weights, squares, seen, biases, *(np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True)))
                waiting, n = [], 0
    for block, *packed in held:
        rows, classes, subclasses, text, sizes, _ = _unpack_block(*packed)
        logs = _log_probabilities(weights, biases, rows, classes, subclasses)
        sums = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
        yield block, len(text), _pack([np.diff(text, prepend=np.uint32(0)), sums.astype(np.float32)])


def _with_sums(texts: list[pa.RecordBatch], block: int, pieces: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Texts of a block, with the sums that its shards sent added to their model_log."""
    parts = [_unpack(data, [(np.uint32, n), (np.float32, n)]) for n, data in pieces]
    sums = np.bincount(np.concatenate([np.cumsum(t, dtype=np.uint32) for t, _ in parts]).astype(np.int64), np.concatenate([x for _, x in parts]).astype(np.float64))  # every text has its end
    for batch in texts:
        logs = batch.column("model_log").to_numpy() + sums[batch.column("row").to_numpy() - block]
        yield batch.set_column(batch.schema.get_field_index("model_log"), "model_log", pa.array(logs))


def score_texts(df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """`id_col`, held_out (not `training`), n_tokens, n_known, train_tokens, base_score and score: log10 probabilities of each whole text under add-one unigrams and under the model.

    Tokens are runs of non-blank bytes (A-Z as a-z) and one end. A null or empty text is its end alone. Without training rows all words are unknown and both scores are 0.
    Repeated rows are scored each (and counted each); a null `training` counts as held out; extra columns are not read; an empty table gives an empty result.
    """
    ship_package(df.sparkSession)
    work = Workspace(df.sparkSession)
    rows = df.select(F.col(id_col), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    learned = rows.where("training")
    counts = work.write(count_words(learned, "text"), "counts")
    model = fit(learned, "text", counts, F.col(id_col), head, rounds)
    shared = df.sparkSession.sparkContext.broadcast(model)
    shards = 1
    if model.total > shard_tokens:
        size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
        own, every = rows.agg(F.sum(F.when(F.col("training"), size)), F.sum(size)).first()
        shards = shard_count(model.total, own / every, shard_tokens)
    tasks = min(shards, SHARD_TASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        biases, slots = known.biases(), known.slots()
        size = len(known.weights[0])
        word_log = np.log10(known.counts + 1)
        end_place = int(known.lookup(np.array([END]), slots)[0][0])
        row = block = TaskContext.get().partitionId() << 40
        held, waiting = [], 0
        for batch in batches:
            for a, b, tokens, first in _token_rows(batch.column(2)):
                place, classes, subclasses = known.lookup(tokens, slots)
                edge = first[:-1]
                in_head = place >= 0
                words = np.where(in_head, word_log[place] if len(word_log) else 0.0, 0.0)
                n_head = np.add.reduceat(in_head.astype(np.int64), edge)
                head_log = np.add.reduceat(words, edge)
                logs, before = -known.log_mass(classes, subclasses), _before(tokens, first)
                feats = _hashed(before, size)
                if shards == 1:
                    logs += _log_probabilities(known.weights, biases, feats, classes, subclasses)
                model_log = np.add.reduceat(logs, edge)
                rest = np.flatnonzero(~in_head)
                borders = np.searchsorted(rest, first).astype(np.int32)
                missing = pa.ListArray.from_arrays(pa.array(borders), pa.array((tokens[rest] & ~np.uint64(7)).view(np.int64)))
                part = batch.slice(a, b - a)
                texts = texts_batch([part.column(0), part.column(1), pa.array(np.diff(first), pa.int64()), pa.array(n_head), pa.array(head_log), pa.array(model_log), missing], row, (block >> 40) % tasks, block)
                yield texts
                if shards > 1:
                    text = np.repeat(np.arange(row - block, row - block + b - a, dtype=np.uint32), np.diff(first))
                    learn = part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)[text - np.uint32(row - block)]
                    held.append((feats, classes.astype(np.uint8), subclasses.astype(np.uint8), _shard_of(known, before, place, first, end_place, shards), text, learn))
                    waiting += len(tokens)
                row += b - a
                if waiting >= BLOCK_TOKENS:
                    yield from packed_rows(texts.schema, held, block)
                    held, waiting, block = [], 0, row
        if held:
            yield from packed_rows(texts.schema, held, block)

    kind = rows.schema[id_col].dataType.simpleString()
    columns = f"id {kind}, training boolean, n_tokens long, n_head long, head_log double, model_log double, missing array<long>"
    names = ["id", "training", "n_tokens", "n_head", "head_log", "model_log", "missing", "row", "part", "shard", "block", "n", "runs", "features", "data"]
    types = {"row": pa.int64(), "part": pa.int32(), "shard": pa.int32(), "block": pa.int64(), "n": pa.int64(), "runs": pa.int64(), "features": pa.binary(), "data": pa.binary()}

    def texts_batch(arrays: list[pa.Array], row: int, part: int, block: int) -> pa.RecordBatch:
        n = len(arrays[0])
        more = {"row": np.arange(row, row + n), "part": np.full(n, part, np.int32), "shard": np.full(n, -1, np.int32), "block": np.full(n, block)}
        return pa.RecordBatch.from_arrays([*arrays, *[pa.array(more[k], t) if k in more else pa.nulls(n, t) for k, t in types.items()]], names=names)

    def packed_row(like: pa.Schema, **found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([found.get(f.name)], f.type) for f in like], schema=like)

    def packed_rows(like: pa.Schema, held: list[tuple], block: int) -> Iterator[pa.RecordBatch]:
        for shard, n, runs, features_of, data in _pack_block(held, shards):
            yield packed_row(like, part=shard % tasks, shard=shard, block=block, n=n, runs=runs, features=features_of, data=data)

    def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        biases, held, current = known.biases(), [], -1

        def sums() -> Iterator[pa.RecordBatch]:
            for block, runs, data in _shard_sums(known, biases, held, rounds > 0):
                yield packed_row(like, shard=current, block=block, runs=runs, data=data)

        for batch in batches:
            like = batch.schema
            texts = batch.filter(pc.less(batch.column("shard"), 0))
            if texts.num_rows:
                yield texts
            packed = batch.filter(pc.greater_equal(batch.column("shard"), 0))
            for shard, *piece in zip(*[packed.column(k).to_pylist() for k in ("shard", "block", "n", "runs", "features", "data")], strict=True):
                if shard != current:
                    yield from sums()
                    held, current = [], shard
                held.append(tuple(piece))
        yield from sums()

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, pieces, current = [], [], None
        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1)).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if block[a] != current:
                    if texts:
                        yield from _with_sums(texts, current, pieces)
                    texts, pieces, current = [], [], int(block[a])
                part = batch.slice(a, b - a)
                own = pc.less(part.column("shard"), 0)
                texts.append(part.filter(own).select(names[:8]))
                part = part.filter(pc.invert(own))
                pieces += zip(part.column("runs").to_pylist(), part.column("data").to_pylist(), strict=True)
        if texts:
            yield from _with_sums(texts, current, pieces)

    schema = f"{columns}, row long, part int, shard int, block long, n long, runs long, features binary, data binary"
    first = rows.select(id_col, "training", "text").mapInArrow(run, schema)
    if shards > 1:
        first = first.repartitionById(tasks, F.col("part")).sortWithinPartitions("shard", "block").mapInArrow(by_shard, schema)
        first = first.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(by_block, f"{columns}, row long")
    first = work.write(first.select(*names[:8]), "scored")
    asked = first.select("row", F.explode("missing").alias("word"))
    found = asked.join(counts.select("word", "n"), "word").groupBy("row").agg(F.count("*").alias("tail_known"), F.sum(F.log10(F.col("n") + 1)).alias("tail_log"))
    joined = first.drop("missing").join(found, "row", "left").withColumns({"tail_known": F.coalesce("tail_known", F.lit(0)), "tail_log": F.coalesce("tail_log", F.lit(0.0))})
    norm = float(np.log10(model.total + model.distinct + 1))
    return joined.select(
        F.col("id").alias(id_col), (~F.col("training")).alias("held_out"), "n_tokens", (F.col("n_head") + F.col("tail_known")).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("tail_log") - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("model_log") + F.col("head_log") + F.col("tail_log")).alias("score"),
    )
