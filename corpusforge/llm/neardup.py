"""Near-duplicate groups by MinHash.

One permutation fills all bins of a signature; empty bins borrow from a full one by optimal densification. Bands of the signature are bucket
keys, and a bucket's texts are compared with one centre, not all with each other. Every candidate is confirmed on the full sets of shingles.

A star finds every link of its centre, not those between the others. So buckets whose other texts still lie in more than one component are
finished in blocks: a worker compares the byte-wide signatures of a block's texts from different components, and what could reach the
threshold goes on, as groups of texts and never as pairs, to a count of shared shingles on full sets by matrix products. Only links come back, and of them
no more than join components. Buckets with very many texts outside their largest component get further centres first, as long as those find links.

Texts with equal sets are one class from the start, so thousands of copies are one member of a bucket. Nothing of the size of the corpus comes to
the driver: signatures, edges and labels are tables in the shared work folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import BROADCAST_ROWS, Workspace, ship_package, small_side
from .wordhash import mix, separators, shingle_hashes, stretches, text_buffer, word_hashes

#: 51 bands of 5 rows: a pair at similarity 0.75 shares no band with probability 1e-6.
SHINGLE, BANDS, ROWS = 5, 51, 5
THRESHOLD = 75  # percent
#: Texts in one side of a block; a round of further centres pays while one in so many of its edges is a link; shingles in one side of a group that is counted at once.
BLOCK, PAYS, GROUP_SHINGLES = 1_024, 20, 2_000_000
#: Rows (two or three numbers each) of candidates that a join with the sets may broadcast; with more the join is shuffled, sets and all.
FEW_EDGES = 250_000
#: Standard deviations that a signature's estimate may lie below the threshold.
SLACK = 6.0
_ALL = (1 << 64) - 1


def probe_order(bins: int) -> np.ndarray:
    """For each bin all bins in a random order of its own: where an empty bin looks for a full one."""
    return np.argsort(mix(np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins) + np.uint64(0x5EED)), axis=1, kind="stable")


def signature(hashes: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of a non-empty sorted set of hashes, densified: the smallest hash of each bin, an empty bin has that of the first full bin in its own probe order."""
    where = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    lead = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    values, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    full[where[lead]] = True
    values[where[lead]] = hashes[lead]
    if len(lead) < bins:
        empty = np.flatnonzero(~full)
        order = probes[empty]
        values[empty] = values[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    table = values[: bands * rows].reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, k])
    return key


def _row_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    parts = separators()
    for batch in batches:
        raw, borders = text_buffer(batch.column(1))
        for a, b in stretches(borders):
            words, first = word_hashes(raw[borders[a] : borders[b]], borders[a : b + 1] - borders[a], parts)
            yield batch.slice(a, b - a), list(shingle_hashes(words, first, size))


def _lists(values: list[np.ndarray]) -> pa.Array:
    borders = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate([*values, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(flat))


def _whole(hashes: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set, in any order of its elements."""
    if not len(hashes):
        return 0, 0
    return int(np.add.reduce(hashes).view(np.int64)), int(np.bitwise_xor.reduce(mix(hashes + np.uint64(0xA5A5A5A5))).view(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, set_a, set_b, bands): the size of each row's set, two hashes of the whole set, and its bucket keys (none for an empty set)."""
    ship_package(docs.sparkSession)
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_order(bins)
        none = np.empty(0, np.uint64)
        for part, sets in _row_sets(batches, size):
            whole = [_whole(s) for s in sets]
            keys = [band_keys(signature(s, bins, probes), bands, rows) if len(s) else none for s in sets]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([w[0] for w in whole], pa.int64()), pa.array([w[1] for w in whole], pa.int64()), _lists(keys)], names=["id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n_shingles long, set_a long, set_b long, bands array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, set_a, set_b, bands, sketch, shingles): each row's sorted distinct shingle hashes, the two hashes of the whole set, its bucket keys, and its signature at a byte a bin."""
    ship_package(docs.sparkSession)
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_order(bins)
        none = np.zeros(bins, np.uint64)
        for part, sets in _row_sets(batches, size):
            whole = [_whole(s) for s in sets]
            signed = [signature(s, bins, probes) if len(s) else none for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([w[0] for w in whole], pa.int64()), pa.array([w[1] for w in whole], pa.int64()),
                    _lists([band_keys(v, bands, rows) for v in signed]), pa.array([v.astype(np.uint8).tobytes() for v in signed], pa.binary()), _lists(sets),
                ],
                names=["id", "set_a", "set_b", "bands", "sketch", "shingles"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, set_a long, set_b long, bands array<long>, sketch binary, shingles array<long>")


def components(work: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Alternates hooking to the smallest neighbour's label and following labels of labels, each step a table in the work folder; the driver sees counts only.
    """
    both = work.write(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}_both")
    labels = work.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), f"{name}_labels_0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("component", "m").alias("next"), F.col("component").alias("was"))
        jumped = (
            hooked.join(labels.select(F.col("node").alias("next"), F.col("component").alias("beyond")), "next", "left")
            .select("node", "was", F.least("next", "beyond").alias("component"))
        )
        written = work.write(jumped, f"{name}_labels_{step}")
        work.drop(f"{name}_labels_{step - 1}")
        labels = written.select("node", "component")
        if written.where("was <> component").isEmpty():
            work.drop(f"{name}_both")
            return labels


def _confirmed(edges: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The candidate edges (a: member, b: centre) whose sets reach the similarity. A member's set is sent once for each of its edges, a centre's once to each task; both joins can be split where a node has very many edges. Few edges are broadcast, and members' sets are then sent once less."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        left.join(small_side(edges, FEW_EDGES), "a").join(right, "b")
        .withColumn("shared", shared)
        .where(F.col("shared") * 100 >= (F.size("x") + F.size("y") - F.col("shared")) * threshold)
        .select("a", "b")
    )


def _merged(label: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Joins the labels of i and the others, in place; the places among `others` of one for each label that was not i's."""
    if not len(others):
        return others
    there, first = np.unique(label[others], return_index=True)
    first = first[there != label[i]]
    if len(first):
        label[np.isin(label, there)] = label[i]
    return first


def _least_estimate(n: np.ndarray, bins: int, threshold: int) -> np.ndarray:
    """Equal bytes of two sketches below which a pair at the threshold lies SLACK standard deviations off; n: shingles of the smaller set. Borrowed bins tell nothing new, so full ones count."""
    full = bins * -np.expm1(n * np.log1p(-1.0 / bins))
    s = threshold / 100.0
    return bins * (s - SLACK * 1.25 * np.sqrt(s * (1 - s) / np.maximum(full, 1.0)))


def plausible_groups(bucket: int, side: np.ndarray, component: np.ndarray, n: np.ndarray, keys: np.ndarray, sketch: np.ndarray, threshold: int) -> list[np.ndarray]:
    """Groups (places) of a block's texts that hold every pair from different components whose sketches let it reach the threshold and that shares no earlier bucket. With two sides only pairs across them count."""
    m, bins = len(n), sketch.shape[1]
    band = int((keys[0] == bucket).argmax())
    label = np.arange(m)
    across = side.min() != side.max()
    for i in range(m - 1):
        rest = np.arange(i + 1, m)
        ok = (component[rest] != component[i]) & (n[rest] * 100 >= n[i] * threshold) & (n[i] * 100 >= n[rest] * threshold)
        if across:
            ok &= side[rest] != side[i]
        rest = rest[ok]
        if not len(rest):
            continue
        equal = (sketch[rest] == sketch[i]).sum(axis=1)
        rest = rest[equal >= _least_estimate(np.minimum(n[rest], n[i]), bins, threshold)]
        if band and len(rest):
            rest = rest[~(keys[rest, :band] == keys[i, :band]).any(axis=1)]
        _merged(label, i, rest)
    order = np.argsort(label, kind="stable")
    lead = np.flatnonzero(np.append(True, label[order][1:] != label[order][:-1]))
    return [g for g in np.split(order, lead[1:]) if len(g) > 1]


def shared_counts(sets: list[np.ndarray], cells: int = 1 << 23) -> np.ndarray:
    """How many shingles each two sets share, by products of slices of their incidence matrix (shingles that only one set has are left out)."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[sizes[0], both], [both, sizes[1]]])
    owner = np.repeat(np.arange(m), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    column = np.cumsum(new) - 1
    common = np.bincount(column) > 1
    column = (np.cumsum(common) - 1)[column[keep := common[column]]]
    owner = owner[keep]
    kind = np.float32 if sizes.max() < 1 << 24 else np.float64  # whole numbers stay exact
    total = np.zeros((m, m), kind)
    width = max(1, cells // m)
    for start in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, (start, start + width))
        part = np.zeros((m, width), kind)
        part[owner[a:b], column[a:b] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def linked_pairs(sets: list[np.ndarray], component: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Linked pairs (places) that join components: no more than it takes."""
    shared = shared_counts(sets)
    n = np.array([len(s) for s in sets])
    label = np.unique(component, return_inverse=True)[1]
    pairs = []
    for i in range(len(sets) - 1):
        others = np.arange(i + 1, len(sets))
        others = others[shared[i, others] * 100 >= (n[i] + n[others] - shared[i, others]) * threshold]
        pairs += [(i, int(others[k])) for k in _merged(label, i, others)]
    return pairs


def _in_blocks(pool: DataFrame, block: int) -> DataFrame:
    """Members of mixed buckets (bucket, cls, n_shingles, component, led, led_n, outside) dealt to blocks, each with every other that it must meet: (bucket, lo, hi, side, cls, component, n_shingles).

    Texts of a bucket's largest component (`led`) meet those outside it, and those outside meet each other. A bucket of `block` texts or fewer is one block.
    """
    led_parts, out_parts = f"greatest(1L, CAST(ceil(led_n / {block}) AS BIGINT))", f"greatest(1L, CAST(ceil(outside / {block}) AS BIGINT))"
    own = f"CASE WHEN component = led THEN pmod(xxhash64(cls, 3), {led_parts}) ELSE {led_parts} + pmod(xxhash64(cls, 3), {out_parts}) END"
    meets = (
        f"CASE WHEN led_n + outside <= {block} THEN array(named_struct('lo', 0L, 'hi', 0L)) "
        f"WHEN component = led THEN transform(sequence({led_parts}, {led_parts} + {out_parts} - 1), j -> named_struct('lo', side, 'hi', j)) "
        f"ELSE concat(transform(sequence(0L, {led_parts} - 1), j -> named_struct('lo', j, 'hi', side)), transform(sequence({led_parts}, {led_parts} + {out_parts} - 1), j -> named_struct('lo', least(j, side), 'hi', greatest(j, side)))) END"
    )
    dealt = pool.withColumn("side", F.expr(f"CASE WHEN led_n + outside <= {block} THEN 0L ELSE {own} END"))
    return dealt.withColumn("meet", F.explode(F.expr(meets))).select("bucket", "meet.lo", "meet.hi", "side", "cls", "component", "n_shingles")


def _finish(work: Workspace, pool: DataFrame, sets: DataFrame, threshold: int, block: int) -> DataFrame:
    """Links (a, b) between texts of one bucket that lie in different components: all that it takes to join those that are linked."""
    blocks = _in_blocks(pool, block).join(sets.select(F.col("id").alias("cls"), "bands", "sketch"), "cls")

    def sift(table: pa.Table) -> pa.Table:
        of = lambda c: table.column(c).to_numpy()
        cls, component, n = of("cls"), of("component"), of("n_shingles")
        keys = np.stack(table.column("bands").to_numpy())
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist()])
        bucket, lo, hi = (table.column(c)[0].as_py() for c in ("bucket", "lo", "hi"))
        out: list[tuple[int, int, int, int]] = []
        for group in plausible_groups(bucket, of("side"), component, n, keys, sketch, threshold):
            # sides of bounded size, and a group for each two of them
            part = (np.cumsum(n[group]) - n[group]) // GROUP_SHINGLES
            parts = np.unique(part)
            for x in range(len(parts)):
                for y in range(x, len(parts)):
                    if y > x or len(parts) == 1:  # two sides hold the pairs of each of them too
                        held = group[(part == parts[x]) | (part == parts[y])]
                        gid = int(mix(np.array([bucket & _ALL], np.uint64) + np.uint64((lo * 1_000_003 + hi) & _ALL) + mix(np.array([int(group[0]) * 65_537 + x * 257 + y], np.uint64)))[0].view(np.int64))
                        out += [(gid, int(cls[g]), int(component[g])) for g in held]
        return pa.table({"gid": pa.array([o[0] for o in out], pa.int64()), "cls": pa.array([o[1] for o in out], pa.int64()), "component": pa.array([o[2] for o in out], pa.int64())})

    groups = work.write(blocks.groupBy("bucket", "lo", "hi").applyInArrow(sift, "gid long, cls long, component long"), "groups")

    def count(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        held = [x.view(np.uint64) for x in table.column("shingles").to_numpy()]
        pairs = linked_pairs(held, table.column("component").to_numpy(), threshold)
        return pa.table({"a": pa.array([int(cls[i]) for i, _ in pairs], pa.int64()), "b": pa.array([int(cls[j]) for _, j in pairs], pa.int64())})

    return sets.select(F.col("id").alias("cls"), "shingles").join(small_side(groups, FEW_EDGES), "cls").groupBy("gid").applyInArrow(count, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row for each row of docs: `id_col`, n_shingles, component_id (the smallest id reachable over links) and kept (id = component_id).

    Words are runs of non-blank bytes with A-Z lower-cased; rows are linked if 100 * shared >= threshold * united distinct shingles. A text with fewer words than a shingle is one shingle;
    null, empty and blank texts have none, are linked with nothing and are kept. Rows with the same id are one document with one component; if their texts differ, the one with the smallest set hash is linked. A row without an id takes part in no link (component null, kept).
    Extra columns are not read; an empty table gives an empty result. Texts are read whole, twice: once for signatures, once for the full sets of those that share a bucket. Equal sets are equal 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    sig = work.write(signatures(docs.select(id_col, text_col), id_col, text_col, size, bands, rows), "signatures")
    usable = sig.where("n_shingles > 0 AND id IS NOT NULL")
    repeats = not usable.groupBy("id").count().where("count > 1").isEmpty()
    if repeats:
        one = F.min_by(F.struct("n_shingles", "set_a", "set_b", "bands"), F.struct("set_a", "set_b")).alias("one")
        usable = work.write(usable.groupBy("id").agg(one).select("id", "one.*"), "usable")
    # what a join needs by key is written first: then both sides are dealt anew and a key with very many rows can be split
    copied = work.write(usable.groupBy("set_a", "set_b").agg(F.min("id").alias("cls"), F.count("*").alias("n")).where("n > 1").drop("n"), "classes")
    member = work.write(usable.select("id", "set_a", "set_b").join(copied, ["set_a", "set_b"], "left").select("id", F.coalesce("cls", "id").alias("cls")), "members")
    copies = work.write(member.where("id <> cls").select("id"), "copies")
    leaders = usable.join(small_side(copies, BROADCAST_ROWS), "id", "left_anti").select(F.col("id").alias("cls"), "n_shingles", F.col("bands"))
    if copies.count() > BROADCAST_ROWS:
        leaders = work.write(leaders, "leaders")  # read twice: once shuffled is enough

    listed = leaders.select("cls", "n_shingles", F.explode("bands").alias("bucket"))
    crowded = work.write(listed.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1"), "crowded")
    rows_in = work.write(listed.join(small_side(crowded), "bucket"), "buckets")  # only buckets with company
    # a text that many others resemble shares large buckets with them in most bands: it makes the best centre
    weight = work.write(rows_in.groupBy("cls").agg(F.sum("crowd").alias("pull")), "pull")
    pool = work.write(rows_in.join(weight, "cls").select("bucket", "cls", "n_shingles", "pull", F.col("cls").alias("component"), F.lit(None).cast("long").alias("led")), "pool_0")

    wanted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(small_side(weight.select(F.col("cls").alias("id"))), "id", "left_semi")
    sets = full_sets(wanted, "id", "text", size, bands, rows)
    if repeats:
        sets = sets.join(usable.select("id", "set_a", "set_b"), ["id", "set_a", "set_b"], "left_semi").dropDuplicates(["id"])
    sets = work.write(sets, "sets")
    work.drop("buckets", "crowded", "classes", "copies", "leaders", "pull")

    links: DataFrame | None = None
    labels: DataFrame | None = None

    def joined(found: DataFrame, name: str) -> bool:
        nonlocal links, labels
        if found.isEmpty():
            return False
        links = found if links is None else links.unionByName(found)
        labels = components(work, links, name)
        return True

    turn = 0
    while True:
        # one centre a bucket: the text with the most pull, in later turns the one with the most pull outside the largest component
        asked = pool if turn == 0 else pool.where(f"outside > {block}")
        centres = work.write((asked if turn == 0 else asked.where("component <> led")).groupBy("bucket").agg(F.min_by(F.struct("cls", "n_shingles", "component"), F.struct(-F.col("pull"), F.col("cls"))).alias("centre")), f"centres_{turn}")
        near = (F.col("n_shingles") * 100 >= F.col("centre.n_shingles") * threshold) & (F.col("centre.n_shingles") * 100 >= F.col("n_shingles") * threshold)
        star = asked.join(centres, "bucket").where((F.col("component") != F.col("centre.component")) & near)
        edges = work.write(star.select(F.col("cls").alias("a"), F.col("centre.cls").alias("b")).distinct(), f"edges_{turn}")
        found = work.write(_confirmed(edges, sets, threshold), f"links_{turn}")
        joined(found, f"cc_{turn}")
        # a centre has met every member of its bucket outside its component: what is left are the pairs of the others
        met = centres.select("bucket", F.col("centre.cls").alias("cls"))
        left = pool.select("bucket", "cls", "n_shingles", "pull").join(met, ["bucket", "cls"], "left_anti")
        left = left.withColumn("component", F.col("cls")) if labels is None else left.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        left = work.write(left, f"left_{turn}")
        counts = left.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        mixed = counts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("led"), F.max("n").alias("led_n"), (F.sum("n") - F.max("n")).alias("outside")).where("parts > 1").drop("parts")
        pool = work.write(left.join(work.write(mixed, f"mixed_{turn}"), "bucket"), f"pool_{turn + 1}")
        work.drop(f"centres_{turn}", f"left_{turn}", f"mixed_{turn}", f"pool_{turn}")
        pays = found.count() * PAYS >= edges.count()
        turn += 1
        if not pays or pool.where(f"outside > {block}").isEmpty():
            break
    if not pool.isEmpty():
        joined(work.write(_finish(work, pool, sets, threshold, block), "links_blocks"), "cc_blocks")
    work.drop("sets", "groups", f"pool_{turn}")
    linked = member.select("id", "cls") if labels is None else member.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("id", F.coalesce("component", "cls").alias("cls"))
    return sig.select("id", "n_shingles").join(linked.where("id <> cls"), "id", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.coalesce("cls", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("cls", "id"), F.lit(True)).alias("kept"),
    )
