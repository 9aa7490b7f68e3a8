"""Operators whose results are exact: against libraries and plain code."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import media, neardup, piece_bpe, sharding, token_counts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_token_counts(odd):
    from tokenizers import Tokenizer

    df = odd.unionByName(odd.limit(1).withColumn("text", F.lit("a<|endoftext|>b it's  12 ²½ ı x")))
    tok = Tokenizer.from_file(BPE)
    expected = sorted(((r.doc_id, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in df.collect()), key=repr)
    out = token_counts.count_tokens(df, BPE)
    assert by_row(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert out.columns.count("n_tokens") == 1 and "score" in out.columns
    assert token_counts.count_tokens(df.limit(0), BPE).count() == 0


def test_frequent_table_changes_no_count():
    table = {"a": 1, " the": 1, "\n": 1}
    assert token_counts.unpack(token_counts.pack(table)) == table and token_counts.unpack(token_counts.pack({})) == {}
    lengths = token_counts.Lengths(BPE, {})
    lengths.most = 3
    assert [lengths.count("the quick brown fox jumps over the lazy dog") for _ in range(3)] == [9, 9, 9] and len(lengths) <= 3


def test_pieces(odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for r in odd.collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    out = piece_bpe.encode_pieces(odd, PIECES)
    assert by_row(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert piece_bpe.encode_pieces(odd.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "▁x▁▁", "\x00\n\t", "aaaaaaaaaaaaaaaa", "<s></s><unk><0x0A>", "中文の🙂é", "....----====    0000"])
def test_piece_corners(text):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = piece_bpe.codec(PIECES).encode(text)
    assert ids.tolist() == sp.encode(text, add_bos=True, add_eos=True)
    assert piece_bpe.codec(PIECES).decode(ids) == sp.decode(ids.tolist())


def test_piece_cache_generations(monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_ENTRIES", 2)
    coder = piece_bpe.Codec(PIECES)
    text = "some words come back and some words never come back"
    assert coder.encode(text).tolist() == coder.encode(text).tolist() == coder.table.model.encode(text, add_bos=True, add_eos=True)
    assert len(coder) <= 2 and len(coder.old) <= 2


def plain_jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b, key = j, (key * sharding.MULTIPLIER + 1) & ((1 << 64) - 1)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(10**9, 10**9 + 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 64, 1000):
        assert by_row(df.select("k", sharding.jump_shard("k", n).alias("s")), "k", "s") == sorted(((k, plain_jump(k, n)) for k in keys), key=repr)


def test_shards_grow_only_into_the_new_one(odd, spark):
    df = spark.range(0, 40_000, 7).withColumnRenamed("id", "doc_id").withColumn("slot", F.lit("clash"))
    rows = sharding.assign_shards(df, 8, rows_per_bucket=50).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    assert max(map(len, slots.values())) < 1.3 * min(map(len, slots.values()))
    out = sharding.assign_shards(odd, 8)
    assert out.count() == odd.count() and {r.shard for r in out.where("doc_id IS NULL").collect()} == {plain_jump(0, 8)}
    assert sharding.assign_shards(odd.limit(0), 8).count() == 0


def test_media_round_trip(odd):
    out = {(r.doc_id, r.n_bytes): r for r in media.store_texts(odd).collect()}
    for r in odd.collect():
        raw = (r.text or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
        got = out[r.doc_id, len(raw)]
        assert media.read_samples(got.media) == payload and payload in got.media
        assert (got.payload_bytes, got.payload_sha256, got.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        at, packets = len(got.media) - len(payload), len(payload) // 64
        ranges = [(at + 64 * k, 64) for k in range(0, packets, 16)]
        said = {"codec": "raw ", "handler": "soun", "timescale": 8000, "duration": len(payload), "seconds": len(payload) / 8000, "samples": packets, "keyframes": len(ranges), "keyframe_bytes": 64 * len(ranges), "keyframes_sha256": hashlib.sha256(b"".join(x.to_bytes(8, "little") for r in ranges for x in r)).hexdigest()}
        assert json.loads(got.feature) == said and [tuple(k) for k in got.keyframes] == ranges
        assert (got.media_bytes, got.media_sha256) == (len(got.media), hashlib.sha256(got.media).hexdigest())
    assert media.store_texts(odd.limit(0)).count() == 0


def test_media_scan(spark):
    good = media.store_samples(bytes(64 * 40))
    df = spark.createDataFrame([(1, good), (2, None), (3, b""), (4, good[:-10]), (5, b"\x00\x00\x00\x01mdat"), (6, good[:200] + b"\xff" * 60 + good[260:])], "id int, media binary")
    got = {r.id: r for r in media.scan_media(df, "media").collect()}
    track = got[1].tracks[0]
    assert (got[1].brand, track.codec, track.timescale, track.duration, track.samples, len(track.keyframes)) == ("qt  ", "raw ", 8000, 2560, 40, 3)
    at = good.find(b"mdat") + 4
    assert [tuple(k) for k in track.keyframes] == [(at, 64), (at + 16 * 64, 64), (at + 32 * 64, 64)]
    assert got[2].tracks == got[3].tracks == [] and got[2].media_error is None and got[4].media_error and got[5].media_error


def fragmented() -> tuple[bytes, list[tuple[int, int]]]:
    """A container whose only samples are in two fragments, and the byte ranges of its sync samples, said by hand."""
    box, full = media._box, media._full
    trak = box(b"trak", full(b"tkhd", bytes(8), (7).to_bytes(4, "big"), bytes(68)), box(b"mdia", full(b"mdhd", bytes(8), (1000).to_bytes(4, "big"), bytes(8)), full(b"hdlr", bytes(4), b"vide", bytes(12)), box(b"minf", box(b"stbl", full(b"stsd", (1).to_bytes(4, "big"), box(b"avc1", bytes(8)))))))
    head = box(b"ftyp", b"iso6", bytes(4)) + box(b"moov", trak, box(b"mvex", full(b"trex", *(k.to_bytes(4, "big") for k in (7, 1, 40, 10, 0x10000)))))
    out, ranges = head, []
    for sizes in ((10, 20, 30), (5, 6)):
        table = b"".join(k.to_bytes(4, "big") for k in sizes)

        def moof(shift):
            return box(b"moof", full(b"mfhd", bytes(4)), box(b"traf", full(b"tfhd", (7).to_bytes(4, "big"), flags=0x20000), full(b"trun", len(sizes).to_bytes(4, "big"), shift.to_bytes(4, "big"), (0).to_bytes(4, "big"), table, flags=0x205)))

        first = moof(len(moof(0)) + 8)
        ranges.append((len(out) + len(first) + 8, sizes[0]))
        out += first + box(b"mdat", bytes(sum(sizes)))
    return out, ranges


def test_fragments():
    data, ranges = fragmented()
    (track,) = media.tracks(data)
    assert (track.codec, track.samples(), track.length(), track.keyframes()) == ("avc1", 5, 200, ranges)


def test_compact_sizes():
    for width, raw, sizes in ((4, b"\x12\x30", [1, 2, 3]), (8, b"\x05\xff\x07", [5, 255, 7]), (16, b"\x01\x00\x00\x02\x00\x03", [256, 2, 3])):
        body = bytes(7) + bytes([width]) + (3).to_bytes(4, "big") + raw
        assert media._compact_sizes(body, 0, len(body)).tolist() == sizes


def test_no_bytes_but_broken_media():
    """10,000 disturbed containers: fields set to extremes, bytes changed, ends cut. Nothing but BrokenMedia is raised, and what is read lies inside."""
    rnd = random.Random(3)
    good = [media.store_samples(media.pad(bytes(rnd.randrange(256) for _ in range(n)))) for n in (1, 5_000, 20_000)] + [fragmented()[0]]
    broken = 0
    for _ in range(10_000):
        data = bytearray(rnd.choice(good))
        for _ in range(rnd.choice((1, 1, 2, 5))):
            at = rnd.randrange(min(len(data), 900))
            kind = rnd.randrange(3)
            if kind == 0:
                data[at : at + 4] = rnd.choice((b"\xff\xff\xff\xff", b"\0\0\0\0", b"\x7f\xff\xff\xff", b"\0\0\0\1", b"\x80\0\0\0"))
            elif kind == 1:
                data[at] = rnd.randrange(256)
            else:
                del data[rnd.randrange(len(data)) :]
                data += b"" if data else b"\0"
        data = bytes(data)
        try:
            for track in media.tracks(data):
                assert all(0 <= a and a + n <= len(data) for a, n in track.keyframes())
        except media.BrokenMedia:
            broken += 1
    assert 1_000 < broken < 10_000


def test_deep_and_greedy_boxes():
    deep = b""
    for _ in range(100):
        deep = media._box(b"moov", deep)
    good = bytearray(media.store_samples(bytes(6400)))
    for kind, field, value in ((b"stsz", 12, 2**32 - 1), (b"stsc", 12, 2**32 - 1), (b"stss", 12, 0), (b"stss", 12, 2**31), (b"stco", 8, 2**32 - 1)):
        bad = bytearray(good)
        at = bad.find(kind) + 4 + field - 4
        bad[at : at + 4] = value.to_bytes(4, "big")
        if kind != b"stsc":
            with pytest.raises(media.BrokenMedia):
                [t.keyframes() for t in media.tracks(bytes(bad))]
    with pytest.raises(media.BrokenMedia):
        media.tracks(deep)


def plain_sets(texts):
    out = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    return out


def plain_components(sets):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        k = len(x & y)
        if x and y and 100 * k >= 75 * (len(x) + len(y) - k):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: find(i) for i in sets}


def test_near_duplicates(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    sets = plain_sets(rows)
    expected = plain_components(sets)
    got = neardup.near_duplicates(corpus).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}
    assert len(set(expected.values())) < len(expected)


def test_few_edges_send_sets_once(spark, corpus, monkeypatch):
    """Few candidates are broadcast to their sets; many are shuffled, with the same result."""
    edges, sets = spark.createDataFrame([(2, 1)], "a long, b long"), neardup.full_sets(corpus, "doc_id", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = neardup._confirmed(edges, sets, 75)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # both sides of the join with centres
    monkeypatch.setattr(neardup, "FEW_EDGES", 0)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", 0)
    expected = plain_components(plain_sets([(r.doc_id, r.text) for r in corpus.collect()]))
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(corpus).collect()} == expected


def test_near_duplicate_corners(odd):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect()}
    assert got[0, 0] == (0, True) and got[1, 0] == (1, True) and got[2, 0] == (2, True)
    assert got[4, 3] == (4, True) and got[5, 3] == (4, False) and got[None, 3] == (None, True) and got[3, 1] == (3, True)
    assert neardup.near_duplicates(odd).count() == odd.count() and neardup.near_duplicates(odd.limit(0)).count() == 0


def test_three_of_four_shingles_are_linked(spark):
    df = spark.createDataFrame([(7, "a b c d e f g h"), (9, "a b c d e f g"), (12, "a b c d e f")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == {7: 7, 9: 7, 12: 12}


def test_links_of_a_bucket_led_by_other_texts(spark):
    """One bucket for all: its first centres are linked with nothing, while texts behind them are linked with each other."""
    probes = neardup.probe_order(1)
    for seed in range(1000):
        rnd = np.random.default_rng(seed)
        words = lambda n: [f"w{k}" for k in rnd.integers(0, 10**9, n)]
        shared, families = words(60), [words(16) for _ in range(8)]
        texts = [" ".join(shared + f) for f in families] + [" ".join([*shared, *f[:-1], "other"]) for f in families[3:]]
        sets = plain_sets(enumerate(texts))
        hashed = [neardup.shingle_hashes(*neardup.word_hashes(*neardup.text_buffer(pa.array([t])), neardup.separators()), 5) for t in texts]
        if len({int(neardup.signature(next(iter(h)), 1, probes)[0]) for h in hashed}) == 1:
            break
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = plain_components(sets)
    assert len(set(expected.values())) == 8
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, bands=1, rows=1).collect()} == expected


def test_a_key_with_very_many_rows_is_split(spark):
    """Null keys fill one bucket far beyond its size: slots stay gapless, and no window holds them all."""
    df = spark.range(4_000).select(F.when(F.col("id") >= 3_000, F.col("id")).alias("doc_id"), F.col("id").alias("n"), F.lit("c").alias("slot"))
    out = sharding.assign_shards(df, 8, rows_per_bucket=100)
    rows = out.collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == 4_000 and {r.n for r in rows} == set(range(4_000))
    assert {r.shard for r in rows if r.doc_id is None} == {plain_jump(0, 8)}
    assert "__part" in out._jdf.queryExecution().analyzed().toString()


def test_other_files_are_refused(tmp_path):
    spec = json.loads(open(BPE, encoding="utf-8").read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({k: v for k, v in (spec | change).items() if k != "model"} | {"model": {"type": "BPE"}}))
        with pytest.raises(token_counts.UnsupportedTokenizer):
            token_counts.check_file(str(path))
    token_counts.check_file(BPE)


@pytest.mark.parametrize("block", [1024, 16])
def test_links_inside_a_template_family(spark, block):
    """All texts share one template at just under the threshold, and 30 pairs of them reach it: whatever the blocks, each pair is found."""
    rnd = random.Random(5)
    template = [f"t{k}" for k in range(104)]
    own = lambda i, n: [f"{i}o{k}" for k in range(n)]
    texts = [" ".join(template + own(i, 18)) for i in range(150)]
    for i in range(150, 180):
        texts += [" ".join(template + own(i, 18)), " ".join(template + own(i, 4) + own(-i, 14))]
    rnd.shuffle(texts)
    expected = plain_components(plain_sets(enumerate(texts)))
    assert len(set(expected.values())) == len(texts) - 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, block=block).collect()} == expected


def test_counts_by_products_are_those_of_sets():
    rnd = np.random.default_rng(8)
    sets = [np.unique(rnd.integers(0, 90, rnd.integers(1, 60))).astype(np.uint64) for _ in range(40)]
    shared = neardup.shared_counts(sets, cells=200)
    component = np.arange(40)
    component[:5] = 0
    pairs = {(i, j) for i, j in combinations(range(40), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))}
    assert all(shared[i, j] == len(np.intersect1d(sets[i], sets[j])) for i, j in combinations(range(40), 2))
    found = neardup.linked_pairs(sets, component, 40)

    def parts(pairs):
        label = component.copy()
        for _ in range(40):
            for i, j in pairs:
                label[[i, j]] = min(label[i], label[j])
            label = np.array([label[component == c].min() for c in component])
        return label.tolist()

    assert set(found) <= pairs and len(found) < 40 and parts(found) == parts(pairs)


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(3)
    probes = neardup.probe_order(255)
    for size in (4, 40, 400, 4000):
        pool = rnd.integers(0, 2**63, size * 5 // 4 + 1).astype(np.uint64) * np.uint64(2)
        a, b = np.unique(pool[:size]), np.unique(pool[size // 4 :])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(np.mean(neardup.signature(a, 255, probes) == neardup.signature(b, 255, probes)) - true) < (0.25 if size < 10 else 0.12)


def test_counter_of_words_is_that_of_hashes():
    import pyarrow as pa

    from corpusforge.llm.wordhash import separators, text_buffer, word_hashes

    texts = ["A b\tc", None, "", "b a É é", " c"]
    words, first = word_hashes(*text_buffer(pa.array(texts)), separators())
    split = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "").split() for t in texts]
    assert np.diff(first).tolist() == [len(s) for s in split]
    assert sorted(Counter(words.tolist()).values()) == sorted(Counter(w for s in split for w in s).values())
