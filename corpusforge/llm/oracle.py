"""SQL of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

from .sharding import MODULUS, MULTIPLIER

#: CRC-32 of UTF-8 bytes: the table from its rule, the bytes from code points.
_CRC_BIT = "CASE WHEN {x} % 2 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"


def _crc_table() -> str:
    out = "CAST(i AS BIGINT)"
    return f"list_transform(range(256), lambda i: list_reduce(list_prepend({out}, CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda c, z: {_CRC_BIT.format(x='c')}))"


_BYTES = """flatten(list_transform(string_split(t, ''), lambda c: CASE WHEN unicode(c) < 0 THEN CAST([] AS BIGINT[]) WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
  WHEN unicode(c) < 2048 THEN [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] WHEN unicode(c) < 65536 THEN [224 + (unicode(c) >> 12), 128 + ((unicode(c) >> 6) & 63), 128 + (unicode(c) & 63)]
  ELSE [240 + (unicode(c) >> 18), 128 + ((unicode(c) >> 12) & 63), 128 + ((unicode(c) >> 6) & 63), 128 + (unicode(c) & 63)] END))"""


def _jump(key: str, shards: int) -> str:
    """Jump consistent hash, one step for each element of a list."""
    state = f"{{'g': CAST(({key} + 18446744073709551616) % {MODULUS} AS HUGEINT), 'b': CAST(-1 AS BIGINT), 'j': CAST(0 AS BIGINT)}}"
    following = f"(s.g * {MULTIPLIER} + 1) % {MODULUS}"
    step = f"CASE WHEN s.j >= {shards} THEN s ELSE {{'g': {following}, 'b': s.j, 'j': CAST(floor((s.j + 1) * (CAST(2147483648 AS DOUBLE) / CAST(({following}) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)}} END"
    return f"list_reduce(list_transform(range({shards + 1}), lambda i: {state}), lambda s, x: {step}).b"


SHARDING = f"""
WITH crc AS (SELECT {_crc_table()} AS tab),
rows AS (SELECT doc_id, coalesce(text, '') AS t, CAST(coalesce(doc_id, 0) AS HUGEINT) AS k FROM documents),
hashed AS (SELECT doc_id, CAST(strlen(t) + 1 AS BIGINT) AS size, CASE WHEN t = '' THEN 0 ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BYTES}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) END AS text_crc32,
  CAST({_jump('k', 8)} AS INT) AS shard, CAST({_jump('k', 9)} AS INT) AS grown_shard,
  CAST(((k % 2147483629 + 2147483629) % 2147483629 * 48271 + 11) % 2147483647 AS BIGINT) AS mixed FROM rows, crc),
placed AS (SELECT *, mixed % greatest(64, CAST(ceil((SELECT count(*) FROM documents) / 1600000.0) AS BIGINT)) AS bucket FROM hashed)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM placed
"""

#: All pairs of documents that share a shingle; components by following links.
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(x) AS h, x FROM (SELECT doc_id, s, unnest(s) AS x FROM sets)),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.h = b.h AND a.x = b.x AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 75 AND b.n * 100 >= a.n * 75
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reached GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept FROM sets LEFT JOIN least ON doc_id = a
"""

def _hex(*fields: int | str, size: int = 4) -> str:
    """Big-endian numbers of `size` bytes, or names of boxes, as hex digits."""
    return "".join(f.encode().hex() if isinstance(f, str) else f"{f:0{2 * size}x}" for f in fields)


#: The container of a text, as hex digits, field by field: constant parts first, then the tables, whose sizes follow the number of packets.
_UNIT = _hex(0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
_ENTRY = _hex(36, "raw ") + "00" * 6 + _hex(1, 0, 0, size=2) + _hex(0) + _hex(1, 8, 0, 0, size=2) + _hex(8000 << 16)
_STSD = _hex(52, "stsd", 0, 1) + _ENTRY
_SMHD_DINF = _hex(16, "smhd", 0, 0) + _hex(36, "dinf") + _hex(28, "dref", 0, 1) + _hex(12, "url ", 1)
_HDLR = _hex(40, "hdlr", 0, 0, "soun", 0, 0, 0) + "samples\0".encode().hex()
_U32 = lambda x: f"printf('%08x', {x})"
_U64 = lambda x: f"printf('%016x', {x})"
_MDHD = f"'{_hex(44, 'mdhd', 1 << 24, 0, 0, 0, 0, 8000)}' || {_U64('size')} || '{_hex(0x55C4, 0, size=2)}'"
_TKHD = f"'{_hex(104, 'tkhd', 1 << 24 | 3, 0, 0, 0, 0, 1, 0)}' || {_U64('size')} || '{_hex(0, 0) + _hex(0, 0, 0x100, 0, size=2) + _UNIT + _hex(0, 0)}'"
_MVHD = f"'{_hex(120, 'mvhd', 1 << 24, 0, 0, 0, 0, 8000)}' || {_U64('size')} || '{_hex(0x10000) + _hex(0x100, size=2) + '00' * 10 + _UNIT + '00' * 24 + _hex(2)}'"
MEDIA = f"""
WITH crc AS (SELECT {_crc_table()} AS tab),
raw AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS body FROM documents),
padded AS (SELECT doc_id, length(body) // 2 AS n_bytes, body || repeat('00', CASE WHEN body = '' THEN 64 ELSE (64 - length(body) // 2 % 64) % 64 END) AS payload FROM raw),
sized AS (SELECT *, length(payload) // 2 AS size, length(payload) // 128 AS packets FROM padded),
counted AS (SELECT *, (packets + 63) // 64 AS chunks, (packets + 15) // 16 AS syncs FROM sized),
laid AS (SELECT *, CASE WHEN chunks = 1 OR packets % 64 = 0 THEN 1 ELSE 2 END AS runs FROM counted),
measured AS (SELECT *, 8 + 52 + 24 + 16 + 12 * runs + 20 + 16 + 4 * chunks + 16 + 4 * syncs AS stbl FROM laid),
placed AS (SELECT *, stbl + 60 AS minf, stbl + 60 + 8 + 44 + 40 AS mdia FROM measured),
moved AS (SELECT *, mdia + 8 + 104 AS trak, mdia + 8 + 104 + 8 + 120 AS moov FROM placed),
started AS (SELECT *, 20 + moov + 8 AS start FROM moved),
tables AS (SELECT *, '{_STSD}' || '{_hex(24, "stts", 0, 1)}' || {_U32('packets')} || '{_hex(64)}' || {_U32('16 + 12 * runs')} || '{_hex("stsc", 0)}' || {_U32('runs')}
    || CASE WHEN runs = 1 THEN '{_hex(1)}' || {_U32('least(64, packets)')} || '{_hex(1)}' ELSE '{_hex(1, 64, 1)}' || {_U32('chunks')} || {_U32('packets % 64')} || '{_hex(1)}' END
    || '{_hex(20, "stsz", 0, 64)}' || {_U32('packets')} || {_U32('16 + 4 * chunks')} || '{_hex("stco", 0)}' || {_U32('chunks')} || array_to_string(list_transform(range(chunks), lambda i: {_U32('start + i * 4096')}), '')
    || {_U32('16 + 4 * syncs')} || '{_hex("stss", 0)}' || {_U32('syncs')} || array_to_string(list_transform(range(syncs), lambda i: {_U32('i * 16 + 1')}), '') AS stbl_body FROM started),
stored AS (SELECT *, '{_hex(20, "ftypqt  ", 0, "qt  ")}' || {_U32('moov')} || '{_hex("moov")}' || {_MVHD} || {_U32('trak')} || '{_hex("trak")}' || {_TKHD} || {_U32('mdia')} || '{_hex("mdia")}' || {_MDHD} || '{_HDLR}'
    || {_U32('minf')} || '{_hex("minf")}' || '{_SMHD_DINF}' || {_U32('stbl')} || '{_hex("stbl")}' || stbl_body || {_U32('size + 8')} || '{_hex("mdat")}' || payload AS media FROM tables),
little AS (SELECT *, list_transform(range(syncs), lambda i: {_U32('start + i * 1024')}) AS offsets FROM stored)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(size AS BIGINT) AS payload_bytes, sha256(unhex(payload)) AS payload_sha256,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(64), lambda i: CAST('0x' || substr(payload, length(payload) - 127 + 2 * i, 2) AS BIGINT))), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS tail_crc32,
  CAST(length(media) // 2 AS BIGINT) AS media_bytes, sha256(unhex(media)) AS media_sha256,
  '{{"codec": "raw ", "duration": ' || size || ', "handler": "soun", "keyframe_bytes": ' || 64 * syncs || ', "keyframes": ' || syncs || ', "keyframes_sha256": "'
    || sha256(unhex(array_to_string(list_transform(offsets, lambda o: substr(o, 7, 2) || substr(o, 5, 2) || substr(o, 3, 2) || substr(o, 1, 2) || '000000004000000000000000'), '')))
    || '", "samples": ' || packets || ', "seconds": ' || CAST(size / 8000 AS DOUBLE) || ', "timescale": 8000}}' AS feature,
  array_to_string(list_transform(range(syncs), lambda i: (start + i * 1024) || '+64'), ',') AS keyframes
FROM little, crc
"""

ORACLE_SQL = {"op3_sharding": SHARDING, "op5_media_columns": MEDIA, "op7_minhash_dedup": NEAR_DUPLICATES}
