"""The SQL of the queries, for DuckDB. Fixed values (word lists, patterns) come from the same constants as the Spark side; the logic is SQL's own."""

from __future__ import annotations

from ..functions import sentences as S
from ..functions import text as T
from ..operators import audit, tools
from ..operators import conversations as C

WS = T.WS


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def strings(values) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def normalize(x: str) -> str:
    table = "".join(T.REPLACED) + "".join(T.DROPPED)
    moved = f"translate(coalesce({x}, ''), {q(table)}, {q(''.join(T.REPLACED.values()))})"
    return strip(f"regexp_replace(regexp_replace({moved}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def category(x: str) -> str:
    name = f"regexp_replace(replace({strip(f'lower(coalesce({x}, ' + q('') + '))')}, ' ', '_'), '[^a-z0-9_]', '', 'g')"
    return f"CASE WHEN {name} = '' THEN 'unknown' ELSE {name} END"


def fingerprint(x: str) -> str:
    kept = f"regexp_replace(lower({x}), '{WS.replace('[', '[^a-z0-9', 1)}', '', 'g')"
    return f"substr(sha256({strip(f'regexp_replace({kept}, ' + q(WS + '+') + ', ' + q(' ') + ', ' + q('g') + ')')}), 1, 16)"


def english(x: str) -> str:
    letters = f"length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))"
    latin = f"length(regexp_replace(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'), '[^\\x{{0000}}-\\x{{024F}}]', '', 'g'))"
    return f"({letters} >= 20 AND {latin} / {letters} > 0.85)"


def word_count(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> ''))"


def contains_any(x: str, phrases) -> str:
    return f"list_bool_or(list_transform({strings(phrases)}, lambda p: contains({x}, p)))"


def low_quality(x: str) -> str:
    return f"(length({strip(f'coalesce({x}, ' + q('') + ')')}) < 50 OR {contains_any(f'lower({strip(x)})', T.AI_SPEAK)})"


def strip_thinking(x: str) -> str:
    return strip(f"regexp_replace(coalesce({x}, ''), '(?s)<think>.*?</think>', '', 'g')")


def order_hash(seed: str, *keys: str) -> str:
    return f"sha256(concat_ws(':', {q(seed)}, {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def pick_number(digest: str, n: int) -> str:
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % {n})"


def pick(options, digest: str) -> str:
    return f"({strings(options)})[{pick_number(digest, len(options))} + 1]"


def display(x: str) -> str:
    words = f"string_split(replace({x}, '_', ' '), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"


def system_prompt(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') = '' THEN {q(C.BASE_PROMPT)} ELSE {q(C.BASE_PROMPT)} || chr(10) || chr(10) || 'The topic at hand is ' || {display(x)} || '.' END"


def sentences(x: str) -> str:
    """The sentences of a text, as a list."""
    out = f"coalesce({x}, '')"
    for d in S.DOTTED:
        out = f"regexp_replace({out}, '(?i)({d[0]})\\.({d[2]})\\.', '\\1' || chr(2) || '\\2' || chr(2), 'g')"
    out = f"regexp_replace({out}, {q(S.ABBREVIATION)}, '\\1\\2' || chr(2), 'g')"
    out = f"regexp_replace({out}, {q(S.LINE_END)}, chr(1), 'g')"
    out = f"regexp_replace({out}, {q(S.SENTENCE_END)}, '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split(replace({out}, chr(2), '.'), chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def chunks(sents: str, most: int = S.CHUNK, overlap: int = S.OVERLAP) -> str:
    """The greedy fold over a list of sentences."""
    state = f"list_transform({sents}, lambda s: {{'done': CAST([] AS VARCHAR[]), 'cur': [s], 'n': CAST(length(s) AS BIGINT)}})"
    carry = f"list_slice(a.cur, -{overlap}, -1)"
    carried = f"CAST(list_sum(list_transform({carry}, lambda c: length(c))) + len({carry}) - 1 AS BIGINT)"
    step = (
        f"CASE WHEN a.n + x.n + 1 > {most} THEN {{'done': list_append(a.done, array_to_string(a.cur, ' ')), 'cur': list_concat({carry}, x.cur), 'n': {carried} + x.n + 1}} "
        f"ELSE {{'done': a.done, 'cur': list_concat(a.cur, x.cur), 'n': a.n + x.n + 1}} END"
    )
    folded = f"list_reduce({state}, lambda a, x: {step})"
    return f"CASE WHEN len({sents}) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform([{folded}], lambda f: list_filter(list_append(f.done, array_to_string(f.cur, ' ')), lambda c: length(c) > {S.LEAST}))[1] END"


def token_chunks(sents: str, most: int = S.TOKEN_CHUNK) -> str:
    state = f"list_transform({sents}, lambda s: {{'done': CAST([] AS VARCHAR[]), 'cur': [s], 'n': CAST(length(s) // 4 AS BIGINT)}})"
    step = f"CASE WHEN a.n + x.n > {most} THEN {{'done': list_append(a.done, array_to_string(a.cur, ' ')), 'cur': x.cur, 'n': x.n}} ELSE {{'done': a.done, 'cur': list_concat(a.cur, x.cur), 'n': a.n + x.n}} END"
    folded = f"list_reduce({state}, lambda a, x: {step})"
    return f"CASE WHEN len({sents}) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform([{folded}], lambda f: list_filter(list_append(f.done, array_to_string(f.cur, ' ')), lambda c: length(c) > {S.LEAST}))[1] END"


SENTENCES = f"SELECT doc_id, source, text, {sentences('text')} AS sents FROM documents"
CHUNKS = f"SELECT doc_id, source, ix - 1 AS ix, cs[ix] AS chunk FROM (SELECT doc_id, source, cs, unnest(range(1, len(cs) + 1)) AS ix FROM (SELECT doc_id, source, {chunks('sents')} AS cs FROM ({SENTENCES})))"
TOKEN_CHUNKS = f"SELECT doc_id, source, ix - 1 AS ix, cs[ix] AS chunk FROM (SELECT doc_id, source, cs, unnest(range(1, len(cs) + 1)) AS ix FROM (SELECT doc_id, source, {token_chunks('sents')} AS cs FROM ({SENTENCES})))"
SEED_SPLIT = f"""
SELECT doc_id, source, ix, array_to_string(sents[1:k], ' ') AS seed, array_to_string(sents[k + 1:], ' ') AS completion
FROM (SELECT *, least(coalesce(list_filter(range(1, len(sents)), lambda i: list_sum(w[1:i]) >= {S.SEED_TOKENS * 0.6} OR list_sum(w[1:i + 1]) > {S.SEED_TOKENS * 1.3})[1], len(sents)), len(sents) - 1) AS k
      FROM (SELECT *, list_transform(sents, lambda s: length(s) // 4) AS w FROM (SELECT *, {sentences('chunk')} AS sents FROM ({TOKEN_CHUNKS}))
            WHERE len(sents) >= 2 AND length(chunk) // 4 > {S.SEED_TOKENS} + 20))
"""

CLEAN = f"""
ruled AS (
  SELECT idx, title, abstract, cancer_type, CASE
    WHEN length(title) < 10 THEN 'no_title' WHEN length(abstract) < 200 THEN 'short_abstract' WHEN length(abstract) > 15000 THEN 'too_long'
    WHEN regexp_matches(lower(title || ' ' || abstract), {q(T.RETRACTION)}) THEN 'retracted' WHEN NOT {english('abstract')} THEN 'non_english' END AS reason
  FROM (SELECT doc_id AS idx, {normalize('substr(text, 1, 80)')} AS title, {normalize('text')} AS abstract, {category('source')} AS cancer_type FROM documents)),
annotated AS (
  SELECT r.*, coalesce(reason, CASE WHEN idx > min(CASE WHEN reason IS NULL THEN idx END) OVER (PARTITION BY {fingerprint('abstract')}) THEN 'duplicate' END) AS drop_reason FROM ruled r)
"""

#: Conversations as lists; every third has its answers behind a thinking block, as the Spark side does.
THINK = "CASE WHEN conv_id % 3 = 0 AND role = 'assistant' THEN '<think>' || substr(text, 1, 40) || '</think>' || text ELSE text END"
CONV = f"""
SELECT conv_id, list({{'from': CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END, 'value': {THINK}}} ORDER BY turn) AS conv FROM conversations GROUP BY conv_id
"""
FORMAT_ERROR = """CASE WHEN len(conv) < 3 THEN 'too few turns' ELSE list_filter(list_transform(range(0, len(conv)), lambda i:
  CASE WHEN conv[i + 1]."from" <> CASE WHEN i = 0 THEN 'system' WHEN i % 2 = 1 THEN 'human' ELSE 'gpt' END
  THEN 'turn ' || i || ': expected ' || CASE WHEN i = 0 THEN 'system' WHEN i % 2 = 1 THEN 'human' ELSE 'gpt' END || ', got ' || conv[i + 1]."from" END), lambda e: e IS NOT NULL)[1] END"""
TEMPLATE = "array_to_string(list_transform(conv, lambda t: '<|im_start|>' || CASE t.\"from\" WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE t.\"from\" END || chr(10) || t.value || '<|im_end|>' || chr(10)), '')"


def sampled(table: str, stratum: str, key: str, seed: str, quota: str) -> str:
    """The first `quota` rows of each stratum by hash; quota is SQL over n (the stratum's rows) and total."""
    return f"""SELECT {key}, {stratum} FROM (
      SELECT {key}, {stratum}, row_number() OVER (PARTITION BY {stratum} ORDER BY {order_hash(seed, key)}, {key}) AS r, count(*) OVER (PARTITION BY {stratum}) AS n, count(*) OVER () AS total FROM {table})
      WHERE r <= {quota}"""


STUB_SUBJECT = strip("regexp_replace(substr(chunk, 1, 40), '[^A-Za-z0-9 ]', '', 'g')")


def stub_question(round_: int, k: str) -> str:
    return f"'Question {round_ + 1}.' || ({k}) || ': what does the source say about ' || {STUB_SUBJECT} || '?'"


def with_reasoning(content: str, reasoning: str) -> str:
    return f"CASE WHEN {strip(reasoning)} <> '' THEN '<think>' || chr(10) || {strip(reasoning)} || chr(10) || '</think>' || chr(10) || chr(10) || {strip(content)} ELSE {strip(content)} END"


STUB_ANSWER = with_reasoning("('The source says: ' || substr(chunk, 1, 200))", "('Asked: ' || question)")
QA = f"""
SELECT doc_id, ix, question_ix, question, answer, substr(chunk, 1, 100) AS chunk_key, source, chunk FROM (
  SELECT *, {STUB_ANSWER} AS answer FROM (SELECT *, {stub_question(0, 'question_ix + 1')} AS question FROM (SELECT *, unnest([0, 1, 2]) AS question_ix FROM ({CHUNKS}))))
WHERE NOT {low_quality('answer')}
"""
LEAK = f"answer || CASE WHEN (x.doc_id + ix) % 11 = 0 THEN ' {T.LEAKS[2]}' ELSE '' END"
REPLY = "CASE WHEN toxic = 1 THEN 'VERDICT: HALLUCINATED' WHEN quality = 0 THEN 'VERDICT: EXTRAPOLATED' WHEN quality = 1 THEN 'VERDICT: GROUNDED' ELSE 'unclear' END"
VERDICT = f"""
SELECT doc_id, ix, question_ix, source, CASE WHEN {contains_any('lower(told)', T.LEAKS)} THEN 'leaked_reference' WHEN contains(lower(reply), 'verdict: hallucinated') THEN 'hallucinated'
  WHEN contains(lower(reply), 'verdict: extrapolated') THEN 'extrapolated' ELSE 'grounded' END AS verdict
FROM (SELECT x.doc_id, ix, question_ix, source, {LEAK} AS told, {REPLY} AS reply FROM ({QA}) x LEFT JOIN labels l ON x.doc_id = l.doc_id)
"""
PHANTOM_SQL = f"""list_bool_or(list_transform(range(0, len(conv)), lambda i: conv[i + 1]."from" = 'gpt' AND list_bool_or(list_transform({strings(audit.PHANTOM)}, lambda p:
  contains(lower(conv[i + 1].value), p) AND NOT contains(lower(array_to_string(list_transform(conv[1:i], lambda t: t.value), chr(10))), p)))))"""
TOOL_NAMES = strings(tools.TOOLS)
